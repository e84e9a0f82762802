"""Stored marts give the same reports as the lazy chain."""

from conftest import SF_SMALL
from farebox.operators import dims, profile, staging
from farebox.operators.fact import FACT_COLUMNS, to_fact
from farebox.plans.marts import Marts, build_marts
from farebox.sources import fixtures

P = fixtures.FIXTURE_PARAMS


def test_marts_equal_lazy_chain(spark, scratch):
    raw = fixtures.trip_raw(spark, SF_SMALL)
    seed = fixtures.zone_seed(spark, SF_SMALL)
    m = build_marts(spark, raw, seed, P, scratch("marts"))
    stored = Marts(m.root).read(spark)
    lazy_fact = to_fact(staging.stg_trips(raw, P))
    assert sorted(stored["fct_trips"].select(*FACT_COLUMNS).collect()) == sorted(lazy_fact.collect())
    assert stored["dim_date"].count() == (P.end - P.start).days + 1   # and the unknown member
    assert stored["dim_payment_type"].count() == 8
    lazy_dim = dims.dim_location(seed, P.airport_zones)
    assert (profile.top_pickup_zones(stored["fct_trips"], stored["dim_location"]).collect()
            == profile.top_pickup_zones(lazy_fact, lazy_dim).collect())
    assert (profile.weekend_revenue_by_quarter(stored["fct_trips"], stored["dim_date"]).collect()
            == profile.weekend_revenue_by_quarter(lazy_fact, dims.dim_date(spark, P.start, P.end)).collect())
    # a second build with the same raw is a no-op for the fact
    build_marts(spark, raw, seed, P, m.root)
    assert Marts(m.root).read(spark)["fct_trips"].count() == lazy_fact.count()


def test_refresh_star_loads_then_upserts_loaded_months(spark, scratch):
    from farebox.plans.marts import refresh_star
    from farebox.sources import lake
    from pyspark.sql import functions as F
    src = fixtures.trip_source(spark, SF_SMALL)
    lake_root, raw_root, audit_root, marts_root = (scratch("l"), scratch("r"), scratch("a"), scratch("m"))
    arrived = src.where(F.col("tpep_dropoff_datetime") < F.lit("1998-06-01").cast("timestamp_ntz"))
    lake.build_lake([arrived], lake_root, "tpep_pickup_datetime")
    refresh_star(spark, lake_root, raw_root, audit_root, fixtures.zone_seed(spark, SF_SMALL), P, marts_root)
    lake.build_lake([src], lake_root, "tpep_pickup_datetime")
    m = refresh_star(spark, lake_root, raw_root, audit_root, fixtures.zone_seed(spark, SF_SMALL), P,
                     marts_root)
    # the fact equals a fresh build over what the raw table now holds
    raw_now = spark.read.parquet(raw_root)
    expected = to_fact(staging.stg_trips(raw_now, P))
    got = Marts(m.root).read(spark)["fct_trips"].select(*FACT_COLUMNS)
    assert sorted(got.collect()) == sorted(expected.collect())
