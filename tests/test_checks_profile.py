"""Checks and profile reports on hand-written rows, against brute force."""

import datetime as dt
from decimal import Decimal

from conftest import raw_rows
from farebox.operators import checks, dims, profile, staging
from farebox.operators.fact import route_unmatched_to_unknown, to_fact
from farebox.params import PipelineParams

P = PipelineParams()


def test_unique_not_null_business_rules(spark):
    raw = raw_rows(spark, dict(vendorid=1), dict(vendorid=1), dict(vendorid=2, dolocationid=None),
                   dict(vendorid=3, fare_amount=-1.0),
                   dict(vendorid=4, tpep_dropoff_datetime=dt.datetime(2024, 1, 10, 7)),
                   dict(vendorid=5, trip_distance=150.0,
                        tpep_dropoff_datetime=dt.datetime(2024, 1, 10, 9)))
    r = staging.renamed(raw)
    dup = checks.check_unique(r, "trip_id").collect()
    assert len(dup) == 1 and dup[0].rows == 2
    nulls = {x.column_name: x.null_rows for x in checks.check_not_null(
        r, ["trip_id", "dropoff_location_id"]).collect()}
    assert nulls == {"trip_id": 0, "dropoff_location_id": 1}
    bad = {x.trip_id: x for x in checks.check_business_rules(staging.stg_trips(raw, P, clean=False)).collect()}
    flags = sorted((x.speed_over_limit, x.negative_amount, x.dropoff_not_after_pickup) for x in bad.values())
    assert flags == [(False, False, True), (False, True, False), (True, False, False)]


def test_relationships_and_unknown_routing(spark):
    raw = raw_rows(spark, dict(vendorid=1, pulocationid=1), dict(vendorid=2, pulocationid=99),
                   dict(vendorid=3, pulocationid=99, payment_type=9), dict(vendorid=4, dolocationid=None))
    f = to_fact(staging.stg_trips(raw, P))
    dim = spark.createDataFrame([(1,), (236,), (-1,)], "location_id int")
    v = sorted((x.column_name, x.key_value, x.rows) for x in checks.check_relationships(f, {
        "pickup_location_id": (dim, "location_id"),
        "payment_type_id": (dims.dim_payment_type(spark), "payment_type_id")}).collect())
    assert v == [("payment_type_id", 9, 1), ("pickup_location_id", 99, 2), ("pickup_location_id", 132, 1)]
    routed = {x.vendor_id: (x.pickup_location_id, x.dropoff_location_id) for x in
              route_unmatched_to_unknown(f, dim, "location_id",
                                         ["pickup_location_id", "dropoff_location_id"]).collect()}
    assert routed == {1: (1, 236), 2: (-1, 236), 3: (-1, 236), 4: (-1, -1)}


def test_reconciliation_and_freshness(spark):
    a = spark.range(5).withColumnRenamed("id", "x")
    b = spark.range(3).withColumnRenamed("id", "x")
    r = checks.check_reconciliation(a, b).first()
    assert (r.staging_rows, r.fact_rows, r.missing_rows, r.passed) == (5, 3, 2, False)
    ev = spark.createDataFrame([(dt.datetime(2024, 1, 31, 12),)], "ts timestamp_ntz")
    f = checks.check_freshness(ev, "ts", dt.datetime(2024, 2, 1), dt.timedelta(hours=24)).first()
    assert (f.age_seconds, f.is_fresh) == (43200, True)
    f = checks.check_freshness(ev, "ts", dt.datetime(2024, 2, 3), dt.timedelta(hours=24)).first()
    assert f.is_fresh is False


def test_star_report_equals_row_level_join(spark):
    """Pre-aggregating the fact before the join gives the inner-join count,
    also with a repeated zone name and a key missing from the dimension."""
    rows = [dict(vendorid=i, pulocationid=[56, 57, 1, 7][i % 4]) for i in range(23)]
    f = to_fact(staging.stg_trips(raw_rows(spark, *rows), P))
    dim = spark.createDataFrame(
        [(56, "Corona", "Queens"), (57, "Corona", "Queens"), (1, "Newark Airport", "EWR")],
        "location_id int, zone_name string, borough string")
    got = {(x.zone_name, x.borough): x.trips for x in profile.trips_by_zone(f, dim).collect()}
    brute = {}
    dl = {r.location_id: (r.zone_name, r.borough) for r in dim.collect()}
    for r in f.collect():
        if r.pickup_location_id in dl:
            brute[dl[r.pickup_location_id]] = brute.get(dl[r.pickup_location_id], 0) + 1
    assert got == brute == {("Corona", "Queens"): 12, ("Newark Airport", "EWR"): 6}
    top = profile.top_pickup_zones(f, dim, k=1).collect()
    assert [(t.zone_name, t.trips) for t in top] == [("Corona", 12)]


def test_busiest_hours_exact_mean(spark):
    ev = spark.createDataFrame(
        [(dt.datetime(2024, 1, 1, 8, m), v) for m, v in [(0, 1.005), (1, 2.0), (2, None)]]
        + [(dt.datetime(2024, 1, 1, 9, 0), 0.01)], "ts timestamp_ntz, value double")
    got = [(r.hour, r.trips, r.avg_fare) for r in profile.busiest_hours(ev, "ts", "value").collect()]
    assert got == [(8, 3, Decimal("1.50")), (9, 1, Decimal("0.01"))]
