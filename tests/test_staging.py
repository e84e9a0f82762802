import datetime as dt
from decimal import Decimal

from conftest import raw_rows
from farebox.operators import fact, staging
from farebox.params import PipelineParams

P = PipelineParams()
T0 = dt.datetime(2024, 3, 1, 12, 0, 0)


def ids(df):
    return sorted(r[0] for r in df.select("vendor_id").collect())


def test_duration_bounds_are_exact(spark):
    raw = raw_rows(
        spark,
        dict(vendorid=1, tpep_dropoff_datetime=T0 + dt.timedelta(seconds=60), tpep_pickup_datetime=T0),
        dict(vendorid=2, tpep_dropoff_datetime=T0 + dt.timedelta(seconds=86400), tpep_pickup_datetime=T0),
        dict(vendorid=3, tpep_dropoff_datetime=T0 + dt.timedelta(seconds=59.999999), tpep_pickup_datetime=T0),
        dict(vendorid=4, tpep_dropoff_datetime=T0 + dt.timedelta(seconds=86400.000001), tpep_pickup_datetime=T0),
    )
    assert ids(staging.stg_trips(raw, P)) == [1, 2]


def test_casts_and_flag(spark):
    raw = raw_rows(
        spark,
        dict(vendorid=1, passenger_count=0.5, store_and_fwd_flag="Y", ratecodeid=1.5),
        dict(vendorid=2, passenger_count=1.5, store_and_fwd_flag="N", ratecodeid=2.5),
        dict(vendorid=3, passenger_count=2.5, store_and_fwd_flag="X", ratecodeid=None),
        dict(vendorid=4, passenger_count=None, store_and_fwd_flag=None),
    )
    got = {r.vendor_id: (r.passenger_count, r.was_store_and_forward, r.rate_code_id)
           for r in staging.renamed(raw).collect()}
    assert got == {1: (0, True, 2), 2: (2, False, 2), 3: (2, None, None), 4: (None, None, 1)}


def test_fare_zero_kept_tip_pct_null_and_ratio_rule(spark):
    raw = raw_rows(spark, dict(vendorid=1, fare_amount=0.0),
                   dict(vendorid=2, fare_amount=100.0, tip_amount=12.344999999999999))
    f = {r.vendor_id: r for r in fact.to_fact(staging.stg_trips(raw, P)).collect()}
    assert f[1].tip_percentage is None
    assert f[2].tip_percentage == Decimal("12.35")
    assert f[2].trip_duration_minutes == Decimal("30.00")
    assert f[2].avg_speed_mph == Decimal("10.00")


def test_distance_rules(spark):
    raw = raw_rows(spark, dict(vendorid=1, trip_distance=200.0), dict(vendorid=2, trip_distance=199.9),
                   dict(vendorid=3, trip_distance=0.0))
    assert ids(staging.stg_trips(raw, P)) == [2]
    from farebox.operators.profile import quality_counters
    q = quality_counters(raw).first()
    assert q.absurd_distance == 0 and q.zero_distance == 1


def test_null_pickup_and_window(spark):
    raw = raw_rows(spark, dict(vendorid=1, tpep_pickup_datetime=None),
                   dict(vendorid=2, tpep_pickup_datetime=dt.datetime(2023, 12, 31, 23, 50),
                        tpep_dropoff_datetime=dt.datetime(2024, 1, 1, 0, 10)),
                   dict(vendorid=3))
    assert ids(staging.stg_trips(raw, P)) == [3]


def test_dedupe_is_deterministic_and_keeps_one(spark):
    # same key (tip is not part of it): the lowest fare then tip wins
    raw = raw_rows(spark, dict(tip_amount=5.0), dict(tip_amount=4.0), dict(tip_amount=4.0),
                   dict(fare_amount=19.0, tip_amount=9.0))
    out = staging.stg_trips(raw, P).collect()
    assert len(out) == 1
    assert (out[0].fare_amount, out[0].tip_amount) == (19.0, 9.0)


def test_rules_below_dedupe_equal_rules_after(spark):
    """Moving key-determined rules below the dedupe must not change the
    result: compare with the literal order (dedupe, then every rule)."""
    rows = []
    for i in range(40):
        rows.append(dict(vendorid=i % 3, fare_amount=float(i % 5 - 1), tip_amount=float(i % 4),
                         trip_distance=float(i % 7) * 40, total_amount=float(i % 6 - 1),
                         tpep_dropoff_datetime=T0 + dt.timedelta(minutes=(i % 5) * 400 - 10),
                         tpep_pickup_datetime=T0))
    raw = raw_rows(spark, *rows)
    fast = staging.stg_trips(raw, P)
    r = staging.deduplicate(staging.renamed(raw))
    for pred in staging.cleaning_rules(P).values():
        r = r.where(pred)
    slow = r.select(*staging.STG_COLUMNS)
    assert sorted(fast.collect()) == sorted(slow.collect())


def test_stg_plan_prunes_partitions_and_limits_window(spark, scratch):
    raw = raw_rows(spark, dict(vendorid=1))
    p = scratch("raw")
    raw.write.partitionBy("year", "month").parquet(p)
    plan = staging.stg_trips(spark.read.parquet(p), P)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan
    assert "WindowGroupLimit" in plan


def test_window_is_time_zone_free_and_pushed(spark, scratch):
    raw = raw_rows(spark, dict(vendorid=1, tpep_pickup_datetime=dt.datetime(2024, 1, 1, 0, 30),
                               tpep_dropoff_datetime=dt.datetime(2024, 1, 1, 1, 0)),
                   dict(vendorid=2, tpep_pickup_datetime=dt.datetime(2023, 12, 31, 23, 30),
                        tpep_dropoff_datetime=dt.datetime(2024, 1, 1, 0, 0)))
    p = scratch("raw_tz")
    raw.write.partitionBy("year", "month").parquet(p)
    old = spark.conf.get("spark.sql.session.timeZone")
    old_len = spark.conf.get("spark.sql.maxMetadataStringLength")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
        df = staging.stg_trips(spark.read.parquet(p), P)
        assert ids(df) == [1]
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "GreaterThanOrEqual(tpep_pickup_datetime,2024-01-01T00:00)" in plan
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
        spark.conf.set("spark.sql.maxMetadataStringLength", old_len)
