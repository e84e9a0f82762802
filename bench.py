"""Benchmark: the headline path at one scale factor.

Steps (each the median of 5 warm runs after one warm-up):
  lake_build        trip source -> partitioned Parquet lake (S-05/S-06)
  raw_load          lake -> raw table, full refresh + audit (S-09..S-12)
  dims_build        dimension tables (S-14..S-16, S-18)
  control_scan      an unchanged scan, to compare machines of different rounds
  stg_fact_build    raw table -> staging -> fact table (W-01, S-13 first run)
  fact_incremental_nothing_new   nightly fact run without a new raw load: audit and ledger only (S-13, P-22)
  fact_mark_nothing_new          the same without a ledger: raw is searched beyond the high-water mark
  fact_incremental_new_day       later fact run with one new day, appended
  fact_corrected_month           one month loaded again, its partition replaced
  top_pickup_zones  stored fact ⋈ stored dim_location, top 5 (J-01, A-08, O-02)
  weekend_revenue_by_quarter, tip_rate_reliable      star reports on stored marts
  trips_by_month, quality_counters, busiest_hours   profile queries
  scan_*            pruned vs full scans (partition pruning, column pruning)

Prints ONE JSON line. Env: BENCH_SF_DIR (default /root/testdata/sf0.1),
BENCH_CPUS (default 8).
"""

from __future__ import annotations

import datetime as dt
import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from farebox.operators import profile  # noqa: E402
from farebox.plans.marts import Marts, build_dimensions, refresh_fact  # noqa: E402
from farebox.session import build_session, scratch_path  # noqa: E402
from farebox.sources import fixtures, lake  # noqa: E402
from farebox.streaming import incremental  # noqa: E402

RUNS = 5


def timed(fn, runs=RUNS):
    fn()  # warm-up
    out = []
    for _ in range(runs):
        t = time.perf_counter()
        fn()
        out.append(time.perf_counter() - t)
    return statistics.median(out)


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session(f"local[{cpus}]", shuffle_partitions=max(8, cpus * 2),
                          extra={"spark.driver.memory": "16g"})
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    P = fixtures.FIXTURE_PARAMS

    # the source as a stored feed, so that the lake write alone is measured
    feed = scratch_path(spark, "bench_feed")
    fixtures.trip_source(spark, sf_dir).repartition(cpus).write.parquet(feed)
    src = spark.read.parquet(feed)
    n_src = src.count()
    q, rows_per_sec = {}, {}

    lake_path = scratch_path(spark, "bench_lake")
    q["lake_build"] = timed(lambda: lake.build_lake([src], lake_path, "tpep_pickup_datetime"))
    rows_per_sec["lake_build"] = n_src / q["lake_build"]

    def load():
        raw_path = scratch_path(spark, "bench_raw")
        incremental.load_partitions(spark, lake_path, raw_path, raw_path + "_audit", full_refresh=True)
        load.raw_path = raw_path
    q["raw_load"] = timed(load)
    rows_per_sec["raw_load"] = n_src / q["raw_load"]
    raw_path = load.raw_path

    seed = fixtures.zone_seed(spark, sf_dir)
    marts_root = scratch_path(spark, "bench_marts")
    q["dims_build"] = timed(lambda: build_dimensions(spark, seed, P, Marts(marts_root)))

    def raw_now():
        return incremental.read_raw(spark, raw_path, raw_path + "_audit")

    # a control: code that no round has changed, beside the steps that it is to be read with
    li = fixtures.table(spark, sf_dir, "lineitem")
    q["control_scan"] = timed(lambda: li.write.mode("overwrite").format("noop").save())

    def stg_fact():
        raw = raw_now()
        fact_path = scratch_path(spark, "bench_fct")
        incremental.build_fact(spark, raw, P, fact_path)
        stg_fact.fact_path = fact_path
    q["stg_fact_build"] = timed(stg_fact)
    rows_per_sec["stg_fact_build"] = n_src / q["stg_fact_build"]
    # a later run with nothing new: no load that the ledger lacks
    nightly = scratch_path(spark, "bench_nightly")

    def night():
        return refresh_fact(spark, raw_path, raw_path + "_audit", P, nightly, nightly + "_absorbed")
    if not night():   # the first one takes in all
        raise RuntimeError("the first nightly run found no load")
    q["fact_incremental_nothing_new"] = timed(night)
    # without a ledger the high-water mark prunes raw to its month
    q["fact_mark_nothing_new"] = timed(lambda: incremental.build_fact(
        spark, raw_now(), P, stg_fact.fact_path, late="drop"))

    raw_all = raw_now()
    last_day = P.end - dt.timedelta(days=880)
    early = raw_all.where(F.col("tpep_pickup_datetime") < F.lit(str(last_day)).cast("timestamp_ntz"))
    day = raw_all.where(F.col("tpep_pickup_datetime") < F.lit(str(last_day + dt.timedelta(days=1)))
                        .cast("timestamp_ntz"))
    days = iter([f"{stg_fact.fact_path}_day{i}" for i in range(RUNS + 1)])
    for i in range(RUNS + 1):
        incremental.build_fact(spark, early, P, f"{stg_fact.fact_path}_day{i}")
    q["fact_incremental_new_day"] = timed(lambda: incremental.build_fact(spark, day, P, next(days)))
    month = [(last_day.year, last_day.month)]
    q["fact_corrected_month"] = timed(lambda: incremental.build_fact(
        spark, raw_all, P, f"{stg_fact.fact_path}_day0", late="upsert", partitions=month))

    marts = Marts(marts_root).read(spark, fact_path=stg_fact.fact_path)
    fact, dim = marts["fct_trips"], marts["dim_location"]
    raw = raw_now()
    ev = fixtures.events(spark, sf_dir)
    q["top_pickup_zones"] = timed(lambda: profile.top_pickup_zones(fact, dim).collect())
    q["weekend_revenue_by_quarter"] = timed(
        lambda: profile.weekend_revenue_by_quarter(fact, marts["dim_date"]).collect())
    q["tip_rate_reliable"] = timed(lambda: profile.tip_rate_reliable(fact, marts["dim_payment_type"]).collect())
    q["trips_by_month"] = timed(lambda: profile.trips_by_month(raw).collect())
    # pruning demos of the reference, measured: one month vs whole lake
    # (2 columns), and 2 columns vs every column of one file
    lk = lake.read_lake(spark, lake_path)
    two = ["trip_distance", "total_amount"]
    q["scan_lake_all_2cols"] = timed(lambda: lk.select(*two).write.mode("overwrite").format("noop").save())
    one_month = lake.read_partition(spark, lake_path, 1996, 1, two)
    q["scan_lake_one_month_2cols"] = timed(lambda: one_month.write.mode("overwrite").format("noop").save())
    # a filter within a month: files dealt by ranges of the column, and not
    clustered = scratch_path(spark, "bench_clustered")
    lake.build_lake([src], clustered, "tpep_pickup_datetime", cluster_by="PULocationID")
    for name, root in (("plain", lake_path), ("clustered", clustered)):
        zone = lake.read_partition(spark, root, 1996, 1).where(F.col("PULocationID") == 7).select(*two)
        q[f"scan_one_zone_{name}"] = timed(lambda z=zone: z.write.mode("overwrite").format("noop").save())
    q["scan_file_all_cols"] = timed(lambda: li.write.mode("overwrite").format("noop").save())
    q["scan_file_2cols"] = timed(
        lambda: li.select("l_quantity", "l_extendedprice").write.mode("overwrite").format("noop").save())
    q["quality_counters"] = timed(lambda: profile.quality_counters(raw).collect())
    q["busiest_hours"] = timed(lambda: profile.busiest_hours(ev, "ts", "value").collect())

    total = sum(q.values())
    print(json.dumps({
        "metric": "headline_path_total_sec", "value": round(total, 3), "unit": "sec",
        "queries": {k: round(v, 3) for k, v in q.items()},
        "rows_per_sec": {k: round(v) for k, v in rows_per_sec.items()},
        "source_rows": n_src, "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
        "cpus": cpus, "runs": RUNS, "stat": "median",
    }))
    spark.stop()


if __name__ == "__main__":
    main()
