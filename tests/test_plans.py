"""Plan assertions: the plans Spark picks for the main operators."""

from conftest import SF_SMALL
from farebox.plans import catalog


def plan_of(df):
    df.collect()  # final adaptive plan
    return df._jdf.queryExecution().executedPlan().toString()


def test_star_query_broadcasts_dimension_after_preaggregation(spark):
    p = plan_of(catalog.q_top_pickup_zones(spark, SF_SMALL))
    assert "BroadcastHashJoin" in p
    assert "TakeOrderedAndProject" in p
    assert "WindowGroupLimit" in p


def test_no_python_udf_in_any_query(spark):
    for name, fn in catalog.QUERIES.items():
        df = fn(spark, SF_SMALL)
        p = df._jdf.queryExecution().executedPlan().toString()
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p, name


def test_lake_one_month_is_pruned(spark):
    df = catalog.q_lake_one_month(spark, SF_SMALL)
    p = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in p
    assert "ReadSchema: struct<trip_distance:double,total_amount:double>" in p


def test_high_water_mark_prunes_raw_scan(spark, scratch):
    """The fact's mark is read from its newest month only and reaches the
    raw scan as a partition bound and a pushed Parquet filter."""
    import datetime as dt

    from conftest import raw_rows
    from farebox.functions.temporal import ntz_literal
    from farebox.operators.staging import stg_trips
    from farebox.params import PipelineParams
    from farebox.sources import lake
    from farebox.streaming import incremental

    P = PipelineParams()
    t1, t2 = dt.datetime(2024, 1, 10, 8), dt.datetime(2024, 3, 1, 9, 0, 0, 1234)
    rows = [dict(vendorid=1, tpep_pickup_datetime=t1, tpep_dropoff_datetime=t1 + dt.timedelta(minutes=20)),
            dict(vendorid=2, tpep_pickup_datetime=t2, tpep_dropoff_datetime=t2 + dt.timedelta(minutes=30))]
    rp, fp = scratch("raw_hwm"), scratch("fct_hwm")
    raw_rows(spark, *rows).write.partitionBy("year", "month").parquet(rp)
    incremental.build_fact(spark, spark.read.parquet(rp), P, fp)
    hwm = incremental.high_water_mark(spark, fp)
    assert hwm == t2
    df = stg_trips(spark.read.parquet(rp), P, since=ntz_literal(hwm))
    old = spark.conf.get("spark.sql.maxMetadataStringLength")
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    try:
        p = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.maxMetadataStringLength", old)
    assert "((year#" in p and ">= 202403)" in p  # partitions before March pruned
    assert "GreaterThan(tpep_pickup_datetime,2024-03-01T09:00:00.001234)" in p
    assert "Subquery" not in p
    assert df.count() == 0  # strict >: the row at the mark is not new


def test_stray_dates_count_per_file_before_source_join(spark):
    """Rows are counted per file (and month) in the scan stage; the source list
    meets only those counts."""
    p = plan_of(catalog.q_stray_dates_trips(spark, SF_SMALL)).split("== Initial Plan ==")[0]
    lines = p.splitlines()
    for i in [i for i, line in enumerate(lines) if "FileScan parquet" in line]:
        above = next(line for line in reversed(lines[:i]) if "HashAggregate" in line or "Join" in line)
        assert "HashAggregate(keys=[file" in above
    assert "partial_count(1)" in p


def test_metadata_reports_open_no_data_file(spark):
    """Partitions and newest month come from the file listing alone; layout and
    summary add a count that decodes no data column."""
    import re
    p = plan_of(catalog.q_lake_partitions(spark, SF_SMALL))
    assert "FileScan parquet" not in p and "FileScan binaryFile" in p
    assert "content" not in re.search(r"FileScan binaryFile.*ReadSchema: (struct<[^>]*>)", p)[1]
    for name in ("lake_layout", "dataset_summary", "source_file_counts"):
        p = plan_of(catalog.QUERIES[name](spark, SF_SMALL))
        schemas = set(re.findall(r"FileScan parquet.*ReadSchema: (struct<[^>]*>)", p))
        assert schemas == {"struct<>"}, (name, schemas)


def test_load_opens_only_new_partitions(spark, scratch, monkeypatch):
    import datetime as dt
    import re

    from conftest import raw_rows
    from farebox.sources import lake
    from farebox.streaming import incremental

    lake_root, raw_root, audit_root = scratch("lk"), scratch("rw"), scratch("au")
    jan = raw_rows(spark, dict(vendorid=1)).drop("year", "month")
    lake.build_lake([jan], lake_root, "tpep_pickup_datetime")
    incremental.load_partitions(spark, lake_root, raw_root, audit_root)
    feb = raw_rows(spark, dict(vendorid=2, tpep_pickup_datetime=dt.datetime(2024, 2, 3)))
    lake.append_to_lake(feb, lake_root, "tpep_pickup_datetime")
    seen = []
    predicate = incremental.partition_predicate
    monkeypatch.setattr(incremental, "partition_predicate", lambda parts: seen.append(list(parts)) or predicate(parts))
    assert incremental.load_partitions(spark, lake_root, raw_root, audit_root).count() == 1
    assert seen == [[(2024, 2)]]   # copied; the rows are counted where they were written
    counted = lake.read_lake(spark, lake_root).where(predicate([(2024, 2)])).groupBy("year", "month").count()
    pushed = re.search(r"PartitionFilters: \[([^\n]*)\], PushedFilters", plan_of(counted))[1]
    assert "= 202402" in pushed
