"""What the stored tables cost: joins, shuffles and sorts that a build does without."""

from conftest import SF_SMALL

import pytest
from pyspark.sql import functions as F

from farebox.plans import catalog
from farebox.sources import fixtures, lake
from farebox.sources.commits import CommittedTable


def executed_plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def counted_joins(monkeypatch):
    """How often the tables are joined to trips; every query builds its own tables."""
    joins = []
    monkeypatch.setattr(catalog.Workspace, "_cache", {})
    joined = fixtures.trip_lines if hasattr(fixtures, "trip_lines") else fixtures.trip_source
    monkeypatch.setattr(fixtures, joined.__name__, lambda *a: joins.append(a) or joined(*a))
    return joins


@pytest.mark.parametrize("query", ["fct_incremental", "fct_incremental_upsert", "fct_incremental_mixed", "check_reconciliation",
                                   "check_model_keys", "check_signature_drift", "check_audit_drift",
                                   "incremental_reload_changed"])
def test_the_tables_are_joined_once(spark, counted_joins, query):
    catalog.QUERIES[query](spark, SF_SMALL).collect()
    assert len(counted_joins) == 1


def test_landed_lines_give_the_same_trips(spark, scratch):
    path = scratch("lines")
    fixtures.land_lines(spark, SF_SMALL, path)
    direct, landed = fixtures.trip_source(spark, SF_SMALL), fixtures.trip_source(spark, SF_SMALL, spark.read.parquet(path))
    assert landed.columns == direct.columns
    assert landed.exceptAll(direct).isEmpty() and direct.exceptAll(landed).isEmpty()


def test_orders_meet_their_customers_before_the_lines(spark):
    plan = fixtures.trip_lines(spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join Inner" in line]
    assert "o_custkey" in joins[-1] and "c_custkey" in joins[-1]   # the innermost one


def test_rows_of_a_lake_are_written_anew_without_a_shuffle(spark, scratch, monkeypatch):
    rows = spark.range(200).select((F.col("id") % 7).alias("v"), F.when(
        F.col("id") % 9 > 0, F.timestamp_add("DAY", (F.col("id") % 90).cast("int"), F.lit("2024-01-01").cast("timestamp_ntz"))).alias("ts"))
    first, second = scratch("lake"), scratch("lake")
    lake.build_lake([rows], first, "ts")
    hints = []
    hint = type(rows).hint
    monkeypatch.setattr(type(rows), "hint", lambda self, *a: hints.append(a) or hint(self, *a))
    lake.build_lake([lake.read_lake(spark, first)], second, "ts", rebalance=False)
    assert not hints
    assert sorted(map(tuple, lake.read_lake(spark, second).collect()), key=str) == \
        sorted(map(tuple, lake.read_lake(spark, first).collect()), key=str)


def test_a_write_by_partition_does_not_sort(spark, scratch):
    spark.sql(f"CREATE TABLE unsorted_write (v BIGINT, year INT, month INT) USING parquet PARTITIONED BY (year, month) LOCATION '{scratch('t')}'")
    try:
        plan = spark.sql("EXPLAIN INSERT INTO unsorted_write SELECT id, 2024, CAST(id % 12 AS INT) FROM range(100)").first()[0]
        assert "Sort" not in plan
        spark.sql("INSERT INTO unsorted_write SELECT id, 2024, CAST(id % 40 AS INT) FROM range(0, 100, 1, 1)")   # over 16 in a task
        assert spark.table("unsorted_write").groupBy("month").count().count() == 40
        assert spark.table("unsorted_write").select("v").distinct().count() == 100
    finally:
        spark.sql("DROP TABLE unsorted_write")


def test_compaction_shuffles_the_rows_once(spark, scratch, monkeypatch):
    root = scratch("lake")
    for k in (1, 2):
        src = scratch("src")
        spark.range(50).select("id", F.lit("2024-01-05").cast("timestamp_ntz").alias("ts")).coalesce(1).write.parquet(src)
        lake.append_sources(spark, [src], root, "ts")
    plans, write = [], CommittedTable.write

    def spied(self, rows, *a, **k):
        plans.append(executed_plan(rows))
        return write(self, rows, *a, **k)
    monkeypatch.setattr(CommittedTable, "write", spied)
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")   # as for a lake of many rows
    try:
        assert lake.compact_lake(spark, root, slack=1) == [(2024, 1)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    assert "BroadcastHashJoin" in plans[0] and "SortMergeJoin" not in plans[0]
    assert lake.read_lake(spark, root).count() == 100


def test_the_grown_lake_is_the_only_one_built_for_it(spark, monkeypatch):
    monkeypatch.setattr(catalog.Workspace, "_cache", {})
    built, build = [], lake.build_lake
    monkeypatch.setattr(lake, "build_lake", lambda rows, root, *a, **k: built.append(root) or build(rows, root, *a, **k))
    catalog.QUERIES["lake_append_month"](spark, SF_SMALL).collect()
    assert len(built) == 1
