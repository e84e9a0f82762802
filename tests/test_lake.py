import datetime as dt

from pyspark.sql import functions as F

from conftest import raw_rows
from farebox.sources import lake
from farebox.sources.raw import RAW_COLUMN_NAMES, read_aligned


def test_lake_roundtrip_and_null_partition(spark, scratch):
    raw = raw_rows(spark, dict(vendorid=1), dict(vendorid=2, tpep_pickup_datetime=None),
                   dict(vendorid=3, tpep_pickup_datetime=dt.datetime(2024, 2, 3)))
    root = scratch("lake")
    lake.build_lake([raw.drop("year", "month")], root, "tpep_pickup_datetime")
    lake.build_lake([raw.drop("year", "month")], root, "tpep_pickup_datetime")  # idempotent
    back = lake.read_lake(spark, root)
    got = [(r.year, r.month) for r in lake.lake_partitions(spark, root).collect()]
    assert got == [(None, None), (2024, 1), (2024, 2)]  # NULL partition sorts first
    assert back.count() == 3
    one = lake.read_partition(spark, root, 2024, 2, ["vendorid"])
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan and "ReadSchema: struct<vendorid:int>" in plan
    assert [r.vendorid for r in one.collect()] == [3]
    layout = lake.lake_layout(spark, root).collect()
    assert sum(r.files for r in layout) >= 3 and all(r.bytes > 0 for r in layout)


def test_read_aligned_schema_drift(spark, scratch):
    a, b, c = scratch("a"), scratch("b"), scratch("c")
    spark.createDataFrame([(1, 2.5, 7)], "VendorID int, Airport_fee double, extra_col int").write.parquet(a)
    spark.createDataFrame([(2, 1)], "vendorid int, airport_fee long").write.parquet(b)
    spark.createDataFrame([(3,)], "VENDORID long").write.parquet(c)
    out = read_aligned(spark, [a, b, c])
    assert out.columns == list(RAW_COLUMN_NAMES)
    assert dict(out.dtypes)["airport_fee"] == "double"
    got = sorted((r.vendorid, r.airport_fee) for r in out.collect())
    assert got == [(1, 2.5), (2, 1.0), (3, None)]


def test_source_counts_and_stray(spark, scratch):
    jan = scratch("src_2024-01")
    spark.createDataFrame(
        [(dt.datetime(2024, 1, 5),), (dt.datetime(2023, 12, 31, 23),), (None,)], "ts timestamp_ntz"
    ).coalesce(1).write.parquet(jan)
    missing = scratch("src_2024-02")
    counts = {r.month: r for r in lake.source_file_counts(spark, [(2024, 1, jan), (2024, 2, missing)]).collect()}
    assert counts[1].rows == 3 and counts[1].is_missing is False and counts[1].total_rows == 3
    assert counts[2].rows is None and counts[2].is_missing is True
    stray = lake.stray_dates(spark, [(2024, 1, jan)], "ts").first()
    assert (stray.rows, stray.in_month, stray.stray) == (3, 1, 2)
    assert str(stray.stray_pct) == "66.67"


def test_sources_with_odd_paths_and_nested_folders(spark, scratch):
    """A plus, a space and a percent sign in a name; files two folders down; a
    source inside another's folder; rows without a time."""
    rows = spark.createDataFrame([(dt.datetime(2024, 1, 5),), (None,)], "ts timestamp_ntz").coalesce(1)
    root = scratch("odd")
    plus, deep = f"{root}/a+b c%2Bd_2024-01", f"{root}/deep_2024-02"
    rows.write.parquet(plus)
    rows.withColumns({"p": F.lit(1), "q": F.lit("x y")}).write.partitionBy("p", "q").parquet(deep)
    sources = [(2024, 1, plus), (2024, 2, deep)]
    got = {r.file_name: (r.rows, r.total_rows) for r in lake.source_file_counts(spark, sources).collect()}
    assert got == {"a+b c%2Bd_2024-01": (2, 4), "deep_2024-02": (2, 4)}
    stray = {r.month: (r.rows, r.in_month, r.stray) for r in lake.stray_dates(spark, sources, "ts").collect()}
    assert stray == {1: (2, 1, 1), 2: (2, 0, 2)}


def test_rows_without_a_time_are_stray(spark, scratch):
    root = scratch("land")
    rows = [(dt.datetime(2024, 1, 5), dt.datetime(2024, 1, 6)), (dt.datetime(2024, 1, 5), None)]
    lake.land_monthly(spark.createDataFrame(rows, "up timestamp_ntz, down timestamp_ntz"), root, "down")
    got = {(r.year, r.month): (r.rows, r.stray) for r in lake.stray_dates(
        spark, lake.stated_months(lake.list_sources(spark, root)), "up").collect()}
    assert got == {(2024, 1): (1, 0), (None, None): (1, 1)}


def test_append_reads_and_rewrites_nothing(spark, scratch):
    root = scratch("grow")
    jan = raw_rows(spark, dict(vendorid=1)).drop("year", "month")
    lake.build_lake([jan], root, "tpep_pickup_datetime")
    before = {r.path for r in lake.lake_files(spark, root).collect()}
    more = raw_rows(spark, dict(vendorid=2), dict(vendorid=3, tpep_pickup_datetime=dt.datetime(2024, 2, 3)))
    lake.append_to_lake(more, root, "tpep_pickup_datetime")
    assert before < {r.path for r in lake.lake_files(spark, root).collect()}
    assert lake.read_lake(spark, root).groupBy("year", "month").count().where("month = 1").first()["count"] == 2


def test_dataset_schema_and_summary(spark, scratch):
    root = scratch("lake_s")
    raw = raw_rows(spark, dict(vendorid=1), dict(vendorid=2, tpep_pickup_datetime=dt.datetime(2024, 2, 3)))
    lake.build_lake([raw.drop("year", "month")], root, "tpep_pickup_datetime")
    df = lake.read_lake(spark, root)
    sch = lake.dataset_schema(spark, df).collect()
    assert [r.column_name for r in sch][-2:] == ["year", "month"]
    assert sch[0].position == 1 and sch[0].data_type == "int"
    s = lake.dataset_summary(spark, root).first()
    assert (s.rows, s.columns) == (2, len(RAW_COLUMN_NAMES)) and s.files >= 2 and s.partitions == 2


def test_stated_months_from_names():
    import pytest
    got = lake.stated_months(["/x/yellow_tripdata_2024-01.parquet", "s3://b/l/green_tripdata_2023-12.parquet/"])
    assert [(y, m) for y, m, _ in got] == [(2024, 1), (2023, 12)]
    with pytest.raises(ValueError):
        lake.stated_months(["/x/events.parquet"])


def test_empty_lake(spark, scratch):
    """No folder, an empty folder, and a lake that was written without a row."""
    from farebox.streaming import incremental
    absent, empty, written = scratch("absent"), scratch("empty"), scratch("written")
    spark.sparkContext._jvm.org.apache.hadoop.fs.FileSystem.getLocal(
        spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(empty))
    lake.build_lake([raw_rows(spark, dict(vendorid=1)).drop("year", "month").limit(0)], written, "tpep_pickup_datetime")
    for root in (absent, empty, written):
        assert lake.lake_partitions(spark, root).collect() == [] and lake.lake_layout(spark, root).collect() == []
        assert lake.newest_partition(spark, root) is None
        assert lake.read_lake(spark, root).select("year", "month").count() == 0
        s = lake.dataset_summary(spark, root).first()
        assert (s.rows, s.partitions, s.files) == (0, 0, 0)
        assert incremental.load_partitions(spark, root, scratch("r"), scratch("a")).collect() == []


def _land(spark, root, name, *days):
    rows = raw_rows(spark, *(dict(vendorid=d, tpep_pickup_datetime=dt.datetime(2024, 1 + d // 40, 1 + d % 28)) for d in days))
    path = f"{root}/{name}"
    rows.drop("year", "month").coalesce(1).write.parquet(path)
    return path


def _vendors(df):
    return sorted(r.vendorid for r in df.collect())


def test_append_sources_takes_each_file_once(spark, scratch, monkeypatch):
    import pytest
    from farebox.sources import commits
    feed, root, ts = scratch("feed"), scratch("lake_once"), "tpep_pickup_datetime"
    a, b = _land(spark, feed, "a", 1, 2), _land(spark, feed, "b", 3, 45)
    assert lake.append_sources(spark, [a], root, ts) == {(2024, 1): 2}
    assert lake.append_sources(spark, [a], root, ts) == {}                        # twice changes nothing
    assert lake.append_sources(spark, [a, b, f"{feed}/absent"], root, ts) == {(2024, 1): 1, (2024, 2): 1}
    assert _vendors(lake.read_lake(spark, root)) == [1, 2, 3, 45]
    # a run that dies after its rows are written adds nothing, and can be repeated
    c = _land(spark, feed, "c", 4)
    with monkeypatch.context() as m:
        m.setattr(commits.CommittedTable, "_commit", lambda *x: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            lake.append_sources(spark, [feed], root, ts)
    assert _vendors(lake.read_lake(spark, root)) == [1, 2, 3, 45]
    lake.append_sources(spark, [feed], root, ts)
    assert _vendors(lake.read_lake(spark, root)) == [1, 2, 3, 4, 45]
    # a source folder that grew adds its new file; a file that changed is refused
    raw_rows(spark, dict(vendorid=5)).drop("year", "month").write.mode("append").parquet(a)
    assert sum(lake.append_sources(spark, [feed], root, ts).values()) == 1
    raw_rows(spark, dict(vendorid=6), dict(vendorid=7)).drop("year", "month").coalesce(1).write.mode("overwrite").parquet(c)
    new = [r.path for r in lake.source_files(spark, [c]).collect()][0]
    jvm = spark.sparkContext._jvm
    fs = jvm.org.apache.hadoop.fs.FileSystem.getLocal(spark.sparkContext._jsc.hadoopConfiguration())
    known = [r.path for r in commits.committed(spark, root).log().where("kind = 'source'").collect() if "/b/" in r.path][0]
    fs.delete(jvm.org.apache.hadoop.fs.Path(known), False)
    fs.rename(jvm.org.apache.hadoop.fs.Path(new), jvm.org.apache.hadoop.fs.Path(known))
    with pytest.raises(ValueError, match="has changed"):
        lake.append_sources(spark, [b], root, ts)


def test_compaction_keeps_rows_and_packs_files(spark, scratch):
    feed, root, ts = scratch("feed_many"), scratch("lake_many"), "tpep_pickup_datetime"
    for i in range(12):
        lake.append_sources(spark, [_land(spark, feed, f"s{i}", i, 50 + i)], root, ts)
    before = {(r.year, r.month): (r.files, r.bytes) for r in lake.lake_layout(spark, root).collect()}
    assert before[(2024, 1)][0] == 12
    rows = sorted(map(tuple, lake.read_lake(spark, root).collect()), key=str)
    target = before[(2024, 1)][1] // 3
    assert sorted(lake.compact_lake(spark, root, target)) == [(2024, 1), (2024, 2)]
    after = {(r.year, r.month): r.files for r in lake.lake_layout(spark, root).collect()}
    assert all(1 <= after[p] <= -(-b // target) + 1 for p, (_, b) in before.items())
    assert sorted(map(tuple, lake.read_lake(spark, root).collect()), key=str) == rows
    assert lake.compact_lake(spark, root, 1 << 20) in ([], [(2024, 1)], [(2024, 2)], [(2024, 1), (2024, 2)])
    assert sorted(map(tuple, lake.read_lake(spark, root).collect()), key=str) == rows
    # sources stay known through a compaction
    assert lake.append_sources(spark, [feed], root, ts) == {}


def test_clustered_lake_prunes_within_a_month(spark, scratch):
    """Rows dealt by ranges of a column: a filter on it opens few of a month's files."""
    root = scratch("lake_range")
    rows = [dict(vendorid=1, pulocationid=i % 64) for i in range(640)]
    lake.build_lake([raw_rows(spark, *rows).drop("year", "month").repartition(8)], root, "tpep_pickup_datetime", cluster_by="pulocationid")
    df = lake.read_lake(spark, root)
    spans = (df.groupBy(F.col("_metadata.file_path").alias("f"))
             .agg(F.min("pulocationid").alias("lo"), F.max("pulocationid").alias("hi")).orderBy("lo").collect())
    assert all(a.hi <= b.lo for a, b in zip(spans, spans[1:]))
    assert df.where("pulocationid = 7").count() == 10 and df.count() == 640


def test_daily_lake(spark, scratch):
    root = scratch("lake_daily")
    days = [dict(vendorid=d, tpep_pickup_datetime=dt.datetime(2024, 1, d)) for d in (1, 2, 2)] + [dict(tpep_pickup_datetime=None)]
    lake.build_lake([raw_rows(spark, *days).drop("year", "month")], root, "tpep_pickup_datetime", by=lake.DAILY)
    got = [tuple(r) for r in lake.lake_partitions(spark, root, lake.DAILY).collect()]
    assert got == [(None, None, None), (2024, 1, 1), (2024, 1, 2)]
    assert lake.read_lake(spark, root).where("day = 2").count() == 2


def test_read_aligned_merges_equal_types_in_one_go(spark, scratch, monkeypatch):
    """A feed whose type changes once: halved to the change, not read one by one."""
    from farebox.sources import raw
    root = scratch("feed_types")
    paths = []
    for i in range(16):
        kind = "int" if i < 11 else "long"
        path = f"{root}/m{i:02d}"
        spark.createDataFrame([(i, i)], f"VendorID {kind}, payment_type {kind}" if i % 2 else f"vendorid {kind}, Extra {kind}").write.parquet(path)
        paths.append(path)
    tried = []
    same = raw.same_types
    monkeypatch.setattr(raw, "same_types", lambda sp, ps: tried.append(len(ps)) or same(sp, ps))
    assert sorted(r.vendorid for r in read_aligned(spark, reversed(paths)).collect()) == list(range(16))
    assert sum(tried) <= 16 * 3 and len(tried) <= 9


def test_counts_and_structure_come_from_footers(spark, scratch):
    """No row is decoded: the scan itself answers counts and bounds."""
    from farebox.streaming import incremental
    roots = [scratch(x) for x in ("lake_f", "raw_f", "audit_f")]
    rows = [dict(vendorid=1, airport_fee=None), dict(vendorid=7, tip_amount=-2.5),
            # a partition in which a column is null throughout
            dict(vendorid=3, tpep_pickup_datetime=dt.datetime(2024, 2, 3), dolocationid=None), dict(vendorid=4, tpep_pickup_datetime=None)]
    lake.build_lake([raw_rows(spark, *rows).drop("year", "month")], roots[0], "tpep_pickup_datetime")
    counts = lake.partition_counts(spark, roots[0])
    assert sorted((tuple(r) for r in counts.collect()), key=str) == [(2024, 1, 2), (2024, 2, 1), (None, None, 1)]
    plan = lake.partition_counts(spark, roots[0], [(2024, 2)])._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(*)]" in plan and "= 202402" in plan
    incremental.load_partitions(spark, *roots)
    table = incremental.raw_table(spark, *roots[1:])
    plan = table.structure()._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(*), COUNT(" in plan
    got = {(r.month, r.column_name): (r.rows, r.nulls, r.min_value, r.max_value) for r in table.structure().collect()}
    assert got[1, "vendorid"] == (2, 0, 1.0, 7.0) and got[1, "airport_fee"] == (2, 1, 0.0, 0.0)
    assert got[1, "tip_amount"] == (2, 0, -2.5, 4.0) and got[None, "tpep_pickup_datetime"] == (1, 1, None, None)
    assert got[2, "store_and_fwd_flag"] == (1, 0, None, None) and got[2, "dolocationid"] == (1, 1, None, None)
    assert got[1, "dolocationid"] == (2, 0, 236.0, 236.0)
    # the log, not the folder, says what the table holds
    incremental.load_partitions(spark, *roots, full_refresh=True)
    assert {r.rows for r in table.structure().where("month = 1").collect()} == {2}
    assert incremental.raw_table(spark, scratch("r0"), scratch("a0")).structure().collect() == []


def test_settings_of_a_cluster_hold_off_one_machine():
    from farebox import session
    assert session.session_conf("local[8]", 8)["spark.sql.shuffle.partitions"] == "8"
    assert session.session_conf("spark://host:7077", 8)["spark.sql.shuffle.partitions"] == session.CLUSTER_CONF["spark.sql.shuffle.partitions"]
