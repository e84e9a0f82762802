import contextlib
import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import raw_rows
from farebox.operators.fact import to_fact
from farebox.params import PipelineParams
from farebox.sources import commits, lake
from farebox.streaming import incremental

P = PipelineParams()
T0 = dt.datetime(2024, 1, 10, 8, 0, 0)


def counts(df):
    return sorted((r.year, r.month, r["count"]) for r in df.groupBy("year", "month").count().collect())


def test_load_is_incremental_and_idempotent(spark, scratch):
    lake_root, raw_root, audit_root = scratch("lake"), scratch("raw"), scratch("audit")
    jan = [dict(vendorid=i) for i in range(3)]
    feb = [dict(vendorid=i, tpep_pickup_datetime=dt.datetime(2024, 2, 2),
                tpep_dropoff_datetime=dt.datetime(2024, 2, 2, 1)) for i in range(2)]
    lake.build_lake([raw_rows(spark, *jan).drop("year", "month")], lake_root, "tpep_pickup_datetime")
    first = incremental.load_partitions(spark, lake_root, raw_root, audit_root)
    assert sorted((r.year, r.month, r.row_count) for r in first.collect()) == [(2024, 1, 3)]
    # lake rebuilt with one more month and one stray row in the loaded month
    extra = [dict(vendorid=9)]
    lake.build_lake([raw_rows(spark, *(jan + feb + extra)).drop("year", "month")], lake_root,
                    "tpep_pickup_datetime")
    second = incremental.load_partitions(spark, lake_root, raw_root, audit_root)
    assert sorted((r.year, r.month, r.row_count) for r in second.collect()) == [(2024, 2, 2)]
    assert counts(spark.read.parquet(raw_root)) == [(2024, 1, 3), (2024, 2, 2)]
    # nothing left: a re-run loads nothing
    assert incremental.load_partitions(spark, lake_root, raw_root, audit_root).count() == 0
    # the audited month drifted
    latest = incremental.audit_latest(incremental.read_audit(spark, audit_root))
    from farebox.operators.checks import check_audit_drift
    drift = check_audit_drift(latest, lake.read_lake(spark, lake_root), "yellow_trips").collect()
    assert [(r.year, r.month, r.audited_rows, r.lake_rows) for r in drift] == [(2024, 1, 3, 4)]
    # full refresh replaces, never appends; twice gives the same table;
    # committing one partition at a time gives the same result
    loaded = incremental.load_partitions(spark, lake_root, raw_root, audit_root, full_refresh=True,
                                         partitions_per_commit=1)
    assert sorted((r.year, r.month, r.row_count) for r in loaded.collect()) == [(2024, 1, 4), (2024, 2, 2)]
    assert incremental.read_audit(spark, audit_root).select("load_id").distinct().count() == 3
    incremental.load_partitions(spark, lake_root, raw_root, audit_root, full_refresh=True)
    assert counts(spark.read.parquet(raw_root)) == [(2024, 1, 4), (2024, 2, 2)]
    latest = {(r.year, r.month): r.row_count
              for r in incremental.audit_latest(incremental.read_audit(spark, audit_root)).collect()}
    assert latest == {(2024, 1): 4, (2024, 2): 2}


def _raw(spark, rows):
    return raw_rows(spark, *rows)


@pytest.mark.parametrize("late,expected", [("drop", [1, 2, 4]), ("upsert", [1, 2, 3, 4])])
def test_fact_high_water_mark(spark, scratch, late, expected):
    path = scratch(f"fct_{late}")
    first = [dict(vendorid=1, tpep_pickup_datetime=T0, tpep_dropoff_datetime=T0 + dt.timedelta(minutes=20)),
             dict(vendorid=2, tpep_pickup_datetime=T0 + dt.timedelta(hours=1),
                  tpep_dropoff_datetime=T0 + dt.timedelta(hours=1, minutes=20))]
    late_rows = [dict(vendorid=3, tpep_pickup_datetime=T0 + dt.timedelta(hours=1),   # = high-water mark
                      tpep_dropoff_datetime=T0 + dt.timedelta(hours=1, minutes=30)),
                 dict(vendorid=4, tpep_pickup_datetime=dt.datetime(2024, 2, 1, 9),
                      tpep_dropoff_datetime=dt.datetime(2024, 2, 1, 9, 30))]
    incremental.build_fact(spark, _raw(spark, first), P, path, late=late)
    parts = [(2024, 1), (2024, 2)] if late == "upsert" else None
    for _ in range(2):  # idempotent
        incremental.build_fact(spark, _raw(spark, first + late_rows), P, path, late=late, partitions=parts)
    got = sorted(r.vendor_id for r in lake.read_lake(spark, path).collect())
    assert got == expected


def test_fact_schema_gate(spark, scratch):
    path = scratch("fct_gate")
    raw = _raw(spark, [dict(vendorid=1)])
    incremental.build_fact(spark, raw, P, path)
    # the fact model gains a column: the incremental writer refuses
    def changed_model(stg):
        return to_fact(stg).withColumn("store_id", F.lit(None).cast("int"))
    with pytest.raises(incremental.SchemaChangeError):
        incremental.build_fact(spark, raw, P, path, model=changed_model)


def test_upsert_limited_to_loaded_partitions(spark, scratch):
    path = scratch("fct_parts")
    jan = dict(vendorid=1, tpep_pickup_datetime=T0, tpep_dropoff_datetime=T0 + dt.timedelta(minutes=20))
    late_jan = dict(vendorid=2, tpep_pickup_datetime=T0 - dt.timedelta(days=2),
                    tpep_dropoff_datetime=T0 - dt.timedelta(days=2) + dt.timedelta(minutes=20))
    late_feb = dict(vendorid=3, tpep_pickup_datetime=dt.datetime(2024, 2, 1, 9),
                    tpep_dropoff_datetime=dt.datetime(2024, 2, 1, 9, 30))
    incremental.build_fact(spark, _raw(spark, [jan]), P, path, late="upsert")
    # only January was reloaded: the February trip waits for its own load
    incremental.build_fact(spark, _raw(spark, [jan, late_jan, late_feb]), P, path, late="upsert",
                           partitions=[(2024, 1)])
    assert sorted(r.vendor_id for r in lake.read_lake(spark, path).collect()) == [1, 2]
    incremental.build_fact(spark, _raw(spark, [jan, late_jan, late_feb]), P, path, late="upsert",
                           partitions=[(2024, 2)])
    assert sorted(r.vendor_id for r in lake.read_lake(spark, path).collect()) == [1, 2, 3]


def test_null_partition_is_loaded_once(spark, scratch):
    lake_root, raw_root, audit_root = scratch("lake_n"), scratch("raw_n"), scratch("audit_n")
    rows = [dict(vendorid=1), dict(vendorid=2, tpep_pickup_datetime=None)]
    lake.build_lake([raw_rows(spark, *rows).drop("year", "month")], lake_root, "tpep_pickup_datetime")
    first = incremental.load_partitions(spark, lake_root, raw_root, audit_root)
    assert sorted(((r.year, r.month, r.row_count) for r in first.collect()),
                  key=lambda t: (t[0] is not None, t[0] or 0)) == [(None, None, 1), (2024, 1, 1)]
    assert incremental.load_partitions(spark, lake_root, raw_root, audit_root).count() == 0
    assert spark.read.parquet(raw_root).count() == 2


def test_upsert_replaces_corrected_and_removed_rows(spark, scratch):
    path = scratch("fct_fix")
    a, b = dict(vendorid=1, tip_amount=4.0), dict(vendorid=2)
    feb = dict(vendorid=3, tpep_pickup_datetime=dt.datetime(2024, 2, 1, 9),
               tpep_dropoff_datetime=dt.datetime(2024, 2, 1, 9, 30))
    incremental.build_fact(spark, _raw(spark, [a, b, feb]), P, path, late="upsert")
    # same key, another tip; one trip of January withdrawn; all of February too
    now = _raw(spark, [dict(a, tip_amount=1.0)])
    incremental.build_fact(spark, now, P, path, late="upsert", partitions=[(2024, 1), (2024, 2)])
    assert [(r.vendor_id, r.tip_amount) for r in lake.read_lake(spark, path).collect()] == [(1, 1.0)]
    with pytest.raises(ValueError):
        incremental.build_fact(spark, now, P, path, late="upsert")


def test_drop_appends_and_heals_an_unfinished_append(spark, scratch, monkeypatch):
    path = scratch("fct_append")
    one = dict(vendorid=1, tpep_pickup_datetime=T0, tpep_dropoff_datetime=T0 + dt.timedelta(minutes=20))
    later = [dict(vendorid=v, tpep_pickup_datetime=T0 + dt.timedelta(days=d),
                  tpep_dropoff_datetime=T0 + dt.timedelta(days=d, minutes=20)) for v, d in ((2, 1), (3, 2), (4, 40))]
    incremental.build_fact(spark, _raw(spark, [one]), P, path)
    before = {r.path for r in lake.lake_files(spark, path).collect()}
    # a run that dies after it has written its rows, before its commit
    with lost_commit(monkeypatch):
        incremental.build_fact(spark, _raw(spark, [one, later[1], later[2]]), P, path)
    assert incremental.high_water_mark(spark, path) == T0
    assert vendors(lake.read_lake(spark, path)) == [1]
    got = incremental.build_fact(spark, _raw(spark, [one, *later]), P, path)
    assert vendors(got) == [1, 2, 3, 4]
    again = {r.path for r in lake.lake_files(spark, path).collect()}
    incremental.build_fact(spark, _raw(spark, [one, *later]), P, path)
    assert before < again == {r.path for r in lake.lake_files(spark, path).collect()}
    # the rows of the run that died lie beside them until they are removed
    assert incremental.fact_table(spark, path).vacuum() >= 1
    assert vendors(lake.read_lake(spark, path)) == [1, 2, 3, 4]


@contextlib.contextmanager
def lost_commit(monkeypatch):
    def lost(*a):
        raise RuntimeError("lost")
    with monkeypatch.context() as m:
        m.setattr(commits.CommittedTable, "_commit", lost)
        with pytest.raises(RuntimeError, match="lost"):
            yield


def trip(vendor, day, **more):
    start = dt.datetime(2024, 1, day, 8) if day < 32 else dt.datetime(2024, 2, day - 31, 8)
    return dict(vendorid=vendor, tpep_pickup_datetime=start,
                tpep_dropoff_datetime=start + dt.timedelta(minutes=20), **more)


def vendors(df):
    return sorted(r.vendor_id for r in df.collect())


def test_a_rebuilt_fact_has_no_stale_mark(spark, scratch):
    """Fact of days 5 and 20, removed and rebuilt from day 5: day 10 is new."""
    path = scratch("fct_again")
    incremental.build_fact(spark, _raw(spark, [trip(1, 5), trip(2, 20)]), P, path)
    commits.remove_path(spark, path)
    incremental.build_fact(spark, _raw(spark, [trip(1, 5)]), P, path)
    got = incremental.build_fact(spark, _raw(spark, [trip(1, 5), trip(3, 10)]), P, path)
    assert vendors(got) == [1, 3]


def test_drop_after_upsert_keeps_every_row(spark, scratch):
    """Day 5 by drop, day 9 by upsert, then an increment with day 12 alone."""
    path = scratch("fct_mixed")
    incremental.build_fact(spark, _raw(spark, [trip(1, 5)]), P, path, late="drop")
    incremental.build_fact(spark, _raw(spark, [trip(1, 5), trip(2, 9)]), P, path, late="upsert", partitions=[(2024, 1)])
    assert incremental.high_water_mark(spark, path) == dt.datetime(2024, 1, 9, 8)
    got = incremental.build_fact(spark, _raw(spark, [trip(3, 12)]), P, path, late="drop")
    assert vendors(got) == [1, 2, 3]
    # an upsert that takes the newest rows away takes the mark back
    incremental.build_fact(spark, _raw(spark, [trip(1, 5)]), P, path, late="upsert", partitions=[(2024, 1)])
    assert incremental.high_water_mark(spark, path) == dt.datetime(2024, 1, 5, 8)
    assert vendors(incremental.build_fact(spark, _raw(spark, [trip(4, 6)]), P, path)) == [1, 4]


def test_first_run_without_rows_or_killed(spark, scratch, monkeypatch):
    path = scratch("fct_empty")
    nothing = _raw(spark, [trip(1, 5, total_amount=-1.0)])   # rejected by a rule
    for _ in range(2):
        assert incremental.build_fact(spark, nothing, P, path).count() == 0
    assert incremental.high_water_mark(spark, path) is None
    assert vendors(incremental.build_fact(spark, _raw(spark, [trip(1, 5)]), P, path)) == [1]
    killed = scratch("fct_killed")
    with lost_commit(monkeypatch):
        incremental.build_fact(spark, _raw(spark, [trip(1, 5), trip(2, 40)]), P, killed)
    (spark.range(1).write.parquet(f"{killed}/_temporary/0/x"))   # what a killed job leaves
    assert lake.read_lake(spark, killed).count() >= 0
    assert vendors(incremental.build_fact(spark, _raw(spark, [trip(3, 6)]), P, killed)) == [3]


def test_load_killed_between_rows_and_audit_leaves_the_old_rows(spark, scratch, monkeypatch):
    roots = [scratch(x) for x in ("lake_k", "raw_k", "audit_k")]
    lake.build_lake([raw_rows(spark, trip(1, 5), trip(2, 40)).drop("year", "month")], roots[0], "tpep_pickup_datetime")
    incremental.load_partitions(spark, *roots)
    old = sorted(incremental.read_raw(spark, *roots[1:]).collect())
    lake.build_lake([raw_rows(spark, trip(3, 5), trip(4, 40)).drop("year", "month")], roots[0], "tpep_pickup_datetime")
    with lost_commit(monkeypatch):
        incremental.load_partitions(spark, *roots, full_refresh=True)
    assert sorted(incremental.read_raw(spark, *roots[1:]).collect()) == old
    incremental.load_partitions(spark, *roots, full_refresh=True)
    assert sorted(r.vendorid for r in incremental.read_raw(spark, *roots[1:]).collect()) == [3, 4]
    assert sorted(r.vendorid for r in spark.read.parquet(roots[1]).collect()) == [3, 4]   # vacuumed


def test_a_loaded_partition_that_grew_is_found_from_the_listing(spark, scratch):
    from farebox.operators.checks import check_signature_drift
    roots = [scratch(x) for x in ("lake_g", "raw_g", "audit_g")]
    rows = [trip(1, 5), trip(2, 40), dict(vendorid=3, tpep_pickup_datetime=None)]
    lake.build_lake([raw_rows(spark, *rows).drop("year", "month")], roots[0], "tpep_pickup_datetime")
    incremental.load_partitions(spark, *roots)
    assert check_signature_drift(spark, roots[0], roots[2], "yellow_trips").count() == 0
    lake.append_to_lake(raw_rows(spark, trip(4, 6)), roots[0], "tpep_pickup_datetime")
    drift = check_signature_drift(spark, roots[0], roots[2], "yellow_trips")
    assert [(r.year, r.month, r.audited_rows, r.lake_rows) for r in drift.collect()] == [(2024, 1, 1, 2)]
    # by default an audited partition is not looked at again
    assert incremental.load_partitions(spark, *roots).count() == 0
    again = incremental.load_partitions(spark, *roots, reload_changed=True).collect()
    assert [tuple(r) for r in again] == [(2024, 1, 2)]
    assert counts(incremental.read_raw(spark, *roots[1:]).where("year is not null")) == [(2024, 1, 2), (2024, 2, 1)]
    assert incremental.load_partitions(spark, *roots, reload_changed=True).count() == 0


def test_star_heals_a_crash_between_raw_and_fact(spark, scratch, monkeypatch):
    from farebox.plans import marts
    roots = [scratch(x) for x in ("lake", "raw", "audit")]
    seed = spark.createDataFrame([(1, "B", "Z", "S")], "LocationID int, Borough string, Zone string, service_zone string")
    m = scratch("marts")
    lake.build_lake([raw_rows(spark, dict(vendorid=1)).drop("year", "month")], roots[0], "tpep_pickup_datetime")
    with monkeypatch.context() as c:
        c.setattr(marts, "build_fact", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            marts.refresh_star(spark, *roots, seed, P, m)
    done = marts.refresh_star(spark, *roots, seed, P, m)
    assert done.read(spark)["fct_trips"].count() == 1
    assert incremental.pending_loads(spark, roots[2], done.absorbed, "yellow_trips").count() == 0


def test_nightly_fact_run_opens_nothing_without_a_new_load(spark, scratch, monkeypatch):
    from farebox.plans import marts
    roots = [scratch(x) for x in ("lake_n", "raw_n", "audit_n")]
    fact, ledger = scratch("fct_n"), scratch("fct_n_absorbed")

    def night(*trips):
        if trips:
            lake.append_to_lake(raw_rows(spark, *trips), roots[0], "tpep_pickup_datetime")
            incremental.load_partitions(spark, *roots, reload_changed=True)
        return marts.refresh_fact(spark, *roots[1:], P, fact, ledger)

    def stored():
        return sorted(r.vendor_id for r in incremental.fact_table(spark, fact).read().collect())

    lake.build_lake([raw_rows(spark, trip(1, 5)).drop("year", "month")], roots[0], "tpep_pickup_datetime")
    incremental.load_partitions(spark, *roots)
    assert night() == [(2024, 1)] and stored() == [1]
    with monkeypatch.context() as c:
        for unread in ("build_fact", "read_raw"):
            c.setattr(marts, unread, lambda *a, **k: pytest.fail("opened without a new load"))
        assert night() == []
    # a new month and, in the old one, a row that the mark has overtaken and one that it has not
    assert night(trip(2, 40), trip(3, 3), trip(4, 7)) == [(2024, 1), (2024, 2)]
    assert stored() == [1, 2, 4]
    # a run that dies between the fact's commit and the ledger is done again, without doubling a row
    with monkeypatch.context() as c:
        c.setattr(marts, "note_absorbed", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            night(trip(5, 41))
    assert stored() == [1, 2, 4, 5]
    assert night() == [(2024, 2)] and stored() == [1, 2, 4, 5]
    assert night() == []
    # a load whose rows are all rejected is noted too
    assert night(trip(6, 42, total_amount=-1.0)) == [(2024, 2)] and stored() == [1, 2, 4, 5]
    assert night() == []


def test_the_state_after_a_load_is_what_the_log_says(spark, scratch):
    table = commits.CommittedTable(spark, scratch("state"), scratch("state_log"))
    state = table.state()
    for kind, rows, parts in (
            ("append", [(1, 2024, 1), (2, 2024, 2), (3, None, None)], ()),
            ("append", [(4, 2024, 1)], ()),
            ("append", [], ()),
            ("replace", [(5, 2024, 2)], ()),
            ("replace", [], [(2024, 1)]),
            ("append", [(6, 2024, 1), (7, 2024, 2)], ()),
            ("replace", [(8, None, None)], [(2024, 2), (None, None)])):
        df = spark.createDataFrame(rows, "d int, year int, month int").withColumn(
            "at", F.expr("make_timestamp_ntz(2024, 1, d, 0, 0, 0)"))
        _, state = table.load(df, kind, parts, mark_col="at", state=state)
        said = table.state()
        assert dict(zip(state.live, state.marks)) == dict(zip(said.live, said.marks))
        assert (state.mark, state.columns, state.seq) == (said.mark, said.columns, said.seq)
        assert sorted(map(str, table.read(state).collect())) == sorted(map(str, table.read().collect()))


def test_unreachable_file_systems_are_errors(spark):
    from farebox.session import path_exists
    for path in ("s3a://nowhere/fact", "nosuchscheme://x/fact"):
        with pytest.raises(Exception):
            path_exists(spark, path)


def test_audit_drift_sees_vanished_and_new_partitions(spark, scratch):
    from farebox.operators.checks import check_audit_drift
    audit = spark.createDataFrame([("t", 2024, 1, 5), ("t", 2024, 2, 5), ("t", None, None, 1)],
                                  "table_name string, year int, month int, row_count long")
    now = spark.createDataFrame([(2024, 2)] * 5 + [(2024, 3)] + [(None, None)], "year int, month int")
    got = {(r.year, r.month, r.audited_rows, r.lake_rows) for r in check_audit_drift(audit, now, "t").collect()}
    assert got == {(2024, 1, 5, 0), (2024, 3, 0, 1)}
