"""Kept summaries and members that arrive late."""

import datetime as dt

from conftest import raw_rows
from farebox.operators import profile, summaries
from farebox.operators.fact import to_fact, with_storage_partitions
from farebox.operators.staging import stg_trips
from farebox.params import PipelineParams
from farebox.sources import lake
from farebox.sources.commits import CommittedTable, log_beside
from farebox.streaming import incremental

P = PipelineParams()
FKS = ["pickup_location_id", "dropoff_location_id"]


def trip(vendor, month, **more):
    start = dt.datetime(2024, month, 5, 8)
    return dict(vendorid=vendor, tpep_pickup_datetime=start, tpep_dropoff_datetime=start + dt.timedelta(minutes=20), **more)


def test_only_touched_partitions_are_summed_up_again(spark, scratch):
    roots, sums = [scratch(x) for x in ("lake", "raw", "audit")], scratch("sums")
    rows = [trip(1, 1), trip(2, 2, total_amount=-3.0), trip(3, 2, passenger_count=None), dict(vendorid=4, tpep_pickup_datetime=None)]
    lake.build_lake([raw_rows(spark, *rows).drop("year", "month")], roots[0], "tpep_pickup_datetime")
    raw = incremental.raw_table(spark, *roots[1:])
    assert summaries.refresh(spark, raw, sums) == []                      # nothing loaded yet
    incremental.load_partitions(spark, *roots)
    assert sorted(summaries.refresh(spark, raw, sums), key=str) == [(2024, 1), (2024, 2), (None, None)]
    assert summaries.refresh(spark, raw, sums) == []
    lake.append_to_lake(raw_rows(spark, trip(5, 2, trip_distance=-1.0)), roots[0], "tpep_pickup_datetime")
    incremental.load_partitions(spark, *roots, reload_changed=True)
    assert summaries.refresh(spark, raw, sums) == [(2024, 2)]
    kept = summaries.summary_table(spark, sums).read()
    whole = raw.read()
    got, want = summaries.profile_of(kept).first().asDict(), profile.quality_counters(whole).first().asDict()
    assert got == {**want, **profile.global_stats(whole).first().asDict()}
    assert summaries.trips_by_month(kept).collect() == profile.trips_by_month(whole).collect()


def test_a_late_member_reroutes_its_partitions_only(spark, scratch):
    path, ids = scratch("fct"), scratch("unmatched")
    fact, kept = (CommittedTable(spark, r, log_beside(r)) for r in (path, ids))
    rows = [trip(1, 1, pulocationid=264), trip(2, 2, pulocationid=300, dolocationid=1), trip(3, 3, pulocationid=1, dolocationid=None)]
    zones = spark.createDataFrame([(1,), (236,), (-1,)], "location_id int")
    summaries.write_routed(fact, kept, with_storage_partitions(to_fact(stg_trips(raw_rows(spark, *rows), P))), zones, "location_id", FKS)
    keys = lambda: sorted((r.vendor_id, r.pickup_location_id, r.dropoff_location_id) for r in fact.read().collect())
    assert keys() == [(1, -1, 236), (2, -1, 1), (3, 1, -1)]
    assert sorted((r.month, r.id) for r in kept.read().collect()) == [(1, 264), (2, 300)]
    before = {e for e in fact.state().live if e[1] != 1}
    more = zones.unionByName(spark.createDataFrame([(264,)], "location_id int"))
    assert summaries.reroute_new_members(fact, kept, more, "location_id", FKS) == [(2024, 1)]
    assert keys() == [(1, 264, 236), (2, -1, 1), (3, 1, -1)]
    assert before == {e for e in fact.state().live if e[1] != 1}           # the other months are as they were
    assert summaries.reroute_new_members(fact, kept, more, "location_id", FKS) == []
    assert fact.state().mark == dt.datetime(2024, 3, 5, 8)
