"""Hot keys: results stay whole and exact, and the plans reduce map-side."""

from conftest import raw_rows
from farebox.operators import profile, staging
from farebox.operators.fact import to_fact
from farebox.params import PipelineParams

P = PipelineParams()


def test_hot_group_of_copies(spark):
    hot = [dict(vendorid=1, tip_amount=float(7 - i % 7)) for i in range(2000)]
    other = [dict(vendorid=2, pulocationid=i) for i in range(50)]
    raw = raw_rows(spark, *(hot + other)).repartition(8)
    out = staging.stg_trips(raw, P)
    rows = out.collect()
    assert len(rows) == 51
    assert [r.tip_amount for r in rows if r.vendor_id == 1] == [1.0]  # lowest tip wins
    plan = out._jdf.queryExecution().executedPlan().toString()
    # partial top-1 per key runs before the exchange, final after it
    assert plan.count("WindowGroupLimit") >= 2


def test_hot_location_star_report(spark):
    rows = [dict(vendorid=i % 5, pulocationid=132 if i % 3 else i, total_amount=20.0 + i)
            for i in range(900)]
    f = to_fact(staging.stg_trips(raw_rows(spark, *rows).repartition(8), P))
    dim = spark.createDataFrame([(132, "JFK Airport", "Queens")], "location_id int, zone_name string, borough string")
    got = profile.trips_by_zone(f, dim).collect()
    expected = sum(1 for r in f.collect() if r.pickup_location_id == 132)
    assert [(g.zone_name, g.trips) for g in got] == [("JFK Airport", expected)]
    assert expected > 500
