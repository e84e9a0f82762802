import datetime as dt
import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from farebox.session import build_session  # noqa: E402
from farebox.sources.raw import RAW_SCHEMA  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[*]", shuffle_partitions=8)
    yield s


@pytest.fixture
def scratch(spark):
    """Fresh folder below the shared checkpoint root (never reused)."""
    from farebox.session import scratch_path
    return lambda name="t": scratch_path(spark, name)


BASE_ROW = dict(
    vendorid=1, tpep_pickup_datetime=dt.datetime(2024, 1, 10, 8, 0, 0),
    tpep_dropoff_datetime=dt.datetime(2024, 1, 10, 8, 30, 0), passenger_count=1.0,
    trip_distance=5.0, ratecodeid=1.0, store_and_fwd_flag="N", pulocationid=132,
    dolocationid=236, payment_type=1, fare_amount=20.0, extra=0.5, mta_tax=0.5,
    tip_amount=4.0, tolls_amount=0.0, improvement_surcharge=0.3, total_amount=27.8,
    congestion_surcharge=2.5, airport_fee=0.0, year=2024, month=1,
)


def raw_rows(spark, *overrides):
    """Raw trip rows from BASE_ROW with per-row overrides (year/month are
    re-derived from the pickup unless given)."""
    rows = []
    for o in overrides:
        r = dict(BASE_ROW, **o)
        if "year" not in o and "month" not in o:
            ts = r["tpep_pickup_datetime"]
            r["year"], r["month"] = (ts.year, ts.month) if ts else (None, None)
        rows.append(tuple(r[f.name] for f in RAW_SCHEMA.fields))
    return spark.createDataFrame(rows, RAW_SCHEMA)
