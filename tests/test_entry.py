"""Driver contract, and the DuckDB twins checked at the smallest scale."""

import os
import sys

import duckdb
import pytest

from conftest import ROOT, SF_SMALL

sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tools"))

import __spark_entry__ as entry_mod  # noqa: E402
from compare import TABLES, digest  # noqa: E402

from farebox.plans import catalog, oracle  # noqa: E402


def test_entry_runs(spark):
    df = entry_mod.entry(spark)
    rows = df.collect()
    assert len(rows) == 5
    assert df.columns == ["zone_name", "borough", "trips"]


def test_every_query_has_a_twin():
    assert set(entry_mod.oracle_sql()) <= set(entry_mod.queries())
    assert set(catalog.QUERIES) == set(oracle.SQL)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


@pytest.mark.parametrize("name", sorted(oracle.SQL))
def test_query_matches_duckdb(spark, duck, name):
    df = entry_mod.queries()[name](spark, SF_SMALL)
    srows = [tuple(r) for r in df.collect()]
    res = duck.execute(entry_mod.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert digest(df.columns, srows)[0] == digest(dcols, drows)[0]
