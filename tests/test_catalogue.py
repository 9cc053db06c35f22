"""Every registered query against DuckDB on the smallest tables."""

import glob
import math
import os

import duckdb
import pytest

from attesta.plans import audit_case  # noqa: F401
from attesta.plans.catalogue import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS FROM '{f}'")
    return con


def plain(v):
    return ("nan" if math.isnan(v) else repr(round(v, 9) + 0.0)) if isinstance(v, float) else str(v)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    rows, cols = df.collect(), sorted(df.columns)
    if name not in ORACLES:
        assert rows
        return
    want = duck.sql(f"SELECT * FROM ({ORACLES[name]})")
    assert sorted(want.columns) == cols
    at = [want.columns.index(c) for c in cols]
    assert sorted(tuple(plain(r[c]) for c in cols) for r in rows) == sorted(tuple(plain(r[i]) for i in at) for r in want.fetchall())
