"""Every registered telemetry query against its SQL, on the driver's smallest tables."""

from __future__ import annotations

import math
import os

import pytest

from tideline.registry import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for name in ("events", "orders"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SF}/{name}.parquet')")
    return con


def plain(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return "null"
    return f"{v:.5g}" if isinstance(v, float) else str(v)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_as_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    result = duck.sql(ORACLE[name])
    columns = sorted(df.columns)
    assert columns == sorted(result.columns)
    place = {c: i for i, c in enumerate(result.columns)}
    want = sorted(tuple(plain(r[place[c]]) for c in columns) for r in result.fetchall())
    assert sorted(tuple(plain(r[c]) for c in columns) for r in df.collect()) == want


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).limit(1).count() == 1
    assert set(e.oracle_sql()) <= set(e.queries())
