"""Every registered query against its SQL, on the smallest tables."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_points

SF = Path("/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

pytestmark = pytest.mark.skipif(not SF.exists(), reason="driver tables are not here")


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "null"
    return repr(v) if isinstance(v, float) else str(v)


@pytest.mark.parametrize("name", sorted(entry_points.queries()))
def test_query(spark, db, name):
    df = entry_points.queries()[name](spark, str(SF))
    cols = sorted(df.columns)
    got = sorted(tuple(plain(r[c]) for c in cols) for r in df.collect())
    sql = entry_points.oracle_sql().get(name)
    if sql is None:
        assert got
        return
    found = db.execute(sql)
    names = [d[0] for d in found.description]
    assert sorted(names) == cols
    at = [names.index(c) for c in cols]
    assert got == sorted(tuple(plain(r[i]) for i in at) for r in found.fetchall())


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0
