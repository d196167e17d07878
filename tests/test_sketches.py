"""Joins of two large sides: landed once, counted by the write, hot keys on a grid."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from pageloom.operators import joins, sketches
from pageloom.operators.joins import JoinSpec, multi_join
from pageloom.operators.skew import null_safe

HOWS = ["inner", "left", "right", "full"]


def sides(spark, seed=1):
    rng = random.Random(seed)
    key = lambda hot: rng.choice([hot, hot, None, 0.0, -0.0, float("nan"), *range(40)])
    left = [(key(7.0), "x" if rng.random() < 0.7 else None, i) for i in range(300)]
    right = [(key(11.0), "x" if rng.random() < 0.7 else None, i) for i in range(200)]
    left += [(7.0, "x", i) for i in range(300, 500)]
    right += [(11.0, "x", i) for i in range(200, 260)] + [(99.0, "y", i) for i in range(260, 300)]
    as_float = lambda rows: [(None if k is None else float(k), s, i) for k, s, i in rows]
    return (
        spark.createDataFrame(as_float(left), "k double, s string, a int").repartition(4),
        spark.createDataFrame(as_float(right), "k double, s string, b int").repartition(3),
    )


def plain(left, right, on, how):
    """The pairs (a, b) of an ordinary null-safe join."""
    return sorted(((r["a"], r["b"]) for r in left.join(right, null_safe(left, right, on), how).select("a", "b").collect()), key=str)


@pytest.mark.parametrize("on", [["k"], ["k", "s"]])
@pytest.mark.parametrize("how", HOWS)
def test_equals_a_plain_join(spark, how, on):
    left, right = sides(spark)
    for hot in (5, 60, None):
        out = sketches.counted_join(left, right, on, how, ["a"], ["b"], hot_rows=hot)
        assert out.columns == [*left.columns, *[c for c in right.columns if c not in on]]
        got = sorted(((r[0], r[1]) for r in out.select("a", "b").collect()), key=str)
        assert got == plain(left, right, on, how)
        keys = {(str(r["k"] + 0.0 if r["k"] is not None else None), r["a"] is None, r["b"] is None) for r in out.select("k", "a", "b").collect()}
        assert (("None", True, True)) not in keys


@pytest.mark.parametrize("how", HOWS)
def test_empty_sides(spark, how):
    left, right = sides(spark)
    for a, b in ((left.limit(0), right), (left, right.limit(0)), (left.limit(0), right.limit(0))):
        out = sketches.counted_join(a, b, ["k"], how, ["a"], ["b"], hot_rows=5)
        assert out.count() == len(plain(a, b, ["k"], how))


def test_the_write_counts_rows_and_hot_keys(spark):
    df = spark.range(9000).selectExpr("if(id % 3 = 0, 'hot', concat('k', id)) AS k", "id % 2 AS m", "id")
    landed = sketches.land_counted(df, ["k", "m"], "side")
    assert landed.n == 9000 and landed.rows.count() == 9000
    assert landed.top['["hot","0"]'] == landed.top['["hot","1"]'] == 1500
    ways = sketches.hot_ways(landed, sketches.Landed(df, 0, {}), 500)
    assert ways == {'["hot","0"]': (3, 1), '["hot","1"]': (3, 1)}


def test_hot_rows_spread_over_tasks(spark):
    whole = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(whole)
    spark.conf.set(whole, "false")
    left = spark.range(4000).selectExpr("'hot' AS k", "id AS a")
    right = spark.range(30).selectExpr("'hot' AS k", "id AS b")
    out = sketches.counted_join(left, right, ["k"], "full", ["a"], ["b"], hot_rows=100)
    try:
        tasks = out.groupBy(F.spark_partition_id().alias("p")).count().collect()
    finally:
        spark.conf.set(whole, before)
    assert sum(r["count"] for r in tasks) == 4000 * 30 and len(tasks) > 1


def test_bloom_keeps_all_partners_and_little_else(spark):
    keys = sketches.land_counted(spark.range(0, 60_000, 3).selectExpr("id AS k"), ["k"], "keys")
    rows = spark.range(60_000).selectExpr("id AS k", "id AS _word")
    kept = {r[0] for r in sketches.filtered(rows, ["k"], keys).select("k").collect()}
    assert kept >= set(range(0, 60_000, 3)) and len(kept) < 20_000 + 0.08 * 40_000
    many = sketches.Landed(keys.rows, sketches.BLOOM_WORDS * sketches.KEYS_A_WORD, {})
    assert sketches.bloom(many, ["k"]) is None and sketches.filtered(rows, ["k"], many) is rows


@pytest.mark.parametrize("how", ["inner", "outer"])
def test_each_side_is_read_once(spark, tmp_path, monkeypatch, how):
    monkeypatch.setattr(joins, "fits_broadcast", lambda df: False)
    monkeypatch.setattr(sketches, "HOT_ROWS", 20)
    for name in ("l", "r"):
        spark.range(500).selectExpr("if(id % 3 = 0, 1, id) AS k", f"id AS {name}").write.parquet(f"{tmp_path}/{name}")
    left, right = (spark.read.parquet(f"{tmp_path}/{name}") for name in ("l", "r"))
    out = multi_join([("a", left), ("b", right)], JoinSpec(["k"], how=how))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 2 and plan.count("SortMergeJoin") == 1 and "Union" not in plan
    want = left.join(right, "k", "inner" if how == "inner" else "full")
    assert sorted(map(str, out.collect())) == sorted(map(str, want.select(*out.columns).collect()))
