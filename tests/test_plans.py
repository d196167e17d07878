"""What the plans must and must not hold, whatever the data is."""

from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
from pageloom.operators import paging
from pageloom.operators.parse import ParseSpec, parse
from pageloom.operators.stops import StopSpec, apply_stops
from pageloom.runtime import RESPONSES_SCHEMA

SF = Path("/root/testdata/sf0.001")
SPEC = ParseSpec(record_path="d.i", schema="struct<d:struct<i:array<struct<a:int,b:string>>>>")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def landed(land, spark, tmp_path):
    land({"d": {"i": [{"a": 1, "b": "x"}]}}).write.parquet(f"{tmp_path}/r")
    return spark.read.schema(RESPONSES_SCHEMA).parquet(f"{tmp_path}/r")


def test_bodies_are_parsed_once(landed):
    assert plan(parse(landed, SPEC)).count("from_json") == 1
    lines = ParseSpec("jsonl", schema="struct<a:int,b:string>")
    assert plan(parse(landed, lines)).count("from_json") == 1
    table = ParseSpec("csv", schema="struct<a:int,b:string>")
    found = plan(parse(landed, table))
    assert "Python" not in found and found.count("split(body") == 1


def test_only_needed_columns_are_read(landed):
    found = plan(parse(landed, SPEC).select("_pull", "a"))
    assert "ReadSchema: struct<body:string,pull:string>" in found or (
        "ReadSchema: struct<pull:string,body:string>" in found
    )


def test_filters_reach_the_scan(landed):
    found = plan(parse(landed.where(F.col("pull") == "p"), SPEC).where(F.col("_page_seq") < 3))
    assert "EqualTo(pull,p)" in found and "LessThan(page_seq,3)" in found


@pytest.mark.parametrize("bound", [None, 1])
def test_cuts_do_not_gather_a_pull(landed, bound):
    trimmed = plan(paging.until_empty(landed, SPEC, max_chains=bound))
    stopped = plan(apply_stops(parse(landed, SPEC), StopSpec("b", "x"), bound))
    for found in (trimmed, stopped):
        assert "Window" not in found and "BroadcastHashJoin" in found
    # With a bound known beforehand nothing has been written out.
    assert ("ExistingRDD" in trimmed) == (bound is None)


@pytest.mark.skipif(not SF.exists(), reason="driver tables are not here")
@pytest.mark.parametrize(
    "name",
    [n for n in sorted(entry_points.queries()) if n.startswith(("multi_", "join_", "page_"))],
)
def test_no_cross_joins(spark, name):
    found = plan(entry_points.queries()[name](spark, str(SF)))
    assert "CartesianProduct" not in found and "NestedLoopJoin" not in found
