"""Stop rules and ranges over landed records read the files that matter, and give the same rows."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from pageloom.operators import zones
from pageloom.operators.stops import StopSpec, apply_stops
from pageloom.operators.zones import apply_stops_zoned, land_zoned

N, PAGE = 4000, 20


@pytest.fixture(scope="module")
def records(spark):
    """Two long chains, newest first, and one without any time; rows out of order."""
    day = F.expr("date_format(timestamp'2024-06-01 00:00:00' - make_interval(0, 0, 0, CAST(id / 10 AS INT)), \"yyyy-MM-dd'T'HH:mm:ss'Z'\")")
    made = spark.range(N).select(
        F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("_pull"),
        F.lit(0).alias("_window_seq"),
        F.expr(f"CAST(id div {PAGE} AS INT)").alias("_page_seq"),
        F.col("id").alias("_row_seq"),
        F.concat(F.lit("i"), F.col("id")).alias("item"),
        F.when(F.col("id") == 2222, "broken").otherwise(day).alias("at"),
        F.col("id").alias("n"),
    )
    other = made.where("_pull = 'a'").withColumns({"_pull": F.lit("c"), "_window_seq": F.lit(3), "at": F.lit(None).cast("string")})
    return made.unionByName(other).orderBy(F.xxhash64("_row_seq"))


@pytest.fixture(scope="module")
def zoned(records):
    return land_zoned(records, ["item", "at", "n", "absent"], files=30)


def rows(df):
    return sorted((r["_pull"], r["_row_seq"]) for r in df.collect())


@pytest.mark.parametrize(
    ("stop", "most"),
    [
        (StopSpec(older_field="at", older_value="2024-04-01T00:00:00Z"), 17),
        (StopSpec("item", "i500"), 25),
        (StopSpec("item", "i500", inclusive=True, older_field="at", older_value="2023-08-01T00:00:00Z"), 22),
        (StopSpec("n", 3001), 29),
        (StopSpec("item", "no such item"), 30),
        (StopSpec("n", "text for a number"), 30),
        (StopSpec("absent", 1), 30),
        (StopSpec(), 30),
    ],
)
def test_same_rows_from_fewer_files(records, zoned, stop, most):
    out = apply_stops_zoned(zoned, stop)
    assert rows(out) == rows(apply_stops(records, stop))
    all_files = len(zoned.of(zoned.zones).inputFiles())
    assert all_files == 30 and len(out.inputFiles()) <= most


def test_zones_tell_what_is_in_the_files(zoned):
    for zone in zoned.zones.collect():
        here = [r for r in zoned.spark.read.parquet(zone["file"]).collect() if r["_pull"] == zone["_pull"]]
        pages, items = [r["_page_seq"] for r in here], [r["item"] for r in here]
        assert (zone["rows"], zone["page_lo"], zone["page_hi"]) == (len(here), min(pages), max(pages))
        assert (zone["lo0"], zone["hi0"]) == (min(items), max(items))
        assert zone["unread1"] == sum(r["at"] == "broken" for r in here)


def test_ranges_of_windows_and_pages(records, zoned):
    some = zoned.read(pages=(30, 40), pulls=["a"])
    assert rows(some) == rows(records.where("_pull = 'a' AND _page_seq BETWEEN 30 AND 40"))
    assert len(some.inputFiles()) <= 4
    late = zoned.read(windows=(1, 9))
    assert rows(late) == rows(records.where("_pull = 'c'")) and len(late.inputFiles()) <= 11
    assert zoned.read(windows=(7, 9)).count() == 0


def test_more_files_than_can_be_named(records, zoned, monkeypatch):
    monkeypatch.setattr(zones, "LISTED", 3)
    stop = StopSpec(older_field="at", older_value="2024-04-01T00:00:00Z")
    assert rows(apply_stops_zoned(zoned, stop)) == rows(apply_stops(records, stop))


def test_no_records(records):
    none = land_zoned(records.limit(0), ["at"])
    assert apply_stops_zoned(none, StopSpec(older_field="at", older_value="2024-04-01")).count() == 0
    assert none.read(pages=(0, 5)).count() == 0
