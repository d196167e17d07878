from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from pageloom.operators import windows as W
from pageloom.operators.stops import StopSpec, apply_stops

D = date


def plan(spark, a, b, n, half_open=False):
    rows = W.plan_windows(
        spark.createDataFrame([(a, b)], "a date, b date"), "a", "b", n, half_open
    )
    return [(r.window_seq, r.window_start, r.window_end) for r in rows.orderBy("window_seq").collect()]


@pytest.mark.parametrize("half_open", [False, True])
@pytest.mark.parametrize(("days", "length"), [(1, 3), (2, 3), (3, 3), (7, 1), (2, 8)])
def test_plan_matches_the_driver_side_list(spark, half_open, days, length):
    a, b = D(2024, 2, 27), D(2024, 2, 27 + length - 1) if length < 3 else D(2024, 3, length - 2)
    assert plan(spark, a, b, days, half_open) == W.window_list(a, b, days, half_open)


def test_closed_windows(spark):
    assert plan(spark, D(2024, 1, 1), D(2024, 1, 3), 2) == [
        (0, D(2024, 1, 1), D(2024, 1, 2)),
        (1, D(2024, 1, 3), D(2024, 1, 3)),
    ]


def test_half_open_windows(spark):
    assert plan(spark, D(2024, 1, 1), D(2024, 1, 3), 2, True) == [
        (0, D(2024, 1, 1), D(2024, 1, 3)),
        (1, D(2024, 1, 3), D(2024, 1, 4)),
    ]


def test_no_window_when_start_is_after_end(spark):
    assert plan(spark, D(2024, 1, 2), D(2024, 1, 1), 2) == []
    assert W.window_list(D(2024, 1, 2), D(2024, 1, 1)) == []


def test_days_must_be_positive():
    with pytest.raises(ValueError, match="positive"):
        W.window_list(D(2024, 1, 1), D(2024, 1, 2), 0)


def test_window_of_agrees_with_the_plan(spark):
    a, b = D(2024, 1, 3), D(2024, 1, 20)
    days = spark.sql("SELECT explode(sequence(DATE'2024-01-01', DATE'2024-01-25')) AS d")
    got = {r.d: r.w for r in days.select("d", W.window_of(F.col("d"), a, b, 7).alias("w")).collect()}
    for seq, s, e in W.window_list(a, b, 7):
        assert {d for d, w in got.items() if w == seq} == {d for d in got if s <= d <= e}
    assert got[D(2024, 1, 2)] is None and got[D(2024, 1, 21)] is None


def test_query_needs_a_template():
    with pytest.raises(ValueError, match="template"):
        W.window_query(None, "at")


# ---- stop rules ----------------------------------------------------------------


@pytest.fixture
def recs(spark):
    def make(*rows, schema="id string, at string"):
        keyed = [("p", 0, page, i, *rest) for i, (page, *rest) in enumerate(rows)]
        head = "_pull string, _window_seq int, _page_seq int, _row_seq int, "
        return spark.createDataFrame(keyed, head + schema)

    return make


ROWS = [
    (0, "a", "2024-01-09T00:00:00Z"),
    (0, "b", "2024-01-08T00:00:00Z"),
    (1, "c", "2024-01-07T00:00:00Z"),
    (1, "d", "2024-01-02T00:00:00Z"),
    (1, "e", "2024-01-06T00:00:00Z"),
    (2, "f", "2024-01-05T00:00:00Z"),
]
CUT = {"older_field": "at", "older_value": "2024-01-03T00:00:00Z"}


def kept(df, **rule):
    return "".join(sorted(r["id"] for r in apply_stops(df, StopSpec(**rule)).collect()))


def test_stop_at_item(recs):
    assert kept(recs(*ROWS), item_field="id", item_value="d") == "abc"
    assert kept(recs(*ROWS), item_field="id", item_value="d", inclusive=True) == "abcd"
    assert kept(recs(*ROWS), item_field="id", item_value="a") == ""


def test_stop_at_item_switched_off(recs):
    for rule in ({"item_value": ""}, {"item_field": "id"}, {"item_field": "zz", "item_value": "a"}):
        assert kept(recs(*ROWS), **rule) == "abcdef"
    assert kept(recs(*ROWS), item_field="id", item_value=5) == "abcdef"


def test_stop_by_age_filters_its_page(recs):
    assert kept(recs(*ROWS), **CUT) == "abce"


def test_unreadable_time_stops_and_is_dropped(recs):
    rows = [(0, "a", "2024-01-09T00:00:00Z"), (0, "b", "soon"), (1, "c", "2024-01-09T00:00:00Z")]
    assert kept(recs(*rows), **CUT) == "a"


def test_stop_time_must_be_readable():
    with pytest.raises(ValueError):
        StopSpec(older_field="at", older_value="last week")


def test_page_without_the_field_does_not_stop(recs):
    rows = [(0, "a", None), (1, "b", "2024-01-09T00:00:00Z"), (2, "c", "2023-01-01T00:00:00Z")]
    assert kept(recs(*rows), **CUT) == "ab"


def test_both_rules(recs):
    item = {"item_field": "id"}
    assert kept(recs(*ROWS), item_value="e", **item, **CUT) == "abcd"  # same page: item wins
    assert kept(recs(*ROWS), item_value="b", **item, **CUT) == "a"  # item page is earlier
    assert kept(recs(*ROWS), item_value="f", **item, **CUT) == "abce"  # age page is earlier


def test_chains_stop_on_their_own(recs, spark):
    other = recs(*ROWS).withColumn("_pull", F.lit("q")).where("id <> 'c'")
    both = recs(*ROWS).unionAll(other)
    got = apply_stops(both, StopSpec("id", "c")).groupBy("_pull").count().collect()
    assert {r["_pull"]: r["count"] for r in got} == {"p": 2, "q": 5}
