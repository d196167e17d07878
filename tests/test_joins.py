from __future__ import annotations

import itertools

import pytest

from pageloom.operators import joins, skew
from pageloom.operators.joins import JoinSpec, join_pair, multi_join
from pageloom.operators.sequence import freeze_ids, sequence_rows


def frame(spark, ddl, *rows):
    return spark.createDataFrame(list(rows), ddl)


@pytest.fixture
def people(spark):
    return frame(spark, "k int, a string", (1, "x"), (2, "y"), (None, "n"))


@pytest.fixture
def towns(spark):
    return frame(spark, "k int, b string", (1, "p"), (3, "q"), (None, "m"))


@pytest.mark.parametrize(
    ("how", "expected"),
    [
        ("left", {(1, "x", "p"), (2, "y", None), (None, "n", "m")}),
        ("inner", {(1, "x", "p"), (None, "n", "m")}),
        ("right", {(1, "x", "p"), (3, None, "q"), (None, "n", "m")}),
        ("outer", {(1, "x", "p"), (2, "y", None), (3, None, "q"), (None, "n", "m")}),
    ],
)
@pytest.mark.parametrize("small", [True, False])
def test_how_and_null_keys(people, towns, how, expected, small, monkeypatch):
    monkeypatch.setattr(joins, "fits_broadcast", lambda df: small)
    out = join_pair(people, towns, ["k"], how)
    assert {(r["k"], r["a"], r["b"]) for r in out.collect()} == expected


def test_missing_key_meets_null_keys(spark, people):
    right = frame(spark, "b string", ("z",))
    got = {(r["a"], r["b"]) for r in join_pair(people, right, ["k"]).collect()}
    assert got == {("x", None), ("y", None), ("n", "z")}


def test_key_kinds_must_agree(spark, people):
    with pytest.raises(TypeError, match="join key 'k'"):
        join_pair(people, frame(spark, "k string, b int", ("1", 1)), ["k"])
    wide = join_pair(people, frame(spark, "k double, b int", (1.0, 1)), ["k"])
    assert {(r["k"], r["b"]) for r in wide.collect()} == {(1.0, 1), (2.0, None), (None, None)}


def test_suffixes_over_a_fold(spark):
    pulls = [(n, frame(spark, "k int, v string", (1, n))) for n in "abcd"]
    out = multi_join(pulls, JoinSpec(["k"]))
    assert out.columns == ["k", "v_x", "v_y", "v_3", "v_4"]
    assert tuple(out.first()) == (1, "a", "b", "c", "d")


def test_three_sides_leave_the_third_name_plain(spark):
    pulls = [(n, frame(spark, "k int, v string", (1, n))) for n in "abc"]
    assert multi_join(pulls, JoinSpec(["k"])).columns == ["k", "v_x", "v_y", "v"]


def test_keep_and_rename(spark, people):
    right = frame(spark, "b int, k int, c int, d int", (5, 1, 6, 7))
    chosen = {"r": {"keep": ["d", "b", "zz"], "rename": {"d": "dd", "zz": "q"}}}
    out = multi_join([("l", people), ("r", right)], JoinSpec(["k"], select_from=chosen))
    assert out.columns == ["k", "a", "b", "dd"]
    with pytest.raises(ValueError, match="renamed"):
        multi_join(
            [("l", people), ("r", right)],
            JoinSpec(["k"], select_from={"r": {"rename": {"k": "z"}}}),
        )


@pytest.mark.parametrize(
    ("case", "columns"),
    [
        ("lower", ["id", "aval", "bval"]),
        ("upper", ["ID", "AVAL", "BVAL"]),
        ("ignore", ["Id", "aVal", "BVal"]),
    ],
)
def test_case(spark, case, columns):
    left, right = frame(spark, "ID int, aVal int", (1, 2)), frame(spark, "iD int, BVal int", (1, 3))
    out = multi_join([("l", left), ("r", right)], JoinSpec(["Id"], case=case))
    assert out.columns == columns
    assert tuple(out.first()) == (1, 2, 3)


def test_case_exact_is_literal(spark):
    left, right = frame(spark, "ID int, a int", (1, 2)), frame(spark, "id int, b int", (1, 3))
    out = multi_join([("l", left), ("r", right)], JoinSpec(["id"]))
    assert out.columns == ["ID", "a", "id", "b"]
    assert [tuple(r) for r in out.collect()] == [(1, 2, None, None)]


def test_names_that_meet_in_one_case(spark):
    df = frame(spark, "id int", (1,)).selectExpr("id AS k", "id AS K")
    with pytest.raises(ValueError, match="differ only by case"):
        multi_join([("l", df), ("r", df)], JoinSpec(["k"], case="lower"))


def test_no_join_reads_the_first_only(people, towns):
    assert multi_join([("a", people), ("b", towns)], None) is people
    assert multi_join([("a", people)], JoinSpec(["k"])) is people


def test_spec_checks():
    for bad in ({"on": []}, {"on": ["k"], "how": "cross"}, {"on": ["k"], "case": "title"}):
        with pytest.raises(ValueError):
            JoinSpec(**bad)


def test_within_a_window(spark):
    head = "_pull string, _window_seq int, _page_seq int, _row_seq int, k int, "
    left = frame(spark, head + "a int", ("l", 0, 0, 0, 1, 10), ("l", 1, 0, 0, 1, 11))
    right = frame(spark, head + "b int", ("r", 1, 0, 5, 1, 99))
    out = join_pair(left, right, ["k"], within=["_window_seq"])
    assert {(r["_window_seq"], r["_pull"], r["b"]) for r in out.collect()} == {
        (0, "l", None),
        (1, "l", 99),
    }


# ---- hot keys -------------------------------------------------------------------


@pytest.mark.parametrize("how", ["inner", "left", "right", "full"])
def test_split_join_equals_a_plain_join(spark, how):
    """Hot on the left, on the right, on both, null, and without a partner."""
    sizes = {"L": (40, 2), "R": (1, 30), "B": (12, 11), None: (15, 2), "l": (20, 0), "r": (0, 20)}
    left = [(k, i) for k, (n, _) in sizes.items() for i in range(n)] + [("L", 0)] * 5
    right = [(k, i) for k, (_, n) in sizes.items() for i in range(n)]
    a, b = frame(spark, "k string, a int", *left), frame(spark, "k string, b int", *right)
    got = skew.split_join(a, b, ["k"], how, ["k", "a"], ["k", "b"], hot_rows=4)
    pairs = [(k, x, y) for (k, x), (j, y) in itertools.product(left, right) if k == j]
    if how in ("left", "full"):
        pairs += [(k, x, None) for k, x in left if sizes[k][1] == 0]
    if how in ("right", "full"):
        pairs += [(k, None, y) for k, y in right if sizes[k][0] == 0]
    key = lambda r: tuple(str(v) for v in r)
    assert sorted([(r["k"], r["a"], r["b"]) for r in got.collect()], key=key) == sorted(
        pairs, key=key
    )


@pytest.mark.parametrize("how", ["inner", "left"])
def test_split_join_with_one_row_per_key(spark, how):
    left = [("h", i) for i in range(50)] + [("c", 0), ("z", 1)]
    a = frame(spark, "k string, a int", *left)
    b = frame(spark, "k string, b int", ("h", 1), ("c", 2))
    got = skew.split_join(a, b, ["k"], how, ["a"], ["k"], hot_rows=7, right_bounded=True)
    assert got.count() == (52 if how == "left" else 51)
    assert got.where("b IS NULL").count() == (1 if how == "left" else 0)


def test_hot_rows_are_spread(spark):
    df = spark.range(4000).selectExpr("'hot' AS k", "id")
    hot = skew.hot_keys(df, None, ["k"], 500)
    assert hot.first()["_lways"] == 8
    spread = skew.spread_by(df, ["k"], ["id"], hot_rows=500)
    sizes = [n for n in spread.rdd.mapPartitions(lambda it: [sum(1 for _ in it)]).collect() if n]
    assert len(sizes) > 1 and sum(sizes) == 4000


def test_attach_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr(skew, "fits_broadcast", lambda df: False)
    monkeypatch.setattr(skew, "HOT_ROWS", 10)
    df = spark.range(100).selectExpr("id % 2 AS k", "id")
    facts = frame(spark, "k bigint, f string", (0, "even"))
    got = skew.attach(df, facts, ["k"], ["id"])
    assert got.where("f = 'even'").count() == 50 and got.count() == 100


def test_sequence_is_dense_and_ordered(spark):
    df = spark.range(0, 5000, 1, 7).selectExpr("(id * 7919) % 5000 AS k")
    got = sequence_rows(df, ["k"], "n").collect()
    assert sorted((r["k"], r["n"]) for r in got) == [(i, i) for i in range(5000)]


def test_freeze_ids_are_unique(spark):
    df = spark.range(0, 100, 1, 5).selectExpr("1 AS same")
    assert freeze_ids(df).select("_row_seq").distinct().count() == 100
