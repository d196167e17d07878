"""Positions in long chains by contraction."""

from __future__ import annotations

import random

import pytest

from pageloom.operators import chains, ranking
from pageloom.operators.chains import follow_chain

SCHEMA = "pull string, key string, next string"


def chain(pull, n, seed, ends=None):
    """Edges of a list of n pages in no order, and its keys in order."""
    keys = [f"{pull}-{i:x}" for i in random.Random(seed).sample(range(10 * n + 1), n)]
    edges = [(pull, a, b) for a, b in zip(keys, [*keys[1:], ends])]
    random.Random(seed + 1).shuffle(edges)
    return edges, keys


def ranks(df):
    return sorted((r.pull, r.depth, r.key) for r in df.collect())


@pytest.mark.parametrize("walked", [30, 10_000])
def test_lists_of_all_lengths(spark, walked):
    edges, want, starts = [], [], []
    for pull, n in (("a", 1), ("b", 2), ("c", 3), ("d", 57), ("e", 300)):
        more, keys = chain(pull, n, n)
        edges += more
        starts.append((pull, keys[0]))
        want += [(pull, i, k) for i, k in enumerate(keys)]
    got = ranking.rank_lists(spark.createDataFrame(edges, SCHEMA), spark.createDataFrame(starts, "pull string, key string"), ["pull"], walked)
    assert ranks(got) == sorted(want)


def test_parts_no_start_leads_to_and_pages_never_landed(spark):
    edges, keys = chain("a", 120, 1, ends="never landed")
    other, _ = chain("a", 90, 2)  # a list of its own, without a start
    ring = [("a", f"r{i}", f"r{(i + 1) % 50}") for i in range(50)]
    without, _ = chain("b", 80, 3)  # a chain whose start is not asked for
    frame = spark.createDataFrame(edges + [(p, "x" + a, b and "x" + b) for p, a, b in other] + ring + without, SCHEMA)
    starts = spark.createDataFrame([("a", keys[0])], "pull string, key string")
    got = ranking.rank_lists(frame, starts, ["pull"], 30)
    assert ranks(got) == [("a", i, k) for i, k in enumerate(keys)]


def test_rounds_write_rows_in_proportion(spark, monkeypatch):
    written = []
    real = ranking.landed

    def counted(df, label):
        out = real(df, label)
        written.append((label, out.count()))
        return out

    monkeypatch.setattr(ranking, "landed", counted)
    n = 2000
    edges, keys = chain("a", n, 9)
    got = ranking.rank_lists(spark.createDataFrame(edges, SCHEMA), spark.createDataFrame([("a", keys[0])], "pull string, key string"), ["pull"], 200)
    assert ranks(got) == [("a", i, k) for i, k in enumerate(keys)]
    rounds = [rows for label, rows in written if label == "chain"]
    assert rounds[0] == n and all(b < 0.75 * a for a, b in zip(rounds, rounds[1:]))
    assert sum(rounds) < 3.6 * n and sum(rows for _, rows in written) < 7 * n


def test_follow_chain_ranks_lists_and_doubles_the_rest(spark, monkeypatch):
    used = []
    real = chains.rank_lists
    monkeypatch.setattr(chains, "rank_lists", lambda *a: used.append(1) or real(*a))
    edges, keys = chain("a", 30, 5)
    starts = spark.createDataFrame([("a", keys[0])], "pull string, key string")
    assert ranks(follow_chain(spark.createDataFrame(edges, SCHEMA), starts, ["pull"], 12)) == [("a", i, k) for i, k in enumerate(keys[:12])]
    assert used == [1]
    # a second way into the list: not ranked, and the same pages
    forked = spark.createDataFrame([*edges, ("a", "side", keys[3])], SCHEMA)
    assert ranks(follow_chain(forked, starts, ["pull"])) == [("a", i, k) for i, k in enumerate(keys)]
    # round up to the cap
    ring = spark.createDataFrame([("a", "x", "y"), ("a", "y", "z"), ("a", "z", "x")], SCHEMA)
    begin = spark.createDataFrame([("a", "x")], "pull string, key string")
    assert ranks(follow_chain(ring, begin, ["pull"], 5)) == [("a", i, "xyzxy"[i]) for i in range(5)]
    assert used == [1]


def test_a_page_landed_twice_is_an_error(spark):
    twice = spark.createDataFrame([("a", "x", "y"), ("a", "x", "y"), ("a", "y", None)], SCHEMA)
    begin = spark.createDataFrame([("a", "x")], "pull string, key string")
    with pytest.raises(Exception, match="more than once"):
        follow_chain(twice, begin, ["pull"]).count()


def test_nothing_landed(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert follow_chain(none, none.select("pull", "key"), ["pull"]).count() == 0


def test_rounds_move_numbers_and_write_each_place_once(spark, monkeypatch):
    written = []
    real = ranking.landed
    monkeypatch.setattr(ranking, "landed", lambda df, label: written.append((label, out := real(df, label))) or out)
    n = 1000
    edges, keys = chain("a", n, 4)
    got = ranking.rank_lists(spark.createDataFrame(edges, SCHEMA), spark.createDataFrame([("a", keys[0])], "pull string, key string"), ["pull"], 300)
    assert ranks(got) == [("a", i, k) for i, k in enumerate(keys)]
    moved = [df for label, df in written if label != "pages"]
    assert {kind for df in moved for _, kind in df.dtypes} <= {"bigint", "boolean"}
    assert sum(df.count() for label, df in written if label == "ranks") == n
    assert ranking.WALKED >= 100_000


def test_chains_of_one_hash_are_walked_each_on_its_own(spark):
    rows = [(7, 1, 2, True, 1), (7, 2, None, False, 4), (7, 3, 4, True, 1), (7, 4, None, False, 2)]
    state = spark.createDataFrame(rows, "chain long, id long, next long, first boolean, back long")
    assert sorted(map(tuple, ranking._walk(state).collect())) == [(1, 0), (2, 4), (3, 0), (4, 2)]
