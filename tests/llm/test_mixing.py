from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from pageloom.llm import mixing as M

from .conftest import words


def sized(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def plain(sizes, weights=(3, 1, 2), share=1.5, cap=2.0):
    """Share out by weight; cut at the cap; share the excess again, until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    full = set()
    while True:
        left = share * sum(sizes.values()) - sum(cap * sizes[s] for s in full)
        free = sum(weight[s] for s in names if s not in full)
        out = {s: cap * sizes[s] if s in full else left * weight[s] / free for s in names}
        over = {s for s in names if s not in full and out[s] > cap * sizes[s]}
        if not over:
            return out
        full |= over


def rows_of(plan):
    return plan.select("doc_id", "source", "_mix_size", "_mix_source_size", "_mix_target", "_mix_taken").collect()


def check(docs, got):
    sizes, taken = {}, {}
    for r in docs:
        sizes[r.source] = sizes.get(r.source, 0) + sized(r.text)
    for r in got:
        taken[r.source] = taken.get(r.source, 0) + r._mix_taken
        assert 0 <= r._mix_taken <= 2 * r._mix_size and r._mix_source_size == sizes[r.source]
        assert r._mix_target == pytest.approx(plain(sizes)[r.source])
    for s, target in plain(sizes).items():
        assert abs(taken[s] - target) <= 8, (s, taken[s], target)  # a shared hash is cut evenly


def test_targets_are_met(spark, documents):
    texts = [words(i, 1 + i * 7 % 90) for i in range(900)]
    sources = [["big", "é", "b", None, "tiny", "z"][min(i % 11, 5) if i else 4] for i in range(900)]
    docs = documents(texts, sources=sources)
    got = rows_of(M.taken(M.mix(docs)))
    assert sorted(r.doc_id for r in got) == list(range(900))
    check(docs.collect(), got)
    again = rows_of(M.taken(M.mix(docs.repartition(5))))
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_odd_rows(documents, odd_texts):
    texts = [*odd_texts, *[words(9, 40)] * 200]
    docs = documents(texts, ids=[None, 1, 1, *range(3, len(texts) - 200), *[77] * 200], sources=[None, *["a"] * (len(texts) - 1)])
    check(docs.collect(), rows_of(M.taken(M.mix(docs))))


def test_mix_rows(documents):
    texts = [words(i, 30) for i in range(700)]
    docs = documents(texts)
    plan = M.mix(docs, shard_words=4_000)
    out = M.draw(plan)
    assert out.columns == [*docs.columns, "_mix_shard"]
    taken = {r.doc_id: r._mix_taken for r in rows_of(M.taken(plan))}
    drawn = {}
    for r in out.collect():
        assert texts[r.doc_id].startswith(r.text)
        drawn[r.doc_id] = drawn.get(r.doc_id, 0) + sized(r.text)
    assert drawn == {k: v for k, v in taken.items() if v}
    shards = out.groupBy("_mix_shard").agg(F.sum(F.size(F.split("text", " "))).alias("n")).collect()
    assert len(shards) == plan.shards and max(r.n for r in shards) < 3 * min(r.n for r in shards)


def test_tree_deals_every_draw_once(spark):
    quotas = spark.createDataFrame([(0, 500), (1, 3), (2, 90)], "rank long, quota long")
    got = M.split_quotas(quotas, 150, 1).collect()
    for rank, quota in ((0, 500), (1, 3), (2, 90)):
        dealt = sorted(d for r in got if r["rank"] == rank for d in range(r["first"], r["first"] + r["quota"]))
        assert dealt == list(range(quota))
    sizes = {}
    for r in got:
        sizes[r["shard"]] = sizes.get(r["shard"], 0) + r["quota"]
    assert set(sizes) <= set(range(150)) and max(sizes.values()) <= 6


def test_empty(documents):
    assert M.taken(M.mix(documents([]))).count() == 0
    assert M.draw(M.mix(documents([None, ""]))).count() in range(5)
