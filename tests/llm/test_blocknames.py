from __future__ import annotations

import hashlib
import random
import re
from collections import defaultdict

import pytest

from pageloom.llm import blocknames as B

from .conftest import words


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def plain(texts, ids):
    """(id, keep_id, size, sha) of each row, by comparing whole texts."""
    members = defaultdict(list)
    for i, t in zip(ids, texts):
        members[lowered(t)].append(i)
    best = {t: max(of, key=lambda i: (i is not None, i or 0)) for t, of in members.items()}
    return sorted(
        ((i, best[lowered(t)], len(members[lowered(t)]), hashlib.sha256(lowered(t).encode()).hexdigest()) for i, t in zip(ids, texts)),
        key=repr,
    )


def got(df):
    return sorted(((r.doc["doc_id"], r.keep_id, r.group_size, r.sha) for r in df.collect()), key=repr)


@pytest.mark.parametrize("block", [1, 7, 2048])
def test_groups_equal_those_of_whole_texts(spark, documents, odd_texts, block):
    texts = [t for t in odd_texts if len(t or "") < 1000] + ["é" * 20, "É" * 20, "ab" * 33, "ab" * 34, "AB" * 33, "abab" * 17]
    texts = texts * 2 + texts[:3]
    ids = list(range(len(texts)))
    found = B.groups(documents(texts, ids), block=block)
    assert got(found) == plain(texts, ids)
    kept = [r.doc["doc_id"] for r in found.where("kept").collect()]
    assert sorted(kept) == sorted({r[1] for r in plain(texts, ids)})


def test_texts_that_differ_in_one_place_or_by_order_of_blocks(spark, documents):
    rng = random.Random(3)
    base = [words(i, 40)[:128] for i in range(8)]
    texts = []
    for _ in range(60):
        mixed = "".join(rng.choice(base) for _ in range(rng.randint(1, 9)))
        texts += [mixed, mixed.upper(), mixed[:-1], mixed + " "]
    found = B.groups(documents(texts), block=16)
    assert got(found) == plain(texts, range(len(texts)))


def test_long_texts(spark, documents, odd_texts):
    long = [odd_texts[10], odd_texts[10].upper(), odd_texts[10][:-1] + "?", odd_texts[11], odd_texts[11]]
    assert got(B.groups(documents(long))) == plain(long, range(5))


def test_a_hot_block_is_folded_before_the_sort(spark, documents, monkeypatch):
    monkeypatch.setattr(B, "HELD_BYTES", 4000)
    line = "x" * 64
    texts = [line * 5 + str(i % 150) for i in range(400)]
    pieces = B.cut(documents(texts).repartition(3), "text", ["doc_id"], 64).cache()
    blocks = pieces.where("block IS NOT NULL")
    assert blocks.count() == blocks.select("task", "local").distinct().count()
    assert blocks.groupBy("task").agg({"block": "count"}).count() > 3  # flushed on the way
    assert blocks.selectExpr("sum(size(rows))").first()[0] == 400 * 6
    pieces.unpersist()
    assert got(B.groups(documents(texts), block=64)) == plain(texts, range(400))


def test_names_are_dense_in_order_and_free_of_collisions(spark):
    rows = [(bytes([a, b]), a * 10 + b, 1) for a in range(20) for b in range(3) for _ in range(2)]
    df = spark.createDataFrame(rows, "block binary, local long, n long").repartition(5)
    found = B.name(df, ["block"], ["local"]).collect()
    by_local = defaultdict(set)
    for r in found:
        by_local[r.local].add((r.name, r.held))
    assert len(found) == len(rows) and all(len(v) == 1 for v in by_local.values())
    names = [next(iter(by_local[k])) for k in sorted(by_local)]
    assert names == sorted(names) and len(set(names)) == 60 and {n[1] for n in names} == {2}


def test_null_ids_repeats_and_clashing_columns(spark, documents):
    texts = ["a", "A", None, "", "b", "b", "b"]
    docs = documents(texts, ids=[None, None, 3, 3, 7, None, 7])
    found = B.groups(docs)
    assert got(found) == plain(texts, [None, None, 3, 3, 7, None, 7])
    kept = B.drop_exact(docs)
    assert kept.columns == docs.columns and kept.schema == docs.schema
    assert sorted((r.doc_id is None, r.doc_id or 0, (r.text or "").lower()) for r in kept.collect()) == [(False, 3, ""), (False, 7, "b"), (True, 0, "a")]


def test_empty_table(spark, documents):
    none = documents(["x"]).limit(0)
    assert B.groups(none).count() == 0 and B.drop_exact(none).columns == none.columns
