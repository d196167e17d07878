from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pageloom.llm import quality_rules as Q

from .conftest import words

SPACE = " \t\n\x0b\x0c\r"


def plain(text):
    text = text or ""
    found = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = Counter(zip(found, found[1:], found[2:]))
    inside = {j for i, g in enumerate(zip(found, found[1:], found[2:])) if grams[g] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return [len(found), sum(map(len, found)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(inside)]


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("ab #\n\t\x1f é"), max_size=60))
def test_counts(text):
    assert Q.rule_stats(text)[0] == plain(text)


def test_rows(spark, documents, odd_texts):
    docs = documents(odd_texts)
    forest = Q.fit(docs, spark.createDataFrame([(None, 1), (5, None)], "doc_id long, quality int"))
    got = {r.doc_id: r for r in Q.judge(docs, forest, keep=["doc_id", "a.b"]).collect()}
    for i, text in enumerate(odd_texts):
        assert [got[i][c] for c in Q.STATS] == plain(text)
        assert got[i].base_failed == Q.fails_base(plain(text)) and got[i].kept == (not got[i].base_failed)


def test_odd_documents_go(spark, documents):
    good = [words(i, 80) for i in range(300)]
    bad = [" ".join(w + "***" for w in words(1000 + i, 80).split()) for i in range(30)]
    docs = documents(good + bad)
    labels = spark.createDataFrame([(i, int(i < 300)) for i in range(330)], "doc_id long, quality int")
    forest = Q.fit(docs, labels, trees=60)
    kept = {r.doc_id: r.kept for r in Q.judge(docs, forest, keep=["doc_id"]).collect()}
    assert all(kept[i] for i in range(300)) and not any(kept[i] for i in range(300, 330))
    assert Q.fit(docs, labels, trees=5).feature.tolist() == Q.fit(docs.repartition(7), labels, trees=5).feature.tolist()


def test_all_columns_stay_and_empty_tables(spark, documents):
    docs = documents([])
    out = Q.judge(docs, Q.Forest())
    assert out.count() == 0 and set(docs.columns) <= set(out.columns)


@pytest.mark.parametrize("good", [[1, 1, 1], [0, 0, 1], [0, 0, 0]])
def test_threshold(good):
    good = np.array(good) > 0
    cut = Q.calibrate(np.array([0.4, 0.9, 0.3]), good, 0.0)
    assert not ((np.array([0.4, 0.9, 0.3]) > cut) & good).any()


def test_one_odd_good_row_does_not_set_the_threshold():
    score = np.concatenate([np.linspace(0.3, 0.5, 300), [0.71], np.linspace(0.6, 0.7, 24)])
    good = np.arange(len(score)) <= 300
    cut = Q.calibrate(score, good, 0.002)
    assert (score[~good] > cut).all() and (score[good] > cut).sum() == 1
    assert (score[good] > Q.calibrate(score, good, 0.0)).sum() == 0
