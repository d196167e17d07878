from __future__ import annotations

import random

import corpus_pipeline as C
import numpy as np
import pytest

from pageloom.llm import similar as S

from .conftest import words


def plain(text):
    found = (text or "").lower().split()
    return {tuple(found[i : i + 5]) for i in range(max(len(found) - 4, min(len(found), 1)))}


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def changed(text, n, seed):
    rng, out = random.Random(seed), text.split()
    for at in rng.sample(range(len(out)), n):
        out[at] = f"new{rng.random()}"
    return " ".join(out)


def least_of_components(texts):
    sets, root = [plain(t) for t in texts], list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if root[i] != root[j] and jaccard(sets[i], sets[j]) >= 0.8:
                low, high = sorted((root[i], root[j]))
                root = [low if r == high else r for r in root]
    return sorted(set(root))


def test_near_copies_leave_the_pipeline(spark, documents):
    texts, near = [], []
    for k, (size, n) in enumerate([(100, 1), (100, 2), (300, 3), (300, 6), (1000, 10), (1000, 20)] * 5):
        texts += [words(k, size), changed(words(k, size), n, k)]
        near.append(jaccard(plain(texts[-2]), plain(texts[-1])) >= 0.8)
    got = {r.doc_id for r in C.near_dedup(spark, documents(texts), "").collect()}
    assert sum(near) >= 25 and got == {2 * k for k in range(30)} | {2 * k + 1 for k in range(30) if not near[k]}


def test_components_of_crowds_and_odd_texts(spark, documents, odd_texts, monkeypatch):
    line = words(77, 12)
    group = [changed(words(50, 120), i % 4, i) for i in range(60)]  # a crowd, some of it beyond 0.8
    common = [words(100 + i, 15) + " " + line for i in range(60)]
    chain = [" ".join(words(60, 400).split()[8 * i : 8 * i + 200]) for i in range(20)]
    texts = [*odd_texts[:10], odd_texts[12], *group, *common, *chain]
    want = least_of_components(texts)
    for sample in (S.SAMPLE_ROWS, 1):  # the sample decides about cost only
        monkeypatch.setattr(S, "SAMPLE_ROWS", sample)
        out = S.drop_similar(documents(texts))
        assert sorted(r.doc_id for r in out.collect()) == want


def test_prefixes_of_similar_sets_meet():
    rng, none = np.random.default_rng(3), np.zeros(0, np.int64)
    for _ in range(500):
        x = np.unique(rng.integers(0, 60, 30).astype(np.uint64))
        y = np.unique(np.append(rng.choice(x, max(1, len(x) - int(rng.integers(4))), False), rng.integers(0, 60, 2).astype(np.uint64)))
        if S.similar(x, y):
            assert set(S.prefix(x, none.astype(np.uint64), none)) & set(S.prefix(y, none.astype(np.uint64), none))


@pytest.mark.parametrize("texts", [[], [None, ""]])
def test_empty(spark, documents, texts):
    assert S.drop_similar(documents(texts)).count() == min(len(texts), 1)


def test_sketches_never_lose_a_similar_pair():
    rng = np.random.default_rng(4)
    kept = 0
    for n in (1, 3, 40, 700, 5000):
        for _ in range(60):
            x = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
            y = np.unique(np.append(rng.choice(x, max(1, int(len(x) * rng.uniform(0.7, 1))), False), rng.integers(0, 2**63, int(n * rng.uniform(0, 0.3))).astype(np.uint64)))
            may = S.may_be_similar(S.sketch(x), S.sketch(y), len(x) + len(y))
            assert may or not S.similar(x, y)
            short = S.may_be_similar(S.short_of(S.sketch(x)), S.short_of(S.sketch(y)), len(x) + len(y))
            assert short or not may
            kept += may
        z = np.unique(rng.integers(0, 2**63, 2 * n + 1).astype(np.uint64))
        assert n < 40 or not S.may_be_similar(S.sketch(x), S.sketch(z), len(x) + len(z))
    assert kept > 50


def test_a_posting_of_many_sets(spark):
    """One shingle in 20,000 prefixes: its pairs are few where sizes or places rule them out, and
    sets of one component do not meet again."""
    n = 20_000
    rows = [(7, i, 1000 + 300 * (i // 40), 0, i // 2 * 2) for i in range(n)]
    same = bytearray(S.SKETCH_BITS // 8)  # sketches that leave all pairs open
    postings = spark.createDataFrame([(*r, same) for r in rows], "shingle long, node long, size long, at long, root long, short binary")
    first = S.candidates(postings, 4, False)
    assert first.where("crowd = 7 AND a IS NULL").count() == 1
    assert 0 < first.where("a IS NOT NULL").count() <= n
    small = postings.where("node < 400")
    again = {(r.a, r.b) for r in S.candidates(small, 4, True).where("a IS NOT NULL").collect()}
    sizes = {i: s for _, i, s, _, _ in rows}
    want = {(a, b) for b in range(400) for a in range(b) if a // 2 != b // 2 and 5 * sizes[a] >= 4 * sizes[b]}
    assert again == want


def test_helper_names_and_repeated_rows(spark):
    schema = "doc_id long, text string, row long, node string, mark int, _row int, doc int, prefix int"
    base = words(5, 50)
    rows = [(4, base, 1, "n", 2, 3, 4, 5), (4, base, 1, "n", 2, 3, 4, 5), (9, base + " x", 1, "n", 2, 3, 4, 5), (None, base, 0, "", 0, 0, 0, 0), (None, "other text", 0, None, 0, 0, 0, 0)]
    out = S.drop_similar(spark.createDataFrame(rows, schema))
    assert out.columns == [c.split()[0] for c in schema.split(", ")]
    assert sorted(map(tuple, out.collect()), key=str) == sorted([rows[0], rows[4]], key=str)


def test_near_dedup_takes_pairs_from_the_byte_postings(spark, documents, monkeypatch):
    """The SimHash operator's links are verified, also where the prefix filter finds nothing."""
    base = words(9, 400)
    texts = [base, base + " x", words(10, 400), *(words(20 + i, 50) for i in range(4))]
    monkeypatch.setattr(S, "candidates", lambda postings, tasks, crowds: spark.createDataFrame([], "a long, b long, crowd long"))
    monkeypatch.setattr(S.simhash, "fingerprint_of_set", lambda made: len(made) // 100)
    got = {r.doc_id for r in C.near_dedup(spark, documents(texts), "").collect()}
    assert got == {0, *range(2, 7)}


def test_sets_of_a_crowd_meet_about_once(spark, documents, monkeypatch):
    """Copies too far from each other but not from the original: one component by the first meeting,
    and pairs that stay apart meet in one posting, not in all they share."""
    base, made = words(60, 300), []
    texts = [changed(base, 5, i) for i in range(60)] + [base] + [changed(base, 16, 100 + i) for i in range(30)]
    run = S.candidates

    def counted(postings, tasks, crowds):
        found = run(postings, tasks, crowds)
        if crowds:
            made.append((found.count(), found.distinct().count()))
        return found

    monkeypatch.setattr(S, "candidates", counted)
    out = S.drop_similar(documents(texts))
    assert sorted(r.doc_id for r in out.collect()) == least_of_components(texts)
    (rows, different), = made
    assert rows <= 1.5 * different + 10


def test_least_of_windows():
    rng = np.random.default_rng(8)
    values, low = rng.permutation(50), np.sort(rng.integers(0, 40, 30))
    high = np.maximum.accumulate(low + rng.integers(1, 10, 30))
    assert S.least_of_windows(values, low, high).tolist() == [a + int(np.argmin(values[a:b])) for a, b in zip(low, high)]
