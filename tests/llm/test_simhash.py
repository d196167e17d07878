from __future__ import annotations

import re

import numpy as np
import pytest
import xxhash

from pageloom.llm import simhash as S
from pageloom.llm.common import components, forest

from .conftest import words


def plain(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    found = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = [" ".join(found[i : i + 3]) for i in range(len(found) - 2)] or ([" ".join(found)] if found else [])
    hashes = [xxhash.xxh64(g.encode(), 42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def linked(fps, bits=2):
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= bits:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


def test_fingerprints(odd_texts):
    for text in odd_texts[:10] + odd_texts[-1:]:
        assert S.fingerprint(text) == plain(text)
    long = odd_texts[10]
    assert S.fingerprint(long) == S.fingerprint(long.replace(" ", "\n \t"))  # pieces are cut elsewhere


def test_long_words_are_whole(odd_texts):
    word = odd_texts[11]
    for text in (word, "a b " + word, word + " " * 3, word + " a b c d", "x " * 600_000 + word):
        assert S.fingerprint(text) == plain(text)


def test_components_of_texts(spark, documents, odd_texts):
    texts = [*odd_texts[:10], *(words(7, 300) + f" tail{i}" for i in range(40))]
    got = {r.id: r.component_id for r in S.near_copies(documents(texts)).collect()}
    assert [got[i] for i in range(len(texts))] == linked([plain(t) for t in texts])


@pytest.mark.parametrize("bits", [1, 2, 3])
def test_links_of_random_and_crowded_fingerprints(spark, bits):
    rng = np.random.default_rng(1)
    near = [int(rng.integers(0, 2**63)) ^ sum(1 << int(b) for b in rng.choice(64, 3, False)) for _ in range(50)]
    crowd = sorted({5 ^ (1 << int(a)) ^ (1 << int(b)) for a, b in rng.integers(0, 64, (400, 2))})
    fps = sorted(set(near + [f ^ (1 << int(rng.integers(64))) for f in near] + crowd + [0]))
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    links = S.links(spark.createDataFrame([(f,) for f in signed], "fp long"), bits, len(fps)).collect()
    at = {f: i for i, f in enumerate(signed)}
    for a, b in links:
        assert a in at and b in at
    joined = linked(fps, bits)
    groups, _ = forest(np.array([0]), np.array([0]))
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in links:
        x, y = find(at[a]), find(at[b])
        root[max(x, y)] = min(x, y)
    assert [find(i) for i in range(len(fps))] == joined


def test_one_of_each_group_stays(spark, documents):
    text = words(5, 100)
    docs = documents([text, text, text, "", None, "other words here", "other words here"], ids=[3, 3, None, 9, 8, None, None])
    out = S.drop_copies(docs)
    assert out.columns == docs.columns
    assert sorted((r.doc_id, r.text) for r in out.collect() if r.doc_id is not None) == [(3, text), (8, None)]
    assert [r.text for r in out.collect() if r.doc_id is None] == ["other words here"]


def test_empty(spark, documents):
    assert S.near_copies(documents([])).count() == 0
    assert S.drop_copies(documents([])).count() == 0


def test_components_of_a_long_chain_and_a_hub(spark):
    chain = [(i, i + 1) for i in range(100, 160)]
    hub = [(7, i) for i in range(1000, 1300)] + [(2, 1299), (5, 5)]
    got = dict(components(spark.createDataFrame(chain + hub, "a long, b long")).collect())
    assert {got[i] for i in range(100, 161)} == {100} and {got[i] for i in (2, 7, *range(1000, 1300))} == {2} and 5 not in got
