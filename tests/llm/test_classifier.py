from __future__ import annotations

import zlib

import numpy as np

from pageloom.llm import classifier as C

from .conftest import words


def test_features_of_words_do_not_depend_on_their_neighbours():
    some = [b"a", b"word", "é".encode(), b"longer-word" * 9]
    ids, sizes = C.features(some)
    at = np.cumsum(sizes) - sizes
    for w, a, n in zip(some, at, sizes):
        alone, _ = C.features([w])
        assert ids[a : a + n].tolist() == alone.tolist() and n == 1 + sum(max(len(w) + 3 - g, 0) for g in C.GRAMS)


def test_score_is_the_mean_of_feature_worths(odd_texts):
    rng = np.random.default_rng(0)
    model = C.Model(rng.normal(size=C.BUCKETS).astype(np.float32), 0.25)
    got = C.Scorer(model).score(odd_texts)
    for text, score in zip(odd_texts, got):
        ids, times = C.counted(text)
        logit = model.bias + (float((model.worth[ids] * times).sum() / times.sum()) if len(ids) else 0.0)
        assert abs(score - 1 / (1 + np.exp(-logit))) < 1e-4
    assert got[0] == got[1] == got[2] and got[5] == got[6]


def test_learns_from_the_training_part_only(spark, documents, odd_texts):
    good = [words(i, 60) for i in range(200)]
    bad = [" ".join(f"{w}%%%" for w in words(500 + i, 60).split()) for i in range(60)]
    docs = documents([*good, *bad, *odd_texts])
    held = {i for i in range(273) if zlib.crc32(str(i).encode()) % 5 == 0}
    # labels of held-out rows are wrong on purpose: they must not count
    labels = spark.createDataFrame([(i, int(i < 200) ^ (i in held)) for i in range(260)] + [(None, 1), (3, None)], "doc_id long, quality int")
    rows = C.classify(docs, C.fit(docs, labels)).collect()
    got = {r.doc_id: r for r in rows}
    assert len(rows) == 273 and {i for i in got if got[i].held_out} == held
    assert np.mean([got[i].predicted == (i < 200) for i in held if i < 260]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    again = C.classify(docs.repartition(3), C.fit(docs.repartition(3), labels)).collect()
    assert {r.doc_id: r.score for r in again} == {r.doc_id: r.score for r in rows}


def test_no_labels_no_rows(spark, documents):
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert [r.score for r in C.classify(documents(["a", None]), C.fit(documents(["a", None]), none)).collect()] == [0.5, 0.5]
    assert C.classify(documents([]), C.Model(np.zeros(C.BUCKETS, np.float32), 0.0)).count() == 0
