from __future__ import annotations

import math

import numpy as np
import pytest

from pageloom.llm import whitening as W

SCHEMA = "vec_id long, embedding array<float>, n long, component int, x string, `a.b` int"


def table(spark, vectors, ids=None):
    ids = range(len(vectors)) if ids is None else ids
    return spark.createDataFrame([(i, None if v is None else [None if c is None else float(c) for c in v], 1, 2, "x", 3) for i, v in zip(ids, vectors)], SCHEMA)


def plain(vectors):
    """Eigenvalues, eigenvectors and mean of the different vectors, and their numbers."""
    x = np.floor(64.0 * np.array(vectors, np.float32).astype(float)).astype(int) + 1_000_000
    fit = np.unique(x, axis=0)
    sums = fit.sum(0)
    centred = fit - sums / len(fit)
    e, v = np.linalg.eigh(centred.T @ centred / len(fit))
    return x, fit, sums, e[::-1], v[:, ::-1]


def check(spark, vectors, components=16, exact=True):
    found = W.whiten(table(spark, vectors), components=components).collect()
    x, fit, sums, e, v = plain(vectors)
    n, rank = len(fit), int((e > 1e-9 * max(e[0], 1e-300)).sum())
    k = min(components, rank)
    assert len(found) == len(vectors) * k
    by = {(r.id, r.component): r for r in found}
    got = np.array([[by[i, c + 1].whitened for c in range(k)] for i in range(len(vectors))])
    assert np.allclose([by[0, c + 1].explained for c in range(k)], e[:k] / e.sum(), rtol=1e-9)
    assert all(r.n == n for r in found) and max(r.identity_error for r in found) < 1e-9
    for i in range(len(vectors)):
        assert int(by[i, 1].deviation) == sum((n * int(c) - int(s)) ** 2 for c, s in zip(x[i], sums))
    centred = x - sums / n
    if exact:  # eigenvalues apart: directions equal but for the sign
        want = centred @ v[:, :k] / np.sqrt(e[:k])
        sign = np.sign((got * want).sum(0))
        assert np.allclose(got * sign, want, atol=1e-7)
    else:  # whatever basis of equal eigenvalues: the same lengths within them
        of = got[np.unique(x, axis=0, return_index=True)[1]]
        assert np.allclose(of.T @ of / n, np.eye(k), atol=1e-9)
    return by


def test_equals_dense_eigenvectors(spark):
    rng = np.random.default_rng(1)
    base = rng.standard_normal((300, 20)) * np.linspace(5, 0.2, 20) + rng.standard_normal(20)
    check(spark, np.concatenate([base, base[:50], base[:1].repeat(200, 0)]))


def test_fewer_dimensions_constant_and_dependent_ones(spark):
    rng = np.random.default_rng(2)
    a = rng.integers(-50, 50, (60, 3)) / 64.0
    check(spark, np.column_stack([a, a[:, 0], np.full(60, 0.5), a[:, 1]]))
    check(spark, rng.standard_normal((5, 12)))  # rank 4
    check(spark, [[0.0, 1.0], [1.0, 0.0]])


def test_repeated_eigenvalues(spark):
    d = 6
    corners = [list(s * np.eye(d)[i]) for i in range(d) for s in (1, -1)]  # a covariance of one eigenvalue
    by = check(spark, corners, exact=False)
    assert len({c for _, c in by}) == d


def test_many_dimensions_end_before_all_steps(spark):
    rng = np.random.default_rng(3)
    scale = np.concatenate([[40, 40, 30, 30, 20, 10, 9, 8], np.full(72, 0.3)])
    vectors = rng.standard_normal((400, 80)) * scale
    fit = W.fit_list(table(spark, vectors), "embedding")
    found = W.bidiagonalise(fit, 4)
    *_, e, v = plain(vectors)
    assert found.steps < 80
    assert np.allclose(found.eigenvalues, e[:4], rtol=1e-10)
    assert np.allclose(np.abs((found.directions * v[:, :4]).sum(0)), 1, atol=1e-9)


def test_more_tasks_than_are_summed_directly(spark, monkeypatch):
    monkeypatch.setattr(W, "DIRECT_TASKS", 0)
    check(spark, np.random.default_rng(4).standard_normal((50, 4)))


def test_rows_that_go_and_null_ids(spark):
    good = [[0.1, 0.2], [0.3, 0.1], [0.5, 0.9], [0.1, 0.2]]
    vectors = [*good, None, [], [None, 1.0], [math.nan, 1.0], [math.inf, 1.0], [1.0, -math.inf]]
    found = W.whiten(table(spark, vectors, ids=[None, 1, 1, 2, *range(3, 9)])).collect()
    assert sorted((str(r.id), r.component) for r in found) == sorted((str(i), c) for i in (None, 1, 1, 2) for c in (1, 2))
    assert {r.n for r in found} == {3}


def test_large_entries_and_exact_sums(spark):
    vectors = [[1e30, 2.0, -5e9], [-1e30, 1.0, 3e9], [2e5, 0.0, 7e9], [1e6, -3.0, 1.0]]
    found = W.whiten(table(spark, vectors), components=2).collect()
    held = [[int(np.floor(min(max(64.0 * float(np.float32(c)), -W.LARGEST), W.LARGEST))) + 1_000_000 for c in v] for v in vectors]
    sums = [sum(c) for c in zip(*held)]
    for r in found:
        assert int(r.deviation) == sum((4 * c - s) ** 2 for c, s in zip(held[r.id], sums))


def test_nothing_to_fit(spark):
    assert W.whiten(table(spark, [[1.0, 2.0]]).limit(0)).count() == 0
    assert W.whiten(table(spark, [[1.0, 2.0]] * 3)).count() == 0
    with pytest.raises(Exception, match="unlike lengths"):
        W.whiten(table(spark, [[1.0, 2.0], [1.0]])).count()


def test_a_small_fit_list_is_one_task(spark, monkeypatch):
    rows = table(spark, np.random.default_rng(6).standard_normal((200, 4))).repartition(4)
    monkeypatch.setattr(W, "land", lambda df, label, land=W.land: land(df.repartition(4, "rows", "low"), label))
    monkeypatch.setattr(W, "blocks", lambda vectors, blocks=W.blocks: blocks(vectors.repartition(12)))
    fit = W.fit_list(rows, "embedding")
    assert fit.landed.select("x").rdd.getNumPartitions() > 1 and fit.tasks == fit.blocks.rdd.getNumPartitions() == 1
    monkeypatch.setattr(W, "TASK_BYTES", 8 * 4 * 100)
    assert W.Fit(fit.landed, fit.n, fit.sums, fit.low, fit.high).tasks == 2
