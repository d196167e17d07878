from __future__ import annotations

import numpy as np
import pytest

from pageloom.llm import topk as W


def plain(rows, queries, k):
    code = lambda v: sum(1 << i for i, x in enumerate(v) if x is not None and x > 0)
    out = set()
    for q, v in queries:
        if not v:
            continue
        near = sorted({((code(v) ^ code(u)).bit_count(), i is None, i or 0) for i, u in rows if u})
        out |= {(q, n + 1, None if no else i, d) for n, (d, no, i) in enumerate(near[:k])}
    return out


def both(spark, rows, queries, k):
    schema = "vec_id long, embedding array<float>, code string, n int"
    frame = lambda part: spark.createDataFrame([(i, v, "x", 1) for i, v in part], schema)
    got = {tuple(r) for r in W.search(frame(rows), frame(queries), k=k).collect()}
    assert got == plain(rows, queries, k)


@pytest.mark.parametrize("blocks", [(100_000, 2_000), (40, 7)])
def test_against_all_pairs(spark, blocks, monkeypatch):
    monkeypatch.setattr(W, "BLOCK_CODES", blocks[0])
    monkeypatch.setattr(W, "BLOCK_QUERIES", blocks[1])
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=64).astype(np.float32).tolist()) for i in range(250)]
    rows += [(1000 + i, rows[i % 5][1]) for i in range(60)]  # ties: equal codes
    both(spark, rows, rows[::20], 10)
    both(spark, rows, rows[::31], 400)


def test_odd_rows(spark):
    v = [1.0, -1.0, 0.5, float("nan")]
    rows = [(1, v), (1, v), (2, None), (3, []), (None, [1.0, 1.0]), (4, [-1.0] * 64), (5, [None, 1.0, 1.0])]
    both(spark, rows, rows, 3)
    assert W.search(spark.createDataFrame([], "vec_id long, embedding array<float>"), spark.createDataFrame([(1, v)], "vec_id long, embedding array<float>")).count() == 0


def test_stops_as_soon_as_covered():
    rng = np.random.default_rng(0)
    block = np.unique(rng.integers(0, 2**63, 5000).astype(np.uint64))
    tables = W.Tables(block)
    place, distance = tables.search(block[7], np.ones(len(block), np.int64), 1)
    assert (place.tolist(), distance.tolist()) == ([7], [0])
