from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pytest

from pageloom.llm import suffixes as S

from .conftest import words


def plain(texts, length):
    raws = [(t or "").encode() for t in texts]
    seen = Counter(r[i : i + length] for r in raws for i in range(len(r) - length + 1))
    out = []
    for r in raws:
        gone = bytearray(len(r))
        for i in range(len(r) - length + 1):
            if seen[r[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        spans = sum(1 for i, x in enumerate(gone) if x and not (i and gone[i - 1]))
        out.append((len(r), sum(gone), spans, hashlib.sha256(bytes(x for x, g in zip(r, gone) if not g)).hexdigest()))
    return out


def found(docs, **options):
    rows = S.remove_repeats(docs, **options).collect()
    return sorted((r.n_bytes, sum(e - s for s, e in zip(r.starts, r.ends)), len(r.starts), hashlib.sha256(r.kept).hexdigest()) for r in rows)


@pytest.mark.parametrize(("length", "gram"), [(400, 128), (60, 20), (37, 19)])
@pytest.mark.parametrize("hot", [20_000, 2])
def test_against_all_windows(documents, length, gram, hot, monkeypatch):
    monkeypatch.setattr(S, "HOT_ROWS", hot)
    passage = words(99, 90)
    texts = [words(i, 100) for i in range(12)]
    texts += [words(50 + i, i * 5) + " " + passage[i * 3 :] + " é" + words(70 + i, 30) for i in range(25)]
    texts += [None, "", "ab" * 400, "ab" * 401, "x" * length, "y" * (length + 1), texts[3], texts[3], passage[:length], texts[0][:250] + "Z" + texts[0][250:]]
    texts += ["erti " * 200, "erti " * 150 + "q", passage * 3]
    docs = documents(texts, ids=[i % 40 if i % 7 else None for i in range(len(texts))])
    assert found(docs, length=length, gram=gram) == sorted(plain(texts, length))


def test_anchors_do_not_depend_on_pieces(monkeypatch):
    raw = np.frombuffer((words(1, 3000) + "z" * 900 + words(2, 500)).encode(), np.uint8)
    whole = S.anchors(raw, 100, 40)
    monkeypatch.setattr(S, "STRIDE", 777)
    parts = S.anchors(raw, 100, 40)
    each = lambda a: [(h, p) for h, p, f, n in zip(*(x.tolist() for x in a)) for _ in range(n)]
    assert each(whole) == each(parts) and len(each(whole)) == len(raw) - 99


def test_grams():
    raw = np.frombuffer(b"abcdefabcdefg", np.uint8)
    for size in (1, 2, 3, 5, 6):
        h = S.gram_hashes(raw, size)
        assert len(h) == len(raw) - size + 1
        same = {(i, j) for i in range(len(h)) for j in range(len(h)) if h[i] == h[j]}
        assert same == {(i, j) for i in range(len(h)) for j in range(len(h)) if bytes(raw[i : i + size]) == bytes(raw[j : j + size])}


def test_empty_and_long(documents, odd_texts):
    assert S.remove_repeats(documents([])).count() == 0
    got = {r.id: r for r in S.remove_repeats(documents(odd_texts)).collect()}
    assert got[11].starts == [0] and got[11].kept == b"" and got[10].starts == [] and got[5].kept == got[6].kept == b""
