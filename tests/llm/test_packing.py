from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from pageloom.llm import packing as K

from .conftest import words


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def check(rows, ids):
    """Every id is in exactly one piece, sequences are gapless, and none needs padding."""
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    assert set(by_doc) == set(ids)
    for doc, pieces in by_doc.items():
        at = 0
        for r in sorted(pieces, key=lambda r: r.start):
            piece = ids[doc][at : at + r.length]
            assert r.start == at and r.doc_tokens == len(ids[doc]) and r.ids_crc32 == zlib.crc32(np.array(piece, "<u4").tobytes())
            at += r.length
        assert at == len(ids[doc])
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048 and at & (at - 1) == 0


def test_ids_are_those_of_the_tokenizer(tokenizer, odd_texts):
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    for text in [*odd_texts[:10], "a <|endoftext|> b<|endoftext|>", "  x \n\n y's 12\t", "  \xa0 日本"]:
        assert K.encode(text, path).tolist() == [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]


def test_pieces(documents, tokenizer, odd_texts):
    texts = [*odd_texts[:11], odd_texts[12], *(words(i, 20 + i * 13 % 900) for i in range(120))]
    ids = {i: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1] for i, t in enumerate(texts)}
    check(K.pack(documents(texts)).collect(), ids)
    out = K.pack(documents(texts), shard_tokens=30_000, keep_ids=True)
    rows = out.collect()
    check(rows, ids)
    assert all(r.ids == ids[r.doc_id][r.start : r.start + r.length] for r in rows)


def test_neighbours_share_words(documents):
    texts = [words(i % 3, 160) + f" {i}" for i in range(90)]  # three topics
    rows = K.pack(documents(texts)).collect()
    seen = {}
    for r in rows:
        seen.setdefault(r.sequence_id, set()).add(r.doc_id % 3)
    assert sum(len(s) == 1 for s in seen.values()) >= 0.6 * len(seen)


def test_repeats_nulls_and_empty(documents):
    docs = documents(["same text"] * 40 + [None] * 3, ids=[5] * 40 + [None] * 3)
    rows = K.pack(docs).collect()
    assert sum(r.length for r in rows if r.doc_id == 5) == 40 * 3 and sum(r.length for r in rows if r.doc_id is None) == 3
    assert K.pack(documents([])).count() == 0


def test_bm25_of_a_small_shard():
    tails = [np.array(t, np.uint16) for t in ([1, 2, 2], [2, 3], [4, 1])]
    idf = np.ones(K.VOCABULARY, np.float32)
    got = K.Index(tails, idf, 7 / 3).scores(0)
    want = [sum(t.tolist().count(q) * (K.K1 + 1) / (t.tolist().count(q) + K.K1 * (1 - K.B + K.B * len(t) / (7 / 3))) for q in (1, 2)) for t in tails]
    assert got == pytest.approx(want, rel=1e-5)
