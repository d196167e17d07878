from __future__ import annotations

import corpus_pipeline as C
from pageloom.llm import packing

from . import test_pii, test_quality_rules
from .conftest import words


def test_stages(spark, documents, odd_texts, tmp_path):
    good = [words(i, 80) for i in range(120)]
    texts = [*good, good[0], good[1] + " x", *odd_texts[:5], *(" ".join(w + "###" for w in words(900 + i, 80).split()) for i in range(8)), words(500, 70) + " me@x.org"]
    docs = documents(texts, sources=["a" if i % 3 else None for i in range(len(texts))])
    spark.createDataFrame([(i, int(not 127 <= i < 135)) for i in range(135)], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    kept = {}
    for name, stage in C.STAGES:
        docs = stage(spark, docs, str(tmp_path))
        docs.write.parquet(f"{tmp_path}/{stage.__name__}")
        docs = spark.read.parquet(f"{tmp_path}/{stage.__name__}")
        kept[stage.__name__] = docs.collect()
        if stage is not C.pack:
            assert docs.columns == C.COLUMNS
    ids = [sorted(r.doc_id for r in kept[s]) for s in ("quality", "near_dedup", "redact")]
    assert set(ids[0]) >= set(range(122)) | {135} and not set(ids[0]) & set(range(122, 135))
    assert all(not test_quality_rules.Q.fails_base(test_quality_rules.plain(r.text)) for r in kept["quality"])
    assert ids[1] == ids[2] and 120 not in ids[1] and set(range(120)) - {1} <= set(ids[1])
    assert all(not test_pii.plain(r.text) and r.n_chars == len(r.text) for r in kept["redact"])
    assert "[EMAIL]" in next(r.text for r in kept["redact"] if r.doc_id == 135)
    assert sum(r.length for r in kept["pack"]) == sum(len(packing.encode(r.text, packing.public_tokenizers.path("byte_bpe_50k.tiktoken"))) for r in kept["mix"])
    assert C.run(spark, str(tmp_path)).count() == len(kept["pack"])


def test_packed_pieces_hold_their_ids(spark, documents):
    texts = [words(i, 30 + 97 * i) for i in range(40)]
    path = packing.public_tokenizers.path("byte_bpe_50k.tiktoken")
    rows = C.pack(spark, documents(texts), "").collect()
    assert all(r.ids == packing.encode(texts[r.doc_id], path)[r.start : r.start + r.length].tolist() for r in rows)
    assert sum(len(r.ids) for r in rows) == sum(len(packing.encode(t, path)) for t in texts)
