"""Packing: seeds draw their lexical neighbours from a sharded BM25 index into their window.

A document's ids are its byte-level BPE ids and an end id. Whole windows are cut off its front;
what is left, the tail, is a unit of packing. Units are dealt evenly into shards of bounded
size. Each shard builds an inverted index of its units (terms are token ids, so counts over all
units are one number per id of the vocabulary), and repeats: the longest unused unit is the
seed of a window, its heaviest terms query the index, and the unused neighbours that BM25
ranks first fill the window. The neighbour that would overrun it is cut; its rest stays in the
index. So windows are full; what is left at the end of a shard goes to sequences whose
lengths are powers of two, which need no padding either.

Defined results: null and empty texts are documents of the end id alone; repeated rows and ids
(null ones too) are packed as separate documents; ties go to the unit that comes first by hash;
an empty table gives no pieces; extra columns are ignored.
"""

from __future__ import annotations

import base64
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import public_tokenizers
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pageloom.catalog.registry import query
from pageloom.llm.common import batches, land, table, tasks_for

WINDOW = 2048
END = 1
VOCABULARY = 50_257
SPECIAL = "<|endoftext|>"
#: Tokens a shard holds about; its index takes some forty times as many bytes.
SHARD_TOKENS = 1 << 20
#: A seed queries with this many of its terms, those that weigh most.
QUERY_TERMS = 24
K1, B = 1.2, 0.75


@lru_cache(maxsize=2)
def encoder(path: str) -> tiktoken.Encoding:
    """The vocabulary of ``byte_bpe_50k.json`` from its file of ranks: same ids, faster."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("byte_bpe_50k", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={SPECIAL: VOCABULARY - 1})


def encode(text: str | None, path: str) -> np.ndarray:
    """Ids of a text and the end id, in 16 bits each."""
    text = text or ""
    ids = encoder(path).encode(text, allowed_special="all") if SPECIAL in text else encoder(path)._core_bpe.encode_ordinary(text)
    ids.append(END)
    return np.frombuffer(array("H", ids), np.uint16)


def crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def units(docs: DataFrame, id_col: str, text_col: str, path: str, keep_ids: bool) -> DataFrame:
    """Each row with its token count, checksums of the windows cut off, and its tail."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = 0
        for batch in batches(source):
            rows = []
            for text in batch.column(1).to_pylist():
                ids = encode(text, path)
                whole = len(ids) // WINDOW * WINDOW
                cuts = ids[:whole].reshape(-1, WINDOW)
                place += 1
                rows.append((place, len(ids), [crc(w) for w in cuts], ids[:whole].tobytes() if keep_ids else None, ids[whole:].tobytes()))
            kinds = (pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary(), pa.binary())
            made = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)] if rows else [pa.array([], k) for k in kinds]
            yield pa.RecordBatch.from_arrays([batch.column(0), *made], names=["id", "place", "doc_tokens", "crcs", "front", "tail"])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, f"id {kind}, place long, doc_tokens long, crcs array<long>, front binary, tail binary")


def document_counts(made: DataFrame) -> np.ndarray:
    """How many tails have each token: one row for each id of the vocabulary at most."""

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(VOCABULARY, np.int64)
        for batch in batches(source):
            for tail in batch.column(0).to_pylist():
                seen[np.unique(np.frombuffer(tail, np.uint16))] += 1
        has = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(has), pa.array(seen[has])], names=["token", "n"])

    out = np.zeros(VOCABULARY, np.int64)
    for row in made.select("tail").mapInArrow(run, "token long, n long").groupBy("token").agg(F.sum("n").alias("n")).collect():
        out[row["token"]] = row["n"]
    return out


class Index:
    """BM25 postings of a shard's units, by token."""

    def __init__(self, tails: list[np.ndarray], idf: np.ndarray, mean: float):
        n = len(tails)
        lengths = np.array([len(t) for t in tails])
        owner = np.repeat(np.arange(n), lengths)
        keys, tf = np.unique(np.concatenate(tails).astype(np.int64) * n + owner, return_counts=True) if n else (np.zeros(0, np.int64), np.zeros(0, np.int64))
        token, self.unit = keys // n if n else keys, keys % n if n else keys
        self.weight = (idf[token] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * lengths[self.unit] / max(mean, 1)))).astype(np.float32)
        self.first = np.searchsorted(token, np.arange(VOCABULARY + 1))
        self.terms: list[np.ndarray] = []
        order = np.lexsort((-self.weight, self.unit))
        bounds = np.searchsorted(self.unit[order], np.arange(n + 1))
        for i in range(n):
            self.terms.append(token[order[bounds[i] : min(bounds[i + 1], bounds[i] + QUERY_TERMS)]])
        self.n = n

    def scores(self, unit: int) -> np.ndarray:
        out = np.zeros(self.n, np.float32)
        for t in self.terms[unit]:
            at = slice(self.first[t], self.first[t + 1])
            out[self.unit[at]] += self.weight[at]
        return out


def fill(lengths: np.ndarray, neighbours) -> Iterator[list[tuple[int, int, int]]]:
    """Sequences as lists of (unit, start within it, length); ``neighbours(seed)`` scores units."""
    begun, left = np.zeros(len(lengths), np.int64), lengths.astype(np.int64).copy()
    seeds = iter(np.argsort(-lengths, kind="stable"))

    def take(unit: int, most: int) -> tuple[int, int, int]:
        size = int(min(most, left[unit]))
        piece = (int(unit), int(begun[unit]), size)
        begun[unit] += size
        left[unit] -= size
        return piece

    for seed in seeds:
        while left[seed] > 0:  # once, unless the rest of a seed became longer than a window
            sequence = [take(seed, WINDOW)]
            space = WINDOW - sequence[0][2]
            if space:
                score = neighbours(seed)
                unused = np.flatnonzero(left > 0)
                ranked = unused[np.argsort(-score[unused], kind="stable")]
                # neighbours in rank order up to the one that overruns the window, which is cut
                upto = np.searchsorted(np.cumsum(left[ranked]), space) + 1
                for unit in ranked[:upto]:
                    sequence.append(take(unit, space))
                    space -= sequence[-1][2]
            if not space:
                yield sequence
                continue
            # nothing is left in the shard: lengths that are powers of two need no padding
            size, part = 1 << (WINDOW - space).bit_length() - 1, []
            for unit, start, length in sequence:
                while length:
                    room = size - sum(p[2] for p in part)
                    cut = min(room, length)
                    part.append((unit, start, cut))
                    start, length, room = start + cut, length - cut, room - cut
                    if not room:
                        yield part
                        rest = WINDOW - space - size
                        space, part = WINDOW - rest, []
                        size = 1 << rest.bit_length() - 1 if rest else 0


def pack(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokenizer: str | None = None,
    keep_ids: bool = False,
    shard_tokens: int = SHARD_TOKENS,
) -> DataFrame:
    """A row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, and the
    piece's ids if ``keep_ids``."""
    path = tokenizer or public_tokenizers.path("byte_bpe_50k.tiktoken")
    made = land(units(docs, id_col, text_col, path, keep_ids), "units")
    n, tokens = made.agg(F.count("*"), F.coalesce(F.sum(F.length("tail") / 2), F.lit(0.0))).first()
    found = document_counts(made)
    idf = np.log1p((n - found + 0.5) / (found + 0.5)).astype(np.float32)
    mean = tokens / max(n, 1)
    # every unit weighs at least one token, so that shards of tiny tails stay small, too
    shards = tasks_for(int(tokens) + 64 * n, shard_tokens)
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids array<int>"

    def run(key: tuple, group: pa.Table) -> pa.Table:
        group = group.sort_by([("spread", "ascending"), ("place", "ascending")]).combine_chunks()
        ids, total, crcs = group.column("id"), group.column("doc_tokens").to_pylist(), group.column("crcs").to_pylist()
        tails = [np.frombuffer(t, np.uint16) for t in group.column("tail").to_pylist()]
        index = Index(tails, idf, mean)
        sequence = key[0].as_py() << 32
        rows, of = [], []
        for i, windows in enumerate(crcs):
            front = np.frombuffer(group.column("front")[i].as_py(), np.uint16) if keep_ids else None
            for w, value in enumerate(windows):
                rows.append((w * WINDOW, WINDOW, value, total[i], sequence, 0, front[w * WINDOW : (w + 1) * WINDOW].astype(np.int32) if keep_ids else None))
                of.append(i)
                sequence += 1
        for parts in fill(np.array([len(t) for t in tails], np.int64), index.scores):
            at = 0
            for i, start, length in parts:
                piece = tails[i][start : start + length]
                rows.append((len(crcs[i]) * WINDOW + start, length, crc(piece), total[i], sequence, at, piece.astype(np.int32) if keep_ids else None))
                of.append(i)
                at += length
            sequence += 1
        names = ["start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
        columns = list(zip(*rows)) if rows else [()] * 7
        arrays = [pa.array(c, pa.int64()) for c in columns[:6]] + [pa.array(columns[6], pa.list_(pa.int32()))]
        return pa.table([ids.take(pa.array(of, pa.int64())), *arrays], names=["doc_id", *names, "ids"])

    spread = F.xxhash64("id", "place", "doc_tokens")
    dealt = made.withColumn("spread", spread).withColumn("shard", F.pmod("spread", F.lit(shards)))
    out = dealt.groupBy("shard").applyInArrow(run, schema)
    return out if keep_ids else out.drop("ids")


@query("op9_packing")
def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
