"""SimHash near-duplicates over an inverted index of byte positions with count filtering.

A fingerprint has eight positional bytes. Two fingerprints that differ in at most d bits
agree in at least 8 - d of them: that is the guaranteed minimum of matches. Postings of a
single positional byte would each hold 1/256 of all fingerprints, and tallying them would
emit pairs by the square. So the count is kept in the key: a fingerprint is posted once for
every choice of 8 - d positions, with the bytes at these positions; two fingerprints meet in
a posting exactly if their tally reaches the minimum. A posting holds at most 256**d
different fingerprints, however skewed the data. Within a posting, partners are looked up by
flipping free bits rather than by comparing all pairs, then the tally and the Hamming distance
of each pair found are checked, and only links that join what was not yet joined are passed on.

Equal fingerprints are folded first, so copies cost one row. Defined results: null and empty
texts have fingerprint 0 and link like any other; texts of one or two words hash their whole
sequence; repeated rows and ids share a component; a null id never names a component unless
the component has no other; extra columns are ignored, and kept by ``drop_copies``.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pageloom.catalog.registry import query
from pageloom.llm.common import batches, bounded, byte_pieces, components, forest, land, table, tasks_for

SEED = 42
POSITIONS = 8
ROWS_PER_TASK = 1_500_000


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """64 bits, each 1 if set in over half of the hashes of all shingles, repeats included."""
    of = xxhash.xxh64_intdigest
    counts, total, carry = np.zeros(64, np.int64), 0, []
    for piece in byte_pieces((text or "").encode().lower()):  # on bytes: only A-Z are changed
        words = carry + piece.split()
        grams = zip(*(words[i:] for i in range(shingle)))
        hashes = np.array([of(g, SEED) for g in map(b" ".join, grams)], "<u8")
        if len(hashes):
            total += len(hashes)
            counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
        carry = words[-(shingle - 1) :] if shingle > 1 else []
    if not total:
        return of(b" ".join(carry), SEED) if carry else 0
    return majority(counts, total)


def majority(counts: np.ndarray, total: int) -> int:
    return int(np.packbits(2 * counts > total, bitorder="little").view("<u8")[0])


def fingerprint_of_set(hashes: np.ndarray) -> int:
    """64 bits, each 1 if set in over half of the hashes; of none 0."""
    bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return majority(bits.sum(0, dtype=np.int64), len(hashes))


def marks(docs: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """(id, row, fp) of every row; ``row`` is the same for rows of equal id and text."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(source):
            made = np.array([fingerprint(t, shingle) for t in batch.column(2).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(made.view(np.int64))], names=["id", "row", "fp"])

    return docs.select(F.col(id_col).alias("id"), row_key(id_col, text_col).alias("row"), F.col(text_col).alias("text")).mapInArrow(run, f"id {kind}, row long, fp long")


def row_key(id_col: str, text_col: str):
    return F.xxhash64(F.col(id_col), F.col(text_col), F.isnull(id_col), F.isnull(text_col))


def masks(max_bits: int) -> list[int]:
    """One mask for each choice of 8 - max_bits byte positions, as signed long."""
    made = []
    for at in combinations(range(POSITIONS), POSITIONS - max_bits):
        mask = sum(0xFF << (8 * p) for p in at)
        made.append(mask - (1 << 64) if mask >> 63 else mask)
    return made


def tally(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Positional bytes that two fingerprints share."""
    return ((x ^ y).view(np.uint8).reshape(-1, POSITIONS) == 0).sum(1)


def links(fps: DataFrame, max_bits: int, rows: int) -> DataFrame:
    """Links a-b that connect what different fingerprints within ``max_bits`` connect."""
    chosen = masks(max_bits)
    free = [[b for b in range(64) if not (m >> b) & 1] for m in chosen]
    post = F.explode(F.array(*(F.struct(F.lit(i).cast("short").alias("which"), F.xxhash64(F.lit(i), F.col("fp").bitwiseAND(F.lit(m))).alias("posting")) for i, m in enumerate(chosen))))
    posted = fps.select("fp", post.alias("p")).select("fp", "p.which", "p.posting")

    def meet(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [(b.column(0).to_numpy().view(np.uint64), b.column(1).to_numpy(), b.column(2).to_numpy()) for b in source if b.num_rows]
        if not got:
            return
        fp, which, posting = (np.concatenate(part) for part in zip(*got))
        order = np.argsort(posting, kind="stable")
        fp, which, posting = fp[order], which[order], posting[order]
        same = posting[1:] == posting[:-1]
        shared = np.append(same, False) | np.append(False, same)
        fp, which = fp[shared], which[shared]
        left, right = [], []
        for w in np.unique(which):
            here = np.unique(fp[which == w])
            for flips in range(1, max_bits + 1):
                for bits in combinations(free[w], flips):
                    other = here ^ np.uint64(sum(1 << b for b in bits))
                    at = np.minimum(np.searchsorted(here, other), len(here) - 1)
                    met = (here[at] == other) & (here < other)
                    left.append(here[met])
                    right.append(other[met])
        if not left:
            return
        a, b = np.concatenate(left), np.concatenate(right)
        enough = tally(a, b) >= POSITIONS - max_bits
        a, b = a[enough], b[enough]
        near = np.unpackbits((a ^ b).view(np.uint8).reshape(-1, 8), axis=1).sum(1) <= max_bits
        a, b = forest(a[near].view(np.int64), b[near].view(np.int64))
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    tasks = tasks_for(rows * len(chosen), ROWS_PER_TASK, 8)
    return posted.repartition(tasks, "posting").mapInArrow(meet, "a long, b long")


def near_copies(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """(id, row, fp, component_id) of every row."""
    marked = land(marks(docs, id_col, text_col, shingle), "fingerprints")
    folded = land(marked.groupBy("fp").agg(F.min("id").alias("first_id")), "folded")
    found = components(links(folded, max_bits, folded.count()))
    joined = land(folded.join(found, folded.fp == found.node, "left").select("fp", "first_id", F.coalesce("root", "fp").alias("root")), "rooted")
    least = land(joined.groupBy("root").agg(F.min("first_id").alias("component_id"), F.count("*").alias("of")).where("of > 1"), "components")
    members = land(joined.join(bounded(least), "root", "left").select("fp", F.when(F.col("of") > 1, F.col("component_id")).otherwise(F.col("first_id")).alias("component_id")), "members")
    return marked.join(bounded(members), "fp").select("id", "row", "fp", "component_id")


def drop_copies(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """One row of each component: that of the least id, null ids last; all columns stay."""
    found = near_copies(docs, id_col=id_col, text_col=text_col, shingle=shingle, max_bits=max_bits)
    best = F.min(F.struct(F.isnull("id").alias("no_id"), F.col("id"), F.col("row"))).alias("best")
    # without an id to name it, a component is its fingerprint's
    by = F.when(F.col("component_id").isNull(), F.col("fp")).alias("unnamed")
    stay = land(found.groupBy("component_id", by).agg(best).select(F.col("best.row").alias("_row")), "stay")
    rows = docs.withColumn("_row", row_key(id_col, text_col)).dropDuplicates(["_row"])
    return rows.join(stay, "_row", "left_semi").drop("_row")


@query("op4_simhash")
def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_copies(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
