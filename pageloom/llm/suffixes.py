"""Repeated passages: a radix sort of suffixes, only as deep as the threshold.

Suffixes that agree in their first ``length`` bytes are what repeats; order beyond that is of no
interest. Digits are taken from the most significant on, and a suffix whose digit no other has
is done:

1. The first digit is content, not place: of the ``ANCHOR``-byte grams in a window of ``length``
   bytes, the one with the least hash (leftmost of equals). Equal windows choose the same gram at
   the same offset. Windows whose gram occurs once in the corpus are unique and go no further;
   this needs one number per run of windows that share a gram, not one per byte.
2. Windows that remain are taken sixteen at a time, by their offset to the gram. Their second
   digit is the core that all sixteen contain (its 128-bit hash); cores meet in a shuffle.
3. Within a core, the sixteen windows differ in fifteen bytes each; these are sorted byte for
   byte, and equal groups are the repeated windows.

Equal texts are folded before the first digit: of a text that occurs twice every window repeats,
and one copy stands for it. Cores that more than ``HOT_ROWS`` blocks share are not gathered:
equal contexts are folded before the shuffle, and the third digit is a grouping by Spark.

Matches never cross documents. Defined results: a null or empty text has no bytes and keeps none;
texts shorter than ``length`` keep everything; repeated rows and ids are copies of each other
like any equal texts; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pageloom.catalog.registry import query
from pageloom.llm.common import batches, bounded, land, table, tasks_for

LENGTH = 400
ANCHOR = 128
BLOCK = 16
#: Bytes whose grams are hashed at a time.
STRIDE = 1 << 20
#: Blocks of one core that one task sorts at most.
HOT_ROWS = 20_000
#: Blocks a task sorts about, all cores together.
TASK_ROWS = 300_000
FACTOR = 0x9E3779B97F4A7C15


def text_key(text: str) -> Column:
    """128 bits of SHA-256: the identity of a text."""
    return F.unhex(F.substring(F.sha2(F.coalesce(F.col(text), F.lit("")), 256), 1, 32))


def gram_hashes(raw: np.ndarray, size: int) -> np.ndarray:
    """A polynomial hash of the ``size`` bytes from each place on, by doubling."""
    h, done, factor = raw.astype(np.uint64) + np.uint64(1), 1, FACTOR
    bits = bin(size)[3:]
    for bit in bits:
        h = h[:-done] * np.uint64(factor) + h[done:]
        done, factor = 2 * done, factor * factor % 2**64
        if bit == "1":
            h = h[:-1] * np.uint64(FACTOR) + raw[done : done + len(h) - 1].astype(np.uint64) + np.uint64(1)
            done, factor = done + 1, factor * FACTOR % 2**64
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def anchors(raw: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows that choose the same gram: its hash and place, the first window, how many."""
    out = []
    for start in range(0, len(raw) - length + 1, STRIDE):
        part = raw[start : start + STRIDE + length - 1]
        h = gram_hashes(part, gram)
        least = (h & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(h), dtype=np.uint64)
        width, done = length - gram + 1, 1
        while done < width:
            step = min(done, width - done)
            least = np.minimum(least[:-step], least[step:])
            done += step
        chosen = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
        first = np.concatenate([[0], np.flatnonzero(np.diff(chosen)) + 1])
        out.append((h[chosen[first]].view(np.int64), chosen[first] + start, first + start, np.diff(np.append(first, len(chosen)))))
    if not out:
        none = np.zeros(0, np.int64)
        return none, none, none, none
    return tuple(np.concatenate(part) for part in zip(*out))


def blocks(raw: bytes, runs: list[dict], length: int) -> Iterator[tuple[bytes, bytes, bytes, int, int]]:
    """(core, left, right, owned windows as bits, place of window 0) of each block of a text.

    Window t of a block at ``place`` is the one that begins t bytes before it.
    """
    for run in runs:
        pos, first, n = run["pos"], run["first"], run["n"]
        low, high = pos - first - n + 1, pos - first
        for j in range(low // BLOCK, high // BLOCK + 1):
            place = pos - BLOCK * j
            core = raw[place : place + length - BLOCK + 1]
            left = raw[max(0, place - BLOCK + 1) : place].rjust(BLOCK - 1, b"\0")
            right = raw[place + length - BLOCK + 1 : place + length].ljust(BLOCK - 1, b"\0")
            begin, end = max(low - BLOCK * j, 0), min(high - BLOCK * j, BLOCK - 1)
            yield hashlib.blake2b(core, digest_size=16).digest(), left, right, (1 << (end + 1)) - (1 << begin), place


def repeated(core: np.ndarray, left: np.ndarray, right: np.ndarray, owned: np.ndarray) -> np.ndarray:
    """For each block, the bits of its owned windows that another block has, too (arrays of bytes
    by row). Sorted by core first; then, among cores that recur, by the bytes of each window."""
    hits = np.zeros(len(owned), np.int64)
    a, b = (core.view(">u8").astype(np.uint64)[:, i] for i in (0, 1))
    order = np.lexsort((b, a))
    group = np.cumsum(np.append(0, (a[order][1:] != a[order][:-1]) | (b[order][1:] != b[order][:-1])))
    some = np.bincount(group)[group] > 1
    rows, group = order[some], group[some]
    for t in range(BLOCK):
        has = (owned[rows] >> t) & 1 > 0
        at, of = rows[has], group[has]
        if not len(at):
            continue
        word = np.zeros((len(at), 16), np.uint8)
        word[:, :t] = left[at, BLOCK - 1 - t :]
        word[:, t : BLOCK - 1] = right[at, : BLOCK - 1 - t]
        high, low = (word.view(">u8").astype(np.uint64)[:, i] for i in (0, 1))
        order = np.lexsort((low, high, of))
        same = (of[order][1:] == of[order][:-1]) & (high[order][1:] == high[order][:-1]) & (low[order][1:] == low[order][:-1])
        twice = np.append(same, False) | np.append(False, same)
        hits[at[order[twice]]] |= 1 << t
    return hits


def fixed(column: pa.Array, width: int) -> np.ndarray:
    """A binary column of values of one width, as rows of bytes."""
    column = column.cast(pa.binary())
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]].reshape(-1, width) if len(column) else np.zeros((0, width), np.uint8)


def sort_cores(made: DataFrame, rows: int) -> DataFrame:
    """(key, place, hits) of blocks with repeated windows, cores dealt to tasks."""

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [b for b in source if b.num_rows]
        if not got:
            return
        parts = [np.concatenate([fixed(b.column(i), w) for b in got]) for i, w in ((0, 16), (1, BLOCK - 1), (2, BLOCK - 1))]
        owned = np.concatenate([b.column(3).to_numpy().astype(np.int64) for b in got])
        hits = repeated(np.ascontiguousarray(parts[0]), *parts[1:], owned)
        at = 0
        for b in got:
            mine = hits[at : at + b.num_rows]
            at += b.num_rows
            some = pa.array(np.flatnonzero(mine))
            yield pa.RecordBatch.from_arrays([b.column(4).take(some), b.column(5).take(some), pa.array(mine[mine > 0].astype(np.int32))], names=["key", "place", "hits"])

    dealt = made.select("core", "left", "right", "owned", "key", "place").repartition(tasks_for(rows, TASK_ROWS, 8), "core")
    return dealt.mapInArrow(run, "key binary, place long, hits int")


def group_cores(made: DataFrame) -> DataFrame:
    """The same for blocks of cores that very many share, without gathering a core anywhere."""
    context = ["core", "left", "right", "owned"]
    folded = land(made.groupBy(*context).agg(F.count("*").alias("m")), "contexts")
    window = F.expr(f"concat(core, substring(left, {BLOCK} - t, t), substring(right, 1, {BLOCK - 1} - t))")
    each = folded.withColumn("t", F.explode(F.expr(f"filter(sequence(0, {BLOCK - 1}), t -> shiftright(owned, t) & 1 = 1)"))).withColumn("window", window)
    twice = land(each.groupBy("t", "window").agg(F.sum("m").alias("m")).where("m > 1").drop("m"), "windows")
    hit = land(each.join(twice, ["t", "window"]).groupBy(*context).agg(F.bit_or(F.expr("shiftleft(1, t)")).alias("hits")), "hits")
    return made.join(hit, context).select("key", "place", "hits")


def repeats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = ANCHOR) -> DataFrame:
    """(key, copies, places, hits) of texts with repeated windows; copies > 1: all of them are."""
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), text_key(text_col).alias("key")).where(F.octet_length("text") >= length)

    def find(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(source, 256):
            found = [anchors(np.frombuffer(t.encode(), np.uint8), length, gram) for t in batch.column(1).to_pylist()]
            lists = [pa.array([f[i] for f in found], pa.list_(pa.int64())) for i in range(4)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), *lists], names=["id", "key", "h", "pos", "first", "n"])

    made = land(rows.mapInArrow(find, f"id {kind}, key binary, h array<long>, pos array<long>, first array<long>, n array<long>"), "anchors")
    texts = land(made.groupBy("key").agg(F.min("id").alias("id"), F.count("*").alias("copies")), "texts")
    one = made.join(texts, (made.key == texts.key) & made.id.eqNullSafe(texts.id)).select(texts.key, texts.id, "copies", "h", "pos", "first", "n").dropDuplicates(["key"])
    runs = land(one.select("key", "id", "copies", F.explode(F.arrays_zip("h", "pos", "first", "n")).alias("run")).select("key", "id", "copies", "run.*"), "runs")
    shared = land(runs.groupBy("h").count().where("count > 1").select("h"), "shared")
    wanted = runs.join(shared, "h").groupBy("key", "id").agg(F.collect_list(F.struct("pos", "first", "n")).alias("runs"))
    wanted = land(wanted, "wanted").withColumnRenamed("key", "k").withColumnRenamed("id", "i")

    def cut(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.binary(), pa.binary(), pa.binary(), pa.int32(), pa.int64(), pa.binary()]
        for batch in batches(source, 128):
            out = []
            for text, key, own in zip(*(batch.column(i).to_pylist() for i in range(3))):
                out += [(*block, key) for block in blocks(text.encode(), own, length)]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=["core", "left", "right", "owned", "place", "key"])

    texts_in = rows.join(wanted, (rows.key == F.col("k")) & rows.id.eqNullSafe(F.col("i"))).select("text", "key", "runs")
    cuts = land(texts_in.mapInArrow(cut, "core binary, left binary, right binary, owned int, place long, key binary"), "blocks")
    many = land(cuts.groupBy("core").count(), "cores")
    hot = land(many.where(F.col("count") > HOT_ROWS).select("core"), "hot")
    usual = cuts.join(bounded(hot), "core", "left_anti")
    hits = sort_cores(usual, many.agg(F.coalesce(F.sum("count"), F.lit(0))).first()[0]).unionByName(group_cores(cuts.join(bounded(hot), "core", "left_semi")))
    spans = land(hits, "repeated").groupBy("key").agg(F.collect_list("place").alias("places"), F.collect_list("hits").alias("hits"))
    return land(texts.where("copies > 1").select("key", "copies").join(spans, "key", "full"), "spans")


def cover(size: int, places: list[int], hits: list[int], length: int) -> list[tuple[int, int]]:
    """Maximal runs of bytes that repeated windows cover."""
    place, bits = np.array(places, np.int64), np.array(hits, np.int64)
    starts = np.unique(np.concatenate([place[(bits >> t) & 1 > 0] - t for t in range(BLOCK)]))
    if not len(starts):
        return []
    gap = np.flatnonzero(np.diff(starts) > length)
    return list(zip(starts[np.append(0, gap + 1)].tolist(), (starts[np.append(gap, len(starts) - 1)] + length).tolist()))


def remove_repeats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = ANCHOR) -> DataFrame:
    """Every row's id, n_bytes, removed runs (``starts``, ``ends``, in bytes) and the kept bytes."""
    found = repeats(docs, id_col=id_col, text_col=text_col, length=length, gram=gram)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]
        for batch in batches(source, 256):
            out = []
            for text, copies, places, hits in zip(*(batch.column(i).to_pylist() for i in range(1, 5))):
                raw = (text or "").encode()
                runs = [(0, len(raw))] if copies else cover(len(raw), places, hits, length) if places else []
                kept, at = [], 0
                for start, end in runs:
                    kept.append(raw[at:start])
                    at = end
                out.append((len(raw), [r[0] for r in runs], [r[1] for r in runs], b"".join([*kept, raw[at:]])))
            if out:
                yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for c, k in zip(zip(*out), kinds))], names=["id", "n_bytes", "starts", "ends", "kept"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), text_key(text_col).alias("k"))
    rows = rows.join(found.withColumnRenamed("key", "k"), "k", "left").select("id", "text", "copies", "places", "hits")
    return rows.mapInArrow(run, f"id {kind}, n_bytes long, starts array<long>, ends array<long>, kept binary")


@query("op6_suffixes")
def op6_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeats(table(spark, sf_dir, "documents"))
    removed = F.expr("aggregate(zip_with(ends, starts, (e, s) -> e - s), 0L, (a, n) -> a + n)")
    return found.select(F.col("id").alias("doc_id"), "n_bytes", removed.alias("n_removed"), F.size("starts").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
