"""Near copies by the Jaccard similarity of their sets of five-word shingles, without loss.

Candidates come first from the SimHash operator: fingerprints of the sets, posted by the positions of
their bytes, filtered by the count of equal ones and linked within ``NEAR_BITS`` bits
(:func:`pageloom.llm.simhash.links`); a set meets the first of its fingerprint, and that one those of
linked fingerprints. SimHash cannot promise similarity 0.8: at 0.8 two fingerprints of 64 bits differ
by about ten bits on average and often by more, which may touch all eight bytes, so that no count of
equal bytes is guaranteed. A prefix filter, which is exact, adds the rest. All shingles have one order; of a set of n, the first n - ceil(0.8 n) + 1 are its prefix, and two sets with similarity
0.8 or more share a shingle of their prefixes. The order begins with what a sample of the texts
has rarely, so postings are short; the sample decides about cost only, never about the result.

A posting of up to ``CROWD`` sets gives all pairs that its sizes and places in the prefixes allow.
In a larger one each set first meets one other, of those whose sizes may be similar the one with the
fewest shingles before the shared one in its prefix: in a group of copies the original or one close
to it, as shingles that a change brings in are rare and come first. When these
pairs are verified, only sets that are not yet of one component meet, and a pair only where none of
the last ``BEFORE`` postings of the one is among those of the other: there they met already. So a
large group of near copies costs in proportion, but for pairs close to the limit that stay apart,
and no pair that could join two components is left out.

Pairs are narrow until the end. First they are held against sketches, a bit or two for each
shingle: a bit tells whether an odd number of the set's hashes fall on it, so two sets differ in at
least as many shingles as their sketches do in bits, and a pair whose sketches differ too much goes
for certain. Of what is left one pair a set is verified on the whole sets; then only pairs between
components that are still apart, so that few sets travel, and each a few times.

Defined results: null and empty texts are copies of each other; texts of one to four words have
their whole sequence as shingle; A-Z are read as a-z; equal sets are folded first; components are
transitive; of a component the row of the least id stays, null ids last, of equal ones the row read
first; all columns stay and may have any names. Shingles are told apart by 64-bit hashes, sets by 128.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator
from functools import reduce
from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from pageloom.llm import simhash
from pageloom.llm.common import NARROW_ROWS, batches, bounded, byte_pieces, components, land, tasks_for
from pageloom.runtime import quoted

SHINGLE = 5
#: Similarity from which texts are near copies, as a fraction.
PART, WHOLE = 4, 5
SAMPLE_ROWS = 20_000
#: Shingles that come last in the order, at most: those that the sample has most often.
FREQUENT = 100_000
CROWD = 16
#: Crowded postings before the one at hand that a set tells, so that pairs meet about once.
BEFORE = 4
#: Bits in which fingerprints may differ that make sets meet before the prefix filter.
NEAR_BITS = 2
ROWS_PER_TASK = 1_500_000
PAIRS_AT_ONCE = 100_000
#: Pairs that a task verifies on whole sets, at least where there are more.
VERIFIED_ROWS = 5_000
#: Bits of a sketch at least; a larger set has the next power of two from its size on.
SKETCH_BITS = 512


def shingles(text: str | None) -> np.ndarray:
    """The set of a text's shingles, as sorted hashes."""
    found, carry = [], []
    for piece in byte_pieces((text or "").encode().lower()):
        words = carry + piece.split()
        found.append(np.fromiter((xxhash.xxh64_intdigest(b" ".join(words[i : i + SHINGLE])) for i in range(len(words) - SHINGLE + 1)), np.uint64))
        carry = words[-(SHINGLE - 1) :]
    made = np.unique(np.concatenate(found))
    if not len(made) and carry:
        made = np.array([xxhash.xxh64_intdigest(b" ".join(carry))], np.uint64)
    return made


def similar(x: np.ndarray, y: np.ndarray) -> bool:
    both = len(np.intersect1d(x, y, assume_unique=True))
    return WHOLE * both >= PART * (len(x) + len(y) - both)


def sketch(made: np.ndarray) -> bytes:
    """Of each bit, whether an odd number of hashes fall on it."""
    bits = max(SKETCH_BITS, 1 << (len(made) - 1).bit_length() if len(made) else 0)
    odd = np.bincount((made & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def short_of(made: bytes) -> bytes:
    """The least sketch a sketch folds to."""
    a = np.frombuffer(made, np.uint64)
    while 64 * len(a) > SKETCH_BITS:
        a = a[: len(a) // 2] ^ a[len(a) // 2 :]
    return a.tobytes()


def may_be_similar(x: bytes, y: bytes, shared_sizes: int) -> bool:
    """Whether sets with these sketches, of so many shingles in sum, may be similar."""
    a, b = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
    while len(a) > len(b):  # the halves of a sketch, one on the other, are the sketch of half the bits
        a = a[: len(a) // 2] ^ a[len(a) // 2 :]
    while len(b) > len(a):
        b = b[: len(b) // 2] ^ b[len(b) // 2 :]
    differ = int(np.bitwise_count(a ^ b).sum())
    return (PART + WHOLE) * differ <= (WHOLE - PART) * shared_sizes


def prefix(made: np.ndarray, frequent: np.ndarray, counts: np.ndarray) -> np.ndarray:
    n = len(made)
    if not n:
        return made
    seen = np.zeros(n, np.int64)
    if len(frequent):
        at = np.minimum(np.searchsorted(frequent, made), len(frequent) - 1)
        seen = np.where(frequent[at] == made, counts[at], 0)
    return made[np.lexsort((made, seen))[: n - -(-PART * n // WHOLE) + 1]]


def sampled(docs: DataFrame, text_col: str) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that several texts of a sample have, sorted, and how many have them."""

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(source):
            made = [shingles(t) for t in batch.column(0).to_pylist()]
            flat = np.concatenate(made) if made else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(flat.view(np.int64))], names=["shingle"])

    rate = max(1, docs.count() // SAMPLE_ROWS)
    part = docs.where(F.pmod(F.xxhash64(text_col), F.lit(rate)) == 0).select(text_col).distinct()
    counted = part.mapInArrow(run, "shingle long").groupBy("shingle").agg(F.count("*").alias("n")).where("n > 1")
    rows = counted.orderBy(F.desc("n"), "shingle").limit(FREQUENT).toPandas()
    frequent, counts = rows["shingle"].to_numpy(np.int64).view(np.uint64), rows["n"].to_numpy(np.int64)
    order = np.argsort(frequent)
    return frequent[order], counts[order]


def pieces(docs: DataFrame, text_col: str) -> DataFrame:
    """(row, doc, mark, size, prefix, sketch, short, fp) of every row: row is a number of its own, doc all
    columns; ``mark`` is the same for equal sets; ``short`` is the sketch in its least size; ``fp`` the
    fingerprint of the set."""
    frequent, counts = sampled(docs, text_col)
    held = docs.sparkSession.sparkContext.broadcast((frequent, counts))
    rows = docs.select(F.struct(*(F.col(quoted(c)) for c in docs.columns)).alias("doc"))
    schema = T.StructType([T.StructField("row", T.LongType()), T.StructField("doc", rows.schema["doc"].dataType), T.StructField("mark", T.BinaryType())])
    schema = schema.add("size", T.LongType()).add("prefix", T.ArrayType(T.LongType())).add("sketch", T.BinaryType()).add("short", T.BinaryType()).add("fp", T.LongType())

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, counts = held.value
        row = TaskContext.get().partitionId() << 33
        for batch in batches(source, 256):
            marked, sizes, prefixes, sketches, prints = [], [], [], [], []
            for text in batch.column(0).field(text_col).to_pylist():
                made = shingles(text)
                marked.append(xxhash.xxh3_128_digest(made.tobytes()))
                sizes.append(len(made))
                prefixes.append(prefix(made, frequent, counts).view(np.int64))
                sketches.append(sketch(made))
                prints.append(simhash.fingerprint_of_set(made))
            columns = [pa.array(range(row, row + batch.num_rows), pa.int64()), batch.column(0), pa.array(marked, pa.binary()), pa.array(sizes, pa.int64())]
            columns += [pa.array(prefixes, pa.list_(pa.int64())), pa.array(sketches, pa.binary()), pa.array(map(short_of, sketches), pa.binary())]
            columns.append(pa.array(np.array(prints, np.uint64).view(np.int64)))
            row += batch.num_rows
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return rows.mapInArrow(run, schema)


def fingerprinted(sets: DataFrame) -> DataFrame:
    """Pairs a-b that connect what fingerprints within ``NEAR_BITS`` bits connect."""
    prints = land(sets.groupBy("fp").agg(F.min("row").alias("first")), "fingerprints")
    found = simhash.links(prints.select("fp"), NEAR_BITS, prints.count())
    first = lambda side: bounded(prints.select(F.col("fp").alias(side), F.col("first").alias(f"first_{side}")))
    apart = found.join(first("a"), "a").join(first("b"), "b").select(F.least("first_a", "first_b").alias("a"), F.greatest("first_a", "first_b").alias("b"))
    same = sets.select("row", "fp").join(bounded(prints), "fp").where("first < row").select(F.col("first").alias("a"), F.col("row").alias("b"))
    return apart.unionByName(same)


def least_of_windows(values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Where the least of ``values[low:high]`` is, for every window; both ends never go back."""
    out, held, to = np.empty(len(low), np.int64), deque(), 0
    for i in range(len(low)):
        while to < high[i]:
            while held and values[held[-1]] > values[to]:
                held.pop()
            held.append(to)
            to += 1
        while held[0] < low[i]:
            held.popleft()
        out[i] = held[0]
    return out


def candidates(postings: DataFrame, tasks: int, crowds: bool) -> DataFrame:
    """Pairs a-b to look at, of (shingle, node, size, at, with ``crowds`` also root and short): without ``crowds`` all pairs of small
    postings and a first few of large ones, whose shingles are told as ``crowd``; with it those of
    large ones whose roots differ, but for pairs that met in one of the last ``BEFORE`` postings."""
    earlier = [f"before_{k}" for k in range(1, BEFORE + 1)]

    def meet(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got, shorts, tolds = [], [], []
        for b in source:
            if b.num_rows:
                got.append([c.to_numpy() for c in b.columns[: 5 if crowds else 4]])
                if crowds:
                    told = [b.column(c).fill_null(0).to_numpy() for c in earlier]
                    none = [b.column(c).is_null().to_numpy(zero_copy_only=False) for c in earlier]
                    tolds.append((np.stack(told, 1), ~np.stack(none, 1)))
                    shorts.append(np.frombuffer(b"".join(b.column("short").to_pylist()), np.uint64).reshape(b.num_rows, -1))
        if not got:
            return
        shingle, node, size, at, *roots = (np.concatenate(part) for part in zip(*got))
        order = np.lexsort((node, size, shingle))
        shingle, node, size, at = shingle[order], node[order], size[order], at[order]
        root, short = (roots[0][order], np.concatenate(shorts)[order]) if crowds else (node, None)
        if crowds:
            told, is_told = (np.concatenate(part)[order] for part in zip(*tolds))
        # fewest shingles before the shared one first; of equal ones the one whose number has the least hash
        place = np.empty(len(node), np.int64)
        place[np.lexsort((node.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15), at))] = np.arange(len(node))
        bounds = np.append(np.flatnonzero(np.append(True, shingle[1:] != shingle[:-1])), len(shingle))
        left, right, crowded, held = [], [], [], 0

        def out() -> pa.RecordBatch:
            a, b = (np.concatenate(side) if side else np.zeros(0, np.int64) for side in (left, right))
            pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)]), axis=1)
            n, m = pairs.shape[1], len(crowded)
            columns = [pa.concat_arrays([pa.array(p), pa.nulls(m, pa.int64())]) for p in pairs]
            columns.append(pa.concat_arrays([pa.nulls(n, pa.int64()), pa.array(crowded, pa.int64())]))
            left.clear()
            right.clear()
            crowded.clear()
            return pa.RecordBatch.from_arrays(columns, names=["a", "b", "crowd"])

        for start, end in zip(bounds[:-1], bounds[1:]):
            crowd = end - start > CROWD
            if end - start < 2 or crowds and (not crowd or (root[start:end] == root[start]).all()):
                continue
            if crowd and not crowds:
                crowded.append(int(shingle[start]))
            first = np.searchsorted(size[start:end] * WHOLE, PART * size[start:end]) + start
            if crowd and not crowds:
                last = np.searchsorted(PART * size[start:end], WHOLE * size[start:end], "right") + start
                middle = least_of_windows(place[start:end], first - start, last - start) + start
            for i in range(start, end):
                if crowd and not crowds:
                    with_ = middle[i - start : i - start + 1]
                    with_ = with_[with_ != i]
                else:
                    with_ = np.arange(first[i - start], i)
                    if crowds:
                        with_ = with_[root[with_] != root[i]]
                # shingles before the shared one, itself, and those behind it, at most
                most = np.minimum(at[with_], at[i]) + 1 + np.minimum(size[with_] - at[with_], size[i] - at[i]) - 1
                with_ = with_[(PART + WHOLE) * most >= PART * (size[with_] + size[i])]
                if crowds and len(with_):
                    differ = np.bitwise_count(short[with_] ^ short[i]).sum(1)
                    with_ = with_[(PART + WHOLE) * differ <= (WHOLE - PART) * (size[with_] + size[i])]
                    met = (told[with_][:, :, None] == told[i][is_told[i]]) & is_told[with_][:, :, None]
                    with_ = with_[~met.any((1, 2))]
                if len(with_):
                    left.append(node[with_])
                    right.append(np.full(len(with_), node[i]))
                    held += len(with_)
                    if held >= PAIRS_AT_ONCE:
                        yield out()
                        held = 0
        yield out()

    if crowds:
        order = Window.partitionBy("node").orderBy("at")
        postings = postings.select("*", *(F.lag("shingle", k).over(order).alias(c) for k, c in enumerate(earlier, 1)))
    found = postings.select("shingle", "node", "size", "at", *(["root", "short", *earlier] if crowds else [])).repartition(tasks, "shingle")
    return found.mapInArrow(meet, "a long, b long, crowd long")


def pruned(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The different pairs whose sketches leave it open whether they are similar."""

    def judge(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            columns = [batch.column(c).to_pylist() for c in ("x", "y", "sizes")]
            near = pa.array([may_be_similar(*row) for row in zip(*columns)], pa.bool_())
            yield batch.select(["a", "b"]).filter(near)

    narrow = land(pairs.where("a IS NOT NULL").select("a", "b").distinct(), "pairs")
    asked = narrow.select(F.col("a").alias("row")).unionByName(narrow.select(F.col("b").alias("row"))).distinct()
    held = land(sets.select("row", "size", "sketch").join(asked, "row", "left_semi"), "sketches")
    x = held.select(F.col("row").alias("a"), F.col("size").alias("m"), F.col("sketch").alias("x"))
    y = held.select(F.col("row").alias("b"), F.col("size").alias("n"), F.col("sketch").alias("y"))
    both = narrow.join(bounded(x), "a").join(bounded(y), "b").select("a", "b", "x", "y", (F.col("m") + F.col("n")).alias("sizes"))
    return land(both.mapInArrow(judge, "a long, b long"), "near")


def hashes(pairs: DataFrame, sets: DataFrame, text_col: str) -> DataFrame:
    """(row, hashes) of the sets that occur in the pairs, made anew from their texts."""

    def made(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(source):
            of = [shingles(t).tobytes() for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(of, pa.binary())], names=["row", "hashes"])

    asked = land(pairs.select(F.col("a").alias("row")).unionByName(pairs.select(F.col("b").alias("row"))).distinct(), "asked")
    texts = sets.select("row", F.col("doc").getField(text_col).alias("text")).join(bounded(asked), "row")
    return land(texts.mapInArrow(made, "row long, hashes binary"), "hashes")


def verified(pairs: DataFrame, whole: DataFrame) -> DataFrame:
    """Those of the pairs whose whole sets are similar."""

    def judge(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(source, 64):
            near = [similar(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)) for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist())]
            yield batch.select(["a", "b"]).filter(pa.array(near, pa.bool_()))

    x, y = (whole.select(F.col("row").alias(side), F.col("hashes").alias(name)) for side, name in (("a", "x"), ("b", "y")))
    both = pairs.select("a", "b").join(x, "a").join(y, "b").select("a", "b", "x", "y")
    return land(both.mapInArrow(judge, "a long, b long"), "similar", tasks=tasks_for(pairs.count(), VERIFIED_ROWS))


def joined(near: DataFrame, whole: DataFrame, links: list[DataFrame], first: bool) -> tuple[list[DataFrame], DataFrame]:
    """Links that join all that the pairs ``near`` and the earlier ``links`` join, and their
    components (node, root). Pairs within a component are never verified."""
    left, found = near, None
    few = tasks_for(near.count(), NARROW_ROWS)
    for turn in count():
        if turn == 0 and first:  # for each set one partner: links, most of which hold
            chosen = left.groupBy("b").agg(F.min("a").alias("a"))
        else:
            if found is None:
                found = land(components(reduce(DataFrame.unionByName, links)), "roots")
                links = [found.where("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b"))]
            root = lambda side: bounded(found.select(F.col("node").alias(side), F.col("root").alias(f"root_{side}")))
            apart = left.join(root("a"), "a", "left").join(root("b"), "b", "left")
            apart = apart.select("a", "b", F.coalesce("root_a", "a").alias("root_a"), F.coalesce("root_b", "b").alias("root_b")).where("root_a <> root_b")
            left = land(apart, "apart", tasks=few)
            if left.isEmpty():
                return links, found
            # of two components more pairs each time, should the first ones fail
            some = F.pmod(F.xxhash64("a", "b"), F.lit(4**turn)).alias("some")
            chosen = left.groupBy(F.least("root_a", "root_b"), F.greatest("root_a", "root_b"), some).agg(F.min(F.struct("a", "b")).alias("p")).select("p.a", "p.b")
        chosen = land(chosen.select("a", "b"), "chosen", tasks=few)
        more = verified(chosen, whole)
        if found is None or not more.isEmpty():
            links, found = [*links, more], None
        left = left.select("a", "b").join(bounded(chosen), ["a", "b"], "left_anti")


def drop_similar(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each component: that of the least id, null ids last; all columns stay."""
    rows = land(pieces(docs, text_col), "pieces", "zstd")
    # of equal sets the row read first stands for all
    reps = land(rows.groupBy("mark").agg(F.min("row").alias("node")), "sets")
    sets = rows.join(bounded(reps.select(F.col("node").alias("row"))), "row", "left_semi")
    alike = pruned(fingerprinted(sets), sets)
    posted = sets.select(F.col("row").alias("node"), "size", F.posexplode("prefix").alias("at", "shingle")).withColumn("at", F.col("at").cast("long"))
    tasks = tasks_for(rows.agg(F.coalesce(F.sum(F.size("prefix")), F.lit(0))).first()[0], ROWS_PER_TASK, 8)
    met = land(candidates(posted, tasks, False), "met")
    near = pruned(met, sets)
    whole = hashes(near.unionByName(alike), sets, text_col)
    links, found = joined(near, whole, [verified(alike, whole)], True)
    crowds = land(met.select(F.col("crowd").alias("shingle")).where("shingle IS NOT NULL"), "crowds")
    # of the crowded postings, those that hold more than one component
    held = posted.join(bounded(crowds), "shingle", "left_semi").join(bounded(found.withColumnRenamed("node", "of")), F.col("node") == F.col("of"), "left")
    rooted = land(held.select("node", "size", "at", "shingle", F.coalesce("root", "node").alias("root")), "crowded")
    apart = land(rooted.groupBy("shingle").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high").select("shingle"), "apart")
    shorts = sets.select(F.col("row").alias("node"), "short")
    rooted = rooted.join(bounded(apart), "shingle", "left_semi").join(shorts, "node")
    more = pruned(candidates(rooted, tasks, True), sets)
    if not more.isEmpty():
        links, found = joined(more, hashes(more, sets, text_col), links, False)
    own = F.col("doc").getField(id_col)
    members = rows.select("row", "mark", own.alias("id")).join(bounded(reps), "mark")
    members = members.join(bounded(found.withColumnRenamed("node", "of")), F.col("node") == F.col("of"), "left")
    best = F.min(F.struct(F.isnull("id").alias("no_id"), F.col("id"), F.col("row"))).alias("best")
    stay = land(members.groupBy(F.coalesce("root", "node").alias("root")).agg(best).select(F.col("best.row").alias("row")), "stay")
    return rows.join(bounded(stay), "row", "left_semi").select("doc.*")
