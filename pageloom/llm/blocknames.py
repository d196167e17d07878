"""Exact duplicates by deterministic block naming.

A normalised text (A-Z lower-cased) is cut into blocks of fixed size. Blocks are sorted, and equal
ones get one integer name, in the order of their bytes. Then adjacent names are paired, the pairs
are sorted and named in turn, and so on until a text has one name: its identity, made without any
hash, so that two texts share it exactly if they are equal. A text that holds a block or a pair
nobody else holds is alone for certain; it is settled there and takes no part in later rounds.

Blocks are folded within a task before they are shuffled, so a block that a third of all texts hold
reaches the sort once per task, and its names return to the tasks' lists of holders, not to the
holders one by one. Rounds after the first move integers only: 8 bytes for 2048 of text.

Defined results: a null text counts as empty, empty texts are equal to each other; only A-Z change
case; repeated rows are rows of their own, one of which stays; null ids come last, so one stays only
where a group has no other; of equal ids the row read first stays; an empty table gives no rows;
a text has to fit a task, its names do in 1/256 of that; other columns may have any names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pageloom.catalog.registry import query
from pageloom.llm.common import batches, bounded, land, table
from pageloom.runtime import quoted

#: Bytes of a block.
BLOCK = 2048
#: Bytes of different blocks a task folds before it hands them on.
HELD_BYTES = 32 << 20
#: Stands for the missing right half of a text's last pair; names are not negative.
NONE = -1


def cut(docs: DataFrame, text_col: str, keep: list[str], block: int = BLOCK) -> DataFrame:
    """Two kinds of rows. Of each document: row (a number of its own), doc (the columns to keep) and
    sha (of the normalised text). Of each block a task holds: task, local (its number there), block,
    and who holds it where, as rows and ats."""
    doc = F.struct(*(F.col(quoted(c)) for c in keep)).alias("doc")
    rows = docs.select(doc, F.col(quoted(text_col)).alias("text"))
    longs = T.ArrayType(T.LongType())
    schema = T.StructType([T.StructField("row", T.LongType()), T.StructField("doc", rows.schema["doc"].dataType), T.StructField("sha", T.StringType())])
    schema = schema.add("task", T.LongType()).add("local", T.LongType()).add("block", T.BinaryType()).add("rows", longs).add("ats", longs)

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        row, task, size, held, kind = part << 33, part << 33, 0, {}, None
        names = schema.names

        def blocks() -> pa.RecordBatch:
            n = len(held)
            longs = pa.list_(pa.int64())
            columns = [pa.nulls(n, pa.int64()), pa.nulls(n, kind), pa.nulls(n, pa.string()), pa.array([task] * n, pa.int64()), pa.array(range(n), pa.int64())]
            columns += [pa.array(list(held), pa.binary()), pa.array([h[0] for h in held.values()], longs), pa.array([h[1] for h in held.values()], longs)]
            return pa.RecordBatch.from_arrays(columns, names=names)

        for batch in batches(source, 256):
            kind, shas, first = batch.column(0).type, [], row
            for text in batch.column(1).cast(pa.binary()).to_pylist():
                raw = (text or b"").lower()  # of bytes: A-Z only
                shas.append(hashlib.sha256(raw).hexdigest())
                for at, start in enumerate(range(0, max(len(raw), 1), block)):
                    piece = raw[start : start + block]
                    found = held.get(piece)
                    if found is None:
                        found = held[piece] = ([], [])
                        size += len(piece) + 400
                    found[0].append(row)
                    found[1].append(at)
                    size += 16
                    if size > HELD_BYTES:
                        yield blocks()
                        held, size, task = {}, 0, task + 1
                row += 1
            n = len(shas)
            columns = [pa.array(range(first, row), pa.int64()), batch.column(0), pa.array(shas, pa.string())]
            columns += [pa.nulls(n, t) for t in (pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=names)
        if held:
            yield blocks()

    return rows.mapInArrow(run, schema)


def name(rows: DataFrame, by: list[str], kept: list[str]) -> DataFrame:
    """The columns ``kept``, with the integer ``name`` of the columns ``by`` (equal exactly if they
    are, and ordered like them) and ``held``, the sum of ``n`` over the rows of that name.

    A range sort brings equal keys to one task side by side; the task's number and a count there
    make the name. Rows are folded before, so equal keys are at most one row a task of the fold.
    """
    types = {f.name: f.dataType for f in rows.schema}
    schema = T.StructType([T.StructField(c, types[c]) for c in kept]).add("name", T.LongType()).add("held", T.LongType())

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made, open_ = TaskContext.get().partitionId() << 40, 0, None

        def starts(batch: pa.RecordBatch) -> np.ndarray:
            new = np.zeros(batch.num_rows, bool)
            new[0] = True
            for c in by:
                keys = batch.column(c)
                new[1:] |= pc.not_equal(keys[1:], keys[:-1]).to_numpy(zero_copy_only=False)
            return new

        def out(batch: pa.RecordBatch, new: np.ndarray) -> pa.RecordBatch:
            at = np.cumsum(new) - 1
            total = np.add.reduceat(batch.column("n").to_numpy(), np.flatnonzero(new))
            columns = [batch.column(c) for c in kept] + [pa.array(part + made + at), pa.array(total[at])]
            return pa.RecordBatch.from_arrays(columns, names=schema.names)

        for batch in source:
            if not batch.num_rows:
                continue
            if open_ is not None:
                batch = pa.Table.from_batches([open_, batch]).combine_chunks().to_batches()[0]
            new = starts(batch)
            last = int(np.flatnonzero(new)[-1])  # the run of equal keys that may go on
            if last:
                yield out(batch.slice(0, last), new[:last])
                made += int(new[:last].sum())
            open_ = batch.slice(last)
        if open_ is not None:
            yield out(open_, starts(open_))

    return rows.repartitionByRange(*by).sortWithinPartitions(*by).mapInArrow(run, schema)


def folded(rows: DataFrame) -> DataFrame:
    """(row, names in order, lone) of rows (row, at, name, held)."""
    ordered = F.array_sort(F.collect_list(F.struct("at", "name"))).alias("ordered")
    grouped = rows.groupBy("row").agg(ordered, (F.min("held") == 1).alias("lone"))
    # a settled text needs no more names than one
    return grouped.select("row", F.when(F.col("lone"), F.slice("ordered.name", 1, 1)).otherwise(F.col("ordered.name")).alias("names"), "lone")


def identities(pieces: DataFrame) -> DataFrame:
    """(row, level, name) of each document: equal texts, and no others, share level and name.
    Texts that are known to be alone have null for both."""
    blocks = pieces.where("block IS NOT NULL")
    named = land(name(blocks.select("block", "task", "local", F.size("rows").cast("long").alias("n")), ["block"], ["task", "local"]), "names")
    holders = blocks.select("task", "local", F.arrays_zip("rows", "ats").alias("holders")).join(bounded(named), ["task", "local"])
    rows = holders.select(F.explode("holders").alias("h"), "name", "held").select(F.col("h.rows").alias("row"), F.col("h.ats").alias("at"), "name", "held")
    level, settled = 0, []
    while True:
        state = land(folded(rows), "state")
        lone = F.when(F.col("lone"), F.lit(None).cast("long"))
        done = state.where("lone OR size(names) = 1")
        settled.append(done.select("row", lone.otherwise(F.lit(level)).alias("level"), lone.otherwise(F.col("names")[0]).alias("name")))
        active = state.where("NOT lone AND size(names) > 1")
        if active.isEmpty():
            break
        pair = f"transform(sequence(0, (size(names) - 1) div 2), i -> struct(names[2 * i] AS a, coalesce(get(names, 2 * i + 1), {NONE}L) AS b))"
        pairs = active.select("row", F.posexplode(F.expr(pair)).alias("at", "p")).select("row", "at", "p.a", "p.b")
        counted = pairs.groupBy("a", "b").agg(F.count("*").alias("n"))
        named = land(name(counted, ["a", "b"], ["a", "b"]), "names")
        rows = pairs.join(bounded(named), ["a", "b"]).select("row", F.col("at").cast("long").alias("at"), "name", "held")
        level += 1
    found = settled[0]
    for more in settled[1:]:
        found = found.unionByName(more)
    return found


def groups(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None, block: int = BLOCK) -> DataFrame:
    """(doc, sha, keep_id, group_size, kept) of every row; doc is a struct of the columns ``keep``,
    those of ``docs`` unless given, the id among them."""
    pieces = land(cut(docs, text_col, keep or docs.columns, block), "blocks")
    found = land(identities(pieces), "identities")
    rows = pieces.where("row IS NOT NULL").select("row", "doc", "sha").join(found, "row")
    own = F.col("doc").getField(id_col)
    shared = found.where("level IS NOT NULL").join(pieces.where("row IS NOT NULL").select("row", own.alias("id")), "row")
    best = F.max(F.struct(F.isnotnull("id").alias("named"), F.col("id"), (-F.col("row")).alias("first"))).alias("best")
    least = land(shared.groupBy("level", "name").agg(best, F.count("*").alias("of")), "groups")
    joined = rows.join(bounded(least), ["level", "name"], "left")
    alone = F.isnull("of")
    keep_id = F.when(alone, own).otherwise(F.col("best.id")).alias("keep_id")
    kept = (alone | (F.col("best.first") == -F.col("row"))).alias("kept")
    return joined.select("doc", "sha", keep_id, F.coalesce("of", F.lit(1).cast("long")).alias("group_size"), kept)


def drop_exact(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """The rows that stay, with all their columns."""
    return groups(docs, id_col=id_col, text_col=text_col, block=block).where("kept").select("doc.*")


SQL = """
WITH texts AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents
)
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size, doc_id = max(doc_id) OVER same AS kept, text_sha256
FROM texts WINDOW same AS (PARTITION BY t)
"""


@query("op12_exact", SQL)
def op12_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = groups(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return found.select("doc.doc_id", "keep_id", "group_size", "kept", F.col("sha").alias("text_sha256"))
