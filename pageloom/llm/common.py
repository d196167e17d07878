"""Helpers the operators share: reading, landing, words, checked broadcasts, components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pageloom.runtime import scratch_path

#: A word is a run of anything but these six characters.
SPACES = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
#: A table is broadcast only if it was landed and its files are no larger than this.
BROADCAST_BYTES = 8 << 20
#: Rows of a few numbers that one task writes.
NARROW_ROWS = 500_000
#: Texts above this are walked in pieces, so that lists of words stay small.
PIECE = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def land(df: DataFrame, label: str, compression: str = "snappy", tasks: int | None = None) -> DataFrame:
    """Write ``df`` to the folder all executors share and read on from there, with ``tasks`` in no
    more files than that: small tables in many files make many small files of all that follows.

    Later reads see only the columns they ask for, lost executors lose nothing, and
    the sizes of the files tell whether a broadcast is safe.
    """
    path = scratch_path(df.sparkSession, label)
    (df.coalesce(tasks) if tasks else df).write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def landed_bytes(df: DataFrame) -> int:
    """Bytes of the files below a landed table, by the optimizer's own statistics."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def bounded(df: DataFrame) -> DataFrame:
    """Hint a landed table for broadcast if its files are small; else leave it to a join
    on both sides' keys, whose hot keys adaptive execution splits."""
    return F.broadcast(df) if landed_bytes(df) <= BROADCAST_BYTES else df


def tasks_for(df_rows: int, rows_per_task: int, least: int = 1) -> int:
    return max(least, -(-df_rows // rows_per_task))


def batches(source: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The same rows in small batches: Python objects are made for a few texts at a time."""
    for batch in source:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def byte_pieces(raw: bytes, piece: int = PIECE) -> Iterator[bytes]:
    """A text cut at white space into pieces of about ``piece`` bytes, none inside a word."""
    at = 0
    while len(raw) - at > piece:
        cut = max(raw.rfind(c, at, at + piece) for c in (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\x0c"))
        if cut <= at:  # one word longer than a piece
            rest = raw[at + piece :].split(maxsplit=1)
            if raw[at + piece : at + piece + 1].isspace():
                cut = at + piece
            else:  # the next word begins the next piece; the last word ends the text
                cut = len(raw) - len(rest[1]) if len(rest) > 1 else len(raw)
        yield raw[at:cut]
        at = cut
    yield raw[at:]


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of the links ``a``-``b`` (long): root is the least node reachable.

    Rounds of large star and small star; each round lands its links and minima, so the
    joins are between plain scans and a node with very many links is split among tasks.
    """

    def same(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    now = land(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    state = same(now)
    while state[0]:
        few = tasks_for(2 * state[0], NARROW_ROWS)
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = land(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m")), "minima", tasks=few)
        large = land(both.where("b > a").join(bounded(least), "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct(), "large", tasks=few)
        least = land(large.groupBy("a").agg(F.min("b").alias("m")), "minima", tasks=few)
        small = large.join(bounded(least), "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        now = land(small.unionByName(least.select("a", F.col("m").alias("b"))).distinct(), "links", tasks=few)
        before, state = state, same(now)
        if state == before:
            break
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links node-root with the same components as the links a-b; no more of them than nodes."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    left, right = at[: len(a)], at[len(a) :]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[left], root[right])
        before = root.copy()
        np.minimum.at(root, root[left], low)
        np.minimum.at(root, root[right], low)
        while (root[root] != root).any():
            root = root[root]
        if (before == root).all():
            moved = root != np.arange(len(nodes))
            return nodes[moved], nodes[root[moved]]
