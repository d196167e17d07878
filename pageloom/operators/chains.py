"""Order the pages of next-token chains."""

from __future__ import annotations

from collections import Counter
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pageloom.operators.ranking import are_lists, rank_lists
from pageloom.runtime import settle

# No cap on pages unless one is set.
NO_CAP = 1 << 62
# A chain with at most this many landed pages is walked within one task.
SHORT_CHAIN = 10_000


def walk_short(edges: DataFrame, group: list[str], max_steps: int) -> DataFrame:
    """Walk chains known to be short, each within a task: one shuffle in all.

    ``edges`` has ``group``, ``key``, ``next`` and the chain's ``start``. Returns
    the same as :func:`follow_chain`.
    """
    out = T.StructType(
        [edges.schema[c] for c in [*group, "key"]] + [T.StructField("depth", T.LongType())]
    )

    def walk(table: pa.Table) -> pa.Table:
        keys = table.column("key").to_pylist()
        after = dict(zip(keys, table.column("next").to_pylist()))
        if len(after) < len(keys):
            twice = next(k for k, n in Counter(keys).items() if n > 1)
            raise ValueError(f"request landed more than once: {twice}")
        at, seen = table.column("start")[0].as_py(), []
        while at in after and len(seen) < max_steps:
            if max_steps == NO_CAP and len(seen) > len(after):
                raise ValueError(f"chain without a cap comes back to {at}")
            seen.append(at)
            at = after[at]
        fixed = [pa.array([table.column(c)[0].as_py()] * len(seen), table.schema.field(c).type)
                 for c in group]
        key_type = table.schema.field("key").type
        columns = [*fixed, pa.array(seen, key_type), pa.array(range(len(seen)), pa.int64())]
        return pa.Table.from_arrays(columns, names=[*group, "key", "depth"])

    chosen = edges.select(*group, "key", "next", "start")
    return chosen.groupBy(*group).applyInArrow(walk, out)


def follow_chain(
    edges: DataFrame,
    starts: DataFrame,
    group: list[str],
    max_steps: int = NO_CAP,
) -> DataFrame:
    """Walk chains of any length, all at once, from their starts.

    ``edges`` has ``group``, ``key`` and ``next`` (null at the end); ``starts``
    has ``group`` and ``key``. Returns ``group``, ``key``, ``depth``. Chains that
    are lists are ranked by contraction. Where two pages name the same next one,
    all chains advance together, four times as far in each round, by equi-joins on
    (group, key): a chain of length L takes log4(L) rounds. A page met again (a
    cycle) is returned again at its later depth, up to ``max_steps`` pages, just as
    a sequential reader would see it; without a cap a cycle is an error.
    """
    keys = [*group, "key"]
    step_of = edges.groupBy(*keys).agg(
        F.max("next").alias("next"), F.count("*").alias("n")
    )
    told = F.concat(F.lit("request landed more than once: "), F.col("key"))
    step_of = step_of.select(
        *keys, F.when(F.col("n") == 1, F.col("next")).otherwise(F.raise_error(told)).alias("next")
    )
    starts = starts.select(*keys).distinct()
    if starts.groupBy(*group).count().where("count > 1").isEmpty():
        if are_lists(edges, starts, group):
            ranked = rank_lists(edges, starts, group)
            # a start that was never landed has its place all the same
            begun = ranked.where(F.col("depth") == 0)
            alone = starts.withColumn("depth", F.lit(0).cast("long")).join(begun, keys, "left_anti")
            return ranked.unionByName(alone).where(F.col("depth") < max_steps)
    jump = settle(step_of.where(F.col("next").isNotNull()))
    reached = [settle(starts.select(*keys, F.lit(0).cast("long").alias("depth")))]
    step, pages = 1, edges.count() if max_steps == NO_CAP else 0
    while step < max_steps and not jump.isEmpty():
        if max_steps == NO_CAP and step > pages:
            raise ValueError("a chain without a cap comes back to one of its pages")
        so_far = reduce(DataFrame.unionAll, reached)
        twice = _compose(jump, group)
        one = _advance(so_far, jump, group, step)
        two = _advance(so_far.unionAll(one), twice, group, 2 * step)
        more = settle(one.unionAll(two).where(F.col("depth") < max_steps))
        if more.isEmpty():
            break
        reached.append(more)
        step *= 4
        if step < max_steps:
            jump = settle(_compose(twice, group))
    return reduce(DataFrame.unionAll, reached)


def _advance(reached: DataFrame, jump: DataFrame, group: list[str], step: int) -> DataFrame:
    return reached.join(jump, [*group, "key"]).select(
        *group, F.col("next").alias("key"), (F.col("depth") + step).alias("depth")
    )


def _compose(jump: DataFrame, group: list[str]) -> DataFrame:
    """Jumps of twice the distance; those that run past the end fall away."""
    onward = jump.select(*group, F.col("key").alias("next"), F.col("next").alias("after"))
    return jump.join(onward, [*group, "next"]).select(
        *group, "key", F.col("after").alias("next")
    )
