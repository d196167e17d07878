"""Mixing sources to target weights over a multivariate-hypergeometric splitting tree.

Rows of a source are dealt into blocks by hash. A source's draws are its blocks in a permuted
order, pass after pass, up to its target; how many draws that are is its exact quota. A tree
then splits the quotas among output shards: a node that stands for several shards deals its
blocks to its two halves as a hand from an urn (multivariate hypergeometric, seeded by the
node), down to single shards. A shard thus owns a range of each source's draws, ranges are
disjoint, and rows are shuffled only within their shard.

Only the block in which a target is reached is cut: rows in hash order are taken whole until it
is met, the row there in part.

Targets: sources by code point (null last) weigh ``weights`` in turn and share ``share`` times
all sizes; none gets more than ``cap`` times its own, the excess is shared again by weight.

Defined results: null and empty texts have size 0 and take nothing; rows of a null source are a
source of their own; repeated rows and ids are rows like any other and share a block; extra
columns are carried along by ``draw`` unless they begin with ``_mix_``.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pageloom.catalog.registry import query
from pageloom.llm.common import WORD, bounded, land, table
from pageloom.operators.sequence import sequence_rows

BLOCK_ROWS = 64
#: Draws that are summed up in one group on the way to running sums.
CHUNK = 256
SHARD_WORDS = 4_000_000
#: Levels of the splitting tree that one task goes down at a time.
LEVELS = 6


@dataclass
class Mix:
    #: rows with _mix_size, _mix_h, _mix_rank, _mix_block and their source's columns
    rows: DataFrame
    #: (_mix_rank, _mix_block) -> _mix_draws: pass, shard, cut and rest of each draw
    blocks: DataFrame
    shards: int


def words(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def targets(sources: DataFrame, weights: tuple[int, ...], share: float, cap: float) -> DataFrame:
    """(source, n, words) with rank, weight and target; one aggregate of the sources a round."""
    ranked = sequence_rows(sources.withColumn("_none", F.isnull("source")), ["_none", "source"], "rank").drop("_none")
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int"))
    ranked = land(ranked.withColumn("weight", weight.cast("double")).withColumn("most", cap * F.col("words")), "sources")
    whole = share * (ranked.agg(F.sum("words")).first()[0] or 0)
    level, above = 0.0, None
    while True:
        over = F.col("most") < F.lit(level) * F.col("weight")
        full, free, n = ranked.agg(F.coalesce(F.sum(F.when(over, F.col("most"))), F.lit(0.0)), F.coalesce(F.sum(F.when(~over, F.col("weight"))), F.lit(0.0)), F.count(F.when(over, 1))).first()
        if n == above or not free:
            break
        level, above = max(0.0, whole - full) / free, n
    return ranked.withColumn("target", F.least(F.col("most"), F.lit(level) * F.col("weight")))


def draws(blocks: DataFrame) -> DataFrame:
    """Adds to every (rank, block) and pass its place ``d`` in the order of draws."""
    spread = blocks.withColumn("turn", F.explode(F.array(F.lit(0), F.lit(1))))
    for i in (1, 2):
        odd = F.pmod(F.xxhash64("rank", "turn", F.lit(i)), F.lit(1 << 30)) * 2 + 1
        put = F.pmod(F.xxhash64("rank", "turn", F.lit(i + 2)), F.col("n_blocks"))
        moved = (F.col("block") if i == 1 else F.col("x")) * odd + put
        spread = spread.withColumn("x", moved.bitwiseAND(F.col("n_blocks") - 1))
        if i == 1:  # fold high bits into low ones; can be undone, so it stays a permutation
            spread = spread.withColumn("x", F.expr("x ^ shiftright(x, cast((bit_count(n_blocks - 1) + 1) div 2 AS int))"))
    return spread.withColumn("d", F.col("turn") * F.col("n_blocks") + F.col("x")).drop("x")


def running(df: DataFrame) -> DataFrame:
    """Adds ``before``: words of the earlier draws of the source. Chunks first, then within one."""
    df = land(df.withColumn("chunk", F.expr(f"d div {CHUNK}")), "draws")
    by = Window.partitionBy("rank").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    chunks = df.groupBy("rank", "chunk").agg(F.sum("words").alias("of")).select("rank", "chunk", F.coalesce(F.sum("of").over(by), F.lit(0)).alias("earlier"))
    within = Window.partitionBy("rank", "chunk").orderBy("d").rowsBetween(Window.unboundedPreceding, -1)
    df = df.withColumn("inside", F.coalesce(F.sum("words").over(within), F.lit(0)))
    return df.join(bounded(land(chunks, "chunks")), ["rank", "chunk"]).withColumn("before", F.col("earlier") + F.col("inside")).drop("earlier", "inside", "chunk")


def split_quotas(quotas: DataFrame, shards: int, seed: int) -> DataFrame:
    """(shard, rank, first, quota): the range of each source's draws that a shard owns."""

    def down(nodes: pd.DataFrame) -> pd.DataFrame:
        nodes = nodes.sort_values("rank")
        ranks = nodes["rank"].to_numpy()
        stack = [(int(nodes["low"].iloc[0]), int(nodes["high"].iloc[0]), nodes["quota"].to_numpy(), nodes["first"].to_numpy(), 0)]
        out = []
        while stack:
            low, high, quota, first, level = stack.pop()
            if high - low == 1 or level == LEVELS:
                has = quota > 0
                out.append(pd.DataFrame({"low": low, "high": high, "rank": ranks[has], "first": first[has], "quota": quota[has]}))
                continue
            mid = (low + high) // 2
            hand = int(round(int(quota.sum()) * (mid - low) / (high - low)))
            rng = np.random.default_rng([seed, low, high])
            left = rng.multivariate_hypergeometric(quota, hand, method="marginals") if quota.sum() else quota
            stack += [(low, mid, left, first, level + 1), (mid, high, quota - left, first + left, level + 1)]
        return pd.concat(out)

    nodes = quotas.select(F.lit(0).cast("long").alias("low"), F.lit(shards).cast("long").alias("high"), "rank", F.lit(0).cast("long").alias("first"), "quota")
    width = shards
    while width > 1:
        nodes = land(nodes.groupBy("low", "high").applyInPandas(down, "low long, high long, rank long, first long, quota long"), "tree")
        width = -(-width // 2**LEVELS)
    return nodes.select(F.col("low").alias("shard"), "rank", "first", "quota")


def mix(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
    weights: tuple[int, ...] = (3, 1, 2),
    share: float = 1.5,
    cap: float = 2.0,
    seed: int = 11,
    shard_words: int = SHARD_WORDS,
) -> Mix:
    """Plan a mix: which blocks are drawn, where targets cut them, and which shard owns a draw."""
    if not 0 < cap <= 2:
        raise ValueError("two passes can give a row twice at most")
    hashed = F.xxhash64(F.col(id_col), F.xxhash64(F.col(text_col)), F.lit(seed)).alias("h")
    sized = land(docs.select(F.col(source_col).alias("source"), hashed, words(text_col).alias("size")), "sizes")
    found = sized.groupBy("source").agg(F.count("*").alias("n"), F.sum("size").alias("words"))
    pow2 = F.expr(f"cast(power(2, ceil(log2(greatest(1, n / {BLOCK_ROWS})))) AS bigint)")
    sources = land(targets(found, weights, share, cap).withColumn("n_blocks", pow2), "targets")
    placed = sized.join(bounded(sources), sized.source.eqNullSafe(sources.source)).select("rank", "n_blocks", (F.col("h").bitwiseAND(F.col("n_blocks") - 1)).alias("block"), "h", "size")
    blocks = land(placed.groupBy("rank", "n_blocks", "block").agg(F.sum("size").alias("words")), "blocks")
    drawn = running(draws(blocks)).join(bounded(sources.select("rank", F.floor("target").alias("goal"))), "rank").withColumn("rest", F.col("goal") - F.col("before"))
    drawn = land(drawn.where("rest > 0"), "drawn")
    # where a target falls inside a block: rows in hash order, equal hashes together
    cut = drawn.where("rest < words").select("rank", "block", "turn", "rest")
    inside = placed.drop("n_blocks").join(bounded(land(cut, "cuts")), ["rank", "block"]).groupBy("rank", "block", "turn", "rest", "h").agg(F.count("*").alias("m"), F.sum("size").alias("of"))
    upto = Window.partitionBy("rank", "block", "turn").orderBy("h").rowsBetween(Window.unboundedPreceding, -1)
    inside = inside.withColumn("left", F.col("rest") - F.coalesce(F.sum("of").over(upto), F.lit(0)))
    cuts = inside.where("left >= 0 AND left < of").select("rank", "block", "turn", F.col("h").alias("cut"), F.expr("left div m").alias("part"))
    quotas = drawn.groupBy("rank").agg((F.max("d") + 1).alias("quota"))
    total = drawn.agg(F.sum(F.least("words", "rest"))).first()[0] or 0
    shards = max(1, -(-int(total) // shard_words))
    owned = split_quotas(quotas, shards, seed).select("shard", "rank", F.explode(F.expr("sequence(first, first + quota - 1)")).alias("d"))
    dealt = drawn.join(owned, ["rank", "d"]).join(bounded(land(cuts, "cut")), ["rank", "block", "turn"], "left")
    each = F.struct("turn", "shard", "cut", "part").alias("draw")
    dealt = land(dealt.select("rank", "block", each).groupBy(F.col("rank").alias("_mix_rank"), F.col("block").alias("_mix_block")).agg(F.array_sort(F.collect_list("draw")).alias("_mix_draws")), "dealt")
    rows = docs.withColumns({"_mix_size": words(text_col), "_mix_h": hashed})
    named = sources.select(F.col("source").alias("_mix_source"), F.col("rank").alias("_mix_rank"), F.col("words").alias("_mix_source_size"), F.col("target").alias("_mix_target"), "n_blocks")
    rows = rows.join(bounded(land(named, "named")), F.col(f"`{source_col}`").eqNullSafe(F.col("_mix_source")))
    rows = rows.withColumn("_mix_block", F.col("_mix_h").bitwiseAND(F.col("n_blocks") - 1)).drop("_mix_source", "n_blocks")
    return Mix(rows, dealt, shards)


#: Words that a draw takes of a row: all before the cut, ``part`` at it, none behind it.
TAKE = "CASE WHEN p.cut IS NULL OR _mix_h < p.cut THEN _mix_size WHEN _mix_h = p.cut THEN least(_mix_size, p.part) ELSE 0L END"


def taken(plan: Mix) -> DataFrame:
    """Every row with ``_mix_taken``, the words the mix takes of it, repeats counted."""
    rows = plan.rows.join(bounded(plan.blocks), ["_mix_rank", "_mix_block"], "left")
    return rows.withColumn("_mix_taken", F.expr(f"coalesce(aggregate(_mix_draws, 0L, (a, p) -> a + {TAKE}), 0L)")).drop("_mix_draws")


def draw(plan: Mix, text_col: str = "text") -> DataFrame:
    """The mix itself: a row for each draw of a row, its text cut to the words taken, grouped by
    shard (``_mix_shard``) and shuffled within it. Rows of which a draw takes nothing are left
    out unless they have no words and the draw is of a whole block."""
    columns = [c for c in plan.rows.columns if not c.startswith("_mix_")]
    rows = plan.rows.join(bounded(plan.blocks), ["_mix_rank", "_mix_block"]).withColumn("p", F.explode("_mix_draws"))
    rows = rows.withColumn("_mix_take", F.expr(TAKE)).where("_mix_take > 0 OR (_mix_size = 0 AND p.cut IS NULL)")
    # the first words of a text, with the white space before each
    first = F.expr(f"regexp_extract(`{text_col}`, concat('^(?:[\\\\x20\\\\x09-\\\\x0D]*+[^\\\\x20\\\\x09-\\\\x0D]++){{0,', _mix_take, '}}+'), 0)")
    rows = rows.withColumn(text_col, F.when(F.col("_mix_take") < F.col("_mix_size"), first).otherwise(F.col(f"`{text_col}`")))
    rows = rows.select(*(F.col(f"`{c}`") for c in columns), F.col("p.shard").alias("_mix_shard"), F.xxhash64("_mix_h", "p.turn", F.lit(3)).alias("_mix_order"))
    # a task for each shard: by hash, some tasks would get several
    dealt = rows.repartitionById(plan.shards, F.col("_mix_shard").cast("int"))
    return dealt.sortWithinPartitions("_mix_order").drop("_mix_order")


@query("op5_mixing")
def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return taken(mix(docs)).select(
        "doc_id", F.col("_mix_size").alias("size"), F.col("_mix_source_size").alias("source_size"), F.col("_mix_target").alias("target"), F.col("_mix_taken").alias("taken")
    )
