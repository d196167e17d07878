"""Positions of the pages of long chains by contraction, with work in proportion to the pages.

A chain landed in no order is a linked list spread over the cluster. Each round takes out pages that
are local minima of a hash of their numbers: no two of them are neighbours, a third of all on average,
and each page knows from its own row (its number and its neighbours') whether it goes, so nothing
is asked of other rows. Parts that no start leads to shrink alike, until nothing is left of them. A page taken out leaves its distance with the page behind it. What stays are
the splitters of the list; when a chain has few enough of them, one task walks them, and the pages
taken out get their positions back in reverse, each from the page that was before it.

Rounds handle n, 2n/3, 4n/9, ... rows: about three times the pages in all rounds together, where
doubling pointers moves all pages in each. Chains of any number advance together.

Pages get numbers first, so keys are shuffled once on the way in and read once on the way out; rounds
move a few numbers a page. Places found are appended, never written again.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pageloom.runtime import landed

#: Splitters of one chain that a task walks: numbers only, a few MB.
WALKED = 100_000
#: What a round sends: a page that stays, or what one that goes tells its neighbours.
SENT = {c: "boolean" if c in ("first", "_ahead", "_behind") else "long" for c in
        ("id", "chain", "next", "prev", "first", "back", "_next", "_prev", "_back", "_ahead", "_behind")}


def are_lists(edges: DataFrame, starts: DataFrame, group: list[str]) -> bool:
    """Whether no page is named twice as the next one, the starts included: then what follows a
    start is a list, with no way back into it."""
    named = edges.where(F.col("next").isNotNull()).select(*group, F.col("next").alias("key"))
    named = named.unionByName(starts.select(*group, "key"))
    return named.groupBy(*group, "key").count().where("count > 1").isEmpty()


def rank_lists(edges: DataFrame, starts: DataFrame, group: list[str], walked: int | None = None) -> DataFrame:
    """``group``, ``key``, ``depth`` of every page that a start leads to.

    ``edges`` has ``group``, ``key`` (once, else an error) and ``next`` (null at the end); ``starts``
    has ``group`` and ``key``; together they are lists (:func:`are_lists`). Pages no start leads to are
    left out.
    """
    at, limit = [*group, "key"], walked or WALKED
    pages = landed(edges.select(*at, "next", F.monotonically_increasing_id().alias("id")), "pages")
    now = _numbered(pages, starts, group)
    taken: list[DataFrame] = []
    while True:
        mine, left, right = (F.when(F.col(c).isNotNull(), F.xxhash64(F.lit(len(taken)), F.col(c))) for c in ("id", "prev", "next"))
        least = F.coalesce(mine < left, F.col("prev").isNull()) & F.coalesce(mine < right, F.col("next").isNull())
        left_alone = F.coalesce(F.col("next") == F.col("id"), F.lit(False))  # all that is left of a ring
        goes = ~F.col("first") & (least | left_alone)
        state = landed(now.withColumn("goes", goes), "chain")
        longest = state.groupBy("chain").count().agg(F.max("count")).first()[0]
        if not longest or longest <= limit:
            places = [_walk(state)]
            break
        prev, following, yes = F.col("prev"), F.col("next"), F.lit(True)
        ahead = _sent(id=prev, _next=following, _ahead=yes)
        behind = _sent(id=following, _prev=prev, _back=F.col("back"), _behind=yes)
        stays = _sent(**{c: F.col(c) for c in ("id", "chain", "next", "prev", "first", "back")})
        sent = state.select(F.inline(F.when(F.col("goes"), F.array(ahead, behind)).otherwise(F.array(stays))))
        # neighbours of a page that goes stay, so a page is told once on each side; ends of the
        # list have no row
        merged = sent.where("id IS NOT NULL").groupBy("id").agg(*[F.max(c).alias(c) for c in SENT if c != "id"])
        now = merged.where("first IS NOT NULL").select(
            "id",
            "chain",
            F.when(F.col("_ahead"), F.col("_next")).otherwise(F.col("next")).alias("next"),
            F.when(F.col("_behind"), F.col("_prev")).otherwise(F.col("prev")).alias("prev"),
            "first",
            (F.col("back") + F.coalesce("_back", F.lit(0))).alias("back"),
        )
        taken.append(state.where("goes").select("prev", "id", "back"))
    for gone in reversed(taken):
        before = _union(places).withColumnRenamed("id", "prev")
        found = gone.join(before, "prev").select("id", (F.col("depth") + F.col("back")).alias("depth"))
        places.append(landed(found, "ranks"))
    return pages.join(_union(places), "id").select(*at, "depth")


def _numbered(pages: DataFrame, starts: DataFrame, group: list[str]) -> DataFrame:
    """The lists as numbers: ``id``, its neighbours' numbers, ``chain``, ``first`` and ``back``."""
    at = [*group, "key"]
    to = pages.where(F.col("next").isNotNull()).select(*group, F.col("next").alias("key"), F.col("id").alias("prev"))
    first = starts.select(*at, F.lit(True).alias("first"))
    # one shuffle brings a page, what names it and its start together
    gathered = _union([pages.select(*at, "id"), to, first]).groupBy(*at)
    met = gathered.agg(F.count("id").alias("n"), *[F.max(c).alias(c) for c in ("id", "prev", "first")])
    twice = F.raise_error(F.concat(F.lit("request landed more than once: "), F.col("key")))
    # a page that was never landed ends the list before it, and a start has nothing before it.
    # Chains whose hashes are equal are walked by one task, nothing else
    met = met.where("n > 0").select(
        F.when(F.col("n") == 1, F.col("id")).otherwise(twice).alias("id"),
        F.xxhash64(*group).alias("chain"),
        F.when(F.col("first").isNull(), F.col("prev")).alias("prev"),
        F.coalesce("first", F.lit(False)).alias("first"),
    )
    mine = _sent(**{c: F.col(c) for c in ("id", "chain", "prev", "first")})
    sent = met.select(F.inline(F.array(mine, _sent(id=F.col("prev"), next=F.col("id")))))
    links = sent.where("id IS NOT NULL").groupBy("id").agg(*[F.max(c).alias(c) for c in ("chain", "next", "prev", "first")])
    return links.withColumn("back", F.lit(1).cast("long"))


def _sent(**given: Column) -> Column:
    return F.struct(*[given.get(c, F.lit(None)).cast(kind).alias(c) for c, kind in SENT.items()])


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for df in frames[1:]:
        out = out.unionByName(df, allowMissingColumns=True)
    return out


def _walk(state: DataFrame) -> DataFrame:
    """Positions of the splitters, chain by chain."""

    def walk(table: pa.Table) -> pa.Table:
        ids, after, back = (table.column(c).to_pylist() for c in ("id", "next", "back"))
        place = {k: i for i, k in enumerate(ids)}
        seen, depths = [], []
        for at in (i for i, first in enumerate(table.column("first").to_pylist()) if first):
            depth = 0
            while at is not None:
                seen.append(ids[at])
                depths.append(depth)
                at = place.get(after[at])
                depth += back[at] if at is not None else 0
        return pa.table({"id": pa.array(seen, pa.int64()), "depth": pa.array(depths, pa.int64())})

    chosen = state.select("chain", "id", "next", "first", "back")
    return landed(chosen.groupBy("chain").applyInArrow(walk, "id long, depth long"), "ranks")
