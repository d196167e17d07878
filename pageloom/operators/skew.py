"""Joins that stay whole when one key holds a large share of the rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pageloom.runtime import BROADCAST_ROWS, fits_broadcast, quoted, settle

# A key with more rows than this is spread over several tasks.
HOT_ROWS = 1_000_000


def null_safe(left: DataFrame, right: DataFrame, on: list[str]) -> Column:
    return reduce(
        lambda a, b: a & b, [left[quoted(k)].eqNullSafe(right[quoted(k)]) for k in on]
    )


def attach(
    df: DataFrame,
    facts: DataFrame,
    on: list[str],
    row_id: list[str],
    how: str = "left",
    max_rows: int | None = None,
    settled: bool = False,
) -> DataFrame:
    """Join per-key facts (one row per ``on`` key) onto a large frame.

    ``max_rows`` is a bound known when the plan is made, such as the number of
    planned windows. Without one the facts are written out (unless they already
    are) and measured; they are broadcast when small, else the large side is
    split on its hot keys.
    """
    if max_rows is not None and max_rows <= BROADCAST_ROWS:
        return df.join(F.broadcast(facts), on, how)
    facts = facts if settled else settle(facts)
    if fits_broadcast(facts):
        return df.join(F.broadcast(facts), on, how)
    return split_join(df, facts, on, how, row_id, on, right_bounded=True)


def _counts(df: DataFrame, on: list[str], name: str, hot_rows: int) -> DataFrame:
    keys = [F.col(quoted(k)) for k in on]
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name)).where(F.col(name) > hot_rows)


def hot_keys(
    left: DataFrame, right: DataFrame | None, on: list[str], hot_rows: int
) -> DataFrame | None:
    """Keys above ``hot_rows`` on either side and how many ways to split each side.

    Counting combines map-side, so a hot key costs one row per task. The
    threshold is raised until the list can be broadcast; any threshold gives the
    same join result, so nothing is lost by that.
    """
    hot = _counts(left, on, "_nl", hot_rows)
    if right is None:
        hot = hot.withColumn("_nr", F.lit(1).cast("bigint"))
    else:
        rc = _counts(right, on, "_nr", hot_rows)
        hot = hot.join(rc, null_safe(hot, rc, on), "full").select(
            *[F.coalesce(hot[quoted(k)], rc[quoted(k)]).alias(k) for k in on],
            F.coalesce("_nl", F.lit(1)).alias("_nl"),
            F.coalesce("_nr", F.lit(1)).alias("_nr"),
        )
    hot = settle(hot)
    bar, n = hot_rows, hot.count()
    while n > BROADCAST_ROWS:
        bar *= 4
        hot = hot.where(F.greatest("_nl", "_nr") > bar)
        n = hot.count()
    if n == 0:
        return None
    ways = lambda c: F.ceil(F.col(c) / F.lit(bar)).cast("int")
    return hot.select(
        *[F.col(quoted(k)) for k in on], ways("_nl").alias("_lways"), ways("_nr").alias("_rways")
    )


def _with_ways(df: DataFrame, hot: DataFrame, on: list[str], ways: list[str]) -> DataFrame:
    """Add the split counts of hot keys; other rows get 1."""
    h = hot.select(*[F.col(quoted(k)).alias(f"_h{i}") for i, k in enumerate(on)], *ways)
    match = reduce(
        lambda a, b: a & b, [df[quoted(k)].eqNullSafe(h[f"_h{i}"]) for i, k in enumerate(on)]
    )
    return df.join(F.broadcast(h), match, "left").select(
        *[df[quoted(c)] for c in df.columns],
        *[F.coalesce(h[w], F.lit(1)).alias(w) for w in ways],
    )


def split_join(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    how: str,
    left_id: list[str],
    right_id: list[str],
    hot_rows: int | None = None,
    right_bounded: bool = False,
) -> DataFrame:
    """Equi-join whose hot keys are spread over a grid of salts.

    Nulls match nulls, key columns come out once. For a hot key, left rows are
    cut into ``a`` parts and right rows into ``b`` parts; each part is sent to
    the whole row or column of the ``a x b`` grid, so every pair meets exactly
    once. Rows without a partner are added by anti joins against the distinct
    keys of the other side. ``*_id`` name columns that tell rows apart, so that
    many equal rows still spread. ``right_bounded`` says that the right side has
    few rows per key by construction; it is then neither counted nor cut.
    """
    hot = hot_keys(left, None if right_bounded else right, on, hot_rows or HOT_ROWS)
    if hot is None:
        return joined(left, right, on, how)

    def salted(df: DataFrame, row_id: list[str], mine: str, other: str, ways: str, others: str):
        marked = _with_ways(df, hot, on, [ways, others])
        own = F.pmod(F.xxhash64(*[F.col(quoted(c)) for c in row_id]), F.col(ways))
        return marked.select(
            *[F.col(quoted(c)) for c in df.columns],
            own.cast("int").alias(mine),
            F.explode(F.sequence(F.lit(0), F.col(others) - 1)).alias(other),
        )

    a = salted(left, left_id, "_s", "_t", "_lways", "_rways")
    b = salted(right, right_id, "_t", "_s", "_rways", "_lways")
    grid = [*on, "_s", "_t"]
    if right_bounded and how == "left":
        # Every part of a left key meets all of its right rows: no anti join needed.
        return joined(a, b, grid, "left").drop("_s", "_t")
    parts = [joined(a, b, grid, "inner").drop("_s", "_t")]
    if how in ("left", "full"):
        keys = right.groupBy(*[F.col(quoted(k)) for k in on]).agg(F.lit(1).alias("_one"))
        parts.append(left.join(keys, null_safe(left, keys, on), "left_anti"))
    if how in ("right", "full"):
        keys = left.groupBy(*[F.col(quoted(k)) for k in on]).agg(F.lit(1).alias("_one"))
        parts.append(right.join(keys, null_safe(right, keys, on), "left_anti"))
    return reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), parts)


def spread_by(
    df: DataFrame, on: list[str], row_id: list[str], hot_rows: int | None = None
) -> DataFrame:
    """Rows of a key together in one task, or in several when the key is hot."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hot = hot_keys(df, None, on, hot_rows or HOT_ROWS)
    if hot is None:
        return df.repartition(n, *[F.col(quoted(k)) for k in on])
    marked = _with_ways(df, hot, on, ["_lways"])
    salt = F.pmod(F.xxhash64(*[F.col(quoted(c)) for c in row_id]), F.col("_lways"))
    return marked.repartition(n, *[F.col(quoted(k)) for k in on], salt).drop("_lways")


def joined(left: DataFrame, right: DataFrame, on: list[str], how: str) -> DataFrame:
    pairs = left.join(right, null_safe(left, right, on), how)

    def key(k: str) -> Column:
        if how == "right":
            return right[quoted(k)]
        if how == "full":
            return F.coalesce(left[quoted(k)], right[quoted(k)]).alias(k)
        return left[quoted(k)]

    return pairs.select(
        *[key(c) if c in on else left[quoted(c)] for c in left.columns],
        *[right[quoted(c)] for c in right.columns if c not in on],
    )
