"""Dense row numbers over a total order without putting all rows in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pageloom.runtime import quoted, settle

_POSITION_BITS = 33  # layout of monotonically_increasing_id


def sequence_rows(df: DataFrame, order: list[str], name: str = "_seq") -> DataFrame:
    """Add a 0-based dense index in the order of ``order`` (which must be unique).

    Rows are range-partitioned and sorted, and each row's partition and position
    are written out with it, so the numbering cannot change on a retry. The
    per-partition offsets are one row per partition and are broadcast.
    """
    cols = [F.col(quoted(c)) for c in order]
    placed = settle(
        df.repartitionByRange(*cols)
        .sortWithinPartitions(*cols)
        .withColumn("_place", F.monotonically_increasing_id())
    )
    part = F.shiftright("_place", _POSITION_BITS).cast("int")
    inside = F.col("_place").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))
    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset")
    )
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_offset") + inside)
        .drop("_part", "_offset", "_place")
    )


def freeze_ids(df: DataFrame, name: str = "_row_seq") -> DataFrame:
    """Give every row a unique (not dense) number, written out with the row."""
    kept = [F.col(quoted(c)) for c in df.columns if c != name]
    return settle(df.select(*kept, F.monotonically_increasing_id().alias(name)))
