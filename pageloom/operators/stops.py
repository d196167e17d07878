"""Stop rules: where a pull ends, decided by what its rows hold."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pageloom.functions.scalars import coerce_ts
from pageloom.operators.skew import attach
from pageloom.runtime import quoted

CHAIN = ["_pull", "_window_seq"]
ROW = ["_pull", "_window_seq", "_page_seq", "_row_seq"]


@dataclass(frozen=True)
class StopSpec:
    """``item_*``: end at the first row whose field equals the value.
    ``older_*``: end at the first page with a time before the value."""

    item_field: str | None = None
    item_value: Any = None
    inclusive: bool = False
    older_field: str | None = None
    older_value: str | None = None

    def __post_init__(self) -> None:
        if self.older_field and self.older_value:
            datetime.fromisoformat(str(self.older_value))  # a stop time has to be readable

    @classmethod
    def from_options(cls, cursor: dict[str, Any] | None) -> StopSpec:
        cursor = cursor or {}
        item = cursor.get("stop_at_item") or {}
        older = cursor.get("stop_when_older_than") or {}
        return cls(
            item.get("field"),
            item.get("value"),
            bool(item.get("inclusive", False)),
            older.get("field"),
            older.get("value"),
        )

    def item_active(self, df: DataFrame) -> bool:
        return bool(self.item_field and self.item_value and self.item_field in df.columns)

    def older_active(self, df: DataFrame) -> bool:
        return bool(self.older_field and self.older_value and self.older_field in df.columns)


def equals(df: DataFrame, field: str, value: Any) -> Column | None:
    """Equality without a silent cast between text, numbers and flags; None if it never holds."""
    kind = df.schema[field].dataType
    same = (
        isinstance(kind, T.BooleanType)
        if isinstance(value, bool)
        else isinstance(kind, T.NumericType)
        if isinstance(value, (int, float))
        else isinstance(kind, T.StringType)
        if isinstance(value, str)
        else True
    )
    return F.coalesce(F.col(quoted(field)) == F.lit(value), F.lit(False)) if same else None


def apply_stops(records: DataFrame, stop: StopSpec, max_chains: int | None = None) -> DataFrame:
    """Records up to the stop of each chain (pull and window).

    The earliest page wins; on one page the item rule wins and the time rule is
    not applied. The item rule keeps the rows before its match (and the match,
    if inclusive); the time rule keeps every row of its page that is new enough.
    """
    by_item, by_age = stop.item_active(records), stop.older_active(records)
    if not (by_item or by_age):
        return records
    here = F.struct("_page_seq", "_row_seq")
    hit = equals(records, stop.item_field, stop.item_value) if by_item else None
    hit = F.lit(False) if hit is None else hit
    if by_age:
        limit = coerce_ts(F.lit(str(stop.older_value)), T.StringType())
        raw = F.col(quoted(stop.older_field))
        ts = coerce_ts(raw, records.schema[stop.older_field].dataType)
        fresh = F.coalesce(ts >= limit, F.lit(False))
        # Map-side combined per page first: the field must occur on the page.
        pages = records.groupBy(*CHAIN, "_page_seq").agg(
            F.min(F.when(hit, F.col("_row_seq"))).alias("_item_row"),
            (F.bool_or(~fresh) & (F.count(raw) > 0)).alias("_old"),
        )
        cuts = pages.groupBy(*CHAIN).agg(
            F.min(
                F.when(
                    F.col("_item_row").isNotNull(),
                    F.struct("_page_seq", F.col("_item_row").alias("_row_seq")),
                )
            ).alias("_item"),
            F.min(F.when(F.col("_old"), F.col("_page_seq"))).alias("_age_page"),
        )
    else:
        fresh = F.lit(True)
        cuts = records.groupBy(*CHAIN).agg(
            F.min(F.when(hit, here)).alias("_item"), F.lit(None).cast("long").alias("_age_page")
        )
    cuts = cuts.where(F.col("_item").isNotNull() | F.col("_age_page").isNotNull())
    marked = attach(records, cuts, CHAIN, ROW, max_rows=max_chains)
    item_first = F.col("_item").isNotNull() & (
        F.col("_age_page").isNull() | (F.col("_item._page_seq") <= F.col("_age_page"))
    )
    before = here <= F.col("_item") if stop.inclusive else here < F.col("_item")
    keep = (
        F.when(item_first, before)
        .when(F.col("_age_page").isNull(), F.lit(True))
        .otherwise(
            (F.col("_page_seq") < F.col("_age_page"))
            | ((F.col("_page_seq") == F.col("_age_page")) & fresh)
        )
    )
    return marked.where(keep).select(*[F.col(quoted(c)) for c in records.columns])


def reaches_stop(page: DataFrame, stop: StopSpec) -> bool:
    """Whether the records of one page end its chain."""
    tests = []
    if stop.item_active(page):
        hit = equals(page, stop.item_field, stop.item_value)
        tests.append(F.lit(False) if hit is None else F.coalesce(F.bool_or(hit), F.lit(False)))
    if stop.older_active(page):
        limit = coerce_ts(F.lit(str(stop.older_value)), T.StringType())
        raw = F.col(quoted(stop.older_field))
        fresh = F.coalesce(coerce_ts(raw, page.schema[stop.older_field].dataType) >= limit, F.lit(False))
        tests.append(F.coalesce(F.bool_or(~fresh) & (F.count(raw) > 0), F.lit(False)))
    return bool(tests) and any(page.agg(*[t.alias(f"t{i}") for i, t in enumerate(tests)]).first())
