"""Date windows: planning, request parameters and row assignment."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pageloom.functions.scalars import format_date, merge_params

DEFAULT_DAYS = 7


def check_days(days: int) -> int:
    if days <= 0:
        raise ValueError("window_days must be positive")
    return days


def plan_windows(
    ranges: DataFrame, start: str, end: str, days: int = DEFAULT_DAYS, half_open: bool = False
) -> DataFrame:
    """One row per window of each ``start..end`` range; none when start > end.

    Closed windows are ``[s, s+days-1]`` cut at ``end``; half-open ones are
    ``[s, s+days)`` cut at ``end + 1``.
    """
    check_days(days)
    steps = F.floor(F.date_diff(F.col(end), F.col(start)) / days).cast("int")
    # sequence() raises on a descending range, so such ranges are dropped first.
    planned = ranges.where(F.col(start) <= F.col(end)).select(
        "*", F.explode(F.sequence(F.lit(0), steps)).alias("window_seq")
    )
    first = F.date_add(F.col(start), F.col("window_seq") * days)
    last = (
        F.least(F.date_add(first, days), F.date_add(F.col(end), 1))
        if half_open
        else F.least(F.date_add(first, days - 1), F.col(end))
    )
    return planned.withColumns({"window_start": first, "window_end": last})


def window_list(
    start: date, end: date, days: int = DEFAULT_DAYS, half_open: bool = False
) -> list[tuple[int, date, date]]:
    """The same plan for one range on the driver, used to lay out source partitions."""
    check_days(days)
    count = (end - start).days // days + 1 if start <= end else 0
    out = []
    for i in range(count):
        s = start + timedelta(days=i * days)
        e = (
            min(s + timedelta(days=days), end + timedelta(days=1))
            if half_open
            else min(s + timedelta(days=days - 1), end)
        )
        out.append((i, s, e))
    return out


def window_params(
    base: Column,
    start_param: str = "start_date",
    end_param: str = "end_date",
    date_format: str = "%Y-%m-%d",
) -> Column:
    """Request parameters of a window: the base map plus its formatted bounds."""
    bounds = F.create_map(
        F.lit(start_param),
        format_date(F.col("window_start"), date_format),
        F.lit(end_param),
        format_date(F.col("window_end"), date_format),
    )
    return merge_params(base, bounds)


def window_query(
    template: str | None, date_field: str, date_format: str = "%Y-%m-%dT%H:%M:%SZ"
) -> Column:
    """Query text of a window from a template with field, start and end."""
    if not template:
        raise ValueError("half-open windows need a query template")
    text = F.lit(template)
    text = F.replace(text, F.lit("{date_field}"), F.lit(date_field))
    text = F.replace(text, F.lit("{start}"), format_date(F.col("window_start"), date_format))
    return F.replace(text, F.lit("{end}"), format_date(F.col("window_end"), date_format))


def window_of(
    ts: Column, start: Column | date, end: Column | date, days: int = DEFAULT_DAYS
) -> Column:
    """Window number of a time, by arithmetic; null outside ``start..end``.

    Closed and half-open plans share their starts, so one formula serves both.
    """
    check_days(days)
    start = start if isinstance(start, Column) else F.lit(start)
    end = end if isinstance(end, Column) else F.lit(end)
    day = ts.cast("date")
    return F.when(
        (day >= start) & (day <= end), F.floor(F.date_diff(day, start) / days).cast("int")
    )
