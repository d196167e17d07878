"""Queries for window planning and stop rules."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from pageloom.catalog.landed import string_map, table
from pageloom.catalog.registry import query
from pageloom.operators import windows as W
from pageloom.operators.stops import StopSpec, apply_stops
from pageloom.operators.zones import apply_stops_zoned, land_zoned

SPAN_SQL = """
WITH u AS (SELECT user_id, CAST(min(ts) AS DATE) AS a, CAST(max(ts) AS DATE) AS b
           FROM events GROUP BY user_id),
w AS (SELECT user_id, a, b, CAST(i AS INTEGER) AS window_seq, a + CAST(7 * i AS INTEGER) AS s
      FROM (SELECT *, unnest(range(0, (b - a) // 7 + 1)) AS i FROM u))
"""
CLOSED, HALF_OPEN = "least(s + 6, b)", "least(s + 7, b + 1)"


def spans(spark, sf):
    """The days each user was active on, from first to last."""
    day = F.col("ts").cast("date")
    return (
        table(spark, sf, "events")
        .groupBy("user_id")
        .agg(F.min(day).alias("a"), F.max(day).alias("b"))
    )


def planned(spark, sf, half_open):
    return W.plan_windows(spans(spark, sf), "a", "b", 7, half_open)


@query(
    "windows_closed",
    SPAN_SQL + f"SELECT user_id, window_seq, s AS window_start, {CLOSED} AS window_end FROM w",
)
def windows_closed(spark, sf):
    return planned(spark, sf, False).select("user_id", "window_seq", "window_start", "window_end")


@query(
    "windows_half_open",
    SPAN_SQL + f"SELECT user_id, window_seq, s AS window_start, {HALF_OPEN} AS window_end FROM w",
)
def windows_half_open(spark, sf):
    return planned(spark, sf, True).select("user_id", "window_seq", "window_start", "window_end")


@query(
    "window_params",
    SPAN_SQL + "SELECT user_id, window_seq, strftime(s, '%d.%m.%Y') AS since, "
    f"strftime({CLOSED}, '%d.%m.%Y') AS until, CAST(user_id AS VARCHAR) AS account, "
    "CAST(3 AS INTEGER) AS n FROM w",
)
def window_params(spark, sf):
    """The bounds join the base parameters and replace one of the same name."""
    base = string_map(account=F.col("user_id"), since=F.lit("never"))
    both = planned(spark, sf, False).withColumn(
        "p", W.window_params(base, "since", "until", "%d.%m.%Y")
    )
    return both.select(
        "user_id",
        "window_seq",
        F.col("p")["since"].alias("since"),
        F.col("p")["until"].alias("until"),
        F.col("p")["account"].alias("account"),
        F.size("p").alias("n"),
    )


@query(
    "window_query_template",
    SPAN_SQL + "SELECT user_id, window_seq, 'SELECT Id FROM Event WHERE at >= ' || "
    "strftime(s, '%Y-%m-%dT%H:%M:%SZ') || ' AND at < ' || "
    f"strftime({HALF_OPEN}, '%Y-%m-%dT%H:%M:%SZ') AS q FROM w",
)
def window_query_template(spark, sf):
    text = "SELECT Id FROM Event WHERE {date_field} >= {start} AND {date_field} < {end}"
    q = W.window_query(text, "at")
    return planned(spark, sf, True).select("user_id", "window_seq", q.alias("q"))


ASSIGN_SQL = (
    "SELECT event_id, CASE WHEN CAST(ts AS DATE) BETWEEN DATE '2024-01-03' AND DATE '2024-01-25' "
    "THEN CAST((CAST(ts AS DATE) - DATE '2024-01-03') // {n} AS INTEGER) END AS window_seq "
    "FROM events"
)


def assigned(spark, sf, days):
    at = W.window_of(F.col("ts"), date(2024, 1, 3), date(2024, 1, 25), days)
    return table(spark, sf, "events").select("event_id", at.alias("window_seq"))


@query("window_assign_closed", ASSIGN_SQL.format(n=7))
def window_assign_closed(spark, sf):
    return assigned(spark, sf, 7)


@query("window_assign_half_open", ASSIGN_SQL.format(n=1))
def window_assign_half_open(spark, sf):
    return assigned(spark, sf, 1)


# ---- stop rules ------------------------------------------------------------


def event_rows(spark, sf):
    """Events as records: a pull per user, a page per hour; rare events carry an alarm."""
    hour = F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 3_600_000_000).cast("int")
    return table(spark, sf, "events").select(
        F.col("user_id").cast("string").alias("_pull"),
        F.lit(0).alias("_window_seq"),
        hour.alias("_page_seq"),
        F.col("event_id").alias("_row_seq"),
        "event_id",
        F.when(F.col("value") > 150, F.col("event_type")).alias("alarm"),
    )


ITEM_SQL = """
WITH e AS (SELECT *, datediff('hour', TIMESTAMP '1970-01-01', date_trunc('hour', ts)) AS page
           FROM events),
n AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY page, event_id) AS rn FROM e),
c AS (SELECT user_id, min(rn) AS cut FROM n
      WHERE event_type = 'error' AND value > 150 GROUP BY user_id)
SELECT CAST(n.user_id AS VARCHAR) AS pull, n.event_id FROM n LEFT JOIN c ON n.user_id = c.user_id
WHERE c.cut IS NULL OR n.rn {op} c.cut
"""


def stopped(rows, spec):
    return apply_stops(rows, spec).select(F.col("_pull").alias("pull"), "event_id")


@query("stop_at_item_excl", ITEM_SQL.format(op="<"))
def stop_at_item_excl(spark, sf):
    return stopped(event_rows(spark, sf), StopSpec("alarm", "error"))


@query("stop_at_item_incl", ITEM_SQL.format(op="<="))
def stop_at_item_incl(spark, sf):
    return stopped(event_rows(spark, sf), StopSpec("alarm", "error", inclusive=True))


AGE_SQL = """
WITH e AS (
  SELECT event_id, event_id // 2000 AS pull_no, event_id % 2000 // 50 AS page, event_type, value,
         CASE WHEN value > 400 THEN NULL WHEN value < 0.02 THEN ts - INTERVAL 40 DAY ELSE ts END
           AS seen
  FROM events),
p AS (
  SELECT pull_no, page,
         bool_or(seen IS NULL OR seen < TIMESTAMP '2024-01-01') AND count(seen) > 0 AS old
  FROM e GROUP BY pull_no, page),
c AS (SELECT pull_no, min(page) AS age_page FROM p WHERE old GROUP BY pull_no),
i AS (SELECT pull_no, min(event_id) AS item FROM e
      WHERE event_type = 'signup' AND value > 350 GROUP BY pull_no)
"""


def aging_rows(spark, sf):
    """Times as text; a few are far too old, a few cannot be read."""
    old = F.date_format(F.col("ts") - F.expr("INTERVAL 40 DAYS"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    new = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    seen = (
        F.when(F.col("value") > 400, F.lit("n/a"))
        .when(F.col("value") < 0.02, F.concat(old, F.lit("Z")))
        .otherwise(F.concat(new, F.lit("Z")))
    )
    mark = F.when((F.col("event_type") == "signup") & (F.col("value") > 350), "last")
    return table(spark, sf, "events").select(
        F.expr("event_id div 2000").cast("string").alias("_pull"),
        F.lit(0).alias("_window_seq"),
        F.expr("event_id % 2000 div 50").cast("int").alias("_page_seq"),
        F.col("event_id").alias("_row_seq"),
        "event_id",
        seen.alias("seen"),
        mark.alias("mark"),
    )


@query(
    "stop_older_than",
    AGE_SQL + "SELECT CAST(e.pull_no AS VARCHAR) AS pull, event_id FROM e LEFT JOIN c USING "
    "(pull_no) WHERE age_page IS NULL OR page < age_page OR (page = age_page AND "
    "seen >= TIMESTAMP '2024-01-01')",
)
def stop_older_than(spark, sf):
    spec = StopSpec(older_field="seen", older_value="2024-01-01T00:00:00Z")
    return stopped(aging_rows(spark, sf), spec)


@query(
    "stop_combined",
    AGE_SQL + "SELECT CAST(e.pull_no AS VARCHAR) AS pull, event_id FROM e LEFT JOIN c USING "
    "(pull_no) LEFT JOIN i USING (pull_no) WHERE CASE WHEN item IS NOT NULL AND (age_page IS NULL "
    "OR item % 2000 // 50 <= age_page) THEN event_id < item WHEN age_page IS NULL THEN true "
    "ELSE page < age_page OR (page = age_page AND coalesce(seen >= TIMESTAMP '2024-01-01', "
    "false)) END",
)
def stop_combined(spark, sf):
    spec = StopSpec("mark", "last", older_field="seen", older_value="2024-01-01T00:00:00Z")
    return stopped(aging_rows(spark, sf), spec)


@query(
    "stop_zone_pruned",
    AGE_SQL + "SELECT CAST(e.pull_no AS VARCHAR) AS pull, event_id FROM e LEFT JOIN c USING "
    "(pull_no) LEFT JOIN i USING (pull_no) WHERE CASE WHEN item IS NOT NULL AND (age_page IS NULL "
    "OR item % 2000 // 50 <= age_page) THEN event_id < item WHEN age_page IS NULL THEN true "
    "ELSE page < age_page OR (page = age_page AND coalesce(seen >= TIMESTAMP '2024-01-01', "
    "false)) END",
)
def stop_zone_pruned(spark, sf):
    """Both rules over landed records: the zones of their files tell which files are read."""
    spec = StopSpec("mark", "last", older_field="seen", older_value="2024-01-01T00:00:00Z")
    zoned = land_zoned(aging_rows(spark, sf), ["mark", "seen"], files=40)
    return apply_stops_zoned(zoned, spec).select(F.col("_pull").alias("pull"), "event_id")
