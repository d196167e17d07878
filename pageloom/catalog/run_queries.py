"""Queries for unions, sinks and whole runs."""

from __future__ import annotations

import hashlib
import json
from dataclasses import dataclass
from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F

from pageloom.catalog.join_queries import SPLIT_PULLS, SPLIT_SQL, split_bodies
from pageloom.catalog.landed import (
    API,
    order_item,
    responses,
    table,
    unless,
)
from pageloom.catalog.paging_queries import (
    ITEM,
    SPEC,
    blanked_pages,
    body_of,
    order_rows,
    order_sql,
)
from pageloom.catalog.registry import query
from pageloom.operators import paging
from pageloom.operators.joins import JoinSpec
from pageloom.operators.parse import ParseSpec, parse
from pageloom.operators.sequence import sequence_rows
from pageloom.operators.skew import attach
from pageloom.operators.windows import window_of, window_query
from pageloom.plans.frames import joined_records
from pageloom.plans.run import Ingest
from pageloom.runtime import scratch_path
from pageloom.sinks.manifest import manifest_frame
from pageloom.sinks.snapshots import SnapshotLog
from pageloom.sinks.writers import SinkSpec, path_values, write_frame
from pageloom.sources.transports import WRITE_OPTIONS, RecordedFetch, RecordedRequests, Response

# ---- unions over windows ----------------------------------------------------

EVENT_ITEM = "array<struct<event_id:bigint,user_id:bigint,kind:string,at:string>>"
EVENT_SPEC = ParseSpec(
    record_path="records", schema=f"struct<records:{EVENT_ITEM}>", drop_keys=("attributes",)
)
EVENT_SQL = """
WITH r AS (SELECT CAST(min(ts) AS DATE) AS d0 FROM events),
e AS (
  SELECT event_id, user_id, event_type AS kind, event_id // 2000 AS shard,
         event_id % 2000 // 100 AS page, CAST((CAST(ts AS DATE) - d0) // {days} AS BIGINT)
         AS window_seq, d0 FROM events, r)
"""


def day_span(df, column):
    """First and last day of a time column: the range a backfill is asked for."""
    day = F.col(column).cast("date")
    return tuple(df.agg(F.min(day), F.max(day)).first())


def event_groups(spark, sf, days):
    """Events in windows of some days; a window's pages hold at most 100 ids each.

    A pull is a shard of 2000 ids, so that windows keep a bounded size however
    many events a day has.
    """
    item = F.struct(
        "event_id",
        "user_id",
        F.col("event_type").alias("kind"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("at"),
    )
    events = table(spark, sf, "events")
    first, last = day_span(events, "ts")
    return (
        events.select(
            F.expr("event_id div 2000").alias("shard"),
            window_of(F.col("ts"), first, last, days).alias("w"),
            F.expr("event_id % 2000 div 100").cast("int").alias("page"),
            item.alias("item"),
        )
        .groupBy("shard", "w", "page")
        .agg(F.array_sort(F.collect_list("item")).alias("items"))
    )


def event_rows(records, *more):
    return records.select(
        F.col("_pull").alias("pull"),
        F.col("_window_seq").alias("window_seq"),
        "event_id",
        "user_id",
        "kind",
        *more,
    )


EVENT_COLS = "SELECT CAST(shard AS VARCHAR) AS pull, window_seq, event_id, user_id, kind FROM e"


def records_body(items):
    return F.to_json(F.struct(items.alias("records")))


@query("union_windows", EVENT_SQL.format(days=1) + EVENT_COLS)
def union_windows(spark, sf):
    """All windows are one frame from the start; no list of frames is built."""
    landed = responses(
        event_groups(spark, sf, 1),
        pull=F.col("shard"),
        window_seq=F.col("w"),
        page_seq=F.col("page"),
        body=records_body(F.col("items")),
    )
    return event_rows(parse(landed, EVENT_SPEC))


@query("union_empty", order_sql("false"))
def union_empty(spark, sf):
    """Every first page is blank: no rows, but the columns of the pull."""
    landed = blanked_pages(spark, sf, F.col("page") == 0)
    return order_rows(parse(paging.until_empty(landed, SPEC), SPEC))


# ---- whole runs ---------------------------------------------------------------


def recorded_orders(spark, sf, per_page=5000):
    """Record orders as one endpoint: page numbers from 1, ``per_page`` keys each."""
    root = scratch_path(spark, "recorded")
    orders = table(spark, sf, "orders").select(
        F.expr(f"o_orderkey div {per_page} + 1").cast("int").alias("page"),
        order_item().alias("item"),
    )
    # By ranges of pages, so that a request finds its page in one small row group.
    pages = orders.repartitionByRange("page").groupBy("page").agg(F.array_sort(F.collect_list("item")).alias("items"))
    recorded = pages.sortWithinPartitions("page").select(
        F.lit(0).alias("key"),
        "page",
        F.lit(200).alias("status"),
        F.lit(None).cast("string").alias("link"),
        body_of(F.col("items")).alias("body"),
    )
    recorded.write.options(**WRITE_OPTIONS).partitionBy("key").parquet(root)
    return root


def order_config(out, **more):
    return {
        "envs": {"qa": {"base_url": API}},
        "apis": {
            "request_defaults": {"params": {"window": 0}},
            "output": {"format": "parquet", "path": out, "prefix": "{env}/{table}"},
            "orders": {
                "path": "v1/orders",
                "parse": {
                    "type": "json",
                    "json_record_path": "data.items",
                    "schema": f"struct<data:struct<items:{ITEM}>>",
                },
                "pagination": {"mode": "page", "stripes": 8},
                **more,
            },
        },
    }


@query(
    "run_once_single",
    "SELECT o_orderkey AS id, o_custkey AS cust, o_orderstatus AS status, o_totalprice AS price "
    "FROM orders",
)
def run_once_single(spark, sf):
    """Request the pages (in stripes), land, trim, parse, write; read the result back."""
    config = order_config(scratch_path(spark, "out"))
    job = Ingest(spark, config, RecordedFetch(recorded_orders(spark, sf)))
    return spark.read.parquet(job.run_once("orders", "qa")["path"])


@query(
    "page_gallop",
    "SELECT o_orderkey AS id, o_custkey AS cust, o_orderstatus AS status, o_totalprice AS price FROM orders",
)
def page_gallop(spark, sf):
    """The end of the pull is searched first, by doubling and halving; tasks then read ranges up to it."""
    config = order_config(scratch_path(spark, "out"))
    config["apis"]["orders"]["pagination"]["gallop"] = True
    job = Ingest(spark, config, RecordedFetch(recorded_orders(spark, sf, per_page=250)))
    return spark.read.parquet(job.run_once("orders", "qa")["path"])


@query(
    "run_manifest",
    "SELECT 'orders' AS \"table\", 'qa' AS env, count(*) AS rows, 'parquet' AS format, "
    "'page' AS pagination_mode, false AS truncated, true AS wrote, true AS timed FROM orders",
)
def run_manifest(spark, sf):
    """What a run tells about itself; times and sizes only as far as they are fixed."""
    config = order_config(scratch_path(spark, "out"))
    job = Ingest(spark, config, RecordedFetch(recorded_orders(spark, sf)))
    told = manifest_frame(spark, [job.run_once("orders", "qa")])
    return told.select(
        "table",
        "env",
        "rows",
        "format",
        "pagination_mode",
        "truncated",
        (F.col("bytes") > 0).alias("wrote"),
        (F.col("ended_at") > F.col("started_at")).alias("timed"),
    )


@query("run_once_joined", SPLIT_SQL.format(""))
def run_once_joined(spark, sf):
    """Two pulls, JSON and CSV, joined; every window stands for one run."""
    spec = JoinSpec(["key"], "left", select_from={"money": {"keep": ["bal"]}})
    joined = joined_records(split_bodies(spark, sf), SPLIT_PULLS, spec, per_window=True)
    return joined.select(F.col("_window_seq").alias("window_seq"), "key", "name", "bal")


# ---- backfills, whole: planned, requested, landed, written, read back ------------


def windowed_pages(df, window, order, size, newest_first=False):
    """``w``, ``page``, ``items`` and the window's last page ``hi``: rows (column ``item``) in
    pages of ``size``, counted within their window. A page is the only thing that is gathered."""
    rows = sequence_rows(df.select(window.alias("w"), *order, "item"), ["w", *order], "at")
    ends = rows.groupBy("w").agg(F.min("at").alias("lo"), F.max("at").alias("last"))
    rows = attach(rows, ends, ["w"], order, how="inner")
    page = F.expr(f"(last - at) div {size}" if newest_first else f"(at - lo) div {size}")
    rows = rows.withColumns({"page": page, "hi": F.expr(f"(last - lo) div {size}")})
    packed = F.array_sort(F.collect_list(F.struct("at", "item")))
    packed = F.reverse(packed) if newest_first else packed
    return rows.groupBy("w", "page", "hi").agg(F.transform(packed, lambda r: r["item"]).alias("items"))


def record(spark, df, request, body, buckets=16, missing="[]"):
    """Record bodies under their requests, for ``RecordedRequests``."""
    root = scratch_path(spark, "recorded")
    rows = df.select(
        request.alias("request"), F.lit(200).alias("status"), F.lit(None).cast("string").alias("link"), body.alias("body")
    ).withColumn("bucket", F.crc32("request") % buckets)
    rows = rows.repartition("bucket").sortWithinPartitions("bucket", "request")
    rows.write.options(**WRITE_OPTIONS).partitionBy("bucket").parquet(root)
    return RecordedRequests(root, buckets, missing)


def event_table(spark, sf, days):
    """Events with their window of some days, and the first and last day."""
    item = F.struct(
        "event_id",
        "user_id",
        F.col("event_type").alias("kind"),
        F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z")).alias("at"),
    )
    events = table(spark, sf, "events").withColumn("item", item)
    first, last = day_span(events, "ts")
    return events, window_of(F.col("ts"), first, last, days), first, last


def backfilled(spark, name, options, fetch, first, last):
    """Run a backfill by config and read back what it wrote."""
    out = scratch_path(spark, "out")
    config = {
        "envs": {"qa": {"base_url": API}},
        "apis": {
            "output": {"format": "parquet", "path": out, "prefix": "{env}/{table}"},
            name: {"path": f"v1/{name}", **options, "backfill": {"enabled": True, **options["backfill"]}},
        },
    }
    return spark.read.parquet(Ingest(spark, config, fetch).run_backfill(name, "qa", first, last)["path"])


def window_text(first, last, days, w="w"):
    start = F.date_add(F.lit(first), F.col(w).cast("int") * days)
    end = F.least(F.date_add(start, days - 1), F.lit(last))
    return start, F.concat(F.lit("end_date="), end.cast("string")), F.concat(F.lit("start_date="), start.cast("string"))


EVENT_PARSE = {"json_record_path": "records", "schema": f"struct<records:{EVENT_ITEM}>"}
PAGED_EVENTS = """
WITH r AS (SELECT CAST(min(ts) AS DATE) AS d0 FROM events),
n AS (SELECT event_id, user_id, event_type AS kind, (CAST(ts AS DATE) - d0) // {days} AS w FROM events, r),
e AS (SELECT *, (row_number() OVER (PARTITION BY w ORDER BY event_id) - 1) // 100 AS page FROM n)
SELECT event_id, user_id, kind FROM e
"""


@query("backfill_date", PAGED_EVENTS.format(days=7) + "WHERE NOT (w % 3 = 1 AND page >= 2)")
def backfill_date(spark, sf):
    """7-day windows, each paged until empty; in every third window page 2 is blank."""
    events, window, first, last = event_table(spark, sf, 7)
    pages = windowed_pages(events, window, ["event_id"], 100)
    blank = (F.col("page") == 2) & (F.col("w") % 3 == 1)
    _, end, start = window_text(first, last, 7)
    page = F.concat(F.lit("page="), (F.col("page") + 1).cast("string"))
    request = F.concat(F.lit(f"{API}/v1/events?"), F.concat_ws("&", end, page, start))
    fetch = record(spark, pages, request, records_body(unless(blank, F.col("items"))))
    options = {"parse": EVENT_PARSE, "pagination": {"mode": "page", "stripes": 4}, "backfill": {"window_days": 7}}
    return backfilled(spark, "events", options, fetch, first, last).select("event_id", "user_id", "kind")


@query(
    "backfill_date_joined",
    "SELECT o_orderkey AS id, o_custkey AS cust, CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS price FROM orders",
)
def backfill_date_joined(spark, sf):
    """Two pulls in every 9-day window, joined within the window; the right pull lacks the
    pending orders. A pull of a join is one response, so windows are kept short."""
    orders = table(spark, sf, "orders")
    first, last = day_span(orders, "o_orderdate")
    orders = orders.select(
        window_of(F.col("o_orderdate"), first, last, 9).alias("w"),
        F.struct(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("cust")).alias("core"),
        F.when(
            F.col("o_orderstatus") != "P",
            F.struct(F.col("o_orderkey").alias("ID"), F.col("o_totalprice").alias("price")),
        ).alias("money"),
    )
    both = orders.groupBy("w").agg(*[F.array_sort(F.collect_list(n)).alias(n) for n in ("core", "money")])
    sides = [F.struct(F.lit(n).alias("pull"), F.to_json(F.struct(F.col(n).alias("data"))).alias("b")) for n in ("core", "money")]
    sent = both.select("w", F.explode(F.array(*sides)).alias("s"))
    _, end, start = window_text(first, last, 9)
    request = F.concat(F.lit(f"{API}/v1/"), F.col("s.pull"), F.lit("?"), F.concat_ws("&", end, start))
    row = "struct<data:array<struct<{}>>>"
    pulls = [
        {"name": n, "path": f"v1/{n}", "parse": {"json_record_path": "data", "schema": row.format(s)}}
        for n, s in (("core", "id:bigint,cust:bigint"), ("money", "ID:bigint,price:double"))
    ]
    options = {"multi_pulls": pulls, "join": {"on": ["id"], "case": "ignore"}, "backfill": {"window_days": 9}}
    rows = backfilled(spark, "orders", options, record(spark, sent, request, F.col("s.b")), first, last)
    return rows.select("id", "cust", "price")


@query("backfill_half_open", PAGED_EVENTS.format(days=1))
def backfill_half_open(spark, sf):
    """1-day windows, asked for by query text, each a chain of done-flag pages."""
    events, window, first, last = event_table(spark, sf, 1)
    pages = windowed_pages(events, window, ["event_id"], 100)
    text = "SELECT Id FROM Event WHERE {date_field} >= {start} AND {date_field} < {end}"
    pages = pages.withColumns({"window_start": F.date_add(F.lit(first), F.col("w").cast("int")), "window_end": F.date_add(F.lit(first), F.col("w").cast("int") + 1)})
    at = lambda p: F.concat_ws("-", F.lit("/q/x"), "w", p)
    request = F.when(F.col("page") == 0, F.concat(F.lit(f"{API}/v1/events?q="), window_query(text, "at")))
    request = request.otherwise(F.concat(F.lit(API), at(F.col("page"))))
    body = F.struct(
        (F.col("page") == F.col("hi")).alias("done"),
        F.when(F.col("page") < F.col("hi"), at(F.col("page") + 1)).alias("nextRecordsUrl"),
        F.col("items").alias("records"),
    )
    options = {
        "parse": {**EVENT_PARSE, "json_drop_keys_any_depth": ["attributes"]},
        "pagination": {"mode": "salesforce"},
        "backfill": {"strategy": "soql_window", "window_days": 1, "soql_template": text, "date_field": "at"},
    }
    fetch = record(spark, pages, request, F.to_json(body), missing='{"done":true,"records":[]}')
    rows = backfilled(spark, "events", options, fetch, first, last + timedelta(days=1))
    return rows.select("event_id", "user_id", "kind")


@dataclass(frozen=True)
class EndsAt:
    """Answers as recorded until a day is asked for, as if the run were ended there."""

    fetch: RecordedRequests
    day: str

    def __call__(self, url, params, headers):
        if params["start_date"] >= self.day:
            raise ConnectionError(f"ended before {self.day}")
        return self.fetch(url, params, headers)


@query("backfill_resumed", PAGED_EVENTS.format(days=3).replace("SELECT event_id, user_id, kind FROM e", "SELECT w AS window_seq, event_id, user_id, kind FROM e"))
def backfill_resumed(spark, sf):
    """3-day windows committed two by two; the run is ended halfway and begun anew, and the second
    run asks for what the log does not have."""
    events, window, first, last = event_table(spark, sf, 3)
    pages = windowed_pages(events, window, ["event_id"], 100)
    _, end, start = window_text(first, last, 3)
    page = F.concat(F.lit("page="), (F.col("page") + 1).cast("string"))
    request = F.concat(F.lit(f"{API}/v1/events?"), F.concat_ws("&", end, page, start))
    fetch = record(spark, pages, request, records_body(F.col("items")))
    log = scratch_path(spark, "log")
    backfill = {"enabled": True, "window_days": 3, "log": log, "commit_every": 2}
    options = {"path": "v1/events", "parse": EVENT_PARSE, "pagination": {"mode": "page"}, "backfill": backfill}
    output = {"format": "parquet", "path": scratch_path(spark, "out")}
    config = {"envs": {"qa": {"base_url": API}}, "apis": {"output": output, "events": options}}
    half = first + (last - first) / 2
    try:
        Ingest(spark, config, EndsAt(fetch, str(half))).run_backfill("events", "qa", first, last)
    except Exception as e:  # the end of the first run
        if "ended before" not in str(e):
            raise
    Ingest(spark, config, fetch).run_backfill("events", "qa", first, last)
    rows = SnapshotLog(spark, log).read()
    return rows.select(window_of(F.to_timestamp("at"), first, last, 3).alias("window_seq"), "event_id", "user_id", "kind")


@query(
    "backfill_cursor",
    """
WITH n AS (SELECT event_id, user_id, event_type AS kind, ts, row_number() OVER (ORDER BY event_id DESC) - 1 AS nth FROM events),
e AS (SELECT *, nth // 500 AS page FROM n WHERE nth >= 500),
c AS (SELECT min(page) AS cut FROM e WHERE ts < TIMESTAMP '2024-01-12')
SELECT event_id, user_id, kind FROM e, c
WHERE cut IS NULL OR page < cut OR (page = cut AND ts >= TIMESTAMP '2024-01-12')
""",
)
def backfill_cursor(spark, sf):
    """Newest first, entered at the token of the second page, until events are older than
    the given day. One chain: its requests follow one another, whatever the cluster."""
    events, _, first, last = event_table(spark, sf, 1)
    pages = windowed_pages(events, F.lit(0), ["event_id"], 500, newest_first=True)
    mark = lambda p: F.md5(F.concat(F.lit("t-"), p.cast("string")))
    request = F.concat(F.lit(f"{API}/v1/events?cursor="), mark(F.col("page")))
    following = F.when(F.col("page") < F.col("hi"), mark(F.col("page") + 1)).alias("next")
    body = F.to_json(F.struct(F.col("items").alias("records"), F.struct(following).alias("meta")))
    options = {
        "parse": EVENT_PARSE,
        "pagination": {"mode": "cursor", "next_cursor_path": "meta.next"},
        "backfill": {
            "strategy": "cursor",
            "cursor": {
                "start_value": hashlib.md5(b"t-1").hexdigest(),
                "stop_when_older_than": {"field": "at", "value": "2024-01-12T00:00:00Z"},
            },
        },
    }
    rows = backfilled(spark, "events", options, record(spark, pages, request, body), first, last)
    return rows.select("event_id", "user_id", "kind")


# ---- sinks --------------------------------------------------------------------


def written(spark, df, spec):
    path = spec.path(path_values("t", "qa", datetime(2024, 3, 5, tzinfo=timezone.utc)))
    write_frame(df, spec, path)
    return path


DOC_SQL = "SELECT doc_id, lang, text, n_chars FROM documents"


def docs(spark, sf):
    return table(spark, sf, "documents").select("doc_id", "lang", "text", "n_chars")


@query("sink_csv", DOC_SQL)
def sink_csv(spark, sf):
    """Texts with quotes and line ends survive; read back as written."""
    spec = SinkSpec(scratch_path(spark, "csv"), "csv", sep=";")
    path = written(spark, docs(spark, sf), spec)
    back = spark.read.schema("doc_id bigint, lang string, text string, n_chars bigint")
    return back.csv(path, header=True, sep=";", multiLine=True, escape='"')


@query(
    "sink_csv_gzip",
    "SELECT row_number() OVER (ORDER BY o_orderkey) - 1 AS index, o_orderkey, o_orderstatus, "
    "o_totalprice, o_orderdate FROM orders",
)
def sink_csv_gzip(spark, sf):
    """Compressed, with a row number in front."""
    df = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("_row_seq"),
        "o_orderkey",
        "o_orderstatus",
        "o_totalprice",
        "o_orderdate",
    )
    spec = SinkSpec(scratch_path(spark, "csv"), "csv", compression="gzip", index=True)
    back = spark.read.schema(
        "index bigint, o_orderkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz"
    )
    return back.csv(written(spark, df, spec), header=True)


@query(
    "sink_jsonl",
    "SELECT d.doc_id, lang, text, quality FROM documents d LEFT JOIN labels l "
    "ON d.doc_id = l.doc_id",
)
def sink_jsonl(spark, sf):
    labels = table(spark, sf, "labels").select("doc_id", "quality")
    df = docs(spark, sf).drop("n_chars").join(labels, "doc_id", "left")
    path = written(spark, df, SinkSpec(scratch_path(spark, "jsonl"), "jsonl"))
    return spark.read.schema("doc_id bigint, lang string, text string, quality int").json(path)


@query(
    "sink_parquet",
    "SELECT p_partkey AS key, "
    """'{"brand":"' || p_brand || '","size":' || p_size || '}' AS spec, p_retailprice AS price """
    "FROM part",
)
def sink_parquet(spark, sf):
    """Nested cells become JSON text."""
    df = table(spark, sf, "part").select(
        F.col("p_partkey").alias("key"),
        F.struct(F.col("p_brand").alias("brand"), F.col("p_size").alias("size")).alias("spec"),
        F.col("p_retailprice").alias("price"),
    )
    spec = SinkSpec(scratch_path(spark, "parquet"), "parquet", compression="none")
    return spark.read.parquet(written(spark, df, spec))


@query("write_empty_guard", "SELECT count(*) AS kept, true AS refused FROM orders "
       "WHERE o_totalprice >= 0")
def write_empty_guard(spark, sf):
    """An empty result is refused when ``write_empty`` is off; a filled one passes."""
    orders = table(spark, sf, "orders")
    spec = SinkSpec(scratch_path(spark, "guard"), "parquet", write_empty=False)
    kept = write_frame(orders.where("o_totalprice >= 0"), spec, spec.root + "/filled")
    try:
        write_frame(orders.where("o_totalprice < 0"), spec, spec.root + "/empty")
        refused = False
    except ValueError:
        refused = True
    back = spark.read.parquet(spec.root + "/filled").agg(F.count(F.lit(1)).alias("kept"))
    return back.where(F.col("kept") == kept).select("kept", F.lit(refused).alias("refused"))


class _SegmentFetch(RecordedFetch):
    """Recorded list pages; a page's own URL is answered with its path segments."""

    def __call__(self, url, params, headers):
        if url.startswith(API):
            return super().__call__(url, params, headers)
        items = [{"seg": s} for s in url.split("/")[2:]]
        return Response(body=json.dumps({"items": items}))


@query("flush_only", "SELECT 'web' AS \"table\", CAST(0 AS BIGINT) AS rows, CAST(0 AS BIGINT) "
       "AS bytes, (SELECT sum(len(string_split(url, '/')) - 2) FROM pages)::BIGINT AS flushed, "
       "(SELECT count(DISTINCT coalesce(nullif(regexp_extract(url, '/([5-9][0-9][0-9])', 1), ''), "
       "'none')) FROM pages) AS objects FROM region LIMIT 1")
def flush_only(spark, sf):
    """Links are fetched and written per session; the aggregate is not, so the
    manifest tells of no rows. The objects are read back and counted."""
    root, out = scratch_path(spark, "recorded"), scratch_path(spark, "out")
    listed = table(spark, sf, "pages").select(
        F.expr("page_id div 500 + 1").cast("int").alias("page"), "page_id", "url"
    )
    bodies = listed.groupBy("page").agg(
        F.to_json(
            F.struct(F.array_sort(F.collect_list(F.struct("page_id", "url"))).alias("data"))
        ).alias("body")
    )
    bodies.select(
        F.lit(0).alias("key"),
        "page",
        F.lit(200).alias("status"),
        F.lit(None).cast("string").alias("link"),
        "body",
    ).write.partitionBy("key").parquet(root)
    config = {
        "envs": {"qa": {"base_url": API}},
        "apis": {
            "output": {"format": "parquet", "path": out},
            "web": {
                "path": "v1/web",
                "params": {"window": 0},
                "parse": {"json_record_path": "data"},
                "pagination": {"mode": "page", "stripes": 8},
                "link_expansion": {
                    "enabled": True,
                    "url_fields": ["url"],
                    "json_record_path": "items",
                    "session_id": {"regex": "/([5-9][0-9][0-9])", "group": 1},
                    "flush": {
                        "mode": "per_session",
                        "prefix": "flushed",
                        "filename": "session_{session_id}",
                        "only": True,
                    },
                },
            },
        },
    }
    told = manifest_frame(spark, [Ingest(spark, config, _SegmentFetch(root)).run_once("web", "qa")])
    back = spark.read.schema("seg string, part string").parquet(f"{out}/flushed/parts")
    flushed = back.agg(
        F.count(F.lit(1)).alias("flushed"), F.count_distinct("part").alias("objects")
    ).first()
    counts = [F.lit(flushed[c]).cast("bigint").alias(c) for c in ("flushed", "objects")]
    return told.select("table", "rows", "bytes", *counts)
