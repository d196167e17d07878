"""Queries for page acquisition and page trimming."""

from __future__ import annotations

from pyspark.sql import functions as F

from pageloom.catalog.landed import (
    API,
    ORDER_SQL,
    order_groups,
    order_item,
    responses,
    string_map,
    table,
    token,
    unless,
)
from pageloom.catalog.registry import query
from pageloom.operators import paging
from pageloom.operators.parse import ParseSpec, parse
from pageloom.operators.sequence import sequence_rows
from pageloom.operators.windows import window_list, window_of
from pageloom.runtime import scratch_path, settle
from pageloom.sources.paged import Pull, read_pulls
from pageloom.sources.transports import WRITE_OPTIONS, RecordedFetch

ITEM = "array<struct<id:bigint,cust:bigint,status:string,price:double>>"
BODY = f"struct<data:struct<items:{ITEM}>>"
SPEC = ParseSpec(record_path="data.items", schema=BODY)


def body_of(items, **more):
    return F.to_json(F.struct(F.struct(items.alias("items")).alias("data"), *[
        v.alias(k) for k, v in more.items()
    ]))


def order_rows(records):
    return records.select(
        F.col("_pull").alias("pull"),
        F.col("_page_seq").alias("page_seq"),
        F.col("id").alias("o_orderkey"),
        F.col("cust").alias("o_custkey"),
        F.col("price").alias("o_totalprice"),
    )


def order_sql(where: str, page: str = "page") -> str:
    return ORDER_SQL + (
        f"SELECT CAST(pull_no AS VARCHAR) AS pull, CAST({page} AS BIGINT) AS page_seq, "
        f"o_orderkey, o_custkey, o_totalprice FROM o WHERE {where}"
    )


SOURCE_SQL = """
WITH r AS (SELECT CAST(min(o_orderdate) AS DATE) AS d0 FROM orders),
w AS (
  SELECT CAST((CAST(o_orderdate AS DATE) - d0) // 90 AS BIGINT) AS window_seq,
         CAST(o_orderkey // 5000 AS BIGINT) AS page_seq, o_orderkey, o_custkey, o_totalprice
  FROM orders, r
),
p AS (SELECT DISTINCT window_seq, page_seq FROM w),
n AS (
  SELECT *, row_number() OVER (PARTITION BY window_seq ORDER BY page_seq) - 1 AS nth FROM p
)
SELECT window_seq, page_seq, o_orderkey, o_custkey, o_totalprice
FROM w JOIN n USING (window_seq, page_seq) WHERE page_seq = nth
"""


@query("source_paged", SOURCE_SQL)
def source_paged(spark, sf):
    """Pulls of 90-day windows over recorded pages, one partition per window."""
    orders = table(spark, sf, "orders")
    span = orders.select(
        F.min("o_orderdate").cast("date").alias("a"), F.max("o_orderdate").cast("date").alias("b")
    ).first()
    root = scratch_path(spark, "recorded")
    recorded = (
        orders.select(
            window_of(F.col("o_orderdate"), span["a"], span["b"], 90).alias("key"),
            F.expr("o_orderkey div 5000 + 1").cast("int").alias("page"),
            "o_orderkey",
            order_item().alias("item"),
        )
        .repartitionByRange("key", "page")
        .groupBy("key", "page")
        .agg(F.array_sort(F.collect_list("item")).alias("items"))
        .sortWithinPartitions("key", "page")
        .select(
            "key",
            "page",
            F.lit(200).alias("status"),
            F.lit(None).cast("string").alias("link"),
            F.to_json("items").alias("body"),
        )
    )
    recorded.write.options(**WRITE_OPTIONS).partitionBy("key").parquet(root)
    pulls = [
        Pull("orders", API, {"window": i}, paging={"mode": "page"}, window_seq=i,
             window_start=s, window_end=e)
        for i, s, e in window_list(span["a"], span["b"], 90)
    ]
    landed = settle(read_pulls(spark, pulls, RecordedFetch(root)))
    spec = ParseSpec(schema=ITEM)
    kept = paging.until_empty(landed, spec, max_chains=len(pulls))
    return parse(kept, spec).select(
        F.col("_window_seq").alias("window_seq"),
        F.col("_page_seq").alias("page_seq"),
        F.col("id").alias("o_orderkey"),
        F.col("cust").alias("o_custkey"),
        F.col("price").alias("o_totalprice"),
    )


@query(
    "page_single",
    "SELECT CAST(o_orderkey // 250 AS VARCHAR) AS pull, CAST(0 AS BIGINT) AS page_seq, o_orderkey, o_custkey, "
    "o_totalprice FROM orders WHERE o_orderstatus <> 'P'",
)
def page_single(spark, sf):
    """Each pull lands two pages (settled orders, pending orders); only the first counts."""
    orders = table(spark, sf, "orders").select(
        F.expr("o_orderkey div 250").alias("pull_no"),
        (F.col("o_orderstatus") == "P").cast("int").alias("page"),
        order_item().alias("item"),
    )
    pages = orders.groupBy("pull_no", "page").agg(
        F.array_sort(F.collect_list("item")).alias("items")
    )
    landed = responses(
        pages, pull=F.col("pull_no"), page_seq=F.col("page"), body=body_of(F.col("items"))
    )
    return order_rows(parse(paging.single(landed), SPEC))


def blanked_pages(spark, sf, blank):
    pages = order_groups(spark, sf)
    return responses(
        pages,
        pull=F.col("pull_no"),
        page_seq=F.col("page"),
        body=body_of(unless(blank, F.col("items"))),
    )


@query("page_until_empty", order_sql("page < 12 + pull_no % 7"))
def page_until_empty(spark, sf):
    """One page of each pull is answered blank; it and the pages behind it are dropped."""
    landed = blanked_pages(spark, sf, F.col("page") == 12 + F.col("pull_no") % 7)
    return order_rows(parse(paging.until_empty(landed, SPEC), SPEC))


@query("page_cap", order_sql("page < 18"))
def page_cap(spark, sf):
    landed = blanked_pages(spark, sf, F.lit(False))
    return order_rows(parse(paging.cap(landed, 18), SPEC))


@query(
    "page_assign",
    "SELECT o_orderkey, CAST((n - 1) // 500 AS BIGINT) AS page_seq, "
    "CAST((n - 1) % 500 AS INTEGER) AS row_seq FROM (SELECT o_orderkey, "
    "row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS n FROM orders)",
)
def page_assign(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderdate", "o_orderkey")
    pages = paging.assign_pages(orders, ["o_orderdate", "o_orderkey"], 500)
    return pages.select("o_orderkey", "page_seq", "row_seq")


@query(
    "cursor_follow",
    "SELECT CAST(user_id AS VARCHAR) AS pull, CAST(row_number() OVER (PARTITION BY user_id "
    "ORDER BY ts, event_id) - 1 AS BIGINT) AS page_seq, event_id FROM events",
)
def cursor_follow(spark, sf):
    """One chain per user, one page per event; each body names the token of the next.

    The neighbours in a chain are found by position in a distributed sort, so a
    user with very many events is not gathered anywhere.
    """
    events = table(spark, sf, "events").select("user_id", "ts", "event_id")
    placed = settle(
        sequence_rows(events, ["user_id", "ts", "event_id"], "at").select(
            "at", "user_id", "event_id"
        )
    )
    after = placed.select(
        (F.col("at") - 1).alias("at"), F.col("user_id").alias("nu"), F.col("event_id").alias("ne")
    )
    before = placed.select((F.col("at") + 1).alias("at"), F.col("user_id").alias("pu"))
    linked = placed.join(after, "at", "left").join(before, "at", "left")
    more = F.coalesce(F.col("nu") == F.col("user_id"), F.lit(False))
    first = ~F.coalesce(F.col("pu") == F.col("user_id"), F.lit(False))
    # The four ways a chain can say that nothing follows.
    end = F.element_at(
        F.array(*[F.lit(x) for x in ("null", '""', "0", "false")]),
        (F.col("user_id") % 4 + 1).cast("int"),
    )
    nxt = F.when(more, F.concat(F.lit('"e'), F.col("ne"), F.lit('"'))).otherwise(end)
    landed = responses(
        linked,
        pull=F.col("user_id"),
        page_seq=F.when(first, F.lit(0)).otherwise(F.lit(1)),
        params=string_map(cursor=F.when(~first, F.concat(F.lit("e"), F.col("event_id")))),
        body=F.concat(
            F.lit('{"data":[{"event_id":'), F.col("event_id"), F.lit('}],"meta":{"next":'), nxt,
            F.lit("}}"),
        ),
    )
    walked = paging.follow_cursor(landed, "meta.next")
    spec = ParseSpec(record_path="data", schema="struct<data:array<struct<event_id:bigint>>>")
    return parse(walked, spec).select(
        F.col("_pull").alias("pull"), F.col("_page_seq").alias("page_seq"), "event_id"
    )


@query(
    "cursor_long_chain",
    "SELECT CAST(row_number() OVER (ORDER BY md5(CAST(o_orderkey AS VARCHAR))) - 1 AS BIGINT) AS page_seq, "
    "o_orderkey FROM orders",
)
def cursor_long_chain(spark, sf):
    """One chain through all orders, a page each, in an order of its own and landed in none:
    the pages' positions come from contracting the list, not from walking it."""
    orders = table(spark, sf, "orders").select("o_orderkey", F.md5(F.col("o_orderkey").cast("string")).alias("at"))
    placed = settle(sequence_rows(orders, ["at"], "n").select("n", "o_orderkey"))
    after = placed.select((F.col("n") - 1).alias("n"), F.col("o_orderkey").alias("following"))
    linked = placed.join(after, "n", "left")
    landed = responses(
        linked,
        pull=F.lit("orders"),
        page_seq=F.when(F.col("n") == 0, F.lit(0)).otherwise(F.lit(1)),
        params=string_map(cursor=F.when(F.col("n") > 0, F.concat(F.lit("t"), F.col("o_orderkey")))),
        body=F.to_json(
            F.struct(
                F.array(F.struct("o_orderkey")).alias("data"),
                F.struct(F.concat(F.lit("t"), F.col("following")).alias("next")).alias("meta"),
            )
        ),
    )
    walked = paging.follow_cursor(landed, "meta.next")
    spec = ParseSpec(record_path="data", schema="struct<data:array<struct<o_orderkey:bigint>>>")
    return parse(walked, spec).select(F.col("_page_seq").alias("page_seq"), "o_orderkey")


@query("cursor_seed", order_sql("page >= 3", "page - 3"))
def cursor_seed(spark, sf):
    """Every chain is entered at the token of its fourth page."""
    pages = order_groups(spark, sf)
    here, nxt = token("page", F.col("page")), token("page", F.col("page") + 1)
    landed = responses(
        pages,
        pull=F.col("pull_no"),
        page_seq=F.col("page"),
        params=string_map(cursor=F.when(F.col("page") > 0, here)),
        body=body_of(
            F.col("items"), meta=F.struct(F.when(F.col("page") < 19, nxt).alias("next"))
        ),
    )
    start = pages.select(token("page", F.lit(3)).alias("t")).first()["t"]
    return order_rows(parse(paging.follow_cursor(landed, "meta.next", start=start), SPEC))


@query("link_header_follow", order_sql("page <= 15 + pull_no % 3"))
def link_header_follow(spark, sf):
    """The Link header stops naming a next page before the landed pages run out."""
    pages = order_groups(spark, sf)
    url = lambda p: F.concat(
        F.lit(f"{API}/orders/"), F.col("pull_no"), F.lit("?page="), p
    )
    entry = lambda p, rel: F.concat(
        F.lit("<"), url(p), F.lit(f'>; title="a, b"; rel="{rel}"')
    )
    more = F.col("page") < 15 + F.col("pull_no") % 3
    link = F.concat_ws(
        ", ",
        F.when(F.col("page") > 0, entry(F.col("page") - 1, "prev")),
        F.when(more, entry(F.col("page") + 1, "next")),
    )
    landed = responses(
        pages,
        pull=F.col("pull_no"),
        page_seq=F.col("page"),
        url=url(F.col("page")),
        headers=string_map(link=link),
        body=body_of(F.col("items")),
    )
    return order_rows(parse(paging.follow_headers(landed), SPEC))


@query("done_next_follow", order_sql("page <= 14 + pull_no % 4 AND page <> 5"))
def done_next_follow(spark, sf):
    """Chains end by flag, by a missing flag or by a missing URL; page 5 is blank."""
    pages = order_groups(spark, sf)
    last = F.col("page") == 14 + F.col("pull_no") % 4
    way = F.col("pull_no") % 3
    path = lambda p: F.concat(
        F.lit("/query/"), F.col("pull_no"), F.when(p > 0, F.concat(F.lit("-"), p)).otherwise("")
    )
    landed = responses(
        pages,
        pull=F.col("pull_no"),
        page_seq=F.col("page"),
        url=F.concat(F.lit(API), path(F.col("page"))),
        body=body_of(
            unless(F.col("page") == 5, F.col("items")),
            done=F.when(last & (way == 0), True).when(last & (way == 1), None).otherwise(False),
            nextRecordsUrl=F.when(~(last & (way == 2)), path(F.col("page") + 1)),
        ),
    )
    return order_rows(parse(paging.follow_done(landed, SPEC), SPEC))


@query("chain_field_follow", order_sql("page < 16 + pull_no % 3"))
def chain_field_follow(spark, sf):
    """The token of a page is the last id of the page before; a blank page ends the chain."""
    pages = settle(order_groups(spark, sf))
    before = pages.select(
        "pull_no", (F.col("page") + 1).alias("page"), F.col("last_id").alias("token")
    )
    linked = pages.join(before, ["pull_no", "page"], "left")
    landed = responses(
        linked,
        pull=F.col("pull_no"),
        page_seq=F.col("page"),
        params=string_map(cursor=F.col("token")),
        body=body_of(unless(F.col("page") == 16 + F.col("pull_no") % 3, F.col("items"))),
    )
    walked = paging.follow_field(landed, parse(landed, SPEC), "id")
    return order_rows(parse(walked, SPEC))


@query(
    "status_guard",
    ORDER_SQL
    + "SELECT CAST(pull_no AS VARCHAR) AS pull, CAST(page AS BIGINT) AS page_seq, "
    "CAST(CASE WHEN page % 9 = 4 THEN 429 WHEN page % 9 = 7 THEN 503 ELSE 200 END AS INTEGER) "
    "AS status, page % 9 NOT IN (4, 7) AS kept, o_orderkey AS id, o_totalprice AS price FROM o",
)
def status_guard(spark, sf):
    """Error responses go to a table of their own; the rest pass the guard."""
    pages = order_groups(spark, sf)
    code = F.col("page") % 9
    landed = responses(
        pages,
        pull=F.col("pull_no"),
        page_seq=F.col("page"),
        status=F.when(code == 4, 429).when(code == 7, 503).otherwise(200),
        body=body_of(F.col("items")),
    )
    good, bad = paging.split_status(landed)
    told = [
        side.select(
            "pull",
            "page_seq",
            "status",
            F.lit(kept).alias("kept"),
            F.explode(F.from_json("body", BODY)["data"]["items"]).alias("item"),
        ).select("pull", "page_seq", "status", "kept", "item.id", "item.price")
        for side, kept in ((paging.guard_status(good), True), (bad, False))
    ]
    return told[0].unionAll(told[1])


@query(
    "page_no_cap",
    "SELECT row_number() OVER (ORDER BY o_orderkey) - 1 AS page_seq, o_orderkey, o_custkey, "
    "o_totalprice FROM orders",
)
def page_no_cap(spark, sf):
    """One pull with a page for every order: no cap unless one is set."""
    orders = table(spark, sf, "orders").withColumn("item", order_item())
    pages = paging.assign_pages(orders.select("o_orderkey", "item"), ["o_orderkey"], 1)
    landed = responses(
        pages,
        pull=F.expr("o_orderkey div 1000000000000"),
        page_seq=F.col("page_seq"),
        body=body_of(F.array("item")),
    )
    rows = parse(paging.trim(landed, {"mode": "page"}, SPEC, max_chains=1), SPEC)
    return order_rows(rows).drop("pull")
