"""Queries for scalar functions."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from pageloom.catalog.landed import string_map, table
from pageloom.catalog.registry import query
from pageloom.functions import scalars as X


@query(
    "json_dig",
    "SELECT event_id, CASE WHEN event_id % 5 NOT IN (1, 2) THEN "
    "CAST(json_extract_string(props, '$.k') AS BIGINT) END AS k FROM events",
)
def json_dig(spark, sf):
    """A value three levels down; missing and null steps give null."""
    props = F.col("props")
    body = (
        F.when(F.col("event_id") % 5 == 1, F.lit('{"a":{"b":null}}'))
        .when(F.col("event_id") % 5 == 2, F.concat(F.lit('{"a":['), props, F.lit("]}")))
        .otherwise(F.concat(F.lit('{"a":{"b":'), props, F.lit("}}")))
    )
    events = table(spark, sf, "events").select("event_id", body.alias("body"))
    return events.select("event_id", X.dig(F.col("body"), "a.b.k").cast("bigint").alias("k"))


@query(
    "row_path",
    "SELECT page_id, url AS literal, 'n' || page_id AS nested, CAST(NULL AS VARCHAR) AS missing "
    "FROM pages",
)
def row_path(spark, sf):
    """A column with the dotted name itself comes before the nested field."""
    pages = table(spark, sf, "pages")
    link = F.struct(
        F.lit("shadowed").alias("self"),
        F.struct(F.concat(F.lit("n"), F.col("page_id")).alias("href")).alias("alt"),
    )
    df = pages.select("page_id", F.col("url").alias("links.self"), link.alias("links"))
    missing = X.row_path(df, "links.none.href")
    return df.select(
        "page_id",
        X.row_path(df, "links.self").alias("literal"),
        X.row_path(df, "links.alt.href").alias("nested"),
        (F.lit(None) if missing is None else missing).cast("string").alias("missing"),
    )


@query(
    "ts_coerce",
    "SELECT event_id, CASE event_type WHEN 'error' THEN NULL WHEN 'signup' "
    "THEN date_trunc('day', ts) ELSE ts END AS ts_utc FROM events",
)
def ts_coerce(spark, sf):
    """Five spellings of a time: Z, offset, none (UTC), date only, unreadable."""
    iso = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
    plus2 = F.col("ts") + F.expr("INTERVAL 2 HOURS")
    kind = F.col("event_type")
    text = (
        F.when(kind == "view", F.concat(F.date_format("ts", iso), F.lit("Z")))
        .when(kind == "click", F.concat(F.date_format(plus2, iso), F.lit("+02:00")))
        .when(kind == "purchase", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
        .when(kind == "signup", F.date_format("ts", "yyyy-MM-dd"))
        .otherwise(F.concat(F.lit("t+"), F.col("event_id")))
    )
    events = table(spark, sf, "events").select("event_id", text.alias("t"))
    ts = X.coerce_ts(F.col("t"), events.schema["t"].dataType)
    return events.select("event_id", X.utc_ntz(ts).alias("ts_utc"))


@query(
    "path_template",
    "SELECT doc_id, 'out/docs/qa/2024/03/05/' || coalesce(CASE WHEN doc_id % 3 > 0 THEN source "
    "END, 'none') || '_' || doc_id || '.jsonl' AS path FROM documents",
)
def path_template(spark, sf):
    now = datetime(2024, 3, 5, 7, 30)
    docs = table(spark, sf, "documents")
    path = X.render_column(
        "out/{table}/{env}/{today:%Y/%m/%d}/{session_id}_{seq}.jsonl",
        {
            "table": "docs",
            "env": "qa",
            "today": now,
            "session_id": F.when(F.col("doc_id") % 3 > 0, F.col("source")),
            "seq": F.col("doc_id"),
        },
    )
    return docs.select("doc_id", path.alias("path"))


@query(
    "url_resolve",
    "SELECT page_id, CASE page_id % 4 WHEN 0 THEN url WHEN 1 THEN host || '/next/' || page_id "
    "WHEN 2 THEN host || '/next/' || page_id ELSE regexp_extract(url, '^https?:') || "
    "'//cdn.example.com/' || page_id END AS resolved FROM "
    "(SELECT *, regexp_extract(url, '^https?://[^/]+') AS host FROM pages)",
)
def url_resolve(spark, sf):
    way = F.col("page_id") % 4
    ref = (
        F.when(way == 0, F.col("url"))
        .when(way == 1, F.concat(F.lit("/next/"), F.col("page_id")))
        .when(way == 2, F.concat(F.lit("next/"), F.col("page_id")))
        .otherwise(F.concat(F.lit("//cdn.example.com/"), F.col("page_id")))
    )
    pages = table(spark, sf, "pages").select("page_id", "url", ref.alias("ref"))
    return pages.select("page_id", X.resolve_url(F.col("url"), F.col("ref")).alias("resolved"))


@query(
    "link_header_next",
    "SELECT page_id, CASE WHEN page_id % 4 IN (0, 1) THEN url END AS next_url FROM pages",
)
def link_header_next(spark, sf):
    """Next among several entries, unquoted, absent, and only look-alikes."""
    way = F.col("page_id") % 4
    link = F.concat(F.lit("<"), F.col("url"), F.lit(">"))
    head = (
        F.when(
            way == 0,
            F.concat(F.lit('<https://x/1>; title="next, please"; rel="prev", '), link,
                     F.lit('; rel="next"')),
        )
        .when(way == 1, F.concat(link, F.lit("; rel=next, <https://x/9>; rel=last")))
        .when(way == 2, F.concat(link, F.lit('; rel="prev"')))
        .otherwise(F.concat(link, F.lit('; rel="nextish"')))
    )
    pages = table(spark, sf, "pages").select("page_id", string_map(link=head).alias("h"))
    return pages.select("page_id", X.next_link(X.header(F.col("h"), "Link")).alias("next_url"))


@query(
    "stringify_nested",
    "SELECT p_partkey AS key, p_name AS name, "
    """'{"brand":"' || p_brand || '","size":' || p_size || '}' AS spec, """
    """'["' || replace(p_name, ' ', '","') || '"]' AS tags, """
    "CAST(NULL AS VARCHAR) AS gone FROM part",
)
def stringify_nested(spark, sf):
    part = table(spark, sf, "part").select(
        F.col("p_partkey").alias("key"),
        F.col("p_name").alias("name"),
        F.struct(F.col("p_brand").alias("brand"), F.col("p_size").alias("size")).alias("spec"),
        F.split("p_name", " ").alias("tags"),
        F.lit(None).cast("array<int>").alias("gone"),
    )
    return X.stringify_nested(part)


@query(
    "redact_map",
    "SELECT c_custkey, '***REDACTED***' AS auth, '***REDACTED***' AS token, "
    "CAST(c_nationkey AS VARCHAR) AS page, c_name AS client FROM customer",
)
def redact_map(spark, sf):
    customers = table(spark, sf, "customer").select(
        "c_custkey",
        X.redact(
            string_map(Authorization=F.col("c_name"), X_Client=F.col("c_name")), X.SECRET_HEADERS
        ).alias("headers"),
        X.redact(
            string_map(Access_Token=F.col("c_name"), page=F.col("c_nationkey")), X.SECRET_PARAMS
        ).alias("params"),
    )
    return customers.select(
        "c_custkey",
        F.col("headers")["Authorization"].alias("auth"),
        F.col("params")["Access_Token"].alias("token"),
        F.col("params")["page"].alias("page"),
        F.col("headers")["X_Client"].alias("client"),
    )


@query(
    "params_merge",
    "SELECT c_custkey, CAST(3 AS INTEGER) AS n, c_name AS a, CAST(c_nationkey AS VARCHAR) AS b, "
    "c_mktsegment AS c FROM customer",
)
def params_merge(spark, sf):
    """Both maps hold ``b``; the right one wins."""
    both = X.merge_params(
        string_map(a=F.col("c_name"), b=F.col("c_custkey")),
        string_map(b=F.col("c_nationkey"), c=F.col("c_mktsegment")),
    )
    customers = table(spark, sf, "customer").select("c_custkey", both.alias("p"))
    return customers.select(
        "c_custkey",
        F.size("p").alias("n"),
        F.col("p")["a"].alias("a"),
        F.col("p")["b"].alias("b"),
        F.col("p")["c"].alias("c"),
    )


@query(
    "link_predicate",
    "SELECT page_id, kind, kind IN ('plain', 'secure') AS is_link FROM pages, "
    "(VALUES ('plain'), ('secure'), ('upper'), ('ftp'), ('relative'), ('inner')) k(kind)",
)
def link_predicate(spark, sf):
    rest = F.regexp_replace("url", "^https?://", "")
    spelled = {
        "plain": F.concat(F.lit("http://"), rest),
        "secure": F.concat(F.lit("https://"), rest),
        "upper": F.concat(F.lit("HTTP://"), rest),
        "ftp": F.concat(F.lit("ftp://"), rest),
        "relative": F.concat(F.lit("/"), rest),
        "inner": F.concat(F.lit("see http://"), rest),
    }
    kinds = F.array(*[F.struct(F.lit(k).alias("kind"), u.alias("u")) for k, u in spelled.items()])
    pages = table(spark, sf, "pages").select("page_id", F.explode(kinds).alias("k"))
    return pages.select("page_id", "k.kind", X.is_link(F.col("k.u")).alias("is_link"))
