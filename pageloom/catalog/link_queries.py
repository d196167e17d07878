"""Queries for link expansion and session ids."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from pageloom.catalog.landed import responses, table
from pageloom.catalog.registry import query
from pageloom.functions.scalars import session_id
from pageloom.operators import links as L
from pageloom.operators.parse import ParseSpec
from pageloom.runtime import scratch_path
from pageloom.sinks import objects
from pageloom.sinks.writers import SinkSpec, flush_parts, path_values

PAGES_PER_WINDOW = 20
SID = r"/([0-9]+)"
BASE = ParseSpec(record_path="data.items", drop_keys=("attributes",))
SEGMENTS = "struct<items:array<struct<pos:bigint,seg:string>>>"

# The path segments of a URL after the scheme, numbered from 0.
SEG_SQL = """
WITH s AS (
  SELECT page_id, url, i - 1 AS pos, string_split(url, '/')[i + 2] AS seg
  FROM (SELECT *, unnest(range(1, len(string_split(url, '/')) - 1)) AS i FROM pages)
)
"""


def base_rows(spark, sf, url=None):
    """Raw pages as records: a window of 20 ids each, one record per page."""
    pages = table(spark, sf, "pages").select("page_id", "url")
    return pages.select(
        F.lit("pages").alias("_pull"),
        F.expr(f"page_id div {PAGES_PER_WINDOW}").cast("int").alias("_window_seq"),
        F.lit(0).alias("_page_seq"),
        F.col("page_id").alias("_row_seq"),
        "page_id",
        (F.col("url") if url is None else url).alias("url"),
    )


def segments(*extra):
    parts = F.filter(F.split("url", "/"), lambda x, i: i >= 2)
    return F.transform(
        parts, lambda x, i: F.struct(i.cast("bigint").alias("pos"), x.alias("seg"), *extra)
    )


def details(spark, sf, body=None, suffix=""):
    """Landed answers of the page URLs: their path segments, numbered. Pages may share a URL;
    it is answered once."""
    body = F.to_json(F.struct(segments().alias("items"))) if body is None else body
    return responses(
        table(spark, sf, "pages").select("url").distinct(),
        pull=F.lit("link"),
        page_seq=F.lit(0),
        url=F.concat("url", F.lit(suffix)),
        body=body,
    )


def shown(rows, *cols):
    return rows.select(
        F.col("_row_seq").alias("base_row"), F.col("_detail_seq").alias("detail_seq"), *cols
    )


@query(
    "link_collect",
    "SELECT page_id, CAST(CASE WHEN page_id % 3 = 0 THEN 0 ELSE n END AS INTEGER) AS url_idx, "
    "CASE n WHEN 0 THEN url ELSE url || '/self' END AS url FROM pages, (VALUES (0), (1)) v(n) "
    "WHERE n = 1 OR page_id % 3 <> 0",
)
def link_collect(spark, sf):
    """A flat field and a nested one; a third of the flat ones hold no link."""
    records = base_rows(spark, sf).select(
        "_pull",
        "_window_seq",
        "_page_seq",
        "_row_seq",
        F.when(F.col("page_id") % 3 != 0, F.col("url")).otherwise("/local").alias("detail_url"),
        F.struct(F.concat("url", F.lit("/self")).alias("self")).alias("links"),
    )
    links = L.collect_links(records, L.LinkSpec(("detail_url", "links.self", "links.none")))
    return links.select(
        F.col("_row_seq").alias("page_id"), F.col("_url_idx").alias("url_idx"), "url"
    )


@query(
    "link_session_id",
    "SELECT page_id, nullif(regexp_extract(url, '/([5-9][0-9][0-9])', 1), '') AS grouped, "
    "nullif(regexp_extract(url, '/(en|fr)/', 1), '') AS behind, "
    "CAST(NULL AS VARCHAR) AS bad_group FROM pages",
)
def link_session_id(spark, sf):
    url = F.col("url")
    return table(spark, sf, "pages").select(
        "page_id",
        session_id(url, "/([5-9][0-9][0-9])", 1).alias("grouped"),
        session_id(url, "(?<=/)(?P<lang>en|fr)(?=/)", 0).alias("behind"),
        session_id(url, "/([0-9]+)", 4).alias("bad_group"),
    )


EXPAND_SQL = (
    SEG_SQL
    + "SELECT page_id AS base_row, CAST(pos AS INTEGER) AS detail_seq, CAST(pos AS BIGINT) AS pos, "
    "seg FROM s{0}"
)


@query("link_expand", EXPAND_SQL.format(""))
def link_expand(spark, sf):
    spec = L.LinkSpec(("url",), record_path="items", schema=SEGMENTS)
    rows = L.expand_links(base_rows(spark, sf), details(spark, sf), spec, BASE)
    return shown(rows, "pos", "seg")


@query(
    "link_replace",
    EXPAND_SQL.format(
        " WHERE (page_id // 20) % 3 <> 2 AND url LIKE 'https:%' UNION ALL SELECT page_id, NULL, "
        "NULL, 'kept ' || page_id FROM pages WHERE (page_id // 20) % 3 = 2 OR page_id // 20 NOT IN "
        "(SELECT page_id // 20 FROM pages WHERE url LIKE 'https:%')"
    ),
)
def link_replace(spark, sf):
    """In a window where some record has a link, the others vanish; in one without
    links the records come back as they are."""
    no_link = (F.floor(F.col("page_id") / 20) % 3 == 2) | ~F.col("url").startswith("https:")
    url = F.when(no_link, F.concat(F.lit("/local/"), F.col("page_id"))).otherwise(F.col("url"))
    spec = L.LinkSpec(("url",), record_path="items", schema=SEGMENTS)
    rows = L.expand_links(
        base_rows(spark, sf, url), details(spark, sf), spec, BASE, ["_window_seq"]
    )
    kept = F.concat(F.lit("kept "), F.col("page_id"))
    return shown(rows, "pos", F.coalesce("seg", kept).alias("seg"))


@query(
    "link_parse_override",
    EXPAND_SQL.format("").replace(", seg FROM s", ", seg, false AS has_attributes FROM s"),
)
def link_parse_override(spark, sf):
    """The links are read as JSON without the record path of the base, which is
    ``data.items``; the keys to drop are inherited."""
    tag = F.lit("t").alias("attributes")
    body = F.to_json(segments(tag))
    rows = L.expand_links(
        base_rows(spark, sf), details(spark, sf, body), L.LinkSpec(("url",)), BASE
    )
    return shown(
        rows, "pos", "seg", F.lit("attributes" in rows.columns).alias("has_attributes")
    )


@query(
    "positional_outer_join",
    """
WITH p AS (SELECT page_id, string_split(url, '/') AS parts FROM pages),
a AS (SELECT page_id, i - 1 AS n, parts[i] AS k, i AS a
      FROM (SELECT *, unnest(range(1, len(parts) + 1)) AS i FROM p)),
b AS (SELECT page_id, i - 1 AS n, 'b' || i AS k, page_id + i AS b
      FROM (SELECT *, unnest(range(1, page_id % 8 + 1)) AS i FROM p) WHERE page_id % 4 <> 0)
SELECT coalesce(a.page_id, b.page_id) AS base_row, CAST(coalesce(a.n, b.n) AS INTEGER) AS
       detail_seq, CASE WHEN coalesce(a.page_id, b.page_id) % 4 = 0 THEN a.k END AS k,
       CASE WHEN coalesce(a.page_id, b.page_id) % 4 <> 0 THEN a.k END AS k_x, b.k AS k_y, a.a, b.b
FROM a FULL JOIN b ON a.page_id = b.page_id AND a.n = b.n
""",
)
def positional_outer_join(spark, sf):
    """Two payloads of different length side by side; a quarter of the records has one."""
    first = F.to_json(
        F.transform(
            F.split("url", "/"),
            lambda x, i: F.struct(x.alias("k"), (i + 1).cast("bigint").alias("a")),
        )
    )
    pages = table(spark, sf, "pages").select("page_id", "url").distinct()
    n = (F.col("page_id") % 8).cast("int")
    steps = F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))
    second = F.to_json(
        F.transform(
            steps,
            lambda i: F.struct(
                F.concat(F.lit("b"), i).alias("k"), (F.col("page_id") + i).alias("b")
            ),
        )
    )
    # The second payload tells of the page, so pages that share a URL ask for one each.
    own = F.concat("url", F.lit("#more-"), "page_id")
    landed = details(spark, sf, first).unionAll(
        responses(pages, pull=F.lit("link"), page_seq=F.lit(0), body=second, url=own)
    )
    more = F.when(F.col("page_id") % 4 != 0, own)
    base = base_rows(spark, sf).withColumn("more", more)
    spec = L.LinkSpec(("url", "more"), schema="array<struct<k:string,a:bigint,b:bigint>>")
    rows = L.expand_links(base, landed, spec, ParseSpec())
    return shown(rows, "k", "k_x", "k_y", "a", "b")


# ---- session ids -----------------------------------------------------------

RUN_SQL = """
WITH l AS (SELECT page_id, page_id // 20 AS run,
                  nullif(regexp_extract(url, '/([0-9]+)', 1), '') AS sid FROM pages)
"""


def run_links(spark, sf):
    spec = L.LinkSpec(("url",), session_regex=SID, session_group=1)
    return L.collect_links(base_rows(spark, sf), spec)


def policy(spark, sf, name, run=("_window_seq",)):
    found = L.resolve_session(run_links(spark, sf), name, list(run))
    return found.select(F.col(run[0]).cast("bigint").alias("run"), "session_id")


@query(
    "session_policy_first",
    RUN_SQL + "SELECT run, arg_min(sid, page_id) AS session_id FROM l WHERE sid IS NOT NULL "
    "GROUP BY run",
)
def session_policy_first(spark, sf):
    return policy(spark, sf, "first")


@query(
    "session_policy_last",
    RUN_SQL + "SELECT run, arg_max(sid, page_id) AS session_id FROM l WHERE sid IS NOT NULL "
    "GROUP BY run",
)
def session_policy_last(spark, sf):
    return policy(spark, sf, "last")


@query(
    "session_policy_all",
    RUN_SQL + "SELECT run, string_agg(sid, ',' ORDER BY sid) AS session_id FROM (SELECT DISTINCT "
    "run, sid FROM l WHERE sid IS NOT NULL) GROUP BY run",
)
def session_policy_all(spark, sf):
    return policy(spark, sf, "all")


@query(
    "session_policy_single",
    RUN_SQL + "SELECT page_id AS run, sid AS session_id FROM l WHERE sid IS NOT NULL",
)
def session_policy_single(spark, sf):
    """Every page is a run of its own, so each has exactly one id."""
    return policy(spark, sf, "require_single", ("_row_seq",))


GROUP_SQL = (
    SEG_SQL
    + "SELECT coalesce(nullif(regexp_extract(url, '/([5-9][0-9][0-9])', 1), ''), 'none') AS "
    "session_id, CAST(pos AS BIGINT) AS pos, seg FROM s"
)
SOME = L.LinkSpec(
    ("url",),
    record_path="items",
    schema=SEGMENTS,
    session_regex="/([5-9][0-9][0-9])",
    session_group=1,
)


def payload(spark, sf, number=False):
    links = L.collect_links(base_rows(spark, sf), SOME)
    links = L.number_links(links) if number else links
    return L.link_payload(links, details(spark, sf), SOME, BASE)


@query("session_groups", GROUP_SQL)
def session_groups(spark, sf):
    grouped = L.session_groups(payload(spark, sf))
    return grouped.select(F.col("_session_id").alias("session_id"), "pos", "seg")


def read_parts(spark, path):
    # Part names are text even where they look like numbers.
    schema = "pos bigint, seg string, part string"
    folder = objects.mounted(spark, path)
    if folder:
        return objects.read_objects(spark, folder, T.StructType.fromDDL(schema), "part")
    return spark.read.schema(schema).parquet(path)


@query(
    "flush_per_link",
    SEG_SQL
    + "SELECT CAST(dense_rank() OVER (ORDER BY page_id) AS VARCHAR) || '_' || "
    "coalesce(nullif(regexp_extract(url, '/([5-9][0-9][0-9])', 1), ''), 'none') AS part, "
    "CAST(pos AS BIGINT) AS pos, seg FROM s",
)
def flush_per_link(spark, sf):
    """One object per link, numbered in order; read back whole."""
    root = scratch_path(spark, "flush")
    sink = SinkSpec(root, "parquet")
    rows = payload(spark, sf, number=True)
    flush_parts(rows, sink, path_values("pages", "qa"), "{seq}_{session_id}", root + "/parts")
    return read_parts(spark, root + "/parts").select("part", "pos", "seg")


@query("flush_per_session", GROUP_SQL.replace("AS session_id,", "AS part,"))
def flush_per_session(spark, sf):
    """One object per session id, ``none`` for links without one."""
    root = scratch_path(spark, "flush")
    sink = SinkSpec(root, "parquet")
    rows = L.session_groups(payload(spark, sf))
    flush_parts(rows, sink, path_values("pages", "qa"), "session_{session_id}", root + "/parts")
    back = read_parts(spark, root + "/parts")
    return back.select(F.regexp_replace("part", "^session_", "").alias("part"), "pos", "seg")
