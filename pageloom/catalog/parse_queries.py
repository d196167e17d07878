"""Queries for bodies of every kind: JSON, JSON lines, CSV."""

from __future__ import annotations

from pyspark.sql import functions as F

from pageloom.catalog.landed import (
    ORDER_SQL,
    order_groups,
    responses,
    table,
)
from pageloom.catalog.registry import query
from pageloom.operators.parse import ParseSpec, parse, split_readable
from pageloom.operators.schemas import union_widened
from pageloom.operators.variants import land_variants
from pageloom.runtime import META

ODD_BODIES = (3, 4, 5, 6, 7)  # pages whose record path leads nowhere


@query(
    "json_record_path",
    ORDER_SQL
    + "SELECT CAST(pull_no AS VARCHAR) AS pull, CAST(page AS BIGINT) AS page_seq, o_orderkey, "
    "o_orderstatus, o_totalprice FROM o WHERE page NOT IN (3, 4, 5, 6, 7)",
)
def json_record_path(spark, sf):
    """Steps that are missing, null, false or empty give no rows; the rest is read.

    The schema is inferred over all bodies, which disagree on the shape of the path.
    """
    pages = order_groups(spark, sf)
    items = F.to_json("items")
    whole = F.concat(F.lit('{"result":{"data":{"items":'), items, F.lit("}}}"))
    body = (
        F.when(F.col("page") == 3, F.lit('{"result":{"data":{}}}'))
        .when(F.col("page") == 4, F.lit('{"result":{"data":null}}'))
        .when(F.col("page") == 5, F.lit('{"other":1}'))
        .when(F.col("page") == 6, F.lit('{"result":{"data":{"items":[]}}}'))
        .when(F.col("page") == 7, F.lit('{"result":false}'))
        .otherwise(whole)
    )
    landed = responses(pages, pull=F.col("pull_no"), page_seq=F.col("page"), body=body)
    rows = parse(landed, ParseSpec(record_path="result.data.items", landing="variant"))
    return rows.select(
        F.col("_pull").alias("pull"),
        F.col("_page_seq").alias("page_seq"),
        F.col("id").alias("o_orderkey"),
        F.col("status").alias("o_orderstatus"),
        F.col("price").alias("o_totalprice"),
    )


@query(
    "json_variant_rows",
    ORDER_SQL
    + "SELECT CAST(pull_no AS VARCHAR) AS pull, CAST(page AS BIGINT) AS page_seq, o_orderkey AS id, "
    "o_custkey AS cust, CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS price, "
    "CASE WHEN page % 2 = 0 THEN CAST(o_custkey AS VARCHAR) ELSE 'c' || o_custkey END AS code, "
    "page = 8 AS as_text FROM o WHERE page NOT IN (3, 4, 7)",
)
def json_variant_rows(spark, sf):
    """Bodies landed as shredded VARIANT: lists of records with a dropped key, a column that is
    a number on some pages and text on others, steps that lead nowhere, and pages no variant
    holds: cut off (7) or with a key twice (8)."""
    page = F.expr("(o_orderkey % 5000) div 250")
    item = F.struct(
        F.struct(F.col("o_orderpriority").alias("prio")).alias("attributes"),
        F.col("o_orderkey").alias("id"),
        F.struct(F.col("o_custkey").alias("cust")).alias("who"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")).alias("price"),
        F.when(page % 2 == 0, F.col("o_custkey")).alias("code_n"),
        F.when(page % 2 == 1, F.concat(F.lit("c"), F.col("o_custkey"))).alias("code_s"),
    )
    pages = order_groups(spark, sf, item)
    items = F.regexp_replace(F.to_json("items"), '"code_[ns]":', '"code":')
    twice = F.when(F.col("page") == 8, F.lit('"kind":0,')).otherwise(F.lit(""))
    whole = F.concat(F.lit("{"), twice, F.lit('"kind":1,"result":{"items":'), items, F.lit("}}"))
    body = (
        F.when(F.col("page") == 3, F.lit('{"kind":1,"result":{"items":[]}}'))
        .when(F.col("page") == 4, F.lit('{"kind":1,"result":null}'))
        .when(F.col("page") == 7, F.expr("left(to_json(items), 30)"))
        .otherwise(whole)
    )
    landed = land_variants(responses(pages, pull=F.col("pull_no"), page_seq=F.col("page"), body=body))
    spec = ParseSpec(record_path="result.items", drop_keys=("attributes",))
    rows = parse(landed, spec, keep={"_as_text": "body_text"})
    return rows.select(
        F.col("_pull").alias("pull"),
        F.col("_page_seq").alias("page_seq"),
        "id",
        F.col("who.cust").alias("cust"),
        "price",
        "code",
        F.col("_as_text").isNotNull().alias("as_text"),
    )


@query(
    "json_list_rows",
    "SELECT o_orderkey AS id, CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS price, "
    """'{"cust":' || o_custkey || ',"status":"' || o_orderstatus || '"}' AS who FROM orders""",
)
def json_list_rows(spark, sf):
    """Top-level lists; nested objects stay nested, keys a row lacks are null."""
    item = F.struct(
        F.col("o_orderkey").alias("id"),
        F.struct(F.col("o_custkey").alias("cust"), F.col("o_orderstatus").alias("status")).alias(
            "who"
        ),
        F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")).alias("price"),
    )
    pages = order_groups(spark, sf, item)
    landed = responses(
        pages, pull=F.col("pull_no"), page_seq=F.col("page"), body=F.to_json("items")
    )
    return parse(landed, ParseSpec()).select("id", "price", F.to_json("who").alias("who"))


@query(
    "json_object_flatten",
    "SELECT p_partkey AS key, p_brand AS spec_brand, p_size AS spec_dims_size, "
    "p_retailprice AS spec_dims_price, replace(p_name, ' ', '|') AS tags FROM part",
)
def json_object_flatten(spark, sf):
    """One object per body: nested objects become dotted columns, lists stay lists."""
    body = F.to_json(
        F.struct(
            F.struct(
                F.col("p_partkey").alias("key"),
                F.struct(
                    F.col("p_brand").alias("brand"),
                    F.struct(
                        F.col("p_size").alias("size"), F.col("p_retailprice").alias("price")
                    ).alias("dims"),
                ).alias("spec"),
                F.split("p_name", " ").alias("tags"),
            ).alias("result")
        )
    )
    landed = responses(
        table(spark, sf, "part"), pull=F.lit("part"), page_seq=F.col("p_partkey"), body=body
    )
    spec = ParseSpec(
        record_path="result",
        schema="struct<result:struct<key:bigint,spec:struct<brand:string,"
        "dims:struct<size:int,price:double>>,tags:array<string>>>",
    )
    return parse(landed, spec).select(
        "key",
        F.col("`spec.brand`").alias("spec_brand"),
        F.col("`spec.dims.size`").alias("spec_dims_size"),
        F.col("`spec.dims.price`").alias("spec_dims_price"),
        F.array_join("tags", "|").alias("tags"),
    )


@query(
    "json_scalar_list",
    "SELECT vec_id, CAST(i - 1 AS INTEGER) AS row_seq, CAST(embedding[i] AS DOUBLE) AS value "
    "FROM (SELECT *, unnest(range(1, len(embedding) + 1)) AS i FROM embeddings)",
)
def json_scalar_list(spark, sf):
    landed = responses(
        table(spark, sf, "embeddings"),
        pull=F.lit("vectors"),
        page_seq=F.col("vec_id"),
        body=F.to_json(F.struct(F.col("embedding").alias("data"))),
    )
    rows = parse(landed, ParseSpec(record_path="data", schema="struct<data:array<float>>"))
    return rows.select(
        F.col("_page_seq").cast("bigint").alias("vec_id"),
        F.col("_row_seq").alias("row_seq"),
        F.col("value").cast("double").alias("value"),
    )


@query(
    "json_drop_keys",
    "SELECT o_orderkey AS id, "
    """'{"cust":' || o_custkey || ',"id":' || o_orderkey || ',"more":{"status":"' """
    """|| o_orderstatus || '"}}' AS record FROM orders""",
)
def json_drop_keys(spark, sf):
    """``attributes`` goes away at every depth and is never materialised."""
    tag = F.struct(F.lit("order").alias("type"), F.col("o_orderpriority").alias("prio"))
    item = F.struct(
        tag.alias("attributes"),
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").alias("cust"),
        F.struct(tag.alias("attributes"), F.col("o_orderstatus").alias("status")).alias("more"),
    )
    pages = order_groups(spark, sf, item)
    body = F.to_json(F.struct(F.lit("x").alias("attributes"), F.col("items").alias("records")))
    landed = responses(pages, pull=F.col("pull_no"), page_seq=F.col("page"), body=body)
    rows = parse(landed, ParseSpec(record_path="records", drop_keys=("attributes",)))
    payload = [c for c in rows.columns if c not in META]
    return rows.select("id", F.to_json(F.struct(*payload)).alias("record"))


DOCS_PER_BODY = 50


def doc_pages(spark, sf, line, header=None):
    """Documents in bodies of 50 consecutive ids, one text line (or more) each."""
    docs = table(spark, sf, "documents")
    labels = table(spark, sf, "labels").select("doc_id", "quality")
    docs = docs.join(labels, "doc_id", "left").withColumn(
        "page", F.expr(f"doc_id div {DOCS_PER_BODY}").cast("int")
    )
    lines = docs.select("page", F.struct("doc_id", line.alias("line")).alias("l"))
    bodies = lines.groupBy("page").agg(
        F.array_join(
            F.transform(F.array_sort(F.collect_list("l")), lambda x: x["line"]), "\n"
        ).alias("body")
    )
    body = F.concat(header, F.lit("\n"), F.col("body")) if header is not None else F.col("body")
    return responses(bodies, pull=F.lit("docs"), page_seq=F.col("page"), body=body)


@query("jsonl_rows", "SELECT doc_id, lang, source, text, n_chars FROM documents")
def jsonl_rows(spark, sf):
    """One record per line; blank lines are no records."""
    line = F.to_json(F.struct("doc_id", "lang", "source", "text", "n_chars"))
    blank = F.when(F.col("doc_id") % 7 == 0, F.lit("\n  \n")).otherwise(F.lit(""))
    landed = doc_pages(spark, sf, F.concat(blank, line))
    schema = "struct<doc_id:bigint,lang:string,source:string,text:string,n_chars:bigint>"
    rows = parse(landed, ParseSpec("jsonl", schema=schema))
    return rows.select("doc_id", "lang", "source", "text", "n_chars")


@query(
    "csv_rows",
    "SELECT d.doc_id, d.lang, CAST(l.quality AS BIGINT) AS quality, d.text, "
    "CASE WHEN (d.doc_id // 50) % 3 <> 1 THEN CAST(d.n_chars + 0.5 AS DOUBLE) END AS size "
    "FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id",
)
def csv_rows(spark, sf):
    """Quoted texts with commas and line ends; column order differs by page and one
    column is absent from a third of the pages; several spellings of no value."""
    text = F.concat(F.lit('"'), F.replace("text", F.lit('"'), F.lit('""')), F.lit('"'))
    missing = F.element_at(
        F.array(*[F.lit(x) for x in ("", "NA", "null", "NaN")]),
        (F.col("doc_id") % 4 + 1).cast("int"),
    )
    quality = F.coalesce(F.col("quality").cast("string"), missing)
    size = (F.col("n_chars") + 0.5).cast("decimal(18,1)").cast("string")
    short = F.concat_ws(",", "doc_id", text, quality, "lang")
    line = F.when(F.col("page") % 3 == 1, short).otherwise(
        F.concat_ws(",", size, "doc_id", "lang", quality, text)
    )
    header = F.when(F.col("page") % 3 == 1, F.lit("doc_id,text,quality,lang")).otherwise(
        F.lit("size,doc_id,lang,quality,text")
    )
    landed = doc_pages(spark, sf, line, header)
    rows = parse(landed, ParseSpec("csv"))
    return rows.select("doc_id", "lang", "quality", "text", "size")


@query(
    "schema_unify",
    ORDER_SQL
    + "SELECT o_orderkey AS id, CASE WHEN page % 2 = 0 THEN CAST(o_custkey AS VARCHAR) "
    "ELSE 'c' || o_custkey END AS code, CASE WHEN page % 3 = 1 THEN o_totalprice "
    "WHEN page % 3 = 2 THEN CAST(o_custkey AS DOUBLE) END AS amount, "
    "CASE WHEN page >= 2 THEN o_orderstatus END AS note FROM o",
)
def schema_unify(spark, sf):
    """Pages that disagree: text meets numbers, whole meets fractional, late columns."""
    page = F.expr("(o_orderkey % 5000) div 250")
    item = F.struct(
        F.col("o_orderkey").alias("id"),
        F.when(page % 2 == 0, F.col("o_custkey")).alias("code_n"),
        F.when(page % 2 == 1, F.concat(F.lit("c"), F.col("o_custkey"))).alias("code_s"),
        F.when(page % 3 == 1, F.col("o_totalprice")).alias("amount_f"),
        F.when(page % 3 == 2, F.col("o_custkey")).alias("amount_n"),
        F.when(page >= 2, F.col("o_orderstatus")).alias("note"),
    )
    pages = order_groups(spark, sf, item)
    # Both variants of a field are sent under one name.
    body = F.regexp_replace(F.to_json("items"), '"(code|amount)_[nsf]":', '"$1":')
    landed = responses(pages, pull=F.col("pull_no"), page_seq=F.col("page"), body=body)
    return parse(landed, ParseSpec()).select("id", "code", "amount", "note")


@query(
    "union_pages",
    "SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN o_totalprice END AS price, "
    "CASE WHEN o_orderstatus = 'O' THEN CAST(o_custkey AS VARCHAR) WHEN o_orderstatus = 'P' "
    "THEN o_orderpriority END AS note FROM orders",
)
def union_pages(spark, sf):
    """Frames with different columns, one of them with a conflicting type."""
    orders = table(spark, sf, "orders")
    by = lambda s: orders.where(F.col("o_orderstatus") == s)
    return union_widened(
        [
            by("F").select("o_orderkey", F.col("o_totalprice").alias("price")),
            by("O").select("o_orderkey", F.col("o_custkey").alias("note")),
            by("P").select("o_orderkey", F.col("o_orderpriority").alias("note")),
        ]
    )


@query(
    "csv_duplicate_header",
    "SELECT p_partkey AS z, p_name AS a, p_retailprice AS \"a.1\", p_size AS m FROM part",
)
def csv_duplicate_header(spark, sf):
    """Two columns of one name and quoted cells; names keep their order."""
    quote = lambda c: F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))
    line = F.concat_ws(",", "p_partkey", quote(F.col("p_name")), "p_retailprice", "p_size")
    pages = table(spark, sf, "part").groupBy(F.expr("p_partkey div 250").alias("page"))
    pages = pages.agg(F.array_join(F.array_sort(F.collect_list(line)), "\n").alias("lines"))
    landed = responses(
        pages,
        pull=F.lit("parts"),
        page_seq=F.col("page"),
        body=F.concat(F.lit("z,a,a,m\n"), F.col("lines")),
    )
    rows = parse(landed, ParseSpec("csv"))
    return rows.select("z", "a", "`a.1`", F.col("m").cast("int").alias("m"))


@query(
    "json_bad_bodies",
    "SELECT p_partkey AS id, CASE WHEN p_partkey // 50 % 4 = 3 THEN NULL ELSE p_name END AS name, "
    "p_partkey // 50 % 4 = 3 AS bad FROM part",
)
def json_bad_bodies(spark, sf):
    """Every fourth page is cut off: its rows are told apart, the others' are kept."""
    item = F.struct(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"))
    pages = table(spark, sf, "part").groupBy(F.expr("p_partkey div 50").alias("page"))
    pages = pages.agg(F.array_sort(F.collect_list(item)).alias("items"))
    text = F.to_json("items")
    landed = responses(
        pages,
        pull=F.lit("parts"),
        page_seq=F.col("page"),
        body=F.when(F.col("page") % 4 == 3, F.expr("left(to_json(items), length(to_json(items)) - 1)")).otherwise(text),
    )
    good, bad = split_readable(landed)
    kept = parse(good, ParseSpec(schema="array<struct<id:bigint,name:string>>", strict=True))
    ids = F.explode(F.regexp_extract_all("body", F.lit('"id":([0-9]+)'), F.lit(1)).cast("array<bigint>"))
    lost = bad.select(ids.alias("id"), F.lit(None).cast("string").alias("name"), F.lit(True).alias("bad"))
    return kept.select("id", "name", F.lit(False).alias("bad")).unionAll(lost)
