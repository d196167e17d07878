"""Queries for joins of pulls and for projections of the joined sides."""

from __future__ import annotations

from pyspark.sql import functions as F

from pageloom.catalog.landed import responses, table
from pageloom.catalog.registry import query
from pageloom.operators.joins import JoinSpec, join_pair, multi_join
from pageloom.operators.parse import ParseSpec
from pageloom.operators.sketches import counted_join
from pageloom.plans.frames import joined_records


def customers(spark, sf):
    return table(spark, sf, "customer").select(
        F.col("c_custkey").alias("custkey"),
        F.col("c_nationkey").alias("nationkey"),
        F.col("c_acctbal").alias("acctbal"),
    )


def nations(spark, sf):
    return table(spark, sf, "nation").select(
        F.col("n_nationkey").alias("nationkey"),
        F.col("n_name").alias("name"),
        F.col("n_regionkey").alias("regionkey"),
    )


def nation_regions(spark, sf):
    nation, region = table(spark, sf, "nation"), table(spark, sf, "region")
    both = nation.join(region, nation.n_regionkey == region.r_regionkey)
    return both.select(
        F.col("n_nationkey").alias("nationkey"), F.col("r_name").alias("region")
    )


@query(
    "multi_join_left",
    "SELECT c_custkey AS custkey, c_nationkey AS nationkey, c_acctbal AS acctbal, n_name AS name, "
    "n_regionkey AS regionkey, r_name AS region FROM customer LEFT JOIN nation ON c_nationkey = "
    "n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey",
)
def multi_join_left(spark, sf):
    pulls = [
        ("customers", customers(spark, sf)),
        ("nations", nations(spark, sf)),
        ("regions", nation_regions(spark, sf)),
    ]
    return multi_join(pulls, JoinSpec(["nationkey"]))


# Documents (those in English under numbers that nothing else has), labels, and vectors
# under their number: every side lacks keys that another one has.
SPARSE_SQL = """
WITH d AS (SELECT CASE WHEN lang <> 'en' THEN doc_id ELSE -1 - doc_id END AS doc_id, lang FROM documents),
v AS (SELECT vec_id AS doc_id, label FROM embeddings)
SELECT {key} AS doc_id, d.lang, l.quality, v.label FROM d {how} JOIN labels l
ON d.doc_id = l.doc_id {how} JOIN v ON {mid} = v.doc_id
"""


def sparse(spark, sf, how):
    own = F.when(F.col("lang") != "en", F.col("doc_id")).otherwise(-1 - F.col("doc_id"))
    docs = table(spark, sf, "documents").select(own.alias("doc_id"), "lang")
    vectors = table(spark, sf, "embeddings").select(F.col("vec_id").alias("doc_id"), "label")
    labels = table(spark, sf, "labels").select("doc_id", "quality")
    pulls = [("docs", docs), ("labels", labels), ("vectors", vectors)]
    return multi_join(pulls, JoinSpec(["doc_id"], how))


@query("multi_join_inner", SPARSE_SQL.format(how="INNER", key="d.doc_id", mid="d.doc_id"))
def multi_join_inner(spark, sf):
    return sparse(spark, sf, "inner")


@query("multi_join_right", SPARSE_SQL.format(how="RIGHT", key="v.doc_id", mid="l.doc_id"))
def multi_join_right(spark, sf):
    return sparse(spark, sf, "right")


@query(
    "multi_join_outer",
    SPARSE_SQL.format(
        how="FULL",
        key="coalesce(d.doc_id, l.doc_id, v.doc_id)",
        mid="coalesce(d.doc_id, l.doc_id)",
    ),
)
def multi_join_outer(spark, sf):
    return sparse(spark, sf, "outer")


@query(
    "join_null_keys",
    "SELECT c_custkey AS custkey, k AS nationkey, c_acctbal AS acctbal, n_name AS name, "
    "n_regionkey AS regionkey FROM (SELECT *, nullif(c_nationkey, 3) AS k FROM customer) c "
    "LEFT JOIN (SELECT *, nullif(n_nationkey, 3) AS m FROM nation) n ON c.k IS NOT DISTINCT "
    "FROM n.m",
)
def join_null_keys(spark, sf):
    """Key 3 is missing on both sides; the rows without a key meet."""
    holed = F.nullif(F.col("nationkey"), F.lit(3))
    left = customers(spark, sf).withColumn("nationkey", holed)
    return join_pair(left, nations(spark, sf).withColumn("nationkey", holed), ["nationkey"])


def cased(spark, sf, case):
    left = customers(spark, sf).toDF("CustKey", "NationKey", "AcctBal")
    right = nations(spark, sf).toDF("NATIONKEY", "Name", "RegionKey")
    return multi_join([("c", left), ("n", right)], JoinSpec(["nationKEY"], case=case))


CASED_SQL = (
    "SELECT c_custkey AS {0}, c_nationkey AS {1}, c_acctbal AS {2}, n_name AS {3}, "
    "n_regionkey AS {4} FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey"
)


@query(
    "join_case_lower", CASED_SQL.format("custkey", "nationkey", "acctbal", "name", "regionkey")
)
def join_case_lower(spark, sf):
    return cased(spark, sf, "lower")


@query(
    "join_case_upper", CASED_SQL.format("CUSTKEY", "NATIONKEY", "ACCTBAL", "NAME", "REGIONKEY")
)
def join_case_upper(spark, sf):
    return cased(spark, sf, "upper")


@query(
    "join_case_ignore", CASED_SQL.format("CustKey", "nationKEY", "AcctBal", "Name", "RegionKey")
)
def join_case_ignore(spark, sf):
    return cased(spark, sf, "ignore")


@query(
    "join_case_exact",
    "SELECT c_custkey AS custkey, c_nationkey AS own_key, CAST(NULL AS INTEGER) AS key, "
    "n_name AS name FROM customer LEFT JOIN nation ON false",
)
def join_case_exact(spark, sf):
    """Names are literal: ``NationKey`` is not the key, so every left key is missing."""
    left = customers(spark, sf).toDF("custkey", "NationKey", "acctbal")
    right = nations(spark, sf)
    joined = multi_join([("c", left), ("n", right)], JoinSpec(["nationkey"]))
    named = joined.toDF(
        *[{"nationkey": "key", "NationKey": "own_key"}.get(c, c) for c in joined.columns]
    )
    return named.select("custkey", "own_key", "key", "name")


@query(
    "join_missing_key",
    "SELECT c_custkey AS custkey, k AS nationkey, s_name AS name FROM (SELECT *, "
    "nullif(c_nationkey, 3) AS k FROM customer) LEFT JOIN (SELECT * FROM supplier WHERE "
    "s_suppkey = (SELECT min(s_suppkey) FROM supplier)) ON k IS NULL",
)
def join_missing_key(spark, sf):
    """The right side lacks the key; it can only meet rows whose key is null."""
    left = customers(spark, sf).select(
        "custkey", F.nullif(F.col("nationkey"), F.lit(3)).alias("nationkey")
    )
    right = table(spark, sf, "supplier").agg(F.min_by("s_name", "s_suppkey").alias("name"))
    return join_pair(left, right, ["nationkey"])


SUFFIX_SQL = (
    "SELECT c_custkey AS key, c_name AS name{0}, c_acctbal AS bal{0}, s_name AS name{1}, "
    "s_acctbal AS bal{1} FROM customer LEFT JOIN supplier ON c_custkey = s_suppkey"
)


def parties(spark, sf):
    left = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("key"), F.col("c_name").alias("name"),
        F.col("c_acctbal").alias("bal"), F.col("c_mktsegment").alias("segment"),
    )
    right = table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"),
        F.col("s_acctbal").alias("bal"), F.col("s_nationkey").alias("nation"),
    )
    return left, right


@query("join_suffixes", SUFFIX_SQL.format("_x", "_y"))
def join_suffixes(spark, sf):
    left, right = parties(spark, sf)
    return join_pair(left.drop("segment"), right.drop("nation"), ["key"])


@query("join_select_suffix", SUFFIX_SQL.format("", "_details"))
def join_select_suffix(spark, sf):
    left, right = parties(spark, sf)
    spec = JoinSpec(
        ["key"], select_from={"details": {"keep": ["name", "bal"]}}, suffixes=("", "_details")
    )
    return multi_join([("base", left.drop("segment")), ("details", right)], spec)


@query(
    "join_keep",
    "SELECT c_custkey AS key, c_mktsegment AS segment, s_nationkey AS nation FROM customer "
    "LEFT JOIN supplier ON c_custkey = s_suppkey",
)
def join_keep(spark, sf):
    """Only the listed column and the key come from the right; unknown names are ignored."""
    left, right = parties(spark, sf)
    spec = JoinSpec(["key"], select_from={"s": {"keep": ["nation", "unknown"]}})
    return multi_join([("c", left.select("key", "segment")), ("s", right)], spec)


@query(
    "join_rename",
    "SELECT c_custkey AS key, c_mktsegment AS segment, s_nationkey AS supplier_nation, "
    "s_name AS supplier FROM customer LEFT JOIN supplier ON c_custkey = s_suppkey",
)
def join_rename(spark, sf):
    left, right = parties(spark, sf)
    chosen = {
        "keep": ["nation", "name"],
        "rename": {"nation": "supplier_nation", "name": "supplier", "unknown": "x"},
    }
    return multi_join(
        [("c", left.select("key", "segment")), ("s", right)],
        JoinSpec(["key"], select_from={"s": chosen}),
    )


@query(
    "multi_no_join",
    "SELECT c_custkey AS custkey, c_nationkey AS nationkey, c_acctbal AS acctbal FROM customer",
)
def multi_no_join(spark, sf):
    return multi_join([("c", customers(spark, sf)), ("n", nations(spark, sf))], None)


def split_bodies(spark, sf):
    """Customers in windows of 500 keys, each sent as two single-page pulls: names as
    JSON, balances as CSV."""
    rows = table(spark, sf, "customer").withColumn("w", F.expr("c_custkey div 500").cast("int"))
    names = F.struct(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"))
    line = F.concat_ws(",", "c_mktsegment", "c_custkey", "c_acctbal")
    both = rows.groupBy("w").agg(
        F.to_json(F.struct(F.array_sort(F.collect_list(names)).alias("data"))).alias("json"),
        F.array_join(F.array_sort(F.collect_list(line)), "\n").alias("csv"),
    )
    sides = F.array(
        F.struct(F.lit("core").alias("pull"), F.col("json").alias("body")),
        F.struct(
            F.lit("money").alias("pull"),
            F.concat(F.lit("segment,key,bal\n"), F.col("csv")).alias("body"),
        ),
    )
    sent = both.select("w", F.explode(sides).alias("s"))
    return responses(
        sent, pull=F.col("s.pull"), window_seq=F.col("w"), page_seq=F.lit(0), body=F.col("s.body")
    )


SPLIT_PULLS = [
    ("core", ParseSpec(record_path="data")),
    ("money", ParseSpec("csv", schema="struct<segment:string,key:bigint,bal:double>")),
]
SPLIT_SQL = (
    "SELECT CAST(c_custkey // 500 AS BIGINT) AS window_seq, c_custkey AS key, c_name AS name, "
    "c_acctbal AS bal{0} FROM customer"
)


@query("multi_pull_parse", SPLIT_SQL.format(", c_mktsegment AS segment"))
def multi_pull_parse(spark, sf):
    """Each pull is parsed its own way before the join."""
    joined = joined_records(
        split_bodies(spark, sf), SPLIT_PULLS, JoinSpec(["key"]), per_window=True
    )
    return joined.select(F.col("_window_seq").alias("window_seq"), "key", "name", "bal", "segment")


HOT_KEY = "CASE WHEN {line} <= 2 THEN 0 WHEN {line} = 3 THEN NULL ELSE {key} END"


@query(
    "join_hot_outer",
    f"""
    WITH l AS (SELECT {HOT_KEY.format(line="l_linenumber", key="l_orderkey")} AS k, l_partkey, l_quantity FROM lineitem),
    o AS (SELECT CASE WHEN o_orderkey <= 3 THEN 0 ELSE o_orderkey END AS k, o_custkey FROM orders)
    SELECT coalesce(l.k, o.k) AS k, l_partkey AS partkey, l_quantity AS quantity, o_custkey AS custkey
    FROM l FULL JOIN o ON l.k IS NOT DISTINCT FROM o.k
    """,
)
def join_hot_outer(spark, sf):
    """Full join of two large sides: one key holds a third of the left rows and has several right
    rows, another part has no key and no partner. Each side is landed and counted once."""
    left = table(spark, sf, "lineitem").select(
        F.expr(HOT_KEY.format(line="l_linenumber", key="l_orderkey")).alias("k"),
        F.col("l_partkey").alias("partkey"),
        F.col("l_quantity").alias("quantity"),
        F.monotonically_increasing_id().alias("row"),
    )
    key = F.when(F.col("o_orderkey") <= 3, F.lit(0)).otherwise(F.col("o_orderkey"))
    right = table(spark, sf, "orders").select(key.cast("bigint").alias("k"), F.col("o_custkey").alias("custkey"))
    out = counted_join(left, right, ["k"], "full", ["row"], ["custkey"], hot_rows=1000)
    return out.select("k", "partkey", "quantity", "custkey")


@query(
    "join_bloom_inner",
    "SELECT l_orderkey AS orderkey, l_partkey AS partkey, l_extendedprice AS price, o_totalprice AS total "
    "FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderpriority = '1-URGENT' AND o_orderkey % 7 = 0",
)
def join_bloom_inner(spark, sf):
    """Lines of few orders: a bitmap of the orders' keys drops the other lines before they are
    written, counted and joined."""
    orders = table(spark, sf, "orders").where("o_orderpriority = '1-URGENT' AND o_orderkey % 7 = 0")
    right = orders.select(F.col("o_orderkey").alias("orderkey"), F.col("o_totalprice").alias("total"))
    left = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("orderkey"), F.col("l_partkey").alias("partkey"), F.col("l_extendedprice").alias("price")
    )
    return counted_join(left, right, ["orderkey"], "inner", ["partkey", "price"], ["orderkey"])
