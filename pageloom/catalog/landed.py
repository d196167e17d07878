"""Landed responses derived from the driver tables.

Every table row ends up in exactly one body. A body holds a bounded range of
unique keys, so the grouping that builds it never meets a large group, and the
number of bodies grows with the table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pageloom.runtime import RESPONSES_SCHEMA

API = "https://api.example.com"
KEYS_PER_PULL = 5000
KEYS_PER_PAGE = 250

# The same split of orders in SQL: 20 pages of 250 keys in each pull of 5000.
ORDER_SQL = """
WITH o AS (
  SELECT *, o_orderkey // 5000 AS pull_no, (o_orderkey % 5000) // 250 AS page FROM orders
)
"""


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def responses(df: DataFrame, **columns: Column) -> DataFrame:
    """Fill in the response columns that are not given."""
    given = {
        "window_seq": F.lit(0),
        "url": F.lit(API),
        "params": F.from_json(F.lit("{}"), "map<string,string>"),
        "headers": F.from_json(F.lit("{}"), "map<string,string>"),
        "status": F.lit(200),
        **columns,
    }
    return df.select(
        *[
            given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name)
            for f in RESPONSES_SCHEMA.fields
        ]
    )


def order_item() -> Column:
    return F.struct(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").alias("cust"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_totalprice").alias("price"),
    )


def order_groups(spark: SparkSession, sf: str, item: Column | None = None) -> DataFrame:
    """``pull_no``, ``page``, ``items`` (sorted by key) and ``last_id`` per page."""
    orders = table(spark, sf, "orders").select(
        F.expr(f"o_orderkey div {KEYS_PER_PULL}").alias("pull_no"),
        F.expr(f"(o_orderkey % {KEYS_PER_PULL}) div {KEYS_PER_PAGE}").alias("page"),
        "o_orderkey",
        (item if item is not None else order_item()).alias("item"),
    )
    rows = F.array_sort(F.collect_list(F.struct("o_orderkey", "item")))
    return orders.groupBy("pull_no", "page").agg(
        F.transform(rows, lambda r: r["item"]).alias("items"),
        F.max("o_orderkey").alias("last_id"),
    )


def unless(blank: Column, items: Column) -> Column:
    """Items of a page, or an empty list where the page is answered blank."""
    return F.when(blank, F.slice(items, 1, 0)).otherwise(items)


def token(*parts: Column | str) -> Column:
    return F.md5(F.concat_ws("-", *[p if isinstance(p, Column) else F.lit(p) for p in parts]))


def string_map(**values: Column) -> Column:
    """Map of the values that are not null."""
    pairs = [x for k, v in values.items() for x in (F.lit(k), v.cast("string"))]
    return F.map_filter(F.create_map(*pairs), lambda _, v: v.isNotNull())
