"""Recorded responses are found by reading little of the recording."""

from __future__ import annotations

import pickle

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from pageloom.catalog import run_queries as R
from pageloom.sources.paged import Pull, walk
from pageloom.sources.transports import RecordedFetch, RecordedRequests

PAGES = 400


@pytest.fixture
def reads(monkeypatch):
    """Row groups read, as (file, row group)."""
    seen, real = [], pq.ParquetFile.read_row_group

    def counted(self, i, *args, **options):
        seen.append((id(self), i))
        return real(self, i, *args, **options)

    monkeypatch.setattr(pq.ParquetFile, "read_row_group", counted)
    return seen


def test_pages_asked_in_order_read_each_row_group_once(spark, tmp_path, reads):
    orders = spark.range(PAGES * 250, numPartitions=1).select(
        F.col("id").alias("o_orderkey"),
        F.col("id").alias("o_custkey"),
        F.lit("O").alias("o_orderstatus"),
        F.lit(1.5).alias("o_totalprice"),
    )
    orders.write.parquet(f"{tmp_path}/orders.parquet")
    fetch = RecordedFetch(R.recorded_orders(spark, str(tmp_path), per_page=250))
    pull = Pull("orders", "u", {"window": 0}, paging={"mode": "page"}, parse={"json_record_path": "data.items"})
    assert len(list(walk(pull, fetch))) == PAGES + 1
    (recording,) = fetch.opened.values()
    assert 1 < len(recording.groups) == len(reads) == len(set(reads))
    assert pickle.loads(pickle.dumps(fetch)).opened == {}


def test_requests_are_found_in_small_row_groups(spark, reads):
    noise = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(600)), lambda i: F.sha2(F.concat("id", F.lit("-"), i), 256)), "")
    df = spark.range(PAGES).select(F.concat(F.lit("u?page="), "id").alias("request"), F.concat(noise, F.lit("x")).alias("body"))
    fetch = R.record(spark, df, F.col("request"), F.concat("body", "request"), buckets=2, missing="none")
    for i in (0, 7, PAGES - 1):
        assert fetch("u", {"page": i}, {}).body.endswith(f"xu?page={i}")
    assert fetch("u", {"page": PAGES}, {}).body == "none"
    assert 2 <= len(reads) <= 4
    opened = next(iter(fetch.opened.values()))
    assert len(opened.groups) > 5


def test_long_requests_and_unsorted_files_are_found(spark, tmp_path):
    rows = [(f"u?q={'y' * 5000}{i}", 200, None, str(i)) for i in range(20)]
    for part in (rows[::2], rows[1::2]):
        df = spark.createDataFrame(part, "request string, status int, link string, body string")
        df.coalesce(1).write.mode("append").parquet(f"{tmp_path}/bucket=0")
    fetch = RecordedRequests(str(tmp_path), buckets=1)
    assert [fetch(r[0], {}, {}).body for r in rows] == [r[3] for r in rows]
    pages = [(p, 200, None, f"[{p}]") for p in (5, 1, 9, 3)]
    for part in (pages[:2], pages[2:]):
        df = spark.createDataFrame(part, "page int, status int, link string, body string")
        df.coalesce(1).write.mode("append").parquet(f"{tmp_path}/key=0")
    found = [RecordedFetch(str(tmp_path))("u", {"window": 0, "page": p}, {}).body for p in range(10)]
    assert found == [f"[{p}]" if p in (1, 3, 5, 9) else "[]" for p in range(10)]
    assert RecordedFetch(str(tmp_path))("u", {"window": 7, "page": 1}, {}).body == "[]"
