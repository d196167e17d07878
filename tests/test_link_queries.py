"""Link queries on pages that share URLs, against their SQL."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as entry_points

URLS = ["https://h.example/en/700", "https://h.example/en/700", "http://h.example/a/b#top"]


@pytest.fixture(scope="module")
def shared_urls(spark, tmp_path_factory):
    """50 pages, in which a URL stands for one page, two or many."""
    folder = str(tmp_path_factory.mktemp("shared"))
    rows = [(i, URLS[i % 3] if i < 40 else f"https://h.example/fr/{i}/x", "<p>") for i in range(50)]
    spark.createDataFrame(rows, "page_id bigint, url string, html string").write.parquet(
        f"{folder}/pages.parquet"
    )
    return folder


def check(spark, folder, name):
    df = entry_points.queries()[name](spark, folder)
    db = duckdb.connect()
    db.execute(f"CREATE VIEW pages AS SELECT * FROM '{folder}/pages.parquet/*.parquet'")
    found = db.execute(entry_points.oracle_sql()[name])
    names = [d[0] for d in found.description]
    wanted = sorted(map(str, found.fetchall()))
    assert sorted(str(tuple(r[c] for c in names)) for r in df.collect()) == wanted


@pytest.mark.parametrize(
    "name",
    [
        "flush_per_link",
        "flush_per_session",
        "session_groups",
        "link_expand",
        "link_parse_override",
        "link_replace",
    ],
)
def test_a_shared_url_is_answered_once(spark, shared_urls, name):
    check(spark, shared_urls, name)


def test_payloads_of_pages_with_one_url_stay_apart(spark, shared_urls):
    check(spark, shared_urls, "positional_outer_join")


def test_objects_of_links_are_not_a_task_each(spark, shared_urls):
    """Objects are written and read by as many tasks as shuffles have, however many there are."""
    sc = spark.sparkContext
    sc.setJobGroup("objects", "objects")
    try:
        n = entry_points.queries()["flush_per_link"](spark, shared_urls).select("part").distinct().count()
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert n == 50
    told = sc.statusTracker()
    stages = [s for j in told.getJobIdsForGroup("objects") for s in told.getJobInfo(j).stageIds]
    most = max(told.getStageInfo(s).numTasks for s in stages if told.getStageInfo(s))
    assert most < 50
