"""The end of a page-number pull, found by doubling and halving."""

from __future__ import annotations

import json
import math

import pytest

from pageloom import Ingest
from pageloom.sources.paged import Pull, first_empty, read_pulls, walk, with_ends
from pageloom.sources.transports import Response

PARSE = {"json_record_path": "data"}


def pages(n, blank=(), broken=None, notes=None):
    """``n`` pages of one record, then empty ones; the page parameter starts at 1."""
    notes = notes and str(notes)

    def fetch(url, params, headers):
        page = int(params["page"]) - 1
        if notes:
            with open(notes, "a") as f:
                f.write(f"{page}\n")
        if broken is not None and page >= broken:
            return Response(status=404, body="")
        rows = [{"id": page}] if page < n and page not in blank else []
        return Response(body=json.dumps({"data": rows}))

    return fetch


def pull(stripes=4, **paging):
    return Pull("p", "https://h/a", paging={"mode": "page", **paging}, parse=PARSE, stripes=stripes)


@pytest.mark.parametrize("n", [0, 1, 2, 3, 7, 8, 9, 100, 1000, 4097])
def test_the_first_empty_page_in_few_requests(n):
    end, requests = first_empty(pull(), pages(n))
    assert end == n and requests <= 2 * math.log2(n + 2) + 2


@pytest.mark.parametrize(("cap", "want"), [(5, 5), (1, 1), (50, 20)])
def test_a_cap_bounds_the_search(cap, want):
    assert first_empty(pull(max_pages=cap), pages(20))[0] == want


def test_pages_that_fail_end_the_search():
    assert first_empty(pull(), pages(100, broken=37))[0] == 37


@pytest.mark.parametrize("stripes", [1, 3, 8, 40])
@pytest.mark.parametrize("n", [0, 1, 5, 17])
def test_ranges_cover_what_a_sequential_reader_sees(n, stripes):
    p = Pull(**{**pull(stripes).__dict__, "end": n})
    parts = min(stripes, n + 1)
    seen = [page for s in range(parts) for page, *_ in walk(p, pages(n), s)]
    assert seen == list(range(n + 1))


def test_no_more_than_the_search_goes_past_the_end(spark, tmp_path):
    notes, n = tmp_path / "notes", 300
    fetch = pages(n, notes=notes)
    found = with_ends(spark, [pull(8)], fetch)
    assert found[0].end == n
    landed = read_pulls(spark, found, fetch)
    assert sorted(r.page_seq for r in landed.select("page_seq").collect()) == list(range(n + 1))
    past = [int(x) for x in notes.read_text().split() if int(x) > n]
    assert len(past) <= 2 * math.log2(n)


@pytest.mark.parametrize("blank", [(), (11,)])
def test_a_run_gives_the_same_rows(spark, tmp_path, blank):
    config = {
        "envs": {"qa": {"base_url": "https://h"}},
        "apis": {"output": {"format": "parquet", "path": f"{tmp_path}/out"}, "t": {"path": "v1", "parse": PARSE, "pagination": {"mode": "page", "stripes": 3, "gallop": True}}},
    }
    told = Ingest(spark, config, pages(23, blank)).run_once("t", "qa")
    rows = spark.read.parquet(told["path"])
    assert sorted(r.id for r in rows.collect()) == list(range(11 if blank else 23))
