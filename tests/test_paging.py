from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from pageloom.operators import paging
from pageloom.operators.parse import ParseSpec, parse
from pageloom.plans.frames import cursor_records
from pageloom.sources.paged import Pull, walk
from pageloom.sources.transports import Response

DATA = ParseSpec(record_path="data")


def data(*ids, **more):
    return {"data": [{"id": i} for i in ids], **more}


def ids(values, responses, spec=DATA):
    return values(parse(responses, spec), "_page_seq", "id")


def test_single_page_only(land, values):
    assert ids(values, paging.trim(land(data(1, 2), data(3)), {}, DATA)) == [(0, 1), (0, 2)]


def test_page_stops_at_first_empty(land, values):
    kept = paging.trim(land(data(1), data(2), data(), data(4)), {"mode": "page"}, DATA)
    assert ids(values, kept) == [(0, 1), (1, 2)]


@pytest.mark.parametrize("blank", [{"data": [{}]}, {"data": None}, {"other": 1}, {"data": "x"}])
def test_shapes_that_count_as_empty(land, values, blank):
    kept = paging.until_empty(land(data(1), blank, data(3)), DATA)
    assert ids(values, kept) == [(0, 1)]


def test_page_with_only_dropped_keys_is_empty(land):
    spec = ParseSpec(record_path="data", drop_keys=("attributes",))
    page = {"data": [{"attributes": {"x": 1}}]}
    assert paging.until_empty(land(page), spec).count() == 0


def test_page_cap_comes_before_the_empty_test(land, values):
    kept = paging.trim(land(data(1), data(2), data(3)), {"mode": "page", "max_pages": 2}, DATA)
    assert ids(values, kept) == [(0, 1), (1, 2)]


def cursor_pages(*steps):
    """(token that asks for the page, id, token it names)."""
    return [
        {"body": data(i, meta={"next": nxt}), "params": {"cursor": at} if at else {}}
        for at, i, nxt in steps
    ]


@pytest.mark.parametrize("end", [None, "", 0, False])
def test_cursor_ends_on_falsy_token(land, values, end):
    pages = cursor_pages((None, 1, "a"), ("a", 2, end), ("b", 3, None))
    kept = paging.follow_cursor(land(*pages), "meta.next")
    assert ids(values, kept) == [(0, 1), (1, 2)]


def test_cursor_text_zero_goes_on(land, values):
    pages = cursor_pages((None, 1, "0"), ("0", 2, None))
    assert ids(values, paging.follow_cursor(land(*pages), "meta.next")) == [(0, 1), (1, 2)]


def test_cursor_number_token(land, values):
    pages = cursor_pages((None, 1, 7), ("7", 2, None))
    assert ids(values, paging.follow_cursor(land(*pages), "meta.next")) == [(0, 1), (1, 2)]


@pytest.fixture(params=["short", "long"])
def any_length(request, monkeypatch):
    """Chains walked within a task, and the same chains by pointer doubling."""
    if request.param == "long":
        monkeypatch.setattr(paging, "SHORT_CHAIN", 0)


def test_cursor_out_of_landing_order(land, values, any_length):
    pages = cursor_pages(
        (None, 1, "c"), ("a", 3, "b"), ("b", 4, None), ("c", 2, "a"), ("x", 9, "y")
    )
    kept = paging.follow_cursor(land(*pages), "meta.next")
    assert ids(values, kept) == [(0, 1), (1, 2), (2, 3), (3, 4)]


def test_cursor_cycle_repeats_up_to_the_cap(land, values, any_length):
    pages = cursor_pages((None, 1, "a"), ("a", 2, "b"), ("b", 3, "a"))
    kept = paging.follow_cursor(land(*pages), "meta.next", max_pages=6)
    assert ids(values, kept) == [(0, 1), (1, 2), (2, 3), (3, 2), (4, 3), (5, 2)]


def test_cursor_cycle_without_a_cap_is_an_error(land, any_length):
    pages = cursor_pages((None, 1, "a"), ("a", 2, "b"), ("b", 3, "a"))
    with pytest.raises(Exception, match="without a cap"):
        paging.follow_cursor(land(*pages), "meta.next").collect()


def test_a_chain_that_stopped_early_is_not_walked(land, values, monkeypatch):
    def walked(*_):
        raise AssertionError("the chain is in order")

    monkeypatch.setattr(paging, "_walked", walked)
    pages = cursor_pages((None, 1, "a"), ("a", 2, "never asked"))
    assert ids(values, paging.follow_cursor(land(*pages), "meta.next")) == [(0, 1), (1, 2)]


def test_reached_cap(land):
    page = {"mode": "page", "max_pages": 2}
    assert paging.reached_cap(land(data(1), data(2), data(3)), page, DATA)
    assert not paging.reached_cap(land(data(1), data()), page, DATA)
    assert not paging.reached_cap(land(data(1), data(2)), {"mode": "page"}, DATA)
    cursor = {"mode": "cursor", "next_cursor_path": "meta.next", "max_pages": 2}
    assert paging.reached_cap(land(*cursor_pages((None, 1, "a"), ("a", 2, "b"))), cursor, DATA)
    assert not paging.reached_cap(land(*cursor_pages((None, 1, "a"), ("a", 2, None))), cursor, DATA)


def test_cursor_cap(land, values):
    pages = cursor_pages((None, 1, "a"), ("a", 2, "b"), ("b", 3, None))
    assert ids(values, paging.follow_cursor(land(*pages), "meta.next", max_pages=2)) == [
        (0, 1),
        (1, 2),
    ]


def test_cursor_seed(land, values, any_length):
    pages = cursor_pages((None, 1, "a"), ("a", 2, "b"), ("b", 3, None))
    assert ids(values, paging.follow_cursor(land(*pages), "meta.next", start="a")) == [
        (0, 2),
        (1, 3),
    ]


def test_request_landed_twice_is_an_error(land, any_length):
    pages = cursor_pages((None, 1, "b"), ("a", 2, None), ("b", 3, "a"), ("a", 4, None))
    with pytest.raises(Exception, match="landed more than once"):
        paging.follow_cursor(land(*pages), "meta.next").collect()


def test_many_chains_at_once(land, values, any_length):
    a = land(*cursor_pages((None, 1, "x"), ("x", 2, None)), pull="a")
    b = land(*cursor_pages((None, 3, "x"), ("y", 4, None), ("x", 5, "y")), pull="b")
    kept = paging.follow_cursor(a.unionAll(b), "meta.next")
    rows = values(parse(kept, DATA), "_pull", "_page_seq", "id")
    assert rows == [("a", 0, 1), ("a", 1, 2), ("b", 0, 3), ("b", 1, 5), ("b", 2, 4)]


def test_long_shuffled_chain(spark, values, any_length):
    """One chain of 500 pages in no order, next to many chains of two pages."""
    order = [(i * 211) % 500 for i in range(500)]
    rows = [("a", 0, n, f"t{i}", f"t{i + 1}" if i < 499 else None) for n, i in enumerate(order)]
    rows += [(f"b{i}", 0, 1 - j, f"t{j}", None if j else "t1") for i in range(40) for j in (0, 1)]
    edges = spark.createDataFrame(
        rows, "pull string, window_seq int, page_seq int, key string, next string"
    )
    facts = edges.groupBy("pull", "window_seq").agg(F.count("*").alias("_pages"))
    facts = facts.withColumn("key", F.lit("t0"))
    got = values(paging._walked(edges, facts, 10_000), "pull", "depth", "key")
    expected = [("a", i, f"t{i}") for i in range(500)]
    expected += [(f"b{i}", j, f"t{j}") for i in range(40) for j in (0, 1)]
    assert got == sorted(expected)


def test_link_header(land, values):
    pages = [
        {"body": data(1), "url": "https://h/1", "headers": {"link": '<https://h/2>; rel="next"'}},
        {"body": data(2), "url": "https://h/2", "headers": {"Link": '<https://h/1>; rel="prev"'}},
        {"body": data(3), "url": "https://h/3"},
    ]
    assert ids(values, paging.follow_headers(land(*pages))) == [(0, 1), (1, 2)]


DONE = ParseSpec(record_path="records", drop_keys=("attributes",))


def done_page(url, i, **more):
    rows = [] if i is None else [{"id": i, "attributes": {"t": "x"}}]
    return {"body": {"records": rows, **more}, "url": url}


def test_done_flag_chain(land, values):
    pages = [
        done_page("https://h/q", 1, done=False, nextRecordsUrl="/q/1"),
        done_page("https://h/q/1", None, done=False, nextRecordsUrl="q/2"),
        done_page("https://h/q/2", 2, done=True, nextRecordsUrl="/q/3"),
        done_page("https://h/q/3", 3, done=True),
    ]
    kept = paging.records_of(land(*pages), {"mode": "salesforce"}, DONE)
    assert values(kept, "_page_seq", "id") == [(0, 1), (2, 2)]
    assert "attributes" not in kept.columns


@pytest.mark.parametrize(
    ("flag", "goes_on"),
    [({}, False), ({"done": True}, False), ({"done": None}, True), ({"done": "true"}, True),
     ({"done": 1}, True), ({"done": False}, True)],
)
def test_done_flag_is_literal(land, values, flag, goes_on):
    pages = [
        done_page("https://h/q", 1, nextRecordsUrl="/q/1", **flag),
        done_page("https://h/q/1", 2, done=True),
    ]
    kept = paging.records_of(land(*pages), {"mode": "salesforce"}, DONE)
    assert values(kept, "id") == ([1, 2] if goes_on else [1])


def test_chain_field(land, values):
    pages = [
        {"body": data("a", "b")},
        {"body": data("c"), "params": {"cursor": "b"}},
        {"body": data(), "params": {"cursor": "c"}},
        {"body": data("z"), "params": {"cursor": "q"}},
    ]
    rows = cursor_records(land(*pages), {"chain_field": "id"}, {}, DATA)
    assert values(rows, "_page_seq", "id") == [(0, "a"), (0, "b"), (1, "c")]


def test_chain_field_that_no_row_has(land, values):
    rows = cursor_records(land(data(1), data(2)), {"chain_field": "nope"}, {}, DATA)
    assert values(rows, "id") == [1]


def test_status_guard(land):
    pages = [data(1), {"body": data(2), "status": 503}]
    good, bad = paging.split_status(land(*pages))
    assert (good.count(), bad.count()) == (1, 1)
    with pytest.raises(Exception, match="status 503"):
        paging.guard_status(land(*pages)).collect()


def test_assign_pages(spark, values):
    df = spark.range(0, 23).selectExpr("22 - id AS k")
    pages = paging.assign_pages(df, ["k"], 10)
    assert values(pages, "k", "page_seq", "row_seq") == [(k, k // 10, k % 10) for k in range(23)]
    with pytest.raises(ValueError, match="positive"):
        paging.assign_pages(df, ["k"], 0)


def test_unknown_mode():
    with pytest.raises(ValueError, match="paging mode"):
        paging.check_mode("offset")


# ---- the requests themselves -------------------------------------------------


def replay(answers):
    """Answers in order; remembers what was asked."""
    asked, left = [], list(answers)

    def fetch(url, params, headers):
        asked.append((url, params))
        return left.pop(0)

    return fetch, asked


def body(text, **headers):
    import json

    return Response(200, headers, text if isinstance(text, str) else json.dumps(text))


PARSE = {"json_record_path": "data"}


def run(pull, *answers):
    fetch, asked = replay(answers)
    pages = [n for n, *_ in walk(pull, fetch)]
    return pages, asked


def test_walk_page_numbers_and_size():
    paging_options = {
        "mode": "page", "start_page": 3, "page_size_param": "limit", "page_size_value": 2,
    }
    pull = Pull("p", "https://h/a", {"k": "v"}, paging=paging_options, parse=PARSE)
    pages, asked = run(pull, body(data(1)), body(data(2)), body(data()))
    assert pages == [0, 1, 2]
    assert [p for _, p in asked] == [{"k": "v", "limit": 2, "page": n} for n in (3, 4, 5)]


def test_walk_page_number_given_by_caller():
    pull = Pull("p", "u", {"page": 9}, paging={"mode": "page", "start_page": 3}, parse=PARSE)
    assert [p["page"] for _, p in run(pull, body(data(1)), body(data()))[1]] == [9, 10]


def test_walk_stripes_cover_what_a_single_reader_sees():
    paging_options = {"mode": "page"}
    bodies = [data(n) if n < 5 else data() for n in range(40)]

    def fetch(url, params, headers):
        return body(bodies[params["page"] - 1])

    pull = Pull("p", "u", paging=paging_options, parse=PARSE, stripes=3)
    seen = sorted(n for s in range(3) for n, *_ in walk(pull, fetch, s))
    assert seen == [0, 1, 2, 3, 4, 5, 6, 7]


def test_walk_cursor_keeps_url_and_adds_token():
    pull = Pull(
        "p", "u", paging={"mode": "cursor", "next_cursor_path": "meta.next"}, parse=PARSE
    )
    _, asked = run(pull, body(data(1, meta={"next": "t"})), body(data(2)))
    assert asked == [("u", {}), ("u", {"cursor": "t"})]


def test_walk_clears_params_after_the_first_page():
    pull = Pull("p", "https://h/q", {"q": "x"}, paging={"mode": "salesforce"})
    first = {"done": False, "nextRecordsUrl": "/q/2", "records": []}
    _, asked = run(pull, body(first), body({"done": True, "records": []}))
    assert asked == [("https://h/q", {"q": "x"}), ("https://h/q/2", {})]


def test_walk_link_header_and_error_status():
    pull = Pull("p", "https://h/1", paging={"mode": "link-header"})
    link = '<https://h/2>; rel="next"'
    pages, asked = run(pull, body("{}", Link=link), Response(500, {"Link": link}, ""))
    assert [u for u, _ in asked] == ["https://h/1", "https://h/2"]
    assert pages == [0, 1]


def test_walk_cursor_backfill_seed_chain_and_stop():
    options = {"mode": "cursor", "chain_field": "id"}
    stop = {"start_value": "s", "stop_at_item": {"field": "id", "value": 4}}
    pull = Pull("p", "u", paging=options, parse=PARSE, cursor=stop)
    _, asked = run(pull, body(data(1, 2)), body(data(3, 4)))
    assert [p["cursor"] for _, p in asked] == ["s", 2]


def test_walk_stops_when_rows_are_old():
    options = {"next_cursor_path": "meta.next"}
    stop = {"stop_when_older_than": {"field": "at", "value": "2024-01-02T00:00:00Z"}}
    pull = Pull("p", "u", paging=options, parse=PARSE, cursor=stop)
    page = {"data": [{"at": "2024-01-01T00:00:00Z"}], "meta": {"next": "t"}}
    assert run(pull, body(page))[0] == [0]


def test_walk_stops_by_parts_of_a_second():
    options = {"next_cursor_path": "meta.next"}
    stop = {"stop_when_older_than": {"field": "at", "value": "2024-01-02T00:00:00Z"}}
    pull = Pull("p", "u", paging=options, parse=PARSE, cursor=stop)
    pages = [
        {"data": [{"at": at}], "meta": {"next": "t"}}
        for at in ("2024-01-02T00:00:00.000000Z", "2024-01-02T00:00:00.5Z", "2024-01-01T23:59:59.999999Z")
    ]
    assert run(pull, *[body(p) for p in pages])[0] == [0, 1, 2]


def test_walk_cap():
    pull = Pull("p", "u", paging={"mode": "page", "max_pages": 2}, parse=PARSE)
    assert run(pull, body(data(1)), body(data(2)), body(data(3)))[0] == [0, 1]


def test_csv_cells_of_any_length_go_on():
    pull = Pull("p", "u", paging={"mode": "page"}, parse={"type": "csv"})
    assert run(pull, body("a\n" + "x" * 200_000), body("a\n"))[0] == [0, 1]
