from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from pageloom.operators import links as L
from pageloom.operators.parse import ParseSpec
from pageloom.sources.transports import Response

HEAD = "_pull string, _window_seq int, _page_seq int, _row_seq int, "


@pytest.fixture
def base(spark):
    def make(*rows, ddl="u1 string, u2 string"):
        keyed = [("p", w, 0, i, *rest) for i, (w, *rest) in enumerate(rows)]
        return spark.createDataFrame(keyed, HEAD + ddl)

    return make


@pytest.fixture
def details(land):
    def make(bodies):
        return land(*[{"body": b, "url": u, "page_seq": 0} for u, b in bodies.items()])

    return make


def test_collect_in_field_order(spark):
    df = spark.sql(
        "SELECT 'p' _pull, 0 _window_seq, 0 _page_seq, id _row_seq, "
        "CASE id WHEN 0 THEN 'http://a' WHEN 1 THEN 'ftp://b' END u, "
        "named_struct('self', 'https://s', 'n', 5) links FROM range(3)"
    )
    got = L.collect_links(df, L.LinkSpec(("u", "links.self", "links.n", "links.none", "zz")))
    assert sorted((r["_row_seq"], r["_url_idx"], r["url"], r["_links"]) for r in got.collect()) == [
        (0, 0, "http://a", 2),
        (0, 1, "https://s", 2),
        (1, 0, "https://s", 1),
        (2, 0, "https://s", 1),
    ]


def test_payload_replaces_rows(base, details, values):
    df = base((0, "http://a", None), (0, None, None), (0, "http://b", None))
    answers = details({"http://a": {"v": 1}, "http://b": {"v": 2}})
    out = L.expand_links(df, answers, L.LinkSpec(("u1",)), ParseSpec(record_path="rows"))
    assert values(out, "_row_seq", "v") == [(0, 1), (2, 2)]
    assert "u1" not in out.columns


def test_nothing_to_expand_returns_the_rows(base, details):
    df = base((0, "x", None))
    assert L.expand_links(df, details({}), L.LinkSpec(("u1",)), ParseSpec()) is df
    assert L.expand_links(df, details({}), L.LinkSpec(()), ParseSpec()) is df


def test_units_without_links_keep_their_rows(base, details, values):
    df = base((0, "http://a", "k0"), (0, None, "k1"), (1, None, "k2"))
    answers = details({"http://a": [{"v": 1}, {"v": 2}]})
    out = L.expand_links(df, answers, L.LinkSpec(("u1",)), ParseSpec(), ["_window_seq"])
    assert values(out, "_window_seq", "v", "u2") == [(0, 1, None), (0, 2, None), (1, None, "k2")]


def test_two_payloads_side_by_side(base, details, values):
    df = base((0, "http://a", "http://b"))
    answers = details({"http://a": [{"A": 1}, {"A": 2}], "http://b": [{"B": 9}]})
    out = L.expand_links(df, answers, L.LinkSpec(("u1", "u2")), ParseSpec())
    assert values(out, "A", "B") == [(1, 9), (2, None)]


def test_shared_columns_get_suffixes(base, details, values):
    df = base((0, "http://a", "http://b"), (0, None, "http://b"))
    answers = details({"http://a": [{"k": 1, "a": 5}], "http://b": [{"k": 2}]})
    out = L.expand_links(df, answers, L.LinkSpec(("u1", "u2")), ParseSpec())
    assert values(out, "_row_seq", "k", "k_x", "k_y", "a") == [
        (0, None, 1, 2, 5),
        (1, 2, None, None, None),
    ]


def test_names_of_three_and_four_payloads():
    fills = {"k": [0, 1, 2, 3]}
    assert list(L._positional_names(fills, 3)) == ["k_x", "k_y", "k"]
    assert sorted(L._positional_names(fills, 4)) == ["k_3", "k_4", "k_x", "k_y"]


def test_type_override_and_inheritance(base, details, values):
    df = base((0, "http://a", None))
    answers = details({"http://a": '{"k":1}\n{"k":2}'})
    spec = L.LinkSpec(("u1",), type="jsonl")
    parse = ParseSpec(record_path="rows", drop_keys=("attributes",))
    assert values(L.expand_links(df, answers, spec, parse), "k") == [1, 2]
    assert L.LinkSpec(("u",)).parse_spec(parse) == ParseSpec(drop_keys=("attributes",))
    assert L.LinkSpec(("u",), record_path="r").parse_spec(parse).record_path == "r"


def test_shared_url_is_fetched_once(spark, base):
    df = base(*[(0, "http://same", None)] * 5, (0, "http://other", None))
    links = L.collect_links(df, L.LinkSpec(("u1",)))

    def fetch(url, params, headers):
        return Response(200, {"X": "1"}, json.dumps([{"u": url}]))

    got = L.fetch_links(links, fetch)
    assert sorted(r["url"] for r in got.collect()) == ["http://other", "http://same"]
    out = L.expand_links(df, got, L.LinkSpec(("u1",)), ParseSpec())
    assert out.groupBy("u").count().where("u = 'http://same'").first()["count"] == 5


@pytest.fixture
def sids(spark):
    def make(*ids):
        rows = [("p", 0, 0, i, 0, s) for i, s in enumerate(ids)]
        return spark.createDataFrame(rows, HEAD + "_url_idx int, session_id string")

    return make


@pytest.mark.parametrize(
    ("policy", "expected"), [("first", "s2"), ("last", "s1"), ("all", "s1,s2,s3")]
)
def test_session_policy(sids, policy, expected):
    links = sids(None, "s2", "s3", "s2", "s1", None)
    assert L.resolve_session(links, policy).first()["session_id"] == expected


def test_require_single(sids):
    assert L.resolve_session(sids("a", "a"), "require_single").first()["session_id"] == "a"
    with pytest.raises(Exception, match="more than one session id"):
        L.resolve_session(sids("a", "b"), "require_single").collect()


def test_no_session_at_all(sids):
    for policy in ("first", "all"):
        row = L.resolve_session(sids(None), policy).first()
        assert not (row and row["session_id"])


def test_session_order(base, details, values):
    df = base((0, "http://b/2", None), (0, "http://a/1", None), (0, "http://c", None))
    spec = L.LinkSpec(("u1",), session_regex=r"/(\d)", session_group=1)
    links = L.collect_links(df, spec)
    answers = details({u: {"v": u} for u in ("http://b/2", "http://a/1", "http://c")})
    rows = L.session_groups(L.link_payload(links, answers, spec, ParseSpec()))
    assert values(L.session_order(rows), "_session_seq", "_session_id") == [
        (0, "2"),
        (1, "1"),
        (2, "none"),
    ]


def test_number_links(base):
    df = base((0, "http://b", "http://c"), (0, "http://a", None))
    got = L.number_links(L.collect_links(df, L.LinkSpec(("u1", "u2")))).orderBy("_seq")
    assert [(r["_seq"], r["url"]) for r in got.collect()] == [
        (1, "http://b"),
        (2, "http://c"),
        (3, "http://a"),
    ]


def test_options():
    assert L.LinkSpec.from_options({"url_fields": ["u"]}) is None
    spec = L.LinkSpec.from_options(
        {"enabled": True, "url_fields": ["u"], "flush": {"mode": "PER_LINK", "only": True}}
    )
    assert (spec.flush, spec.flush_only) == ("per_link", True)
    with pytest.raises(ValueError, match="flush mode"):
        L.LinkSpec(flush="sometimes")
    with pytest.raises(ValueError, match="session policy"):
        L.LinkSpec(session_policy="random")


def test_hot_url_is_split(spark, monkeypatch):
    from pageloom.operators import skew

    monkeypatch.setattr(skew, "HOT_ROWS", 20)
    base = spark.range(200).selectExpr(
        "'p' _pull", "0 _window_seq", "0 _page_seq", "int(id) _row_seq",
        "if(id % 3 = 0, 'http://hot', concat('http://u', id)) u",
    )
    urls = base.select("u").distinct()
    answers = urls.select(
        F.lit("link").alias("pull"), F.lit(0).alias("window_seq"), F.lit(0).alias("page_seq"),
        F.col("u").alias("url"), F.to_json(F.array(F.struct("u"), F.struct("u"))).alias("body"),
    )
    out = L.expand_links(base, answers, L.LinkSpec(("u",)), ParseSpec())
    assert out.count() == 400
    assert out.where("u = 'http://hot'").select("_row_seq").distinct().count() == 67
