from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pageloom.functions import scalars as X


def one(spark, col, **values):
    df = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])
    return df.select(col.alias("out")).first()["out"]


def test_dig(spark):
    doc = '{"a":{"b":{"c":5}},"l":[{"c":1}],"n":null}'
    at = lambda p: one(spark, X.dig(F.col("d"), p), d=doc)
    assert at("a.b.c") == "5"
    assert [at(p) for p in ("a.x.c", "l.c", "n.c", "n", "", None)] == [None] * 6


def test_row_path(spark):
    df = spark.sql("SELECT 1 AS flat, named_struct('inner', named_struct('leaf', 2)) AS root, "
                   "'{\"x\":3}' AS raw, 4 AS `root.inner`")
    read = lambda p: df.select(X.row_path(df, p)).first()[0]
    assert (read("flat"), read("root.inner.leaf"), read("raw.x"), read("root.inner")) == (
        1, 2, "3", 4,
    )
    assert X.row_path(df, "root.none") is None and X.row_path(df, "flat.x") is None


@pytest.mark.parametrize(
    ("ref", "out"),
    [
        ("/n/2", "https://h:8/n/2"),
        ("n/2", "https://h:8/n/2"),
        ("//o/x", "https://o/x"),
        ("http://z/y", "http://z/y"),
        ("?q=1", "https://h:8/?q=1"),
    ],
)
def test_resolve_url(spark, ref, out):
    assert one(spark, X.resolve_url(F.col("b"), F.col("r")), b="https://h:8/a/b?c", r=ref) == out


def test_build_url():
    assert X.build_url("https://h/api", "/v1/x") == "https://h/api/v1/x"
    assert X.build_url("https://h/api/", "") == "https://h/api/"


@pytest.mark.parametrize(
    ("head", "out"),
    [
        ('<u>; rel="next"', "u"),
        ("<u>; rel=next", "u"),
        ('<a>; rel="prev", <u>; title="x, y"; rel="next"; k="v"', "u"),
        ('<a>; rel="prev"', None),
        ('<a>; rel="nextish"', None),
        ("", None),
    ],
)
def test_next_link(spark, head, out):
    from pageloom.sources.paged import next_of

    assert one(spark, X.next_link(F.col("h")), h=head) == out
    assert next_of({"LINK": head}) == out


def test_session_id(spark):
    at = lambda p, g=0: one(spark, X.session_id(F.col("u"), p, g), u="http://h/s- 42 /x")
    assert at(r"s-([^/]*)", 1) == "42"
    assert at(r"(?<=s-)[^/]*") == "42"
    assert at(r"s-(?P<the_id>[^/]*)", 1) == "42"
    assert [at("zzz"), at("s-", 3), at(None), at(r"s-(q?)", 1)] == [None] * 4


@pytest.mark.parametrize(
    ("text", "out"),
    [
        ("2024-01-02T03:04:05Z", datetime(2024, 1, 2, 3, 4, 5)),
        ("2024-01-02T03:04:05+02:00", datetime(2024, 1, 2, 1, 4, 5)),
        ("2024-01-02 03:04:05.25", datetime(2024, 1, 2, 3, 4, 5, 250000)),
        ("2024-01-02", datetime(2024, 1, 2)),
        ("12:30", None),
        ("soon", None),
        ("2024-13-45", None),
        (None, None),
    ],
)
@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_coerce_ts(spark, text, out, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame([(text,)], "t string")
        assert df.select(X.utc_ntz(X.coerce_ts(F.col("t"), T.StringType()))).first()[0] == out
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_coerce_ts_numbers_are_nanoseconds(spark):
    col = X.utc_ntz(X.coerce_ts(F.col("n"), T.LongType()))
    assert one(spark, col, n=1_704_164_645_000_000_000) == datetime(2024, 1, 2, 3, 4, 5)


def test_formats(spark):
    when = datetime(2024, 3, 5, 7, 8, 9)
    for fmt in ("%Y-%m-%dT%H:%M:%SZ", "%d/%m/%y", "year=%Y 100%%", "o'clock %I %p", "%j %b %A"):
        assert one(spark, X.format_date(F.col("t").cast("timestamp_ntz"), fmt), t=str(when)) == (
            when.strftime(fmt)
        )
    with pytest.raises(ValueError, match="%Q"):
        X.spark_pattern("%Q")


def test_stringify(spark):
    df = spark.sql("SELECT named_struct('a', 1, 'b', CAST(NULL AS INT)) s, array(1, 2) l, "
                   "map('k', 1) m, 5 n, CAST(NULL AS ARRAY<INT>) z, 'é' t")
    assert tuple(X.stringify_nested(df).first()) == ('{"a":1}', "[1,2]", '{"k":1}', 5, None, "é")
    assert X.stringify_nested(df, keep_nulls=True).first()["s"] == '{"a":1,"b":null}'


def test_redact(spark):
    m = F.create_map(*[F.lit(x) for x in ("AuthoriZation", "s", "Accept", "j")])
    assert one(spark, X.redact(m, X.SECRET_HEADERS)) == {
        "AuthoriZation": "***REDACTED***",
        "Accept": "j",
    }


def test_templates(spark):
    values = {"table": "t", "env": "qa", "now": datetime(2024, 3, 5), "today": datetime(2024, 3, 5)}
    text = "{env}/{table}/{today:%Y/%m}/{session_id}-{now:%Y%m%dT%H%M%SZ}"
    assert X.render(text, values) == "qa/t/2024/03/none-20240305T000000Z"
    assert one(spark, X.render_column(text, values)) == X.render(text, values)
    col = X.render_column("{session_id}_{seq}", {"session_id": F.col("s"), "seq": F.lit(7)})
    assert one(spark, col, s="abc") == "abc_7"
    with pytest.raises(KeyError):
        X.render_column("{nope}", {})


def test_merge_params(spark):
    a = F.create_map(F.lit("x"), F.lit("1"), F.lit("y"), F.lit("2"))
    b = F.create_map(F.lit("y"), F.lit("3"))
    assert one(spark, X.merge_params(a, b)) == {"x": "1", "y": "3"}
    assert one(spark, X.merge_params(F.lit(None).cast("map<string,string>"), b)) == {"y": "3"}
