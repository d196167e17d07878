from __future__ import annotations

import csv
import io

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pageloom.operators import schemas
from pageloom.operators.parse import NA_TEXTS, ParseSpec, parse
from pageloom.operators.schemas import infer_json, prune, union_widened, widen


def test_record_path_missing_or_falsy(land, values):
    pages = [{"a": {"b": [{"x": 1}]}}, {"a": {}}, {"a": None}, {"a": False}, {"a": {"b": None}}, {}]
    rows = parse(land(*pages), ParseSpec(record_path="a.b"))
    assert values(rows, "_page_seq", "_row_seq", "x") == [(0, 0, 1)]


def test_record_path_nowhere(land):
    assert parse(land({"a": 1}), ParseSpec(record_path="x.y")).count() == 0


def test_scalar_or_null_at_the_path_gives_no_rows(land):
    rows = parse(land({"d": 5}, {"d": None}, {"d": "text"}), ParseSpec(record_path="d"))
    assert rows.count() == 0


def test_list_keeps_nested_objects(land, values):
    rows = parse(land([{"a": {"b": 1}}, {"c": 2}]), ParseSpec())
    assert isinstance(rows.schema["a"].dataType, T.StructType)
    assert values(rows, "_row_seq", "c") == [(0, None), (1, 2)]


def test_object_is_flattened_lists_stay(land):
    row = parse(land({"d": {"a": {"b": {"c": 1}}, "l": [{"q": 1}]}}), ParseSpec(record_path="d"))
    assert row.columns[-2:] == ["a.b.c", "l"]
    assert row.select("`a.b.c`").first()[0] == 1


def test_lists_and_objects_on_different_pages(land, values):
    rows = parse(land({"d": [{"x": 1}, {"x": 2}]}, {"d": {"x": 3}}), ParseSpec(record_path="d"))
    assert values(rows, "_page_seq", "_row_seq", "x") == [(0, 0, 1), (0, 1, 2), (1, 0, 3)]


def test_scalar_list(land, values):
    rows = parse(land({"d": [5, 6]}), ParseSpec(record_path="d"))
    assert values(rows, "_row_seq", "value") == [(0, 5), (1, 6)]


def test_drop_keys_any_depth(land):
    page = {"meta": {"attributes": 1}, "o": {"i": [{"x": 1, "attributes": {"x": 2}}]}}
    rows = parse(land(page), ParseSpec(record_path="o.i", drop_keys=("attributes",)))
    assert rows.columns[-1] == "x"
    gone = ParseSpec(record_path="o.i", drop_keys=("o",))
    assert parse(land(page), gone).count() == 0


def test_int_with_gaps_stays_whole(land, values):
    rows = parse(land([{"a": 1}, {"a": None}], [{"a": 3}]), ParseSpec())
    assert rows.schema["a"].dataType == T.LongType()


def test_types_are_widened_over_pages(land, values):
    rows = parse(land([{"a": 1, "b": 1}], [{"a": "x", "b": 1.5, "c": True}]), ParseSpec())
    assert values(rows, "a", "b", "c") == [("1", 1.0, None), ("x", 1.5, True)]


def test_mixed_cell_is_json_text(land, values):
    rows = parse(land([{"a": 1}, {"a": {"k": 1}}, {"a": "s"}]), ParseSpec())
    assert values(rows, "a") == ["1", "s", '{"k":1}']


def test_jsonl(land, values):
    rows = parse(land('{"a":1}\n\n {"a":2}\r\n', "  \n"), ParseSpec("ndjson", record_path="zzz"))
    assert values(rows, "_page_seq", "_row_seq", "a") == [(0, 0, 1), (0, 1, 2)]


def test_jsonl_keeps_json_types(land, values):
    rows = parse(land('{"date":"2024-01-01","n":"007"}'), ParseSpec("jsonl"))
    assert values(rows, "date", "n") == [("2024-01-01", "007")]


def test_csv_plain_and_quoted(land, values):
    pages = ["x,y\n1,a\n2,NA\n", 'y,x\n"q, ""w""\nz",3\n', "x,y\n"]
    rows = parse(land(*pages), ParseSpec("csv"))
    assert values(rows, "_page_seq", "x", "y") == [(0, 1, "a"), (0, 2, None), (1, 3, 'q, "w"\nz')]


def test_csv_types(land, values):
    text = "n,f,b,s,e\n007,1e3,True,5d,\n-2,.5,false,x,\n"
    rows = parse(land(text), ParseSpec("csv"))
    assert values(rows, "n", "f", "b", "s", "e") == [
        (-2, 0.5, False, "x", None),
        (7, 1000.0, True, "5d", None),
    ]


def test_csv_short_rows_and_missing_columns(land, values):
    rows = parse(land("a,b\n1\n", "b\n2\n"), ParseSpec("csv"))
    assert values(rows, "a", "b") == [(1, None), (None, 2)]


@pytest.mark.parametrize(
    "body",
    [
        'a,b\n"x,1","y""z"\n', 'a,b\r\n"l1\r\nl2",3\r\n\r\n"",4', 'a,b\n"q"r,s"t\n', 'a,b\n,"x"\n"x",\n', 'a,b\n"never closed, 1\n2,3',
        '"a","b c"\n1,"2"', '\n\n"a",b\n"1",2', 'a,b\n"' + "long,\n" * 40_000 + '",1', 'a\n"' + '""' * 20_000 + '"',
    ],
)
def test_csv_cells_are_those_of_the_csv_module(land, body):
    csv.field_size_limit(1 << 30)
    head, *lines = [r for r in csv.reader(io.StringIO(body, newline="")) if r]
    spec = ParseSpec("csv", schema="struct<" + ",".join(f"`{h}`:string" for h in head) + ">")
    rows = sorted(parse(land(body), spec).collect(), key=lambda r: r["_row_seq"])
    assert [[r[h] or "" for h in head] for r in rows] == [
        [c if c not in NA_TEXTS else "" for c in [*x, *[""] * len(head)][: len(head)]] for x in lines
    ]


def test_csv_keeps_duplicate_names_and_the_order_of_columns(land):
    rows = parse(land("z,a,a,m,a\n1,2,3,4,5\n", "b,z\n6,7\n"), ParseSpec("csv"))
    names = [c for c in rows.columns if not c.startswith("_")]
    assert names == ["z", "a", "a.1", "m", "a.2", "b"]
    assert [[r[n] for n in names] for r in rows.orderBy("_page_seq").collect()] == [
        [1, 2, 3, 4, 5, None], [7, None, None, None, None, 6]
    ]
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" not in plan


def test_unknown_type():
    with pytest.raises(ValueError, match="parse type"):
        ParseSpec("xml")
    assert ParseSpec("JSON").family == "json"


def test_strict_refuses_malformed(land):
    pages = land("[{\"a\":1}]", "{oops")
    assert parse(pages, ParseSpec()).count() == 1
    with pytest.raises(ValueError, match="not JSON"):
        parse(pages, ParseSpec(strict=True))


def test_a_key_that_occurs_twice(land, values):
    rows = parse(land('[{"a":1,"a":2},{"a":3}]'), ParseSpec(strict=True))
    assert values(rows, "a") == [2, 3]


def test_large_texts_are_taken_apart(spark):
    """What inference does with texts beyond the size of one variant value."""
    docs = spark.createDataFrame(
        [
            ('{"data":[{"a":1},{"b":{"c":"x"}}],"n":{"o":{"p":1.5}},"s":"5","t":true}',),
            ('[{"z":1}]',),
        ],
        "t0 string",
    )
    unread = docs.withColumn("vt0", F.lit(None).cast("variant"))
    objects = unread.where(F.col("t0").startswith("{"))
    assert schemas._infer_large(objects, "t0").simpleString() == (
        "struct<data:array<struct<a:bigint,b:struct<c:string>>>,n:struct<o:struct<p:double>>,"
        "s:string,t:boolean>"
    )
    lists = unread.where(F.col("t0").startswith("["))
    assert schemas._infer_large(lists, "t0").simpleString() == "array<struct<z:bigint>>"


@pytest.mark.parametrize(
    "text",
    [
        "[1,2,3]", "[[1],[2]]", '{"it\'s":5}', '["5","x"]', "[1,\"x\"]", "[1,2.5]", "[true,false]", "[[{\"a\":1}],[]]", "[null,1]",
        '[{"a":1},{"a":"x"}]', '{"a":[1,"2"],"b":null,"c":"7"}', '{"a.b":{"x":[{"y":1.5}]}}', "[]", "{}",
    ],
)
def test_large_texts_get_the_type_of_small_ones(spark, text):
    docs = spark.createDataFrame([(text,)], "t0 string")
    unread = docs.withColumn("vt0", F.lit(None).cast("variant"))
    large = schemas._no_void(schemas._infer_large(unread, "t0")).simpleString()
    small = infer_json(docs, F.col("t0"))[0].simpleString()
    assert large == small or (text in ("{}",) and large == "struct<>")


def test_declared_schema_refuses_malformed(land):
    pages = land("[{\"a\":1}]", "oops")
    spec = ParseSpec(schema="array<struct<a:bigint>>")
    assert parse(pages, spec).count() == 1
    with pytest.raises(Exception, match="not JSON"):
        parse(pages, ParseSpec(schema=spec.schema, strict=True)).collect()
    lines = land('{"a":1}\n{"a"')
    with pytest.raises(Exception, match="not JSON"):
        parse(lines, ParseSpec("jsonl", schema="struct<a:bigint>", strict=True)).collect()


def test_infer_odd_names(spark):
    docs = spark.createDataFrame([('{"a.b":1,"VOID":{"OBJECT":2},"e":{},"n":null}',)], "d string")
    assert infer_json(docs, F.col("d"))[0].simpleString() == (
        "struct<VOID:struct<OBJECT:bigint>,a.b:bigint,e:string,n:string>"
    )


def test_widen_and_prune():
    ddl = T.StructType.fromDDL
    a, b = ddl("a int, s struct<x:int>"), ddl("a string, s struct<y:double>, l array<int>")
    assert widen(a, b).simpleString() == (
        "struct<a:string,s:struct<x:int,y:double>,l:array<int>>"
    )
    assert prune(b, {"y", "l"}).simpleString() == "struct<a:string,s:struct<>>"


def test_union_widened_nested_to_text(spark, values):
    a = spark.sql("SELECT 1 AS k, named_struct('x', 1) AS v")
    b = spark.sql("SELECT 'z' AS k, 2 AS v")
    assert values(union_widened([a, b]), "k", "v") == [("1", '{"x":1}'), ("z", "2")]
