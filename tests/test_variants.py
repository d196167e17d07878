"""Bodies landed as VARIANT give the rows that their texts give."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from pageloom.operators import variants
from pageloom.operators.parse import ParseSpec, has_records, parse
from pageloom.operators.variants import land_variants
from pageloom.runtime import META, quoted


def rows(df):
    """Payload as JSON with sorted keys, nulls left out, by position."""
    cols = [c for c in df.columns if c not in META]
    text = F.to_json(F.struct(*[F.col(quoted(c)) for c in cols])) if cols else F.lit("{}")
    found = df.select("_page_seq", "_row_seq", text.alias("r")).collect()
    return sorted((r[0], r[1], json.dumps(json.loads(r[2]), sort_keys=True)) for r in found)


CASES = {
    "lists": ([[{"id": 1, "a": {"b": 2}}, {"id": 2}], [{"id": 3, "x": [1, 2]}], []], {}),
    "path": ([{"r": {"d": [{"id": 1}]}}, {"r": {"d": None}}, {"r": False}, {}, {"r": {"d": []}}, {"r": {}}], {"record_path": "r.d"}),
    "objects": ([{"r": {"id": 1, "n": {"m": {"k": "v"}, "l": [1]}}}, {"r": {"id": 2, "n": None}}], {"record_path": "r"}),
    "both": ([{"r": [{"id": 1, "s": "x"}, {"id": 2}]}, {"r": {"id": 3, "more": {"k": 1.5}}}], {"record_path": "r"}),
    "scalars": ([{"r": [1, 2.5]}, {"r": [7]}, {"r": []}], {"record_path": "r"}),
    "texts": ([{"r": ["a", "b"]}, {"r": ["c"]}], {"record_path": "r"}),
    "dropped": ([{"r": [{"id": 1, "z": 0, "n": {"z": 5, "k": 1}}]}, {"z": 1, "r": [{"z": 3, "id": 2}]}], {"record_path": "r", "drop_keys": ("z",)}),
    "dropped path": ([{"r": [{"id": 1}]}], {"record_path": "r", "drop_keys": ("r",)}),
    "types meet": ([[{"c": 1}, {"c": 2.5}], [{"c": "x"}]], {}),
    "kinds meet": ([[{"c": {"k": 1}}], [{"c": "x"}], [{"c": [1]}]], {}),
    "names": ([[{"a b": 1, "c.d": 2, "e`f": {"g h": 3}, "ü": True}]], {}),
    "no path": ([{"other": 1}], {"record_path": "r.d"}),
    "large numbers": ([[{"n": 2**62, "d": 12.25}], [{"n": 2**53 + 1}]], {}),
    "given": ([{"r": [{"id": 1, "x": "1"}]}, {"r": None}], {"record_path": "r", "schema": "struct<r:array<struct<id:bigint>>>"}),
    "given object": ([{"r": {"id": 1}}, {"r": {"id": 2, "y": 1}}], {"record_path": "r", "schema": "struct<r:struct<id:bigint,y:int>>"}),
}


@pytest.mark.parametrize("name", CASES)
def test_same_rows_as_from_text(land, name):
    bodies, options = CASES[name]
    landed = land(*bodies)
    spec = ParseSpec(**options)
    want = rows(parse(landed, spec))
    assert rows(parse(land_variants(landed), spec)) == want
    assert rows(parse(landed, ParseSpec(**options, landing="variant"))) == want


def test_bodies_no_variant_holds_go_the_way_of_text(land):
    twice = '{"k":1,"k":2,"r":[{"id":7,"id":8}]}'
    landed = land({"r": [{"id": 1}]}, {"body": twice}, {"body": '{"r":[{"id":'}, {"body": None}, {"body": ""})
    variant = land_variants(landed)
    assert {r.page_seq: r.body_text for r in variant.collect()} == {0: None, 1: twice, 2: '{"r":[{"id":', 3: None, 4: ""}
    spec = ParseSpec(record_path="r")
    assert rows(parse(variant, spec)) == rows(parse(landed, spec)) == [(0, 0, '{"id": 1}'), (1, 0, '{"id": 8}')]
    with pytest.raises(ValueError, match="not JSON"):
        parse(variant, ParseSpec(record_path="r", strict=True))


def test_text_is_parsed_in_the_write_alone(land):
    variant = land_variants(land([{"id": 1}], [{"id": 2, "n": {"k": 3}}]))
    plan = parse(variant, ParseSpec())._jdf.queryExecution().toString()
    assert "try_variant_get" in plan
    for parser in ("from_json", "parse_json", "get_json_object", "json_array_length"):
        assert parser not in plan


def test_common_fields_are_shredded(spark, land, tmp_path):
    import pyarrow.parquet as pq

    land_variants(land(*[[{"id": i, "name": "x"}] for i in range(20)]), below=str(tmp_path))
    file = next(tmp_path.glob("variants-*/*.parquet"))
    assert "typed_value" in str(pq.ParquetFile(file).schema)


@pytest.mark.parametrize("drop", [(), ("z",)])
def test_pages_with_records(land, drop):
    bodies = [{"r": [{"id": 1}]}, {"r": []}, {"r": [{}]}, {"r": {}}, {"r": {"k": None}}, {"r": None}, {"r": [1]}, {"r": [{"z": 1}]}, {"r": {"z": 1}}, {}, {"r": "x"}]
    landed = land(*bodies)
    spec = ParseSpec(record_path="r", drop_keys=drop)
    text = {r[0]: r[1] for r in landed.select("page_seq", has_records(F.col("body"), spec)).collect()}
    variant = land_variants(landed).select("page_seq", variants.has_records("r", drop))
    assert {r[0]: r[1] for r in variant.collect()} == text


def test_empty_table_and_extra_columns(land):
    none = land_variants(land([{"id": 1}]).limit(0))
    assert parse(none, ParseSpec()).count() == 0
    kept = parse(land_variants(land([{"id": 1}])), ParseSpec(), keep={"_url": "url"})
    assert kept.select("_url", "id").first() == ("https://h/a", 1)


def test_unknown_landing():
    with pytest.raises(ValueError, match="landing"):
        ParseSpec(landing="rows")
    assert ParseSpec.from_options({"landing": "variant"}).landing == "variant"
