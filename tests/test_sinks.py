from __future__ import annotations

import gzip
from datetime import datetime, timezone
from pathlib import Path

import pytest

from pageloom.sinks.writers import (
    SinkSpec,
    flush_parts,
    path_values,
    write_frame,
    written_bytes,
)

NOW = datetime(2024, 3, 5, 7, 8, 9, tzinfo=timezone.utc)


def lines(path, opener=open):
    out = []
    for f in sorted(Path(path).glob("part-*")):
        with opener(f, "rt", encoding="utf-8") as fh:
            out += fh.read().splitlines()
    return out


@pytest.fixture
def df(spark):
    return spark.sql(
        "SELECT 'p' _pull, id _row_seq, id AS n, named_struct('a', id) AS s, "
        "if(id = 0, 'x;\"y', null) AS t FROM range(2)"
    ).coalesce(1)


def test_csv(df, tmp_path):
    spec = SinkSpec(str(tmp_path), "csv", sep=";")
    assert write_frame(df, spec, f"{tmp_path}/o") == 2
    assert lines(f"{tmp_path}/o") == ["n;s;t", '0;"{""a"":0}";"x;""y"', '1;"{""a"":1}";']


def test_csv_gzip_with_index(df, tmp_path):
    spec = SinkSpec(str(tmp_path), "csv", compression="gzip", index=True, single_file=True)
    write_frame(df.select("_row_seq", "n"), spec, f"{tmp_path}/o")
    assert sorted(lines(f"{tmp_path}/o", gzip.open)) == ["0,0", "1,1", "index,n"]


def test_jsonl_writes_nulls(df, tmp_path):
    write_frame(df, SinkSpec(str(tmp_path), "jsonl"), f"{tmp_path}/o")
    assert lines(f"{tmp_path}/o")[1] == '{"n":1,"s":{"a":1},"t":null}'


@pytest.mark.parametrize(("kind", "mark"), [(None, "snappy"), ("none", ""), ("gzip", "gz")])
def test_parquet_compression(df, tmp_path, spark, kind, mark):
    path = f"{tmp_path}/o"
    write_frame(df, SinkSpec(str(tmp_path), "parquet", compression=kind), path)
    assert [r["s"] for r in spark.read.parquet(path).orderBy("n").collect()] == [
        '{"a":0}', '{"a":1}',
    ]
    assert mark in next(Path(path).glob("part-*")).name
    assert written_bytes(spark, path) == sum(f.stat().st_size for f in Path(path).glob("part-*"))


def test_parquet_native_nesting(df, tmp_path, spark):
    write_frame(df, SinkSpec(str(tmp_path), "parquet", stringify=False), f"{tmp_path}/o")
    assert spark.read.parquet(f"{tmp_path}/o").schema["s"].dataType.names == ["a"]


def test_paths():
    values = path_values("t", "qa", NOW)
    assert SinkSpec("s3a://b", "csv").path(values) == "s3a://b/t-20240305T070809Z.csv"
    spec = SinkSpec("/r/", "jsonl", "/a/{env}/{today:%Y}/", "f_{session_id}.jsonl")
    assert spec.path(values) == "/r/a/qa/2024/f_none.jsonl"
    assert spec.path({**values, "session_id": "s1"}) == "/r/a/qa/2024/f_s1.jsonl"


def test_options_are_checked():
    for bad in (None, {}, {"format": "csv"}, {"s3": {"bucket": " "}},
                {"format": "xml", "path": "/x"}):
        with pytest.raises(ValueError):
            SinkSpec.from_options(bad)
    spec = SinkSpec.from_options({"format": "CSV", "s3": {"bucket": "b", "sep": "|"}})
    assert (spec.root, spec.format, spec.sep) == ("s3a://b", "csv", "|")


def test_write_empty(df, tmp_path):
    none = df.where("n > 5")
    with pytest.raises(ValueError, match="write_empty"):
        write_frame(none, SinkSpec(str(tmp_path), "csv", write_empty=False), f"{tmp_path}/a")
    assert write_frame(none, SinkSpec(str(tmp_path), "csv"), f"{tmp_path}/b") == 0
    assert write_frame(none.select("_pull"), SinkSpec(str(tmp_path), "csv"), f"{tmp_path}/c") == 0


def test_flush_parts(spark, tmp_path, monkeypatch):
    from pageloom.operators import skew

    monkeypatch.setattr(skew, "HOT_ROWS", 50)
    df = spark.sql(
        "SELECT 'p' _pull, 0 _window_seq, 0 _page_seq, id _row_seq, id v, "
        "if(id % 3 = 0, 'hot', concat('s', id % 7)) _session_id FROM range(600)"
    )
    path = f"{tmp_path}/o"
    n = flush_parts(df, SinkSpec(str(tmp_path), "jsonl"), path_values("t", "qa", NOW),
                    "x_{session_id}", path)
    assert n == 600
    parts = {p.name: len(lines(p)) for p in Path(path).glob("part=*")}
    assert parts["part=x_hot"] == 200 and sum(parts.values()) == 600
    assert len(list(Path(path, "part=x_hot").glob("part-*"))) > 1


def test_same_name_is_written_anew_and_others_stay(spark, tmp_path):
    def flush(*sessions):
        df = spark.createDataFrame(
            [("p", i, i, s) for i, s in enumerate(sessions)],
            "_pull string, _row_seq int, v int, _session_id string",
        )
        spec = SinkSpec(str(tmp_path), "jsonl")
        flush_parts(df, spec, path_values("t", "qa", NOW), "{session_id}", f"{tmp_path}/o")

    flush("a", "a", "b")
    flush("b", "b", "b", "c")
    parts = {p.name: len(lines(p)) for p in (tmp_path / "o").glob("part=*")}
    assert parts == {"part=a": 2, "part=b": 3, "part=c": 1}


def odd_parts(spark):
    """600 rows: a hot session, ordinary ones, odd names and none; nulls in every column."""
    return spark.sql(
        "SELECT 'p' _pull, 0 _window_seq, 0 _page_seq, id _row_seq, if(id % 5 = 0, null, id) v, "
        "if(id % 7 = 0, null, concat('t', id)) s, cast(id AS DOUBLE) / 3 d, id % 2 = 0 b, "
        "date_add(date'2024-01-01', cast(id AS INT)) day, if(id % 3 = 0, 'hot', "
        "element_at(array('a/b=c', 'x y%41', '0012', 'ü[1]', cast(null AS STRING)), "
        "cast(id % 5 AS INT) + 1)) _session_id FROM range(600)"
    )


@pytest.mark.parametrize("kind", ["", "none", "gzip", "zstd", "lz4"])
def test_objects_are_read_as_written(spark, tmp_path, monkeypatch, kind):
    """By Spark's reader and by read_objects; lz4 is left to Spark's writer."""
    from pageloom.operators import skew
    from pageloom.sinks import objects

    monkeypatch.setattr(skew, "HOT_ROWS", 50)
    df = odd_parts(spark)
    path = f"{tmp_path}/o"
    sink = SinkSpec(str(tmp_path), "parquet", compression=kind)
    template = "{session_id}"
    assert flush_parts(df, sink, path_values("t", "qa", NOW), template, path) == 600
    assert len(list(Path(path, "part=hot").glob("part-*"))) > 1
    assert not list(Path(path).glob(".*"))
    got = spark.read.schema("v long, s string, d double, b boolean, day date, part string")
    got = got.parquet(path)
    wanted = df.selectExpr("v", "s", "d", "b", "day", "coalesce(_session_id, 'none') part")
    rows = sorted(map(str, wanted.collect()))
    assert sorted(map(str, got.collect())) == rows
    back = objects.read_objects(spark, path, got.schema, "part")
    assert sorted(map(str, back.collect())) == rows
    assert spark.read.parquet(path).schema["day"].dataType.typeName() == "date"


def test_objects_of_a_part_are_replaced_and_others_stay(spark, tmp_path):
    def flush(*sessions):
        df = spark.createDataFrame(
            [("p", i, i, s) for i, s in enumerate(sessions)],
            "_pull string, _row_seq int, v int, _session_id string",
        )
        spec = SinkSpec(str(tmp_path), "parquet")
        flush_parts(df, spec, path_values("t", "qa", NOW), "{session_id}", f"{tmp_path}/o")

    flush("a", "a", "b")
    flush("b", "b", "b", "c")
    back = spark.read.parquet(f"{tmp_path}/o").groupBy("part").count()
    assert sorted(map(tuple, back.collect())) == [("a", 2), ("b", 3), ("c", 1)]
    before = sorted(p.name for p in (tmp_path / "o").rglob("*"))
    broken = spark.range(4).selectExpr(
        "'p' _pull", "id _row_seq", "if(id = 3, raise_error('no'), id) v", "'a' _session_id"
    )
    with pytest.raises(Exception, match="no"):
        flush_parts(broken, SinkSpec(str(tmp_path), "parquet"), path_values("t", "qa", NOW),
                    "{session_id}", f"{tmp_path}/o")
    assert sorted(p.name for p in (tmp_path / "o").rglob("*")) == before


def test_moving_a_part_twice_does_no_harm(tmp_path):
    from pageloom.sinks.objects import into

    stage, folder = tmp_path / "s", tmp_path / "f"
    for d, names in ((stage, ["x-new", "y-new"]), (folder, ["x-old", ".x-old.crc"])):
        d.mkdir()
        for n in names:
            (d / n).write_text(n)
    for _ in range(2):
        into(str(stage), str(folder), "new")
        assert sorted(p.name for p in folder.iterdir()) == ["x-new", "y-new"]
