"""Bodies landed once as shredded VARIANT, records read from the landed values.

Text is parsed in one place, the write. The fields that bodies have in common become Parquet
columns of their own below the variant (shredding), so the type aggregate, the test for records
and the records themselves read values, and no text is looked at again.

What no variant holds (text that is not JSON, objects with a key twice, values above the size
limit) lands as text beside it and goes the way of text; with ``strict`` text that is not JSON is
an error. Cells whose type differs between bodies are kept as JSON text with sorted keys, and
numbers in them are written without trailing zeros: a variant keeps values, not their spelling.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pageloom.functions.scalars import json_path
from pageloom.operators.schemas import _no_void, _type_of, prune, union_widened
from pageloom.runtime import quoted, scratch_path

_LISTS, _OBJECTS = "array<variant>", "map<string,variant>"


def land_variants(pages: DataFrame, below: str | None = None) -> DataFrame:
    """The same rows with ``body`` as VARIANT and ``body_text`` where that is null."""
    rest = [c for c in pages.columns if c != "body"]
    value = F.try_parse_json("body")
    text = F.when(value.isNull(), F.col("body"))
    found = pages.select(*rest, value.alias("body"), text.alias("body_text"))
    path = scratch_path(pages.sparkSession, "variants", below)
    found.write.parquet(path)
    return pages.sparkSession.read.schema(found.schema).parquet(path)


def landed_as_variant(pages: DataFrame) -> bool:
    return isinstance(pages.schema["body"].dataType, T.VariantType)


def has_records(record_path: str | None, drop_keys: tuple[str, ...] = ()) -> Column:
    """Whether a landed page holds a record with at least one field."""
    if set(drop_keys) & set((record_path or "").split(".")):
        return F.lit(False)
    filled = lambda of: F.size(F.map_filter(of, lambda k, _: ~k.isin(*drop_keys)) if drop_keys else of) > 0
    of_cell = lambda c: F.coalesce(filled(F.try_variant_get(c, "$", _OBJECTS)), c.isNotNull() & ~F.is_variant_null(c))
    leaf = _path(record_path)
    rows = F.try_variant_get("body", leaf, _LISTS)
    return F.coalesce(F.exists(rows, of_cell), filled(F.try_variant_get("body", leaf, _OBJECTS)), F.lit(False))


def _path(record_path: str | None) -> str:
    return json_path(record_path) if record_path else "$"


def ddl(kind: T.DataType) -> str:
    """The type as text, with its names quoted."""
    if isinstance(kind, T.StructType):
        return "struct<" + ",".join(f"{quoted(f.name)}:{ddl(f.dataType)}" for f in kind.fields) + ">"
    return f"array<{ddl(kind.elementType)}>" if isinstance(kind, T.ArrayType) else kind.simpleString()


def infer(landed: DataFrame, record_path: str | None) -> tuple[dict[str, T.DataType | None], int, int]:
    """Types at the record path of the bodies that have a list there, and of those that have an
    object; the number of bodies left as text, and how many of these are not JSON. One aggregate,
    combined map-side; types of more than one kind of value are text."""
    leaf = _path(record_path)
    value = F.try_variant_get("body", leaf, "variant")
    lists, objects = (F.when(F.try_variant_get("body", leaf, kind).isNotNull(), value) for kind in (_LISTS, _OBJECTS))
    text = F.col("body_text")
    is_json = F.json_array_length(text).isNotNull() | F.json_object_keys(text).isNotNull() | F.try_parse_json(text).isNotNull()
    told = landed.agg(
        F.schema_of_variant_agg(lists).alias("list"),
        F.schema_of_variant_agg(objects).alias("object"),
        F.count("body_text").alias("text"),
        F.count_if(text.isNotNull() & ~is_json).alias("broken"),
    ).first()
    kinds = {shape: None if told[shape] in (None, "VOID") else _no_void(_type_of(told[shape])) for shape in ("list", "object")}
    return kinds, told["text"], told["broken"]


def parse_variants(landed: DataFrame, keys: list[str], spec, numbered, flattened, of_text) -> DataFrame:
    """Records of landed bodies: ``keys``, ``_row_seq``, payload columns.

    ``numbered(frame, keys, rows)`` gives one row per element of a list, ``flattened(record,
    type)`` the columns of an object, ``of_text(frame, keys, spec)`` the records of bodies that
    are text: what the parser of texts uses, too.
    """
    if spec.record_path and set(spec.drop_keys) & set(spec.record_path.split(".")):
        return landed.select(*keys, F.lit(0).alias("_row_seq")).where(F.lit(False))
    kinds, texts, broken = infer(landed, spec.record_path)
    if broken and spec.strict:
        raise ValueError(f"{broken} bodies are not JSON")
    given = spec.data_type()
    if given is not None:
        for step in spec.record_path.split(".") if spec.record_path else []:
            given = given[step].dataType
        kinds = {"list": given if isinstance(given, T.ArrayType) else None, "object": given if isinstance(given, T.StructType) else None}
    leaf, dropped, frames = _path(spec.record_path), set(spec.drop_keys), []
    if kinds["list"] is not None:
        kind = prune(kinds["list"], dropped)
        rows = numbered(landed, keys, F.try_variant_get("body", leaf, ddl(kind)))
        record = F.col("_record")
        if isinstance(kind.elementType, T.StructType):
            columns = [record.getField(n).alias(n) for n in kind.elementType.names]
        else:
            columns = [record.alias("value")]
        frames.append(rows.select(*keys, "_row_seq", *columns))
    if kinds["object"] is not None:
        kind = prune(kinds["object"], dropped)
        some = landed.where(F.size(F.try_variant_get("body", leaf, _OBJECTS)) > 0)
        if kind.names:
            one = some.select(*keys, F.lit(0).alias("_row_seq"), F.try_variant_get("body", leaf, ddl(kind)).alias("_record"))
            frames.append(one.select(*keys, "_row_seq", *flattened(F.col("_record"), kind)))
    if texts:
        left = landed.where("body_text IS NOT NULL").select(*keys, F.col("body_text").alias("body"))
        frames.append(of_text(left, keys, replace(spec, landing="text")))
    if not frames:
        return landed.select(*keys, F.lit(0).alias("_row_seq")).where(F.lit(False))
    return union_widened(frames) if len(frames) > 1 else frames[0]
