"""Schema inference, widening, pruning and flattening."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pageloom.runtime import quoted

_TYPE_WORDS = re.compile(
    r"`(?:[^`]|``)*`"
    r"|\bOBJECT<\s*>"
    r"|\b(?:OBJECT|VARIANT|VOID|FLOAT|DECIMAL\(\d+,\s*\d+\))(?!\s*:)"
)


def _to_ddl(found: re.Match) -> str:
    word = found.group(0)
    if word.startswith("`"):
        return word
    if word.startswith("OBJECT<"):
        return "STRING"  # only ever {} : no field to name
    if word == "OBJECT":
        return "STRUCT"
    if word.startswith("DECIMAL"):
        return "DOUBLE" if not word.replace(" ", "").endswith(",0)") else word
    return {"VARIANT": "STRING", "VOID": "STRING", "FLOAT": "DOUBLE"}[word]


def infer_json(docs: DataFrame, *columns: Column, strict: bool = False) -> list[T.DataType]:
    """One type for all JSON texts of a column: fields are unioned, conflicts are STRING.

    The schema aggregate combines map-side, so a single row reaches the driver,
    and several columns share one pass. With ``strict`` the same pass refuses
    texts that are not JSON.
    """
    names = [f"t{i}" for i in range(len(columns))]
    texts = docs.select(*[c.alias(n) for c, n in zip(columns, names)])
    values = texts.select(*names, *[F.try_parse_json(n).alias(f"v{n}") for n in names])
    aggregates = []
    for n in names:
        unread = F.col(f"v{n}").isNull() & F.col(n).isNotNull()
        is_json = F.json_array_length(n).isNotNull() | F.json_object_keys(n).isNotNull()
        aggregates += [
            F.schema_of_variant_agg(f"v{n}").alias(f"kind_{n}"),
            F.count_if(unread & is_json).alias(f"large_{n}"),
            F.count_if(unread & ~is_json).alias(f"broken_{n}"),
        ]
    found = _last_key_wins(values.agg(*aggregates))[0]
    if strict and found["broken_t0"]:
        raise ValueError(f"{found['broken_t0']} bodies are not JSON")
    kinds = [_type_of(found[f"kind_{n}"]) for n in names]
    for i, n in enumerate(names):
        if found[f"large_{n}"]:
            kinds[i] = widen(kinds[i], _infer_large(values, n))
    return [_no_void(k) for k in kinds]


def _infer_large(values: DataFrame, name: str) -> T.DataType:
    """Type of the JSON texts that are too large for one variant value: that of their
    parts, each a variant of its own; parts that are too large are taken apart in turn."""
    rest = values.where(F.col(f"v{name}").isNull() & F.col(name).isNotNull()).select(name)
    text = F.ltrim(F.col(name))
    lists, objects = rest.where(text.startswith("[")), rest.where(text.startswith("{"))
    kind: T.DataType = T.NullType()
    if not lists.isEmpty():
        texts, values = (F.from_json(name, T.ArrayType(t())) for t in (T.StringType, T.VariantType))
        parts = lists.select(F.posexplode(texts).alias("at", "text"), values.alias("all"))
        parts = parts.select(F.lit("").alias("key"), "text", F.get("all", F.col("at")).alias("value"))
        kind = T.ArrayType(_parts_type(parts).get("", T.NullType()))
    if not objects.isEmpty():
        texts, values = (
            F.from_json(name, T.MapType(T.StringType(), t())) for t in (T.StringType, T.VariantType)
        )
        parts = objects.select(F.explode(texts).alias("key", "text"), values.alias("all"))
        parts = parts.select("key", "text", F.try_element_at("all", F.col("key")).alias("value"))
        fields = _parts_type(parts)
        kind = widen(kind, T.StructType([T.StructField(k, fields[k]) for k in sorted(fields)]))
    return kind


def _parts_type(parts: DataFrame) -> dict[str, T.DataType]:
    """Type of the parts of lists (under an empty name) or of each key of objects, in one
    aggregate. ``value`` is null where a part, or one beside it, is too large for a variant;
    ``text`` is what such a part says."""
    value = F.coalesce("value", F.try_parse_json("text"))
    lost = value.isNull() & F.col("text").isNotNull()
    nested = F.json_array_length("text").isNotNull() | F.json_object_keys("text").isNotNull()
    found = parts.groupBy("key").agg(
        F.schema_of_variant_agg(value).alias("kind"),
        F.coalesce(F.bool_or(lost & ~nested), F.lit(False)).alias("plain"),
        F.coalesce(F.bool_or(lost & nested), F.lit(False)).alias("large"),
    )
    out: dict[str, T.DataType] = {}
    for row in _last_key_wins(found):
        kind = widen(_type_of(row["kind"]), T.StringType() if row["plain"] else T.NullType())
        if row["large"]:
            here = parts.where(F.col("key").eqNullSafe(F.lit(row["key"])) & lost & nested)
            kind = widen(kind, infer_json(here, F.col("text"))[0])
        out[row["key"]] = kind
    return out


def _last_key_wins(aggregated: DataFrame) -> list[Row]:
    """Run an aggregate; of a key that occurs twice in an object the last value counts."""
    conf, name = aggregated.sparkSession.conf, "spark.sql.variant.allowDuplicateKeys"
    before = conf.get(name, "false")
    conf.set(name, "true")
    try:
        return aggregated.collect()
    finally:
        conf.set(name, before)


def _type_of(kind: str | None) -> T.DataType:
    if kind in (None, "VOID"):
        return T.NullType()
    text = _TYPE_WORDS.sub(_to_ddl, kind)
    return T.StructType.fromDDL(f"c {text}")["c"].dataType


def _no_void(kind: T.DataType) -> T.DataType:
    """A type without unknown parts: those read as text."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _no_void(f.dataType)) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_no_void(kind.elementType))
    return T.StringType() if isinstance(kind, T.NullType) else kind


_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def widen(a: T.DataType, b: T.DataType) -> T.DataType:
    """Smallest type holding both; unlike kinds meet at STRING."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        names = a.names + [n for n in b.names if n not in a.names]
        return T.StructType(
            [
                T.StructField(
                    n,
                    widen(
                        a[n].dataType if n in a.names else T.NullType(),
                        b[n].dataType if n in b.names else T.NullType(),
                    ),
                )
                for n in names
            ]
        )
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(widen(a.elementType, b.elementType))
    if isinstance(a, _INTEGRAL) and isinstance(b, _INTEGRAL):
        return max(a, b, key=lambda t: [x for x, c in enumerate(_INTEGRAL) if isinstance(t, c)])
    if isinstance(a, T.NumericType) and isinstance(b, T.NumericType):
        return T.DoubleType()
    times = (T.DateType, T.TimestampType, T.TimestampNTZType)
    if isinstance(a, times) and isinstance(b, times):
        return T.TimestampNTZType() if T.TimestampType() not in (a, b) else T.TimestampType()
    return T.StringType()


def cast_to(col: Column, have: T.DataType, want: T.DataType) -> Column:
    """Cast that writes nested values as JSON when the target is text."""
    if have == want:
        return col
    if isinstance(want, T.StringType) and isinstance(
        have, (T.StructType, T.ArrayType, T.MapType, T.VariantType)
    ):
        return F.to_json(col)
    if isinstance(have, T.StructType) and isinstance(want, T.StructType):
        fields = [
            (
                cast_to(col.getField(f.name), have[f.name].dataType, f.dataType)
                if f.name in have.names
                else F.lit(None).cast(f.dataType)
            ).alias(f.name)
            for f in want.fields
        ]
        return F.when(col.isNotNull(), F.struct(*fields))
    if isinstance(have, T.ArrayType) and isinstance(want, T.ArrayType):
        return F.transform(col, lambda x: cast_to(x, have.elementType, want.elementType))
    return col.cast(want)


def union_widened(frames: list[DataFrame]) -> DataFrame:
    """Union by name: missing columns are null, conflicting types are widened first."""
    if not frames:
        raise ValueError("nothing to union")
    target = reduce(widen, [f.schema for f in frames])

    def align(df: DataFrame) -> DataFrame:
        have = df.schema
        return df.select(
            *[
                (
                    cast_to(F.col(quoted(f.name)), have[f.name].dataType, f.dataType)
                    if f.name in have.names
                    else F.lit(None).cast(f.dataType)
                ).alias(f.name)
                for f in target.fields
            ]
        )

    return reduce(DataFrame.unionAll, [align(f) for f in frames])


def prune(kind: T.DataType, names: set[str]) -> T.DataType:
    """Type without the named fields, at any depth."""
    if isinstance(kind, T.StructType):
        kept = [f for f in kind.fields if f.name not in names]
        return T.StructType([T.StructField(f.name, prune(f.dataType, names)) for f in kept])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(prune(kind.elementType, names))
    return kind


def flatten(col: Column, kind: T.StructType, prefix: str = "") -> list[Column]:
    """Leaf fields of a struct under dotted names; arrays are leaves."""
    out: list[Column] = []
    for f in kind.fields:
        inner, name = col.getField(f.name), prefix + f.name
        if isinstance(f.dataType, T.StructType) and f.dataType.fields:
            out += flatten(inner, f.dataType, name + ".")
        else:
            out.append(inner.alias(name))
    return out
