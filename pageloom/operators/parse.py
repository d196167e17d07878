"""Response bodies to records."""

from __future__ import annotations

from dataclasses import dataclass, replace
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pageloom.functions.scalars import json_path
from pageloom.operators import variants
from pageloom.operators.schemas import flatten, infer_json, prune, union_widened

_FAMILY = {"json": "json", "jsonl": "jsonl", "ndjson": "jsonl", "csv": "csv"}

# CSV spellings that mean "no value".
NA_TEXTS = [
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
]


@dataclass(frozen=True)
class ParseSpec:
    """How a body is read. ``schema`` is the type of the whole body (JSON) or of
    one record (JSONL, CSV); without one it is inferred over all bodies.
    ``strict`` makes a body (a line) that is not JSON an error, with a schema or without.
    ``landing="variant"`` lands JSON bodies as shredded VARIANT first, and no text is read twice."""

    type: str = "json"
    record_path: str | None = None
    drop_keys: tuple[str, ...] = ()
    schema: T.DataType | str | None = None
    strict: bool = False
    landing: str = "text"

    def __post_init__(self) -> None:
        if self.landing not in ("text", "variant"):
            raise ValueError(f"parse landing {self.landing!r} is not text or variant")
        if self.family not in _FAMILY.values():
            raise ValueError(f"parse type {self.type!r} is not one of {sorted(_FAMILY)}")

    @property
    def family(self) -> str:
        return _FAMILY.get((self.type or "json").lower(), "unknown")

    @classmethod
    def from_options(cls, options: dict[str, Any] | None) -> ParseSpec:
        options = options or {}
        return cls(
            type=options.get("type") or "json",
            record_path=options.get("json_record_path") or None,
            drop_keys=tuple(options.get("json_drop_keys_any_depth") or ()),
            schema=options.get("schema"),
            strict=bool(options.get("strict", False)),
            landing=options.get("landing") or "text",
        )

    def data_type(self) -> T.DataType | None:
        if self.schema is None or isinstance(self.schema, T.DataType):
            return self.schema
        return T.StructType.fromDDL(f"c {self.schema}")["c"].dataType


def parse(
    responses: DataFrame, spec: ParseSpec, keep: dict[str, str] | None = None
) -> DataFrame:
    """Records of every response: key columns, ``_row_seq``, payload columns.

    ``keep`` maps new names to further response columns to carry along.
    """
    base, keys = _base(responses, keep)
    if spec.family == "csv":
        return _csv(base, keys, spec)
    if spec.family == "jsonl":
        return _jsonl(base, keys, spec)
    return _json(base, keys, spec)


def with_schema(responses: DataFrame, spec: ParseSpec) -> ParseSpec:
    """The spec with its schema inferred now, for responses that are parsed twice."""
    if spec.schema is not None:
        return spec
    base, keys = _base(responses)
    if spec.family == "csv":
        return replace(spec, schema=_infer_csv(base, keys))
    texts = _json_lines(base, keys) if spec.family == "jsonl" else base
    text = F.col("_record" if spec.family == "jsonl" else "body")
    return replace(spec, schema=infer_json(texts, text, strict=spec.strict)[0])


def _base(
    responses: DataFrame, keep: dict[str, str] | None = None
) -> tuple[DataFrame, list[str]]:
    texts = ["body_text"] if variants.landed_as_variant(responses) else []
    base = responses.select(
        F.col("pull").alias("_pull"),
        F.col("window_seq").alias("_window_seq"),
        F.col("page_seq").alias("_page_seq"),
        *[F.col(have).alias(name) for name, have in (keep or {}).items()],
        "body",
        *texts,
    )
    return base, [c for c in base.columns if c not in ("body", *texts)]


# ---- JSON ------------------------------------------------------------------


def _leaf_type(kind: T.DataType, path: list[str]) -> T.DataType | None:
    """Type at the record path; STRING where bodies differ in shape on the way."""
    for step in path:
        if isinstance(kind, T.StringType):
            return kind
        if not isinstance(kind, T.StructType) or step not in kind.names:
            return None
        kind = kind[step].dataType
    return kind


def _json(base: DataFrame, keys: list[str], spec: ParseSpec) -> DataFrame:
    if variants.landed_as_variant(base) or spec.landing == "variant":
        landed = base if variants.landed_as_variant(base) else variants.land_variants(base)
        return variants.parse_variants(landed, keys, spec, _numbered, flatten, _json)
    kind = spec.data_type() or infer_json(base, F.col("body"), strict=spec.strict)[0]
    if spec.strict and spec.schema is not None:
        base = base.withColumn("body", _readable(F.col("body")))
    kind = prune(kind, set(spec.drop_keys))
    path = spec.record_path.split(".") if spec.record_path else []
    leaf = _leaf_type(kind, path)
    if leaf is None:
        # No body has the path, so there are no records of any shape.
        return _no_rows(base, keys)
    if isinstance(leaf, T.StringType):
        return _mixed(base, keys, spec)
    # Only the branch that leads to the records is parsed.
    wanted: T.DataType = leaf
    for step in reversed(path):
        wanted = T.StructType([T.StructField(step, wanted)])
    found = F.from_json("body", wanted)
    for step in path:
        found = found.getField(step)
    rows = _numbered(base, keys, F.array(found) if isinstance(leaf, T.StructType) else found)
    record = F.col("_record")
    if isinstance(leaf, T.StructType):
        rows = rows.where(record.isNotNull())
        return rows.select(*keys, "_row_seq", *flatten(record, leaf))
    if isinstance(leaf.elementType, T.StructType):
        return rows.select(
            *keys, "_row_seq", *[record.getField(n).alias(n) for n in leaf.elementType.names]
        )
    return rows.select(*keys, "_row_seq", record.alias("value"))


def _is_json(text: Column) -> Column:
    """Whether a text is JSON; nothing is built to find out."""
    start = F.ltrim(text)
    ok = F.when(start.startswith("["), F.json_array_length(text).isNotNull())
    ok = ok.when(start.startswith("{"), F.json_object_keys(text).isNotNull())
    return text.isNull() | ok.otherwise(F.try_parse_json(text).isNotNull())


def _readable(text: Column) -> Column:
    """The text if it is JSON; fails the run otherwise."""
    told = F.concat(F.lit("not JSON: "), F.left(text, F.lit(80)))
    return F.when(_is_json(text), text).otherwise(F.raise_error(told).cast("string"))


def split_readable(responses: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Responses whose body is JSON, and those to keep in a table of their own."""
    ok = _is_json(F.col("body"))
    return responses.where(ok), responses.where(~ok)


def _numbered(base: DataFrame, keys: list[str], rows: Column) -> DataFrame:
    """One row per array element with its position.

    The outer form is used and its empty rows are dropped afterwards: for the
    plain form the optimizer adds a size test below the generator, which would
    parse every body a second time.
    """
    found = base.select(*keys, F.posexplode_outer(rows).alias("_row_seq", "_record"))
    return found.where(F.col("_row_seq").isNotNull())


def _no_rows(base: DataFrame, keys: list[str]) -> DataFrame:
    return base.select(*keys, F.lit(0).alias("_row_seq")).where(F.lit(False))


def _mixed(base: DataFrame, keys: list[str], spec: ParseSpec) -> DataFrame:
    """The record path holds a list on some pages and an object on others."""
    if spec.record_path and set(spec.drop_keys) & set(spec.record_path.split(".")):
        return _no_rows(base, keys)
    text = F.ltrim(_leaf_text(F.col("body"), spec))
    shapes = {s: F.when(text.startswith(s), text) for s in ("[", "{")}
    sides = []
    for shape, kind in zip(shapes, infer_json(base, *shapes.values())):
        if not isinstance(kind, T.StringType):
            at_root = replace(spec, record_path=None, schema=kind)
            sides.append(_json(base.select(*keys, shapes[shape].alias("body")), keys, at_root))
    return union_widened(sides) if sides else _no_rows(base, keys)


def _leaf_text(body: Column, spec: ParseSpec) -> Column:
    return F.get_json_object(body, json_path(spec.record_path)) if spec.record_path else body


def has_records(body: Column, spec: ParseSpec) -> Column:
    """Whether a page holds a record with at least one field; needs no schema."""
    if spec.family == "jsonl":
        return body.rlike(r"\S")
    if spec.family == "csv":
        # Something in a line after the first.
        return body.rlike(r"\S[^\r\n]*[\r\n]\s*\S")
    dropped = set(spec.drop_keys)
    if spec.record_path and dropped & set(spec.record_path.split(".")):
        return F.lit(False)
    text = F.ltrim(_leaf_text(body, spec))
    # Brackets and commas alone are lists and objects without a single key.
    filled = text.rlike(r"[^\[\]{},\s]")
    if dropped:

        def has_key(cell: Column) -> Column:
            names = F.json_object_keys(cell)
            kept = F.filter(names, lambda k: ~k.isin(*dropped))
            return F.when(names.isNotNull(), F.size(kept) > 0).otherwise(cell.isNotNull())

        cells = F.from_json(text, T.ArrayType(T.StringType()))
        filled = filled & F.when(text.startswith("["), F.exists(cells, has_key)).otherwise(
            has_key(text)
        )
    return F.coalesce(text.rlike(r"^[\[{]") & filled, F.lit(False))


# ---- JSON lines ------------------------------------------------------------


def _json_lines(base: DataFrame, keys: list[str]) -> DataFrame:
    lines = F.filter(F.split("body", "\n"), lambda x: F.trim(F.translate(x, "\r\t", "  ")) != "")
    return _numbered(base, keys, lines)


def _jsonl(base: DataFrame, keys: list[str], spec: ParseSpec) -> DataFrame:
    rows = _json_lines(base, keys)
    kind = spec.data_type() or infer_json(rows, F.col("_record"), strict=spec.strict)[0]
    if spec.strict and spec.schema is not None:
        rows = rows.withColumn("_record", _readable(F.col("_record")))
    record = F.col("_record")
    if not isinstance(kind, T.StructType):
        return rows.select(*keys, "_row_seq", record.alias("value"))
    return rows.withColumn("_record", F.from_json("_record", kind)).select(
        *keys, "_row_seq", *[record.getField(n).alias(n) for n in kind.names]
    )


# ---- CSV -------------------------------------------------------------------


# A cell, quoted (line ends and doubled quotes inside) or not; possessive, so that long
# cells neither recurse nor backtrack. A quote that is never closed runs to the end.
_CELL = r'(?:"(?:[^"]++|"")*+(?:"[^,\r\n]*+|\z)|[^",\r\n][^,\r\n]*+|)'
_LINE = f"{_CELL}(?:,{_CELL})*+"


def _cells(line: Column) -> Column:
    def value(cell: Column) -> Column:
        inner = F.regexp_extract(cell, r'(?s)^"((?:[^"]++|"")*+)', 1)
        rest = F.regexp_extract(cell, r'(?s)^"(?:[^"]++|"")*+"(.*)\z', 1)
        text = F.concat(F.replace(inner, F.lit('""'), F.lit('"')), rest)
        return F.when(cell.startswith('"'), text).otherwise(cell)

    # With a comma in front every cell is matched by at least one character.
    found = F.regexp_extract_all(F.concat(F.lit(","), line), F.lit(f",({_CELL})"), F.lit(1))
    return F.transform(found, value)


def _unlike(header: Column) -> Column:
    """Names that occur before get a number: a, a.1, a.2."""
    earlier = lambda x, i: F.size(F.filter(F.slice(header, 1, i), lambda y: y == x))
    return F.transform(
        header,
        lambda x, i: F.when(earlier(x, i) == 0, x).otherwise(
            F.concat(x, F.lit("."), earlier(x, i).cast("string"))
        ),
    )


def _csv_header(body: Column) -> Column:
    first = F.regexp_extract(F.regexp_replace(body, r"^[\r\n]+", ""), f"^{_LINE}", 0)
    return F.when(body.isNotNull(), _cells(first))


def _csv_lines(base: DataFrame, keys: list[str]) -> DataFrame:
    """``_header`` and ``_cells`` of every line after the header."""
    body = F.col("body")
    quoted_lines = F.regexp_extract_all(body, F.lit(_LINE), F.lit(0))
    lines = F.when(body.contains('"'), quoted_lines).otherwise(F.split(body, r"\r\n|\n|\r"))
    # The header is taken out first, so that rows do not carry all lines of their page.
    parts = base.select(
        *keys, _csv_header(body).alias("_head"), F.filter(lines, lambda x: x != "").alias("_lines")
    )
    parts = parts.select(*keys, _unlike(F.col("_head")).alias("_header"), "_lines")
    rest = F.when(F.size("_lines") > 1, F.slice("_lines", 2, F.size("_lines")))
    rows = _numbered(parts, [*keys, "_header"], rest)
    line = F.col("_record")
    cells = F.when(line.contains('"'), _cells(line)).otherwise(F.split(line, ",", -1))
    return rows.select(*keys, "_header", "_row_seq", cells.alias("_cells"))


def _csv(base: DataFrame, keys: list[str], spec: ParseSpec) -> DataFrame:
    rows = _csv_lines(base, keys)
    kind = spec.data_type()
    if kind is None:
        kind = _infer_csv(base, keys)
    cell = _cell_of
    return rows.select(
        *keys, "_row_seq", *[_typed(cell(f.name), f.dataType).alias(f.name) for f in kind.fields]
    )


_NUMBER = r"^\s*[+-]?(\d+\.?\d*([eE][+-]?\d+)?|\.\d+([eE][+-]?\d+)?|inf|Inf|infinity|Infinity)\s*$"
_WHOLE = r"^\s*[+-]?\d+\s*$"
_TRUTH = ["True", "TRUE", "true", "False", "FALSE", "false"]


def _typed(text: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.StringType):
        return text
    if isinstance(kind, T.DoubleType):
        return F.when(text.rlike(_NUMBER), text.try_cast("double"))
    return text.try_cast(kind)


def _cell_of(name: str) -> Column:
    at = F.array_position("_header", name).cast("int")
    text = F.when(at > 0, F.get("_cells", at - 1))
    return F.when(~text.isin(NA_TEXTS), text)


def _infer_csv(base: DataFrame, keys: list[str]) -> T.StructType:
    """Column types over all pages, in the order in which names first appear.

    The names come from the first lines alone; one aggregate with three tests a name over
    the rows then tells their types.
    """
    place = [c for c in ("_window_seq", "_page_seq") if c in keys]
    heads = base.select(*place, F.posexplode(_unlike(_csv_header(F.col("body")))).alias("_at", "name"))
    firsts = heads.groupBy("name").agg(F.min(F.struct(*place, "_at")).alias("first"))
    names = [r["name"] for r in firsts.orderBy("first", "name").collect() if r["name"] is not None]
    if not names:
        return T.StructType([])
    rows = _csv_lines(base, keys)
    rows = rows.select(*[_cell_of(n).alias(f"c{i}") for i, n in enumerate(names)])

    def every(text: Column, test: Column) -> Column:
        return F.coalesce(F.bool_and(F.when(text.isNotNull(), test)), F.lit(False))

    tests = []
    for i in range(len(names)):
        text = F.col(f"c{i}")
        tests += [
            every(text, text.rlike(_WHOLE) & text.try_cast("bigint").isNotNull()).alias(f"whole{i}"),
            every(text, text.rlike(_NUMBER)).alias(f"number{i}"),
            every(text, text.isin(_TRUTH)).alias(f"truth{i}"),
        ]
    told = rows.agg(*tests).first()
    found = [
        {"name": n, **{k: told[f"{k}{i}"] for k in ("whole", "number", "truth")}}
        for i, n in enumerate(names)
    ]
    pick = lambda r: (
        T.LongType()
        if r["whole"]
        else T.DoubleType()
        if r["number"]
        else T.BooleanType()
        if r["truth"]
        else T.StringType()
    )
    return T.StructType([T.StructField(r["name"], pick(r)) for r in found])

