"""Column expressions used across the package. All of them stay inside the JVM."""

from __future__ import annotations

import re
from string import Formatter
from typing import Any
from urllib.parse import urljoin

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pageloom.runtime import quoted

# Names whose values never reach a log line.
SECRET_HEADERS = ["authorization", "x-api-key", "api-key", "proxy-authorization"]
SECRET_PARAMS = [
    "access_token",
    "token",
    "apikey",
    "api_key",
    "authorization",
    "signature",
    "client_id",
    "client_secret",
    "refresh_token",
    "secret",
    "password",
    "private_key",
    "x-authorization",
    "auth",
]
REDACTED = "***REDACTED***"

# Strftime directives and the Spark datetime pattern of each.
STRFTIME = {
    "Y": "yyyy",
    "y": "yy",
    "m": "MM",
    "d": "dd",
    "H": "HH",
    "I": "hh",
    "M": "mm",
    "S": "ss",
    "f": "SSSSSS",
    "p": "a",
    "j": "DDD",
    "b": "MMM",
    "B": "MMMM",
    "a": "EEE",
    "A": "EEEE",
}


# ---- nested access ---------------------------------------------------------


def json_path(path: str) -> str:
    return "$" + "".join(f"['{step}']" for step in path.split("."))


def dig(body: Column, path: str | None) -> Column:
    """Text at a dotted path of a JSON string; null when any step is missing."""
    if not path:
        return F.lit(None).cast("string")
    return F.get_json_object(body, json_path(path))


def variant_at(body: Column, steps: list[str]) -> Column:
    """Value below a chain of keys with its JSON type kept; SQL null when missing.

    Only this branch of the body is materialised.
    """
    kind: T.DataType = T.VariantType()
    for step in reversed(steps):
        kind = T.StructType([T.StructField(step, kind)])
    value = F.from_json(body, kind)
    for step in steps:
        value = value.getField(step)
    return value


def token_text(token: Column) -> Column:
    """Text of a paging token, null when it would not continue the chain.

    Null, ``""``, ``0``, ``false`` and empty containers end a chain; the text
    ``"0"`` does not, hence the typed value.
    """
    text = F.try_variant_get(token, "$", "string")
    stops = F.when(F.schema_of_variant(token) == "STRING", text == "").otherwise(
        text.isin("false", "{}", "[]")
        | F.coalesce(text.try_cast("double") == F.lit(0.0), F.lit(False))
    )
    return F.when(text.isNotNull() & ~stops, text)


def row_path(df: DataFrame, path: str) -> Column | None:
    """Column for ``path``: a column of that very name first, else a struct field."""
    if path in df.columns:
        return F.col(quoted(path))
    root, *steps = path.split(".")
    if root not in df.columns:
        return None
    kind: T.DataType = df.schema[root].dataType
    col = F.col(quoted(root))
    if isinstance(kind, T.StringType) and steps:
        # A column of mixed scalars and objects is held as raw JSON text.
        return dig(col, ".".join(steps))
    for step in steps:
        if not isinstance(kind, T.StructType) or step not in kind.names:
            return None
        kind = kind[step].dataType
        col = col.getField(step)
    return col


# ---- URLs and headers ------------------------------------------------------


def build_url(base: str, path: str) -> str:
    return urljoin(base.rstrip("/") + "/", path.lstrip("/"))


def is_link(col: Column) -> Column:
    return col.rlike("^https?://")


def resolve_url(base: Column, ref: Column) -> Column:
    """``ref`` against the host root of ``base``; absolute references stand."""
    root = F.regexp_extract(base, "^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]+)", 1)
    scheme = F.regexp_extract(base, "^([a-zA-Z][a-zA-Z0-9+.-]*:)", 1)
    return (
        F.when(ref.rlike("^[a-zA-Z][a-zA-Z0-9+.-]*:"), ref)
        .when(ref.startswith("//"), F.concat(scheme, ref))
        .otherwise(F.concat(root, F.lit("/"), F.regexp_replace(ref, "^/", "")))
    )


def header(headers: Column, name: str) -> Column:
    """Header value, name matched in any case."""
    hits = F.map_filter(headers, lambda k, _: F.lower(k) == name.lower())
    return F.get(F.map_values(hits), F.lit(0))


def next_link(link_header: Column) -> Column:
    """URL of the ``rel="next"`` entry of a Link header, null when there is none."""
    pattern = r"""<([^>]*)>[^<]*?;\s*rel\s*=\s*["']?next["']?\s*(?:[;,]|$)"""
    found = F.regexp_extract(link_header, pattern, 1)
    return F.when(found != "", found)


def java_regex(pattern: str) -> str:
    """Rewrite Python's named-group spelling to Java's."""
    named = re.sub(r"\(\?P<(\w+)>", lambda m: f"(?<{m.group(1).replace('_', 'U')}>", pattern)
    return re.sub(r"\(\?P=(\w+)\)", lambda m: rf"\k<{m.group(1).replace('_', 'U')}>", named)


def session_id(url: Column, pattern: str | None, group: int = 0) -> Column:
    """First match of ``pattern`` in the URL, trimmed; null without one."""
    if not pattern or group > re.compile(pattern).groups:
        return F.lit(None).cast("string")
    hit = F.regexp_extract(url, java_regex(pattern), group)
    hit = F.regexp_replace(hit, r"^\s+|\s+$", "")
    return F.when(hit != "", hit)


# ---- maps ------------------------------------------------------------------


def merge_params(base: Column, over: Column) -> Column:
    """Union of two string maps; ``over`` wins on a shared key."""
    empty = F.from_json(F.lit("{}"), T.MapType(T.StringType(), T.StringType()))
    base, over = F.coalesce(base, empty), F.coalesce(over, empty)
    kept = F.map_filter(base, lambda k, _: ~F.array_contains(F.map_keys(over), k))
    return F.map_concat(kept, over)


def redact(values: Column, names: list[str]) -> Column:
    """Mask the values of the named keys, names matched in any case."""
    return F.transform_values(
        values, lambda k, v: F.when(F.lower(k).isin(names), F.lit(REDACTED)).otherwise(v)
    )


# ---- time ------------------------------------------------------------------


def spark_pattern(fmt: str) -> str:
    """Spark datetime pattern of a strftime format."""
    out, literal, i = [], "", 0

    def flush() -> None:
        nonlocal literal
        if literal:
            out.append("'" + literal.replace("'", "''") + "'")
            literal = ""

    while i < len(fmt):
        if fmt[i] == "%" and i + 1 < len(fmt):
            code = fmt[i + 1]
            if code == "%":
                literal += "%"
            elif code in STRFTIME:
                flush()
                out.append(STRFTIME[code])
            else:
                raise ValueError(f"date format directive %{code} is not supported")
            i += 2
        else:
            literal += fmt[i]
            i += 1
    flush()
    return "".join(out)


def format_date(col: Column, fmt: str) -> Column:
    return F.date_format(col.cast("timestamp_ntz"), spark_pattern(fmt))


def utc_ntz(instant: Column) -> Column:
    """UTC wall clock of a timestamp, whatever the session time zone is."""
    micros = F.unix_micros(instant)
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(0), (micros.cast("decimal(18,0)") / 1000000).cast("decimal(18,6)")
    )


def coerce_ts(col: Column, kind: T.DataType) -> Column:
    """Lenient UTC instant; null when the value cannot be read as a time.

    Text without an offset is taken as UTC, numbers as nanoseconds since 1970.
    """
    if isinstance(kind, T.TimestampNTZType):
        return F.concat(col.cast("string"), F.lit("Z")).try_cast("timestamp")
    if isinstance(kind, (T.TimestampType, T.DateType)):
        return col.try_cast("timestamp")
    if isinstance(kind, T.BooleanType):
        return F.lit(None).cast("timestamp")
    if isinstance(kind, T.NumericType):
        return F.timestamp_micros((col / 1000).cast("bigint"))
    text = F.trim(col.try_cast("string"))
    zoned = text.rlike(r"(?i)(z|utc|[+-]\d{2}(:?\d{2})?)$") & text.rlike(r"\d{2}:\d{2}")
    shaped = F.when(text.rlike(r"^\d{4}"), text)
    day_only = text.rlike(r"^\d{4}(-\d{1,2}){0,2}$")
    return (
        F.when(zoned, shaped)
        .when(day_only, F.concat(shaped.try_cast("date").cast("string"), F.lit("T00:00:00Z")))
        .otherwise(F.concat(shaped, F.lit("Z")))
        .try_cast("timestamp")
    )


# ---- text ------------------------------------------------------------------


def stringify_nested(df: DataFrame, keep_nulls: bool = False) -> DataFrame:
    """Nested columns as JSON text; scalar columns untouched."""
    nested = (T.StructType, T.ArrayType, T.MapType, T.VariantType)
    options = {"ignoreNullFields": str(not keep_nulls).lower()}
    return df.select(
        *[
            F.to_json(F.col(quoted(f.name)), options).alias(f.name)
            if isinstance(f.dataType, nested)
            else F.col(quoted(f.name))
            for f in df.schema.fields
        ]
    )


def render(template: str, values: dict[str, Any]) -> str:
    """Fill a path template on the driver; an unknown session id reads ``none``."""
    return template.format(**{"session_id": "none", **values})


def render_column(template: str, values: dict[str, Any]) -> Column:
    """The same template where some values are columns (session id, sequence)."""
    parts: list[Column] = []
    for text, name, spec, _ in Formatter().parse(template):
        if text:
            parts.append(F.lit(text))
        if name is None:
            continue
        value = values.get(name, "none" if name == "session_id" else None)
        if value is None:
            raise KeyError(name)
        if isinstance(value, Column):
            parts.append(F.coalesce(value.cast("string"), F.lit("none")))
        else:
            parts.append(F.lit(format(value, spec or "")))
    return F.concat(*parts) if parts else F.lit("")
