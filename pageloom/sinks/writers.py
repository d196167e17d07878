"""Write a frame as CSV, JSON lines or Parquet under a templated path."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timezone
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pageloom.functions.scalars import render, render_column, stringify_nested
from pageloom.operators.sequence import sequence_rows
from pageloom.operators.skew import spread_by
from pageloom.runtime import INTERNAL, META, quoted
from pageloom.sinks import objects

EXTENSIONS = {"csv": "csv", "jsonl": "jsonl", "parquet": "parquet"}


@dataclass(frozen=True)
class SinkSpec:
    """Where and how rows are written. ``root`` is a bucket URI or any folder."""

    root: str
    format: str = "csv"
    prefix: str = ""
    filename: str = ""
    sep: str = ","
    index: bool = False
    compression: str | None = None
    write_empty: bool = True
    stringify: bool = True
    single_file: bool = False

    def __post_init__(self) -> None:
        if self.format not in EXTENSIONS:
            raise ValueError(f"output format {self.format!r} is not one of {sorted(EXTENSIONS)}")
        if not self.root:
            raise ValueError("output needs a bucket or a path")

    @classmethod
    def from_options(cls, options: dict[str, Any] | None) -> SinkSpec:
        if not options:
            raise ValueError("an output section is required")
        store = options.get("s3") or {}
        bucket = (store.get("bucket") or "").strip()
        root = options.get("path") or (f"s3a://{bucket}" if bucket else "")
        if not root:
            raise ValueError("output needs s3.bucket or path")
        return cls(
            root=root,
            format=(options.get("format") or "csv").lower(),
            prefix=store.get("prefix") or options.get("prefix") or "",
            filename=store.get("filename") or options.get("filename") or "",
            sep=store.get("sep", ","),
            index=bool(store.get("index", False)),
            compression=store.get("compression"),
            write_empty=bool(options.get("write_empty", True)),
            stringify=bool(options.get("stringify", True)),
            single_file=bool(options.get("single_file", False)),
        )

    def path(self, values: dict[str, Any]) -> str:
        name = self.filename or "{table}-{now:%Y%m%dT%H%M%SZ}." + EXTENSIONS[self.format]
        parts = [render(self.prefix, values).strip("/"), render(name, values)]
        return "/".join([self.root.rstrip("/"), *[p for p in parts if p]])


def path_values(table: str, env: str, now: datetime | None = None, **more: Any) -> dict[str, Any]:
    now = now or datetime.now(timezone.utc)
    return {"table": table, "env": env, "now": now, "today": now, **more}


def shape_rows(df: DataFrame, spec: SinkSpec) -> DataFrame:
    """Payload columns as the format can hold them."""
    if spec.format == "csv" and spec.index:
        order = [c for c in [*META, "_url_idx", "_detail_seq"] if c in df.columns]
        df = sequence_rows(df, order or df.columns, "index")
        df = df.select("index", *[F.col(quoted(c)) for c in df.columns if c != "index"])
    df = df.select(*[F.col(quoted(c)) for c in df.columns if c not in INTERNAL])
    if spec.format == "csv" or (spec.format == "parquet" and spec.stringify):
        df = stringify_nested(df)
    return df


def writer(df: DataFrame, spec: SinkSpec):
    # A rendered name is written anew; other names below the same prefix stay.
    out = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    kind = (spec.compression or "").lower()
    if spec.format == "csv":
        out = out.format("csv").option("header", True).option("sep", spec.sep)
        out = out.option("escape", '"').option("emptyValue", "")
        return out.option("compression", "gzip") if kind == "gzip" else out
    if spec.format == "jsonl":
        return out.format("json").option("ignoreNullFields", False)
    return out.format("parquet").option("compression", codec(spec))


def codec(spec: SinkSpec) -> str:
    kind = (spec.compression or "").lower()
    return {"": "snappy", "none": "uncompressed"}.get(kind, kind)


def write_frame(df: DataFrame, spec: SinkSpec, path: str, by: list[str] | None = None) -> int:
    """Write and return the row count, taken in the same pass."""
    if not spec.write_empty and df.isEmpty():
        raise ValueError("no rows to write and write_empty is off")
    shaped = shape_rows(df, spec)
    if not shaped.columns:
        # Files cannot hold a table without columns; the manifest alone tells of it.
        return 0
    if any(isinstance(f.dataType, T.NullType) for f in shaped.schema.fields):
        shaped = shaped.select(
            *[
                F.col(quoted(f.name)).cast("string").alias(f.name)
                if isinstance(f.dataType, T.NullType)
                else F.col(quoted(f.name))
                for f in shaped.schema.fields
            ]
        )
    if spec.single_file:
        shaped = shaped.coalesce(1)
    if by and len(by) == 1 and spec.format == "parquet":
        kind = codec(spec)
        folder = objects.mounted(df.sparkSession, path)
        if folder and objects.fits(shaped, by[0], kind):
            return objects.write_objects(shaped, by[0], folder, kind)
    seen = Observation()
    shaped = shaped.observe(seen, F.count(F.lit(1)).alias("rows"))
    out = writer(shaped, spec)
    if by:
        out = out.partitionBy(*by)
    out.save(path)
    return int(seen.get["rows"])


def flush_parts(
    df: DataFrame, spec: SinkSpec, values: dict[str, Any], template: str, path: str
) -> int:
    """One object per rendered name (per link or per session), in one write.

    ``template`` may use ``{session_id}`` and ``{seq}``, which are columns of
    ``df`` (``_session_id``, ``_seq``). Rows meet by name; a session with very
    many rows is written by several tasks, into several files of its folder.
    """
    columns = (("session_id", "_session_id"), ("seq", "_seq"))
    more = {k: F.col(c) for k, c in columns if c in df.columns}
    named = df.withColumn("part", render_column(template, {**values, **more}))
    row_id = [c for c in [*META, "_url_idx", "_detail_seq"] if c in df.columns]
    named = spread_by(named, ["part"], row_id or df.columns)
    return write_frame(named, spec, path, by=["part"])


def written_bytes(spark: SparkSession, path: str) -> int:
    """Size of the data files below a path; file contents are not read."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "part-*")
    )
    try:
        sizes = files.load(path).agg(F.coalesce(F.sum("length"), F.lit(0)).alias("b"))
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return 0  # a frame without columns was not written
        raise
    return int(sizes.first()["b"])
