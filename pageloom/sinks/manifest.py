"""The one-row record of a run."""

from __future__ import annotations

from datetime import datetime, timezone
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

MANIFEST_SCHEMA = T.StructType(
    [
        T.StructField("table", T.StringType()),
        T.StructField("env", T.StringType()),
        T.StructField("rows", T.LongType()),
        T.StructField("format", T.StringType()),
        T.StructField("path", T.StringType()),
        T.StructField("bytes", T.LongType()),
        T.StructField("started_at", T.TimestampType()),
        T.StructField("ended_at", T.TimestampType()),
        T.StructField("duration_s", T.DoubleType()),
        T.StructField("source_url", T.StringType()),
        T.StructField("strategy", T.StringType()),
        T.StructField("pagination_mode", T.StringType()),
        T.StructField("windows", T.IntegerType()),
        # A set cap on pages ended a pull that goes on.
        T.StructField("truncated", T.BooleanType()),
    ]
)


def manifest(started: datetime, **values: Any) -> dict[str, Any]:
    ended = datetime.now(timezone.utc)
    row = {name: None for name in MANIFEST_SCHEMA.names}
    row |= {"started_at": started, "ended_at": ended}
    row |= {"duration_s": (ended - started).total_seconds()}
    return row | values


def manifest_frame(spark: SparkSession, rows: list[dict[str, Any]]) -> DataFrame:
    data = [tuple(r[name] for name in MANIFEST_SCHEMA.names) for r in rows]
    return spark.createDataFrame(data, MANIFEST_SCHEMA)
