"""Shared-folder handling and the column names every stage agrees on."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Key of a landed response, and the same key on parsed records.
RESPONSE_KEYS = ["pull", "window_seq", "page_seq"]
CHAIN_KEYS = ["pull", "window_seq"]
META = ["_pull", "_window_seq", "_page_seq", "_row_seq"]
# Every helper column a frame may carry; none of them is written out.
INTERNAL = [*META, "_url_idx", "_links", "_url", "_session_id", "_detail_seq", "_seq"]

RESPONSES_SCHEMA = T.StructType(
    [
        T.StructField("pull", T.StringType()),
        T.StructField("window_seq", T.LongType()),
        T.StructField("window_start", T.DateType()),
        T.StructField("window_end", T.DateType()),
        T.StructField("page_seq", T.LongType()),
        T.StructField("url", T.StringType()),
        T.StructField("params", T.MapType(T.StringType(), T.StringType())),
        T.StructField("status", T.IntegerType()),
        T.StructField("headers", T.MapType(T.StringType(), T.StringType())),
        T.StructField("body", T.StringType()),
    ]
)

# A side is broadcast only when it is measured to be below both bounds.
BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 64 << 20


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: the one named in ``spark.checkpoint.dir``.

    A machine-local folder is made only in local mode, where nothing is set.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named and sc.getCheckpointDir():
        named = sc.getCheckpointDir()
    if not named:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        named = tempfile.mkdtemp(prefix="pageloom-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(named)
    return named.rstrip("/")


def scratch_path(spark: SparkSession, label: str, below: str | None = None) -> str:
    """A fresh path below a given folder, or below the shared one."""
    root = below.rstrip("/") if below else f"{shared_dir(spark)}/pageloom"
    return f"{root}/{label}-{uuid.uuid4().hex}"


def settle(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read on from there (lineage is cut)."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def landed(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read on from there: later reads see
    only the columns they ask for, and a lost executor loses nothing."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fits_broadcast(df: DataFrame) -> bool:
    """Measure ``df`` against the broadcast limits.

    Only row widths are looked at, and no more than one past the row limit: the
    plan is a plain limit, which reads partitions a few at a time and stops as
    soon as it has enough.
    """
    width = F.length(F.to_json(F.struct(*[F.col(_quoted(c)) for c in df.columns])))
    seen = df.select(width.alias("w")).limit(BROADCAST_ROWS + 1).collect()
    return len(seen) <= BROADCAST_ROWS and sum(r["w"] or 0 for r in seen) <= BROADCAST_BYTES


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def quoted(name: str) -> str:
    """Column name safe for ``F.col`` even when it holds dots."""
    return _quoted(name)


def meta_of(df: DataFrame) -> list[str]:
    return [c for c in META if c in df.columns]


def payload_of(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c not in META]
