"""Very many small Parquet objects in a folder that executors mount.

Spark's file writer pays some milliseconds for each object: without Hadoop's native library the local
file system starts a process for every permission it sets, about six an object, and the driver moves
the folders of a partitioned overwrite one after the other. Here a task gets its rows sorted by part
and writes them with Arrow below a staging folder; when all are written, tasks move them into place.

Names hold the run and the task's number, so that a task that runs again writes the same objects.
A part that was written before is replaced as a whole; other parts stay. What fails before the moves
begin changes nothing.
"""

from __future__ import annotations

import os
import re
import shutil
import uuid
from collections.abc import Iterator
from contextlib import suppress
from itertools import islice

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from pageloom.runtime import landed, quoted

KINDS = {"snappy": ".snappy", "uncompressed": "", "gzip": ".gz", "zstd": ".zstd"}
# Types that Arrow and Spark write alike; a frame with others is left to Spark's writer.
PLAIN = (
    *(T.StringType, T.BinaryType, T.BooleanType, T.ByteType, T.ShortType, T.IntegerType, T.LongType),
    *(T.FloatType, T.DoubleType, T.DateType),
)
LISTED, READ_ROWS = 1000, 10_000
NO_NAME = "__HIVE_DEFAULT_PARTITION__"
# Characters that Spark escapes in the name of a partition's folder.
ESCAPED = {*map(chr, range(1, 32)), *"\"#%'*/:=?\\\x7f{[]^"}


def mounted(spark: SparkSession, path: str) -> str | None:
    """The path as plain files have it, or None where another file system holds it."""
    sc = spark.sparkContext
    given = sc._jvm.org.apache.hadoop.fs.Path(path)
    uri = given.getFileSystem(sc._jsc.hadoopConfiguration()).makeQualified(given).toUri()
    return uri.getPath() if uri.getScheme() == "file" else None


def fits(df: DataFrame, by: str, compression: str) -> bool:
    kinds = [f.dataType for f in df.schema.fields if f.name != by]
    # the second condition leaves out strings with a collation of their own
    plain = all(type(k) in PLAIN and k.simpleString() in (k.typeName(), "tinyint", "smallint", "int", "bigint") for k in kinds)
    return bool(kinds) and plain and compression in KINDS


def escape(text: str) -> str:
    return "".join(f"%{ord(c):02X}" if c in ESCAPED else c for c in text)


def folder_name(by: str, value: str | None) -> str:
    """The folder of a partition as Spark names it."""
    return f"{escape(by)}={escape(value) if value else NO_NAME}"


def unescaped(name: str) -> str | None:
    if name == NO_NAME:
        return None
    return re.sub("%([0-9A-Fa-f]{2})", lambda m: chr(int(m[1], 16)), name)


def runs(values: pa.Array) -> list[int]:
    """Where runs of equal values begin, and the end."""
    if len(values) < 2:
        return [0, len(values)]
    import pyarrow.compute as pc

    a, b = values.slice(1), values.slice(0, len(values) - 1)
    differ = pc.fill_null(pc.not_equal(a, b), True)
    same_null = pc.and_(pc.is_null(a), pc.is_null(b))
    changes = pc.indices_nonzero(pc.and_not(differ, same_null)).to_pylist()
    return [0, *(i + 1 for i in changes), len(values)]


def write_objects(df: DataFrame, by: str, folder: str, compression: str) -> int:
    """Rows written, each to ``folder``/``by``=value; rows of a value should meet in few tasks."""
    run = uuid.uuid4().hex
    stage = f"{folder.rstrip('/')}/.objects-{run}"
    os.makedirs(stage, exist_ok=True)
    kept = [f for f in df.schema.fields if f.name != by]
    told = {"org.apache.spark.sql.parquet.row.metadata": T.StructType(kept).json()}
    names = [f.name for f in kept]

    def write(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.parquet as pq

        task = TaskContext.get()
        name = f"part-{task.partitionId():05d}-{run}{KINDS[compression]}.parquet"
        kind = "none" if compression == "uncompressed" else compression
        # Attempts of a task may overlap; each has a file of its own until an object is whole.
        own = f"{stage}/.{task.taskAttemptId()}"
        out, file, at, done, rows = None, None, None, [], 0

        def end() -> None:
            if out is not None:
                out.close()
                file.close()
                os.replace(own, f"{stage}/{at}/{name}")

        for batch in source:
            parts = batch.column(by)
            held = batch.select(names).replace_schema_metadata(told)
            bounds = runs(parts)
            for low, high in zip(bounds[:-1], bounds[1:]):
                if low == high:
                    continue
                here = folder_name(by, parts[low].as_py())
                if here != at:
                    end()
                    with suppress(FileExistsError):
                        os.mkdir(f"{stage}/{here}")
                    file = pa.OSFile(own, "wb")
                    out = pq.ParquetWriter(file, held.schema, compression=kind, store_schema=False)
                    at = here
                    done.append(here)
                out.write_batch(held.slice(low, high - low))
                rows += high - low
        end()
        told_rows = [rows] + [0] * (len(done) - 1)
        if done:
            yield pa.RecordBatch.from_arrays(
                [pa.array(done, pa.string()), pa.array(told_rows, pa.int64())], names=["name", "rows"]
            )

    def move(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            for here in batch.column("name").to_pylist():
                into(f"{stage}/{here}", f"{folder}/{here}", run)
            yield batch

    try:
        sorted_rows = df.sortWithinPartitions(F.col(quoted(by)))
        wrote = landed(sorted_rows.mapInArrow(write, "name string, rows long"), "objects")
        rows = wrote.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
        n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        moved = wrote.select("name").repartition(n, "name").mapInArrow(move, "name string")
        moved.write.format("noop").mode("overwrite").save()
    finally:
        shutil.rmtree(stage, ignore_errors=True)
    return int(rows)


def into(stage: str, folder: str, run: str) -> None:
    """Move a part's objects into place; those of other runs go. Doing it twice does no harm."""
    try:
        os.rename(stage, folder)  # in place at once where the part is new
        return
    except FileNotFoundError:  # moved by an attempt before
        staged = []
    except OSError:
        staged = os.listdir(stage)
    for name in staged:
        with suppress(FileNotFoundError):
            os.replace(f"{stage}/{name}", f"{folder}/{name}")
    for name in os.listdir(folder):
        if run not in name:
            with suppress(FileNotFoundError):
                os.remove(f"{folder}/{name}")
    with suppress(OSError):
        os.rmdir(stage)


def read_objects(spark: SparkSession, folder: str, schema: T.StructType, by: str) -> DataFrame:
    """The rows below ``folder``/``by``=value with the columns of ``schema``, ``by`` as text.

    One task lists the parts, and tasks read them: no list of all objects is made on the driver.
    """
    kept = [f.name for f in schema.fields if f.name != by]
    wanted = to_arrow_schema(schema)
    mark = escape(by) + "="

    def placed(rows: pa.RecordBatch, value: str | None) -> pa.Table:
        found = dict(zip(rows.schema.names, rows.columns)) | {by: pa.repeat(pa.scalar(value, pa.string()), rows.num_rows)}
        return pa.Table.from_arrays([found[f.name].cast(f.type) if f.name in found else pa.nulls(rows.num_rows, f.type) for f in wanted], schema=wanted)

    def listed(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _ in source:
            found = (e.name for e in os.scandir(folder) if e.name.startswith(mark))
            while some := list(islice(found, LISTED)):
                yield pa.RecordBatch.from_arrays([pa.array(some, pa.string())], names=["name"])

    def read(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.parquet as pq

        held, held_rows = [], 0
        for batch in source:
            for name in batch.column("name").to_pylist():
                value = unescaped(name[len(mark) :])
                for file in os.listdir(f"{folder}/{name}"):
                    if file[0] in "._":
                        continue
                    with pq.ParquetFile(f"{folder}/{name}/{file}") as f:
                        asked = [n for n in kept if n in f.schema_arrow.names]
                        for rows in f.iter_batches(READ_ROWS, columns=asked, use_threads=False):
                            held.append(placed(rows, value))
                            held_rows += rows.num_rows
                            if held_rows >= READ_ROWS:
                                yield from pa.concat_tables(held).combine_chunks().to_batches()
                                held, held_rows = [], 0
        if held:
            yield from pa.concat_tables(held).combine_chunks().to_batches()

    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    names = spark.range(0, 1, 1, 1).mapInArrow(listed, "name string").repartition(n, "name")
    return names.mapInArrow(read, schema)
