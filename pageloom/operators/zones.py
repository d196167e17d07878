"""Zone maps of landed records: which files a stop rule, a window or a page range needs.

Records are landed in the order of chain and page, and a side table says of each file and chain
which pages are in it and the least and greatest value of the fields that stop rules look at. A stop
rule first asks the side table: a file that holds a time before the limit ends its chain at its last
page at the latest, so no file that begins after that page can matter, for the cut or for the rows.
Only a value that is looked for needs a look into files, those whose range has it in, and there at
its column alone. The rule itself is the one for any records; it is given fewer files.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pageloom.functions.scalars import coerce_ts
from pageloom.operators.stops import CHAIN, ROW, StopSpec, apply_stops, equals
from pageloom.runtime import quoted, scratch_path

#: File names the driver names in a plan at most; beyond, all files are read and rows are filtered.
LISTED = 100_000


@dataclass
class Zoned:
    """Landed records with their zones: one row a file and chain."""

    spark: SparkSession
    path: str
    schema: T.StructType
    fields: list[str]
    zones: DataFrame

    def files(self, zones: DataFrame) -> list[str] | None:
        """Names of the files of some zones, or nothing where there are too many to name."""
        names = [r[0] for r in zones.select("file").distinct().limit(LISTED + 1).collect()]
        return None if len(names) > LISTED else sorted(names)

    def of(self, zones: DataFrame) -> DataFrame:
        """The records of these files."""
        names = self.files(zones)
        if names is not None and not names:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*(names if names is not None else [self.path]))

    def read(self, windows: tuple[int, int] | None = None, pages: tuple[int, int] | None = None, pulls: Sequence[str] | None = None) -> DataFrame:
        """Records of some pulls, window numbers and page numbers (both ends included), from the
        files that have them."""
        zones, rows = self.zones, F.lit(True)
        for bounds, low, high, column in ((windows, "_window_seq", "_window_seq", "_window_seq"), (pages, "page_lo", "page_hi", "_page_seq")):
            if bounds:
                zones = zones.where((F.col(high) >= bounds[0]) & (F.col(low) <= bounds[1]))
                rows = rows & F.col(column).between(*bounds)
        if pulls is not None:
            zones, rows = zones.where(F.col("_pull").isin(*pulls)), rows & F.col("_pull").isin(*pulls)
        return self.of(zones).where(rows)


def land_zoned(records: DataFrame, fields: Sequence[str], below: str | None = None, files: int | None = None) -> Zoned:
    """Write records in the order of their rows, in at most ``files`` files (as many as the session
    shuffles to unless given), and the zones of ``fields`` beside them."""
    spark = records.sparkSession
    path = scratch_path(spark, "records", below)
    order = [F.col(c) for c in ROW]
    dealt = records.repartitionByRange(files, *order) if files else records.repartitionByRange(*order)
    dealt.sortWithinPartitions(*order).write.parquet(path)
    landed = spark.read.schema(records.schema).parquet(path)
    known = [f for f in dict.fromkeys(fields) if f in records.columns]
    told: list[Column] = [F.count(F.lit(1)).alias("rows"), F.min("_page_seq").alias("page_lo"), F.max("_page_seq").alias("page_hi")]
    for i, name in enumerate(known):
        value, kind = F.col(quoted(name)), records.schema[name].dataType
        time = coerce_ts(value, kind)
        told += [F.min(value).alias(f"lo{i}"), F.max(value).alias(f"hi{i}"), F.min(time).alias(f"time{i}")]
        told.append(F.count_if(value.isNotNull() & time.isNull()).alias(f"unread{i}"))
    place = f"{path}-zones"
    zones = landed.groupBy(F.col("_metadata.file_path").alias("file"), *CHAIN).agg(*told)
    zones.write.parquet(place)
    return Zoned(spark, path, records.schema, known, spark.read.schema(zones.schema).parquet(place))


def _last_pages(zoned: Zoned, stop: StopSpec) -> DataFrame | None:
    """(chain, _last): a page that a chain does not go beyond, for chains where the zones tell one."""
    empty = zoned.spark.createDataFrame([], zoned.schema)
    found: list[DataFrame] = []
    if stop.older_active(empty) and stop.older_field in zoned.fields:
        i = zoned.fields.index(stop.older_field)
        limit = coerce_ts(F.lit(str(stop.older_value)), T.StringType())
        ends = zoned.zones.where((F.col(f"time{i}") < limit) | (F.col(f"unread{i}") > 0))
        found.append(ends.groupBy(*CHAIN).agg(F.min("page_hi").alias("_last")))
    if stop.item_active(empty) and stop.item_field in zoned.fields:
        i = zoned.fields.index(stop.item_field)
        equal = equals(empty, stop.item_field, stop.item_value)
        if equal is not None:
            value = F.lit(stop.item_value)
            rows = zoned.of(zoned.zones.where((F.col(f"lo{i}") <= value) & (F.col(f"hi{i}") >= value)))
            found.append(rows.where(equal).groupBy(*CHAIN).agg(F.min("_page_seq").alias("_last")))
    if not found:
        return None
    both = found[0] if len(found) == 1 else found[0].unionByName(found[1])
    return both.groupBy(*CHAIN).agg(F.min("_last").alias("_last"))


def apply_stops_zoned(zoned: Zoned, stop: StopSpec, max_chains: int | None = None) -> DataFrame:
    """Records up to the stop of each chain, from the files that can hold them."""
    last = _last_pages(zoned, stop)
    if last is None:
        return apply_stops(zoned.of(zoned.zones), stop, max_chains)
    needed = zoned.zones.join(last, CHAIN, "left").where(F.col("_last").isNull() | (F.col("page_lo") <= F.col("_last")))
    return apply_stops(zoned.of(needed), stop, max_chains)
