"""An append-only log of what a backfill has committed.

Each commit is one small JSON file with the next number. It is written under another name first and
then renamed to its own, which fails if the number is taken: of two writers one wins, the other sees
what was committed and takes the next number, or gives up where both did the same windows. Rows
belong to the table when the commit that names their folder is there, and not before: what a run
that died has written is in no commit, and no reader sees it.

The rename is atomic on HDFS and alike; on a store whose rename copies, use a file system that
commits by conditional put.
"""

from __future__ import annotations

import json
import uuid
from datetime import date
from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

ENTRY = (
    "version bigint, windows array<struct<start:string,end:string>>, token string, ended boolean, "
    "pages bigint, path string, rows bigint, bytes bigint, truncated boolean, committed_at string"
)


class CommittedElsewhere(RuntimeError):
    """Another run has committed some of the same windows, or the same stretch of a chain."""


class SnapshotLog:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    # ---- files ---------------------------------------------------------------

    def _path(self, name: str) -> Any:
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")

    def _put(self, name: str, text: str) -> bool:
        """Write a file unless there is one of this name."""
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        target, draft = self._path(name), self._path(f"_draft-{uuid.uuid4().hex}")
        fs = target.getFileSystem(conf)
        fs.mkdirs(target.getParent())
        out = fs.create(draft, False)
        out.write(bytearray(text.encode()))
        out.close()
        plain = self.spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), conf)
        try:
            context.rename(draft, target, plain)
        except Py4JJavaError:
            taken = fs.exists(target)
            fs.delete(draft, False)
            if not taken:
                raise
            return False
        return True

    # ---- entries -------------------------------------------------------------

    def entries(self) -> list[dict[str, Any]]:
        """All commits in order: one a batch of windows, or a stretch of a chain."""
        try:
            found = self.spark.read.schema(ENTRY).json(f"{self.folder}/commit-*.json").collect()
        except AnalysisException as e:
            if e.getCondition() == "PATH_NOT_FOUND":
                return []
            raise
        return sorted((r.asDict(recursive=True) for r in found), key=lambda r: r["version"])

    def windows(self) -> set[tuple[str, str]]:
        return {(w["start"], w["end"]) for e in self.entries() for w in e["windows"] or []}

    def commit(self, committed_at: str, windows: list[tuple[date, date]] = (), **values: Any) -> int:
        """Append a commit; returns its number."""
        mine = [{"start": str(s), "end": str(e)} for s, e in windows]
        known = self.entries()
        begun = len(known)
        while True:
            version = known[-1]["version"] + 1 if known else 0
            row = {"version": version, "windows": mine, "committed_at": committed_at, **values}
            if self._put(f"commit-{version:012d}.json", json.dumps(row)):
                return version
            known = self.entries()
            theirs = {(w["start"], w["end"]) for e in known[begun:] for w in e["windows"] or []}
            if not mine or theirs & {(w["start"], w["end"]) for w in mine}:
                raise CommittedElsewhere(f"{self.folder} was committed to by another run")

    # ---- the table -----------------------------------------------------------

    def read(self, format: str = "parquet", **options: Any) -> DataFrame:
        """The committed rows, and no others."""
        paths = [e["path"] for e in self.entries() if e["path"] and e["rows"]]
        if not paths:
            raise ValueError(f"nothing is committed in {self.folder}")
        reader = self.spark.read.format(format).options(**options)
        return (reader.option("mergeSchema", True) if format == "parquet" else reader).load(paths)
