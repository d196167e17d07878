"""WARC archives: write, read back, and an external merge of capture indexes.

Pages become WARC/1.1 records (HTTP response records, or revisit records that refer to the
response with the same payload) in archives of bounded size, written by Spark. Reading an archive
gives its captures sorted by URL key and timestamp: a run. Runs are cut at common key ranges, so
that each task holds one range of every run, and a loser tree merges them there; tasks in order
of their range are the global order, in which all captures of a URL, its history, are neighbours.
A URL with very many captures is cut by its timestamps, too.

Defined results: a null page is an empty one; a null url is empty; line breaks and blanks in urls become %20;
of equal payloads that with the largest id is the response (rows that share this id are all
responses), others revisit it, null ids included; payloads below ``min_bytes`` are all
responses; an empty table writes no archive and reads as no captures; extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pageloom.catalog.registry import query
from pageloom.llm.common import bounded, land, table, tasks_for
from pageloom.runtime import scratch_path

#: Bytes an archive holds about; one is read by one task as a whole.
ARCHIVE_BYTES = 16 << 20
#: Captures that one task merges about.
MERGE_ROWS = 50_000
FIRST = 1_700_000_000
#: Ids count as seconds after that, round and round in this span, so that every id has a date.
SPAN = 1_000_000_000
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CAPTURES = "urlkey string, timestamp string, page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, archive string, at long, size long"


def payload_digest(html: Column) -> Column:
    """Base32 of SHA-1: each ten hexadecimal digits are eight digits to the base 32."""
    sha = F.sha1(html.cast("binary"))
    parts = [F.lpad(F.conv(F.substring(sha, at, 10), 16, 32), 8, "0") for at in (1, 11, 21, 31)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def write(pages: DataFrame, path: str, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", time: Column | None = None, min_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES) -> int:
    """Write a record per row below ``path``; returns their number. ``time``: seconds since 1970."""
    html = F.coalesce(F.col(html_col), F.lit(""))
    time = F.pmod(F.col(id_col).cast("long"), F.lit(SPAN)) + FIRST if time is None else time
    rows = pages.select(
        F.col(id_col).cast("long").alias("id"), F.translate(F.coalesce(F.col(url_col), F.lit("")), "\r\n", "  ").alias("url"), html.alias("html"),
        F.octet_length(html).cast("long").alias("bytes"), payload_digest(html).alias("digest"), F.coalesce(time, F.lit(FIRST)).cast("long").alias("time"),
    )
    seen = land(rows.select("id", "digest", "bytes"), "digests")
    n, total = seen.agg(F.count("*"), F.coalesce(F.sum("bytes"), F.lit(0))).first()
    same = seen.where(F.col("bytes") >= min_bytes).groupBy("digest").agg(F.max("id").alias("first_id"), F.count("*").alias("of")).where("of > 1 AND first_id IS NOT NULL").drop("of")
    rows = rows.withColumn("key", F.when(F.col("bytes") >= min_bytes, F.col("digest"))).join(bounded(land(same.withColumnRenamed("digest", "key"), "repeated")), "key", "left")
    revisit = F.col("first_id").isNotNull() & ~F.col("first_id").eqNullSafe(F.col("id"))
    eol = F.lit("\r\n")
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("bytes").cast("string"), eol, eol)
    body = F.when(revisit, F.lit("")).otherwise(F.col("html"))
    name = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit(">"))
    url = F.replace("url", F.lit(" "), F.lit("%20"))
    head = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "), F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")),
        F.lit("\r\nWARC-Record-ID: "), name("id"), F.lit("\r\nWARC-Date: "), F.date_format(F.timestamp_seconds("time"), "yyyy-MM-dd'T'HH:mm:ss'Z'"),
        F.lit("\r\nWARC-Target-URI: "), url, F.lit("\r\nWARC-Payload-Digest: sha1:"), F.col("digest"),
        F.when(revisit, F.concat(F.lit(f"\r\nWARC-Profile: {PROFILE}\r\nWARC-Refers-To: "), name("first_id"))).otherwise(F.lit("")),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "), (F.octet_length(http) + F.octet_length(body)).cast("string"), eol, eol,
    )
    # the writer ends each value with the line feed that ends a record
    record = F.concat(head, http, body, F.lit("\r\n\r"))
    per_file = max(1, int(archive_bytes // max(1, total // max(n, 1) + 600)))
    rows.select(record.alias("value")).write.option("lineSep", "\n").option("maxRecordsPerFile", per_file).text(path)
    return n


def records(raw: bytes) -> Iterator[tuple[dict[str, str], int, int, bytes]]:
    """(headers, offset, size, block) of each record of an archive, by the lengths they state."""
    at = 0
    while at < len(raw):
        end = raw.index(b"\r\n\r\n", at)
        lines = raw[at:end].decode("utf-8", "replace").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no record at byte {at}")
        headers = dict(line.split(": ", 1) for line in lines[1:])
        first, size = end + 4, int(headers["Content-Length"])
        if raw[first + size : first + size + 4] != b"\r\n\r\n":
            raise ValueError(f"record at byte {at} is cut off")
        yield headers, at, first + size + 4 - at, raw[first : first + size]
        at = first + size + 4


def url_key(url: str) -> str:
    """Host from the top domain down, then path and query, in lower case."""
    try:
        parts = urlsplit(url.lower())
        host = parts.hostname or ""
    except ValueError:
        return url.lower()
    host = ",".join(reversed(host.removeprefix("www.").split(".")))
    return f"{host}){parts.path or '/'}{'?' + parts.query if parts.query else ''}"


def runs(spark: SparkSession, path: str) -> DataFrame:
    """Captures of every archive below ``path``, each archive's in order, with checked payloads."""

    def number(name: str) -> int | None:
        digits = name.removeprefix("<urn:page:").removesuffix(">")
        return int(digits) if digits else None

    def read(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            for i in range(batch.num_rows):
                archive, raw = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
                made = []
                for headers, at, size, block in records(raw):
                    http, _, payload = block.partition(b"\r\n\r\n")
                    stated = int(http.rsplit(b": ", 1)[1])
                    digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
                    kind = headers["WARC-Type"]
                    if kind == "response" and (len(payload) != stated or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest):
                        raise ValueError(f"{archive}: the payload at byte {at} is not what its record says")
                    url, refers = headers["WARC-Target-URI"], headers.get("WARC-Refers-To")
                    made.append((url_key(url), headers["WARC-Date"], number(headers["WARC-Record-ID"]), url, kind, number(refers) if refers else None, stated, digest, archive, at, size))
                made.sort(key=order)
                if made:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*made), [pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64()])], names=[c.split()[0] for c in CAPTURES.split(", ")])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")
    return files.mapInArrow(read, CAPTURES)


def order(capture: tuple) -> tuple:
    return (capture[0], capture[1], capture[2] is not None, capture[2] or 0, capture[8], capture[9])


class LoserTree:
    """Merges sorted iterators: inner nodes keep the loser of a match, the winner goes out, and
    only the matches on its way up are played anew."""

    def __init__(self, sources: list[Iterator[tuple]]):
        self.sources = [iter(s) for s in sources]
        self.k = len(self.sources)
        self.heads: list[tuple | None] = [next(s, None) for s in self.sources]
        self.keys = [order(h) if h else None for h in self.heads]
        self.losers = [-1] * max(self.k, 1)
        winners = [-1] * self.k + list(range(self.k))
        for node in range(self.k - 1, 0, -1):
            a, b = winners[2 * node], winners[2 * node + 1]
            winners[node], self.losers[node] = (a, b) if self._before(a, b) else (b, a)
        self.winner = winners[1] if self.k > 1 else 0

    def _before(self, a: int, b: int) -> bool:
        if self.keys[a] is None or self.keys[b] is None:
            return self.keys[a] is not None
        return self.keys[a] <= self.keys[b]

    def __iter__(self) -> Iterator[tuple]:
        while self.k and self.keys[self.winner] is not None:
            w = self.winner
            yield self.heads[w]
            self.heads[w] = head = next(self.sources[w], None)
            self.keys[w] = order(head) if head else None
            node = (w + self.k) // 2
            while node:
                if self._before(self.losers[node], w):
                    self.losers[node], w = w, self.losers[node]
                node //= 2
            self.winner = w


def merge(captures: DataFrame, rows: int) -> DataFrame:
    """All captures in global order: by ``part``, then ``place`` in it."""

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_run: dict[str, list[tuple]] = {}
        for batch in source:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                by_run.setdefault(row[8], []).append(row)
        part = TaskContext.get().partitionId()
        # a run's rows keep their order within a shuffle block, but blocks may come in any order
        merged = list(LoserTree([sorted(by_run[name], key=order) for name in sorted(by_run)]))
        if merged:
            kinds = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64()]
            arrays = [pa.array(c, k) for c, k in zip(zip(*merged), kinds)]
            arrays += [pa.array([part] * len(merged), pa.int32()), pa.array(range(len(merged)), pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, names=[*(c.split()[0] for c in CAPTURES.split(", ")), "part", "place"])

    ranges = captures.repartitionByRange(tasks_for(rows, MERGE_ROWS, 4), "urlkey", "timestamp", "page_id", "archive", "at")
    return ranges.mapInArrow(run, CAPTURES + ", part int, place long")


def capture_histories(spark: SparkSession, path: str, rows: int) -> DataFrame:
    return land(merge(land(runs(spark, path), "runs"), rows), "histories")


@query("op2_warc")
def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    n = write(table(spark, sf_dir, "pages"), path)
    merged = capture_histories(spark, path, n)
    return merged.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "urlkey", "timestamp", "archive", "at", "size", "part", "place")
