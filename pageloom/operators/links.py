"""Replace rows by the payloads behind their links."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pageloom.functions.scalars import is_link, row_path, session_id
from pageloom.operators.joins import suffix_overlap
from pageloom.operators.parse import ParseSpec, parse
from pageloom.operators.schemas import union_widened
from pageloom.operators.sequence import sequence_rows
from pageloom.operators.skew import attach, split_join
from pageloom.runtime import INTERNAL, META, RESPONSES_SCHEMA, quoted, settle

FLUSH_MODES = ["none", "per_link", "per_session"]
POLICIES = ["first", "last", "all", "require_single"]
LINK_KEY = [*META, "_url_idx"]


@dataclass(frozen=True)
class LinkSpec:
    url_fields: tuple[str, ...] = ()
    type: str | None = None
    record_path: str | None = None
    session_regex: str | None = None
    session_group: int = 0
    session_policy: str = "first"
    flush: str = "none"
    flush_only: bool = False
    flush_prefix: str | None = None
    flush_filename: str | None = None
    schema: T.DataType | str | None = None

    def __post_init__(self) -> None:
        if self.flush not in FLUSH_MODES:
            raise ValueError(f"flush mode {self.flush!r} is not one of {FLUSH_MODES}")
        if self.session_policy not in POLICIES:
            raise ValueError(f"session policy {self.session_policy!r} is not one of {POLICIES}")
        if any(f in (self.flush_prefix or "") for f in ("{session_id", "{seq")):
            raise ValueError("session_id and seq belong in the flush file name")

    @classmethod
    def from_options(cls, options: dict[str, Any] | None) -> LinkSpec | None:
        if not options or not options.get("enabled", False):
            return None
        sid, flush = options.get("session_id") or {}, options.get("flush") or {}
        return cls(
            url_fields=tuple(options.get("url_fields") or ()),
            type=options.get("type"),
            record_path=options.get("json_record_path"),
            session_regex=sid.get("regex"),
            session_group=int(sid.get("group", 0)),
            session_policy=sid.get("policy", "first"),
            flush=(flush.get("mode") or "none").lower(),
            flush_only=bool(flush.get("only")),
            flush_prefix=flush.get("prefix"),
            flush_filename=flush.get("filename"),
            schema=options.get("schema"),
        )

    def parse_spec(self, base: ParseSpec) -> ParseSpec:
        """Reading of the linked bodies: the record path is never inherited."""
        return replace(
            base,
            type=self.type or base.type,
            record_path=self.record_path,
            schema=self.schema,
        )


def collect_links(records: DataFrame, spec: LinkSpec) -> DataFrame:
    """One row per link of a record, in the order of the URL fields."""
    found = []
    for name in spec.url_fields:
        col = row_path(records, name)
        if col is not None:
            found.append(F.when(is_link(col.cast("string")), col.cast("string")))
    urls = F.array(*found) if found else F.array().cast("array<string>")
    urls = F.filter(urls, lambda u: u.isNotNull())
    return records.select(
        *META, F.size(urls).alias("_links"), F.posexplode(urls).alias("_url_idx", "url")
    ).withColumn(
        "session_id", session_id(F.col("url"), spec.session_regex, spec.session_group)
    )


def fetch_links(
    links: DataFrame,
    fetch: Callable,
    headers: dict[str, str] | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """Responses of the distinct URLs, fetched by the executors.

    Every URL is requested once however many rows point at it. The result should
    be landed before it is used: it is read more than once.
    """
    todo = links.select("url").distinct()
    partitions = partitions or int(links.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    todo = todo.repartition(partitions, "url")

    def pull(batches):
        import pandas as pd

        names = RESPONSES_SCHEMA.names
        blank = dict.fromkeys(names) | {"pull": "link", "window_seq": 0, "page_seq": 0}
        rows, held = [], 0
        for batch in batches:
            for url in batch["url"]:
                got = fetch(url, {}, dict(headers or {}))
                told = {"url": url, "status": got.status, "body": got.body}
                rows.append(blank | told | {"headers": dict(got.headers or {})})
                held += len(got.body)
                # Bodies are handed on in bounded lots, not per request.
                if len(rows) == 256 or held > 16 << 20:
                    yield pd.DataFrame(rows, columns=names)
                    rows, held = [], 0
        if rows:
            yield pd.DataFrame(rows, columns=names)

    return todo.mapInPandas(pull, RESPONSES_SCHEMA)


def expand_links(
    records: DataFrame,
    details: DataFrame,
    spec: LinkSpec,
    base_parse: ParseSpec,
    unit: list[str] | None = None,
    links: DataFrame | None = None,
) -> DataFrame:
    """Payload rows in place of the records that carry links.

    ``details`` holds one landed response per URL. Base columns are not carried.
    ``unit`` is the scope in which records without links vanish as soon as any
    record expanded: the whole run (``[]``), a window or a page. A unit in which
    nothing expanded keeps its records. Payload rows carry the row key of their
    record, their row number in the payload and the session id of the link.
    """
    if not spec.url_fields or spec.flush == "per_link":
        # Per link, each payload goes to an object of its own; the records come back.
        return records
    links = settle(collect_links(records, spec)) if links is None else links
    if links.isEmpty():
        return records
    payload = link_payload(links, details, spec, base_parse)
    merged = payload if spec.flush == "per_session" else merge_positional(payload, spec)
    merged = merged.drop("_url_idx", "_links", "_url")
    if not unit:
        return merged
    rest = records.join(links.select(*unit).distinct(), unit, "left_anti")
    if rest.isEmpty():
        return merged
    return union_widened([merged, rest])


def link_payload(
    links: DataFrame, details: DataFrame, spec: LinkSpec, base_parse: ParseSpec
) -> DataFrame:
    """Parsed payload rows of every link: the row key of its record, link columns
    under an underscore, ``_detail_seq`` (row within the payload), payload columns.

    Bodies are parsed once per URL, then joined to the links; a URL many rows
    point at is a hot key and is split.
    """
    parsed = parse(details, spec.parse_spec(base_parse), keep={"_url": "url"})
    payload = [c for c in parsed.columns if c not in META and c != "_url"]
    parsed = parsed.select(
        "_url",
        F.col("_row_seq").alias("_detail_seq"),
        *[F.col(quoted(c)).alias(f"p{i}") for i, c in enumerate(payload)],
    )
    named = links.withColumnsRenamed({"url": "_url", "session_id": "_session_id"})
    joined = split_join(
        named, parsed, ["_url"], "inner", LINK_KEY, ["_url", "_detail_seq"], right_bounded=True
    )
    return joined.select(
        *named.columns,
        "_detail_seq",
        *[F.col(f"p{i}").alias(c) for i, c in enumerate(payload)],
    )


def _positional_names(
    fills: dict[str, list[int]], links: int
) -> dict[str, tuple[int, str]]:
    """Output name -> (position, column) for a record with ``links`` payloads."""
    names: dict[str, tuple[int, str]] = {}
    for i in range(links):
        added = {c: (i, c) for c, at in fills.items() if i in at}
        left, right = suffix_overlap(list(names), list(added), [], ("_x", "_y"))
        names = {left.get(n, n): src for n, src in names.items()} | {
            right.get(n, n): src for n, src in added.items()
        }
    return names


def merge_positional(payload: DataFrame, spec: LinkSpec) -> DataFrame:
    """Put the payloads of one record side by side, row i with row i.

    One grouping on (record, row number) does the outer join of all positions;
    a group holds at most one row per URL field. Columns that two payloads share
    are suffixed as in a join of frames, first with ``_x`` and ``_y``, then with
    numbers; a record with a single link keeps the plain names.
    """
    most = len(spec.url_fields)
    cols = [c for c in payload.columns if c not in INTERNAL]
    if most == 1:
        return payload
    payload = settle(payload)
    # Which columns each position fills, over all records: one aggregated row.
    filled = [
        F.bool_or((F.col("_url_idx") == i) & F.col(quoted(c)).isNotNull()).alias(f"f{i}_{n}")
        for i in range(most)
        for n, c in enumerate(cols)
    ]
    flags = payload.agg(*filled).first() if filled else None
    fills = {
        c: [i for i in range(most) if flags[f"f{i}_{n}"]] or [0] for n, c in enumerate(cols)
    }
    out: dict[str, list[Column]] = {}
    for k in range(1, most + 1):
        for name, (i, c) in _positional_names(fills, k).items():
            here = (F.col("_links") == k) & (F.col("_url_idx") == i)
            out.setdefault(name, []).append(
                F.first(F.when(here, F.col(quoted(c))), ignorenulls=True)
            )
    return payload.groupBy(*META, "_detail_seq").agg(
        F.min_by("_session_id", "_url_idx").alias("_session_id"),
        *[F.coalesce(*picks).alias(name) for name, picks in out.items()],
    )


# ---- session ids -----------------------------------------------------------


def resolve_session(
    links: DataFrame, policy: str = "first", run: list[str] | None = None
) -> DataFrame:
    """The session id a run is named after: one row per ``run`` key.

    Order is that of the links. ``all`` lists the distinct ids, sorted; the list
    is one value by definition, so ids are made distinct before they meet.
    """
    if policy not in POLICIES:
        raise ValueError(f"session policy {policy!r} is not one of {POLICIES}")
    run = run or []
    named = links.where(F.col("session_id").isNotNull())
    order = F.struct(*[c for c in LINK_KEY if c in links.columns])
    if policy in ("first", "last"):
        pick = F.min_by if policy == "first" else F.max_by
        return named.groupBy(*run).agg(pick("session_id", order).alias("session_id"))
    ids = named.select(*run, "session_id").distinct()
    if policy == "all":
        return ids.groupBy(*run).agg(
            F.concat_ws(",", F.sort_array(F.collect_list("session_id"))).alias("session_id")
        )
    return (
        ids.groupBy(*run)
        .agg(F.count(F.lit(1)).alias("n"), F.min("session_id").alias("session_id"))
        .withColumn(
            "session_id",
            F.when(F.col("n") == 1, F.col("session_id")).otherwise(
                F.raise_error(F.lit("more than one session id in a run"))
            ),
        )
        .drop("n")
    )


def session_groups(payload: DataFrame) -> DataFrame:
    """Payload rows under their session id, ``none`` where there is none."""
    return payload.withColumn("_session_id", F.coalesce("_session_id", F.lit("none")))


def session_order(payload: DataFrame) -> DataFrame:
    """Payload rows with the rank of their session, by first appearance."""
    seen = payload.groupBy("_session_id").agg(F.min(F.struct(*LINK_KEY)).alias("_first"))
    ranked = sequence_rows(
        seen.select("_session_id", "_first.*"), [*LINK_KEY, "_session_id"], "_session_seq"
    ).select("_session_id", "_session_seq")
    return attach(payload, ranked, ["_session_id"], [*LINK_KEY, "_detail_seq"], "inner")


def number_links(links: DataFrame) -> DataFrame:
    """Links with their 1-based sequence number, used to name per-link objects."""
    numbered = sequence_rows(links, LINK_KEY, "_at")
    return numbered.withColumn("_seq", F.col("_at") + 1).drop("_at")
