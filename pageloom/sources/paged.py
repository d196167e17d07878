"""Paged requests as a Spark data source: one partition per pull, window and stripe."""

from __future__ import annotations

import csv
import io
import json
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field, replace
from datetime import date
from itertools import count
from typing import Any
from urllib.parse import urljoin

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, In, InputPartition

from pageloom.operators.chains import NO_CAP
from pageloom.operators.paging import check_mode
from pageloom.runtime import RESPONSES_SCHEMA

SOURCE_NAME = "pageloom_paged"
_SOURCES = count()


@dataclass(frozen=True)
class Pull:
    """One chain of requests: its first URL, parameters, paging and parse options."""

    name: str
    url: str
    params: dict[str, Any] = field(default_factory=dict)
    headers: dict[str, str] = field(default_factory=dict)
    paging: dict[str, Any] = field(default_factory=dict)
    parse: dict[str, Any] = field(default_factory=dict)
    window_seq: int = 0
    window_start: date | None = None
    window_end: date | None = None
    cursor: dict[str, Any] | None = None  # cursor backfill: seed and stop rules
    stripes: int = 1
    # Number of the first page found empty: tasks read ranges up to it instead of stripes.
    end: int | None = None


class _Part(InputPartition):
    def __init__(self, pull: Pull, stripe: int):
        super().__init__((pull.name, pull.window_seq, stripe))
        self.pull, self.stripe = pull, stripe


class _Reader(DataSourceReader):
    def __init__(self, pulls: list[Pull], fetch: Callable):
        self.pulls, self.fetch = pulls, fetch

    def pushFilters(self, filters):  # noqa: N802
        """Filters on pull and window drop whole partitions; others stay with Spark."""
        for f in filters:
            at = {("window_seq",): "window_seq", ("pull",): "name"}.get(tuple(f.attribute)) if (
                isinstance(f, (EqualTo, In))
            ) else None
            if at is None:
                yield f
                continue
            wanted = {f.value} if isinstance(f, EqualTo) else set(f.value)
            self.pulls = [p for p in self.pulls if getattr(p, at) in wanted]

    def partitions(self):
        return [
            _Part(p, s)
            for p in self.pulls
            for s in range(_parts(p))
        ]

    def read(self, partition: _Part) -> Iterator[tuple]:
        pull = partition.pull
        for page_seq, url, params, got in walk(pull, self.fetch, partition.stripe):
            yield (
                pull.name,
                pull.window_seq,
                pull.window_start,
                pull.window_end,
                page_seq,
                url,
                {k: str(v) for k, v in params.items()},
                int(got.status),
                {k: str(v) for k, v in (got.headers or {}).items()},
                got.body,
            )


def _parts(pull: Pull) -> int:
    if pull.paging.get("mode") != "page":
        return 1
    return min(pull.stripes, pull.end + 1) if pull.end is not None else pull.stripes


class _EndReader(_Reader):
    """Where each page-number pull ends, found by few requests."""

    def partitions(self):
        return [_Part(p, 0) for p in self.pulls]

    def read(self, partition: _Part) -> Iterator[tuple]:
        pull = partition.pull
        end, requests = first_empty(pull, self.fetch)
        yield pull.name, pull.window_seq, end, requests


ENDS_SCHEMA = "pull string, window_seq bigint, end bigint, requests bigint"


def _source(spark: SparkSession, wanted, made: Callable) -> DataFrame:
    own = f"{SOURCE_NAME}_{next(_SOURCES)}"  # runs of one session do not share a source

    class Paged(DataSource):
        @classmethod
        def name(cls):
            return own

        def schema(self):
            return wanted

        def reader(self, schema):
            return made()

    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(Paged)
    return spark.read.format(own).load()


def read_pulls(spark: SparkSession, pulls: list[Pull], fetch: Callable) -> DataFrame:
    """Responses of the pulls. Nothing is requested until an action runs; land the
    result before using it twice."""
    for p in pulls:
        check_mode(p.paging.get("mode"))
    return _source(spark, RESPONSES_SCHEMA, lambda: _Reader(list(pulls), fetch))


def with_ends(spark: SparkSession, pulls: list[Pull], fetch: Callable) -> list[Pull]:
    """The pulls, those of page numbers with their first empty page. It is found on the
    executors, a task a pull, in at most twice the logarithm of its number of requests; their
    tasks then read ranges of equal length, and none has to run into the end to find it."""
    asked = [p for p in pulls if p.paging.get("mode") == "page" and p.cursor is None]
    if not asked:
        return pulls
    found = _source(spark, ENDS_SCHEMA, lambda: _EndReader(list(asked), fetch)).collect()
    ends = {(r.pull, r.window_seq): r.end for r in found}
    return [replace(p, end=ends.get((p.name, p.window_seq))) for p in pulls]


# ---- one chain, request by request ------------------------------------------


def rows_in(body: str, parse: dict[str, Any]) -> list[dict]:
    """Records of one page, as far as the next-request decision needs them."""
    kind = (parse.get("type") or "json").lower()
    if kind == "csv":
        csv.field_size_limit(1 << 30)
        return list(csv.DictReader(io.StringIO(body, newline="")))
    if kind in ("jsonl", "ndjson"):
        return [json.loads(x) for x in body.split("\n") if x.strip()]
    found = json.loads(body)
    dropped = set(parse.get("json_drop_keys_any_depth") or ())
    for step in (parse.get("json_record_path") or "").split("."):
        if step:
            found = found.get(step) if isinstance(found, dict) and step not in dropped else None
    if isinstance(found, dict):
        found = [found]
    rows = found if isinstance(found, list) else []
    return [r for r in rows if not isinstance(r, dict) or set(r) - dropped]


def has_rows(body: str, parse: dict[str, Any]) -> bool:
    """Whether a page has a record; stops reading at the first."""
    kind = (parse.get("type") or "json").lower()
    if kind == "csv":
        csv.field_size_limit(1 << 30)
        return next(csv.DictReader(io.StringIO(body, newline="")), None) is not None
    if kind in ("jsonl", "ndjson"):
        return bool(body.strip())
    return bool(rows_in(body, parse))


def at_path(body: str, path: str) -> Any:
    value = json.loads(body)
    for step in path.split("."):
        value = value.get(step) if isinstance(value, dict) else None
    return value


def next_of(headers: dict[str, str]) -> str | None:
    link = next((v for k, v in (headers or {}).items() if k.lower() == "link"), "")
    found = re.search(r"""<([^>]*)>[^<]*?;\s*rel\s*=\s*["']?next["']?\s*(?:[;,]|$)""", link)
    return found.group(1) if found else None


def _utc(value: Any) -> tuple[str, str] | None:
    """A UTC time to the microsecond as texts that sort by time; none for any other form."""
    if not isinstance(value, str):
        return None
    full = re.fullmatch(r"(\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2})(?:\.(\d{1,6}))?Z", value, re.ASCII)
    return (full[1], (full[2] or "").ljust(6, "0")) if full else None


def _stops(rows: list[dict], cursor: dict[str, Any]) -> bool:
    """Whether a stop rule surely ends the pull here. The exact cut is made on the
    landed rows; this only avoids requests whose rows would be cut anyway."""
    item = cursor.get("stop_at_item") or {}
    older = cursor.get("stop_when_older_than") or {}
    rows = [r for r in rows if isinstance(r, dict)]
    if item.get("field") and item.get("value"):
        if any(r.get(item["field"]) == item["value"] for r in rows):
            return True
    if older.get("field") and older.get("value"):
        seen = [r.get(older["field"]) for r in rows]
        bound = _utc(older["value"])
        stamps = [t for t in map(_utc, seen) if t is not None]
        return bound is not None and any(t < bound for t in stamps)
    return False


def first_params(pull: Pull) -> tuple[dict[str, Any], str, int]:
    """Parameters every request of a pull starts from, the name of the page parameter, its first value."""
    opts, params = pull.paging, dict(pull.params)
    if pull.cursor is None and (opts.get("mode") or "none") in ("cursor", "page"):
        if opts.get("page_size_param") and opts.get("page_size_value"):
            params[opts["page_size_param"]] = opts["page_size_value"]
    name = opts.get("page_param", "page")
    return params, name, int(params.get(name, opts.get("start_page", 1)))


def first_empty(pull: Pull, fetch: Callable) -> tuple[int, int]:
    """A page number whose page is empty (or fails, or is the cap) while the one before is not, by
    doubling the distance and halving it again; and the number of requests. Where a blank page lies
    before full ones this may be a later end than a sequential reader's: the pages behind the blank
    one are trimmed after landing, as they are for stripes."""
    params, name, first_page = first_params(pull)
    limit = int(pull.paging.get("max_pages") or NO_CAP)
    asked = 0

    def filled(page: int) -> bool:
        nonlocal asked
        asked += 1
        got = fetch(pull.url, {**params, name: first_page + page}, dict(pull.headers))
        return got.status < 400 and has_rows(got.body, pull.parse)

    low, high = -1, 0  # the last page known to be filled, the next one to ask for
    while high < limit and filled(high):
        low, high = high, 2 * high + 1
    high = min(high, limit)
    while high - low > 1:
        middle = (low + high) // 2
        low, high = (middle, high) if filled(middle) else (low, middle)
    return high, asked


def walk(pull: Pull, fetch: Callable, stripe: int = 0) -> Iterator[tuple]:
    """Requests of one chain in order: (page number, URL, parameters, response)."""
    opts, cursor = pull.paging, pull.cursor or {}
    mode = opts.get("mode") or "none"
    limit = int(opts.get("max_pages") or NO_CAP)
    params, page_param, first_page = first_params(pull)
    url = pull.url
    token_param = opts.get("cursor_param", "cursor")
    if cursor.get("start_value"):
        params[token_param] = cursor["start_value"]
    step = pull.stripes if mode == "page" else 1
    page = stripe
    if mode == "page" and pull.end is not None:
        # the page at the end is asked for, too: it may have failed rather than been empty
        size = -(-(pull.end + 1) // _parts(pull))
        page, limit, step = stripe * size, min(limit, (stripe + 1) * size, pull.end + 1), 1
    while page < limit:
        if mode == "page" and pull.cursor is None:
            params[page_param] = first_page + page
        got = fetch(url, dict(params), dict(pull.headers))
        yield page, url, dict(params), got
        if got.status >= 400:
            return
        if pull.cursor is not None:
            rows = rows_in(got.body, pull.parse)
            if _stops(rows, cursor):
                return
            if opts.get("next_cursor_path"):
                token = at_path(got.body, opts["next_cursor_path"])
            else:
                last = rows[-1] if rows and isinstance(rows[-1], dict) else {}
                token = last.get(opts.get("chain_field"))
            if token is None or (opts.get("next_cursor_path") and not token):
                return
            params[token_param] = token
        elif mode == "none":
            return
        elif mode == "page":
            # An empty page ends this stripe; the exact cut is made on landed pages.
            if not has_rows(got.body, pull.parse):
                return
        elif mode == "cursor":
            path = opts.get("next_cursor_path")
            token = at_path(got.body, path) if path else None
            if not token:
                return
            params[token_param] = token
        elif mode == "link-header":
            url = next_of(got.headers)
            if not url:
                return
        else:
            data = json.loads(got.body)
            ref = data.get(opts.get("next_url_path", "nextRecordsUrl"))
            if data.get(opts.get("done_path", "done"), True) is True or not ref:
                return
            url = urljoin(urljoin(pull.url, "/"), ref)
            if opts.get("clear_params_on_next", True):
                params = {}
        page += step


