"""What a source calls to get one response. Any picklable callable will do."""

from __future__ import annotations

import time
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import accumulate
from typing import Any
from urllib.error import HTTPError
from urllib.parse import urlencode
from urllib.request import Request, urlopen
from zlib import crc32


@dataclass(frozen=True)
class Response:
    status: int = 200
    headers: dict[str, str] = field(default_factory=dict)
    body: str = ""


@dataclass(frozen=True)
class HttpFetch:
    """Plain GET with default headers, a time limit and retries on given statuses."""

    headers: dict[str, str] = field(default_factory=dict)
    timeout: float = 30.0
    retries: int = 3
    backoff: float = 0.5
    retry_on: tuple[int, ...] = (429, 500, 502, 503, 504)
    delay: float = 0.0

    def __call__(self, url: str, params: dict[str, Any], headers: dict[str, str]) -> Response:
        mark = "&" if "?" in url else "?"
        full = url + (mark + urlencode(params) if params else "")
        request = Request(full, headers={**self.headers, **(headers or {})})
        for attempt in range(self.retries + 1):
            if attempt:
                time.sleep(self.backoff * 2 ** (attempt - 1))
            try:
                with urlopen(request, timeout=self.timeout) as got:
                    text = got.read().decode("utf-8", errors="replace")
                    out = Response(got.status or 200, dict(got.headers), text)
                    break
            except HTTPError as e:
                text = e.read().decode("utf-8", errors="replace")
                out = Response(e.code, dict(e.headers or {}), text)
                if e.code not in self.retry_on:
                    break
        time.sleep(self.delay)
        return out


#: How recordings are written: in small row groups, so that a request reads little of them.
ROW_GROUP_BYTES = 1 << 20
WRITE_OPTIONS = {
    "parquet.block.size": ROW_GROUP_BYTES,
    "parquet.page.size.row.check.min": 1,
    "parquet.enable.dictionary": "false",
}
ROW_GROUPS_KEPT = 4


class _Recording:
    """The Parquet files of a folder, read by key.

    Footers tell which row groups may hold a key: one, where files are sorted by it and do not
    overlap. The row groups read last are kept, as neighbours tend to be asked for in a row.
    """

    def __init__(self, system: Any, folder: str, column: str):
        import pyarrow.parquet as pq
        from pyarrow import fs

        self.column, self.files, self.kept = column, [], {}
        groups, unknown = [], []
        for info in sorted(system.get_file_info(fs.FileSelector(folder)), key=lambda i: i.path):
            if info.type != fs.FileType.File or info.base_name.startswith(("_", ".")):
                continue
            file = pq.ParquetFile(info.path, filesystem=system)
            at = file.schema_arrow.get_field_index(column)
            for g in range(file.num_row_groups):
                told = file.metadata.row_group(g).column(at).statistics
                if told is not None and told.has_min_max:
                    groups.append((told.min, told.max, len(self.files), g))
                elif told is None or told.num_values:
                    unknown.append((len(self.files), g))  # long keys: Parquet leaves their range out
            self.files.append(file)
        self.groups, self.unknown = sorted(groups), unknown
        self.lows = [g[0] for g in self.groups]
        # The largest key up to each row group: behind it, none further down can match.
        self.highs = list(accumulate((g[1] for g in self.groups), max))

    def find(self, key: Any) -> dict[str, Any] | None:
        for file, g in self._candidates(key):
            rows, columns = self._read(file, g)
            if key in rows:
                return {n: c[rows[key]].as_py() for n, c in columns.items()}
        return None

    def _candidates(self, key: Any) -> Iterator[tuple[int, int]]:
        at = bisect_right(self.lows, key) - 1
        while at >= 0 and self.highs[at] >= key:
            if self.groups[at][1] >= key:
                yield self.groups[at][2:]
            at -= 1
        yield from self.unknown

    def _read(self, file: int, g: int) -> tuple[dict[Any, int], dict[str, Any]]:
        at = (file, g)
        if at in self.kept:
            self.kept[at] = self.kept.pop(at)  # now the youngest
            return self.kept[at]
        names = ["status", "link", "body"]
        found = self.files[file].read_row_group(g, [self.column, *names], use_threads=False)
        keys = found.column(self.column).to_pylist()
        while len(self.kept) >= ROW_GROUPS_KEPT:
            del self.kept[next(iter(self.kept))]
        rows = {k: i for i, k in reversed(list(enumerate(keys)))}
        self.kept[at] = rows, {n: found.column(n) for n in names}
        return self.kept[at]


@dataclass(frozen=True)
class _Recorded:
    """Recordings opened by a task; they do not travel with the fetch."""

    root: str

    def __getstate__(self) -> dict[str, Any]:
        return {**self.__dict__, "opened": {}}

    def _find(self, folder: str, column: str, key: Any) -> Response | None:
        from pyarrow import fs

        if folder not in self.opened:
            system, path = fs.FileSystem.from_uri(self.root)
            path = f"{path}/{folder}"
            missing = system.get_file_info(path).type == fs.FileType.NotFound
            self.opened[folder] = None if missing else _Recording(system, path, column)
        hit = self.opened[folder].find(key) if self.opened[folder] else None
        if hit is None:
            return None
        return Response(hit["status"], {"Link": hit["link"]} if hit["link"] else {}, hit["body"])


@dataclass(frozen=True)
class RecordedFetch(_Recorded):
    """Replays responses recorded as Parquet, one folder per request key.

    Layout: ``root/key=<window number>/*.parquet`` with ``page`` (best sorted), ``status``,
    ``link`` and ``body``. ``key_param`` and ``page_param`` name the request
    parameters that select a response; one that was not recorded is answered
    with an empty list.
    """

    key_param: str = "window"
    page_param: str = "page"
    opened: dict[str, Any] = field(default_factory=dict, compare=False, repr=False)

    def __call__(self, url: str, params: dict[str, Any], headers: dict[str, str]) -> Response:
        page = int(params.get(self.page_param, 0))
        return self._find(f"key={params[self.key_param]}", "page", page) or Response(body="[]")


def request_text(url: str, params: dict[str, Any]) -> str:
    """A request as one text: the URL, then parameters by name."""
    return "?".join([url, *(["&".join(f"{k}={v}" for k, v in sorted(params.items()))] if params else [])])


@dataclass(frozen=True)
class RecordedRequests(_Recorded):
    """Replays responses recorded under the text of their request.

    Layout: ``root/bucket=<n>/*.parquet`` with ``request`` (sorted), ``status``, ``link`` and
    ``body``; the bucket is the checksum of the request. Only row groups that may hold the
    request are read. One that was not recorded is answered with ``missing``.
    """

    buckets: int = 16
    missing: str = "[]"
    opened: dict[str, Any] = field(default_factory=dict, compare=False, repr=False)

    def __call__(self, url: str, params: dict[str, Any], headers: dict[str, str]) -> Response:
        text = request_text(url, params)
        bucket = crc32(text.encode()) % self.buckets
        return self._find(f"bucket={bucket}", "request", text) or Response(body=self.missing)
