"""Runs: plan requests, land responses, turn them into rows, write, report."""

from __future__ import annotations

import logging
import uuid
from collections.abc import Callable
from dataclasses import replace
from datetime import date, datetime, timezone
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pageloom.functions.scalars import (
    REDACTED,
    SECRET_HEADERS,
    SECRET_PARAMS,
    token_text,
    variant_at,
)
from pageloom.operators import links as L
from pageloom.operators.paging import broken, reached_cap
from pageloom.operators.parse import ParseSpec, parse
from pageloom.operators.sequence import freeze_ids
from pageloom.operators.stops import StopSpec, reaches_stop
from pageloom.operators.windows import DEFAULT_DAYS, window_list
from pageloom.plans.config import Job, resolve
from pageloom.plans.frames import cursor_records, joined_records, paged_records
from pageloom.runtime import RESPONSES_SCHEMA, quoted, scratch_path, settle
from pageloom.sinks.manifest import manifest
from pageloom.sinks.snapshots import SnapshotLog
from pageloom.sinks.writers import flush_parts, path_values, write_frame, written_bytes
from pageloom.sources.paged import Pull, read_pulls, with_ends
from pageloom.sources.transports import HttpFetch

LOG = logging.getLogger("pageloom")


def masked(values: dict[str, Any], names: list[str]) -> dict[str, Any]:
    return {k: REDACTED if k.lower() in names else v for k, v in values.items()}


def _now() -> str:
    return datetime.now(timezone.utc).isoformat()


def _committed(told: dict[str, Any]) -> dict[str, Any]:
    return {n: told[n] for n in ("path", "rows", "bytes", "truncated")}


class Ingest:
    """``run_once`` and ``run_backfill`` for the tables of a config dict.

    ``fetch(url, params, headers)`` is called by the executors. Responses are
    landed below ``landing`` (the shared folder by default) before anything is
    parsed, so a failed parse, a lost executor or a second pass over the rows
    never repeats a request.
    """

    def __init__(
        self,
        spark: SparkSession,
        config: dict[str, Any],
        fetch: Callable | None = None,
        landing: str | None = None,
    ):
        self.spark, self.config, self.fetch, self.landing = spark, config, fetch, landing

    # ---- entry points --------------------------------------------------------

    def run_once(self, table: str, env: str) -> dict[str, Any]:
        started = datetime.now(timezone.utc)
        job = resolve(self.config, table, env)
        job.sink()
        landed = self._land(self._pulls(job, [(0, None, None, {})]), job)
        if job.pulls:
            rows = self._joined(job, landed, per_window=False)
        else:
            rows = paged_records(landed, job.paging, job.parse, max_chains=1)
        cut = not job.pulls and reached_cap(landed, job.paging, job.parse)
        return self._finish(job, rows, [], started, {"windows": None, "truncated": cut})

    def run_backfill(self, table: str, env: str, start: date, end: date) -> dict[str, Any]:
        started = datetime.now(timezone.utc)
        job = resolve(self.config, table, env)
        strategy = job.strategy()
        job.sink()
        opts = job.backfill
        if opts.get("log"):
            return self._resumed(job, strategy, start, end, started)
        if strategy == "cursor":
            rows, landed, cut = self._cursor_rows(job, opts.get("cursor") or {})
            unit, windows = ["_page_seq"], None
        else:
            plan = self._window_plan(job, strategy, start, end)
            rows, cut = self._window_rows(job, strategy, plan)
            unit, windows = ["_window_seq"], len(plan)
        told = {"windows": windows, "strategy": strategy, "truncated": cut}
        return self._finish(job, rows, unit, started, told)

    # ---- backfills -------------------------------------------------------------

    @staticmethod
    def _window_plan(job: Job, strategy: str, start: date, end: date) -> list[tuple]:
        days = int(job.backfill.get("window_days", DEFAULT_DAYS))
        return window_list(start, end, days, strategy == "soql_window")

    def _window_rows(self, job: Job, strategy: str, plan: list[tuple]) -> tuple[DataFrame, bool]:
        """Rows of some windows, and whether a set cap cut one short."""
        half_open = strategy == "soql_window"
        asked = [(i, s, e, self._window_params(job.backfill, s, e, half_open)) for i, s, e in plan]
        chosen = replace(job, pulls=[]) if half_open else job
        landed = self._land(self._pulls(chosen, asked), job)
        if job.pulls and not half_open:
            return self._joined(job, landed, per_window=True), False
        rows = paged_records(landed, job.paging, job.parse, max_chains=max(len(plan), 1))
        return rows, reached_cap(landed, job.paging, job.parse)

    def _cursor_rows(self, job: Job, cursor: dict[str, Any]) -> tuple[DataFrame, DataFrame, bool]:
        """Rows of a chain from its seed, the landed pages, and whether a set cap cut it short."""
        pulls = self._pulls(replace(job, pulls=[]), [(0, None, None, {})], cursor=cursor)
        landed = self._land(pulls, job)
        rows = cursor_records(landed, job.paging, cursor, job.parse, max_chains=1)
        return rows, landed, reached_cap(landed, job.paging, job.parse)

    def _resumed(self, job: Job, strategy: str, start: date, end: date, started: datetime) -> dict[str, Any]:
        """A backfill in steps, each committed to a log when its rows are written. Windows that a log
        has are skipped, and a chain goes on at the token behind its last committed page."""
        opts = job.backfill
        log = SnapshotLog(self.spark, opts["log"])
        each = int(opts.get("commit_every") or 0)
        windows = None
        if strategy == "cursor":
            self._chain_in_steps(job, log, each, started)
        else:
            plan = self._window_plan(job, strategy, start, end)
            windows, known = len(plan), log.windows()
            left = [w for w in plan if (str(w[1]), str(w[2])) not in known]
            for at in range(0, len(left), each or len(left) or 1):
                part = left[at : at + (each or len(left))]
                rows, cut = self._window_rows(job, strategy, part)
                told = self._finish(job, rows, ["_window_seq"], started, {"truncated": cut}, commit=True)
                log.commit(_now(), [(s, e) for _, s, e in part], **_committed(told))
        done = log.entries()
        told = {"table": job.table, "env": job.env, "source_url": job.url, "format": job.sink().format}
        told |= {"pagination_mode": job.mode, "strategy": strategy, "windows": windows, "path": log.folder}
        told |= {n: sum(e[n] or 0 for e in done) for n in ("rows", "bytes")}
        return manifest(started, **told, truncated=any(e["truncated"] for e in done))

    def _chain_in_steps(self, job: Job, log: SnapshotLog, each: int, started: datetime) -> None:
        cursor = dict(job.backfill.get("cursor") or {})
        cap = int(job.paging.get("max_pages") or 0)
        while True:
            done = log.entries()
            so_far = sum(e["pages"] or 0 for e in done)
            if done and done[-1]["ended"] or cap and so_far >= cap:
                return
            if done:
                cursor["start_value"] = done[-1]["token"]
            step = min(x for x in (each, cap - so_far) if x > 0) if each or cap else 0
            here = replace(job, paging={**job.paging, "max_pages": step or None})
            rows, landed, _ = self._cursor_rows(here, cursor)
            token = self._token_behind(here, landed, cursor, step) if step else None
            full = bool(token and cap and so_far + step >= cap)
            told = self._finish(here, rows, ["_page_seq"], started, {"truncated": full}, commit=True)
            log.commit(_now(), token=token, ended=token is None, pages=landed.count(), **_committed(told))

    def _token_behind(self, job: Job, landed: DataFrame, cursor: dict[str, Any], pages: int) -> str | None:
        """The token that goes on behind the last of so many pages; none if the chain ended, or a
        stop rule did, at that page or before."""
        last = landed.where(F.col("page_seq") == pages - 1)
        path, field = job.paging.get("next_cursor_path"), job.paging.get("chain_field")
        if last.isEmpty() or not (path or field):
            return None
        records = parse(last, job.parse)
        if reaches_stop(records, StopSpec.from_options(cursor)):
            return None
        if path:
            found = last.select(token_text(variant_at(F.col("body"), path.split("."))).alias("t")).first()
            return found["t"] or None
        if field not in records.columns:
            return None
        found = records.agg(F.max_by(F.col(quoted(field)).cast("string"), "_row_seq").alias("t")).first()
        return found["t"] or None

    # ---- stages --------------------------------------------------------------

    @staticmethod
    def _window_params(opts: dict, start: date, end: date, half_open: bool) -> dict[str, str]:
        if not half_open:
            fmt = opts.get("date_format", "%Y-%m-%d")
            return {
                opts.get("start_param", "start_date"): start.strftime(fmt),
                opts.get("end_param", "end_date"): end.strftime(fmt),
            }
        template = opts.get("soql_template")
        if not template:
            raise ValueError("half-open windows need a query template")
        fmt = opts.get("date_format", "%Y-%m-%dT%H:%M:%SZ")
        names = {"date_field": opts.get("date_field", "LastModifiedDate")}
        return {"q": template.format(start=start.strftime(fmt), end=end.strftime(fmt), **names)}

    @staticmethod
    def _pulls(job: Job, asked: list[tuple], cursor: dict | None = None) -> list[Pull]:
        """Requests to make: one chain per window, or one request per joined pull."""
        out = []
        for seq, start, end, params in asked:
            at = {"window_seq": seq, "window_start": start, "window_end": end}
            base = {**job.params, **params}
            for p in job.pulls:
                out.append(
                    Pull(
                        p.name,
                        p.url,
                        {**base, **p.params},
                        {**job.headers, **p.headers},
                        parse=p.parse,
                        **at,
                    )
                )
            if not job.pulls:
                out.append(
                    Pull(
                        job.table,
                        job.url,
                        base,
                        job.headers,
                        paging=job.paging,
                        parse=job.parse_options,
                        cursor=cursor,
                        stripes=job.stripes,
                        **at,
                    )
                )
        return out

    def _fetcher(self, job: Job) -> Callable:
        if self.fetch:
            return self.fetch
        again = job.retries
        return HttpFetch(
            timeout=job.timeout,
            retries=int(again.get("total", 3)) if again else 0,
            backoff=float(again.get("backoff_factor", 0.5)),
            retry_on=tuple(again.get("status_forcelist") or HttpFetch.retry_on),
            delay=job.delay,
        )

    def _land(self, pulls: list[Pull], job: Job) -> DataFrame:
        for p in pulls:
            LOG.info(
                "GET %s params=%s headers=%s",
                p.url,
                masked(p.params, SECRET_PARAMS),
                masked(p.headers, SECRET_HEADERS),
            )
        fetch = self._fetcher(job)
        if job.paging.get("gallop"):
            pulls = with_ends(self.spark, pulls, fetch)
        found = read_pulls(self.spark, pulls, fetch)
        mode = "none" if job.pulls else job.mode
        return self._landed(found, f"responses-{job.table}", mode, job.parse)

    def _landed(
        self,
        responses: DataFrame,
        label: str,
        mode: str = "none",
        spec: ParseSpec | None = None,
    ) -> DataFrame:
        """Write responses under a name of their own, by pull, and read them back."""
        path = scratch_path(self.spark, label, self.landing)
        responses.write.partitionBy("pull").parquet(path)
        landed = self.spark.read.schema(RESPONSES_SCHEMA).parquet(path)
        bad = landed.where(F.col("status") >= 400)
        if bad.isEmpty():
            return landed
        told = broken(landed, mode, spec or ParseSpec()).select("status", "url").first()
        if told:
            raise RuntimeError(f"status {told['status']} from {told['url']}")
        return landed.where(F.coalesce("status", F.lit(200)) < 400)

    def _joined(self, job: Job, landed: DataFrame, per_window: bool) -> DataFrame:
        specs = [(p.name, ParseSpec.from_options(p.parse)) for p in job.pulls]
        rows = joined_records(landed, specs, job.join, per_window)
        # A joined row may repeat its left row, so rows get numbers of their own.
        return freeze_ids(rows) if job.links else rows

    def _finish(
        self,
        job: Job,
        rows: DataFrame,
        unit: list[str],
        started: datetime,
        told: dict[str, Any],
        commit: bool = False,
    ) -> dict[str, Any]:
        """Expand, write, report. With ``commit`` rows go to a folder of their own, for a log to name."""
        spec, sink = job.links, job.sink()
        values = path_values(job.table, job.env, started)
        if spec and spec.url_fields:
            rows = settle(rows)
            links = settle(L.collect_links(rows, spec))
            if not links.isEmpty():
                fetched = L.fetch_links(links, self._fetcher(job), job.headers)
                details = self._landed(fetched, f"links-{job.table}")
                if spec.flush != "none":
                    self._flush(job, links, details, values)
                if not spec.flush_only:
                    rows = L.expand_links(rows, details, spec, job.parse, unit, links)
                sid = L.resolve_session(links, spec.session_policy).first()
                if sid and sid["session_id"]:
                    values["session_id"] = sid["session_id"]
        told = {"table": job.table, "env": job.env, "source_url": job.url, **told}
        told |= {"format": sink.format, "pagination_mode": job.mode}
        if spec and spec.flush_only:
            return manifest(started, **told, rows=0, path="", bytes=0)
        path = sink.path(values)
        if commit:
            path = f"{path}/rows-{uuid.uuid4().hex}"
        n = write_frame(rows, sink, path)
        size = written_bytes(self.spark, path)
        return manifest(started, **told, rows=n, path=path, bytes=size)

    def _flush(self, job: Job, links: DataFrame, details: DataFrame, values: dict) -> None:
        """Per-link or per-session objects, under the flush prefix and file name."""
        spec = job.links
        sink = replace(job.sink(), prefix=spec.flush_prefix or job.sink().prefix)
        numbered = L.number_links(links) if spec.flush == "per_link" else links
        payload = L.link_payload(numbered, details, spec, job.parse)
        name = spec.flush_filename or "{table}-{now:%Y%m%dT%H%M%SZ}-" + (
            "{seq}" if spec.flush == "per_link" else "{session_id}"
        )
        if spec.flush == "per_session":
            payload = L.session_groups(payload)
        folder = replace(sink, filename="parts").path({**values, "seq": "all"})
        flush_parts(payload, sink, values, name, folder)
