"""Landed responses to result rows, for every kind of run. Nothing is fetched here."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pageloom.operators import paging
from pageloom.operators.chains import NO_CAP
from pageloom.operators.joins import JoinSpec, multi_join
from pageloom.operators.parse import ParseSpec, parse, with_schema
from pageloom.operators.stops import StopSpec, apply_stops


def paged_records(
    responses: DataFrame,
    options: Mapping[str, Any] | None,
    spec: ParseSpec,
    max_chains: int | None = None,
) -> DataFrame:
    """One pull, or one pull per window: trim the pages, parse them."""
    return paging.records_of(responses, options, spec, max_chains)


def joined_records(
    responses: DataFrame,
    pulls: Sequence[tuple[str, ParseSpec]],
    join: JoinSpec | None,
    per_window: bool = False,
) -> DataFrame:
    """Several single-page pulls joined, within each window for a backfill."""
    frames = [
        (name, parse(paging.single(responses.where(F.col("pull") == name)), spec))
        for name, spec in pulls
    ]
    return multi_join(frames, join, ["_window_seq"] if per_window else [])


def cursor_records(
    responses: DataFrame,
    options: Mapping[str, Any],
    cursor: Mapping[str, Any] | None,
    spec: ParseSpec,
    max_chains: int | None = None,
) -> DataFrame:
    """Seeded chain (next token, or last value of a field), then the stop rules."""
    cursor = cursor or {}
    limit = int(options.get("max_pages") or NO_CAP)
    token_param = options.get("cursor_param", "cursor")
    seed = cursor.get("start_value")
    if options.get("next_cursor_path"):
        walked = paging.follow_cursor(
            responses, options["next_cursor_path"], token_param, seed, limit
        )
        records = parse(walked, spec)
    elif options.get("chain_field"):
        spec = with_schema(responses, spec)
        first = parse(responses, spec)
        walked = paging.follow_field(
            responses, first, options["chain_field"], token_param, seed, limit
        )
        records = parse(walked, spec)
    else:
        records = parse(paging.cap(paging.single(responses), limit), spec)
    return apply_stops(records, StopSpec.from_options(dict(cursor)), max_chains)
