"""Effective options of a job from a nested dict with ``envs`` and ``apis``."""

from __future__ import annotations

import os
import re
from dataclasses import dataclass, field, replace
from typing import Any

from pageloom.functions.scalars import build_url
from pageloom.operators.joins import JoinSpec
from pageloom.operators.links import LinkSpec
from pageloom.operators.paging import check_mode
from pageloom.operators.parse import ParseSpec
from pageloom.sinks.writers import SinkSpec

STRATEGIES = ["date", "soql_window", "cursor"]


def expand_env(value: Any) -> Any:
    """``${NAME}`` from the environment, at any depth; unknown names stay."""
    if isinstance(value, dict):
        return {k: expand_env(v) for k, v in value.items()}
    if isinstance(value, list):
        return [expand_env(v) for v in value]
    if not isinstance(value, str):
        return value
    return re.sub(r"\$\{([A-Za-z_]\w*)\}", lambda m: os.environ.get(m[1], m[0]), value)


@dataclass(frozen=True)
class PullOptions:
    """One of several joined pulls; each is a single request."""

    name: str
    url: str
    params: dict[str, Any]
    headers: dict[str, str]
    parse: dict[str, Any]


@dataclass(frozen=True)
class Job:
    table: str
    env: str
    url: str
    headers: dict[str, str]
    params: dict[str, Any]
    paging: dict[str, Any]
    parse_options: dict[str, Any]
    parse: ParseSpec
    links: LinkSpec | None
    backfill: dict[str, Any]
    output: dict[str, Any]
    pulls: list[PullOptions] = field(default_factory=list)
    join: JoinSpec | None = None
    stripes: int = 1
    timeout: float = 30.0
    retries: dict[str, Any] = field(default_factory=dict)
    delay: float = 0.0

    @property
    def mode(self) -> str:
        return check_mode(self.paging.get("mode"))

    def sink(self) -> SinkSpec:
        return SinkSpec.from_options(self.output)

    def strategy(self) -> str:
        """Backfill strategy; a name that is not known means date windows."""
        if not self.backfill.get("enabled", False):
            raise ValueError(f"backfill is not enabled for {self.table!r}")
        name = str(self.backfill.get("strategy", "date")).lower()
        name = name if name in STRATEGIES else "date"
        if name == "soql_window" and self.mode != "salesforce":
            raise ValueError("half-open query windows need done-flag paging")
        return name


def resolve(config: dict[str, Any], table: str, env: str) -> Job:
    """Merge global and table options. Maps of headers and parameters, paging,
    link and output options merge one level deep, the table winning; parse,
    backfill, pulls and join come from the table alone."""
    place = expand_env((config.get("envs") or {}).get(env) or {})
    if not place.get("base_url"):
        raise ValueError(f"environment {env!r} has no base_url")
    shared = config.get("apis") or {}
    own = shared.get(table)
    if not own:
        raise KeyError(f"no table {table!r} under apis")
    parse_options = own.get("parse") or {"type": "json"}
    defaults, mine = expand_env(shared.get("request_defaults") or {}), expand_env(own)
    shared = expand_env({k: v for k, v in shared.items() if k != table})

    def merged(name: str, base: dict[str, Any]) -> dict[str, Any]:
        return {**(base.get(name) or {}), **(mine.get(name) or {})}

    headers, params = merged("headers", defaults), merged("params", defaults)
    path = mine.get("path", shared.get("path", ""))
    pulls = [
        PullOptions(
            name=p.get("name") or "pull",
            url=build_url(place["base_url"], p.get("path", path)),
            params=p.get("params") or {},
            headers=p.get("headers") or {},
            parse=p.get("parse") or {"type": "json"},
        )
        for p in mine.get("multi_pulls") or []
    ]
    parse = ParseSpec.from_options(parse_options)
    if "strict" not in parse_options:
        # Unless asked for otherwise, a body that cannot be read is an error.
        parse = replace(parse, strict=True)
    paging = merged("pagination", shared)
    check_mode(paging.get("mode"))
    join = JoinSpec.from_options(mine["join"]) if mine.get("join") and len(pulls) > 1 else None
    return Job(
        table=table,
        env=env,
        url=build_url(place["base_url"], path),
        headers=headers,
        params=params,
        paging=paging,
        parse_options=parse_options,
        parse=parse,
        links=LinkSpec.from_options(merged("link_expansion", shared)),
        backfill=mine.get("backfill") or {},
        output=merged("output", shared),
        pulls=pulls,
        join=join,
        stripes=int(paging.get("stripes", 1)),
        timeout=float(mine.get("timeout", defaults.get("timeout")) or 30),
        retries=mine.get("retries") or defaults.get("retries") or shared.get("retries") or {},
        delay=float((mine.get("backfill") or {}).get("per_request_delay", 0)),
    )
