"""Which landed pages belong to a pull, for every paging mode."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pageloom.functions.scalars import (
    header,
    json_path,
    next_link,
    resolve_url,
    token_text,
    variant_at,
)
from pageloom.operators.chains import (
    NO_CAP,
    SHORT_CHAIN,
    follow_chain,
    walk_short,
)
from pageloom.operators.parse import ParseSpec, has_records, parse
from pageloom.operators.sequence import sequence_rows
from pageloom.operators.skew import attach
from pageloom.runtime import CHAIN_KEYS, RESPONSE_KEYS, quoted, settle

MODES = ["none", "page", "cursor", "link-header", "salesforce"]


def check_mode(mode: str | None) -> str:
    mode = mode or "none"
    if mode not in MODES:
        raise ValueError(f"paging mode {mode!r} is not one of {MODES}")
    return mode


def guard_status(responses: DataFrame) -> DataFrame:
    """Fail the run on the first response that reports an error."""
    told = F.concat_ws(" ", F.lit("status"), F.col("status"), F.lit("from"), F.col("url"))
    checked = F.when(F.col("status") >= 400, F.raise_error(told)).otherwise(F.col("status"))
    return responses.withColumn("status", checked).where(F.coalesce("status", F.lit(200)) < 400)


def split_status(responses: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good responses and bad ones, to keep the latter in a table of their own."""
    bad = F.coalesce(F.col("status") >= 400, F.lit(False))
    return responses.where(~bad), responses.where(bad)


def single(responses: DataFrame) -> DataFrame:
    return responses.where(F.col("page_seq") == 0)


def cap(responses: DataFrame, max_pages: int = NO_CAP) -> DataFrame:
    return responses.where(F.col("page_seq") < max_pages)


def until_empty(
    responses: DataFrame, spec: ParseSpec, max_chains: int | None = None
) -> DataFrame:
    """Pages before the first empty one of each chain.

    Only one row per chain (the cut) is joined back; pages are never grouped.
    """
    empty_at = F.when(~has_records(F.col("body"), spec), F.col("page_seq"))
    cuts = responses.groupBy(*CHAIN_KEYS).agg(F.min(empty_at).alias("_cut"))
    cuts = cuts.where(F.col("_cut").isNotNull())
    kept = attach(responses, cuts, CHAIN_KEYS, RESPONSE_KEYS, max_rows=max_chains)
    return kept.where(F.col("_cut").isNull() | (F.col("page_seq") < F.col("_cut"))).drop("_cut")


def assign_pages(df: DataFrame, order: list[str], size: int, start_page: int = 0) -> DataFrame:
    """Cut rows into pages of ``size`` in the given (unique) order."""
    if size <= 0:
        raise ValueError("page size must be positive")
    numbered = sequence_rows(df, order, "_at")
    return numbered.select(
        *df.columns,
        (F.floor(F.col("_at") / size) + start_page).cast("long").alias("page_seq"),
        (F.col("_at") % size).cast("int").alias("row_seq"),
    )


def broken(responses: DataFrame, mode: str, spec: ParseSpec) -> DataFrame:
    """Responses that report an error and belong to a pull.

    A page past the first empty one of its chain does not: readers that take turns ask
    past the end, and endpoints may well answer that with an error.
    """
    bad = responses.where(F.col("status") >= 400)
    if mode != "page":
        return bad
    good = responses.where(F.coalesce("status", F.lit(200)) < 400)
    empty_at = F.when(~has_records(F.col("body"), spec), F.col("page_seq"))
    cuts = good.groupBy(*CHAIN_KEYS).agg(F.min(empty_at).alias("_cut")).where("_cut IS NOT NULL")
    kept = bad.join(cuts, CHAIN_KEYS, "left")
    return kept.where(F.col("_cut").isNull() | (F.col("page_seq") < F.col("_cut"))).drop("_cut")


def reached_cap(responses: DataFrame, options: dict | None, spec: ParseSpec) -> bool:
    """Whether a set cap ended a chain that goes on."""
    options = options or {}
    mode, limit = check_mode(options.get("mode")), int(options.get("max_pages") or 0)
    if not limit:
        return False
    body, path = F.col("body"), options.get("next_cursor_path")
    if mode == "page":
        responses = until_empty(cap(responses, limit), spec)
    last = responses.where(F.col("page_seq") == limit - 1)
    if path:
        goes_on = F.nullif(token_text(variant_at(body, path.split("."))), F.lit("")).isNotNull()
    elif mode == "link-header":
        goes_on = next_link(header(F.col("headers"), "link")).isNotNull()
    elif mode == "salesforce":
        done = F.lower(F.get_json_object("body", json_path(options.get("done_path", "done"))))
        following = F.get_json_object("body", json_path(options.get("next_url_path", "nextRecordsUrl")))
        goes_on = (done != "true") & following.isNotNull()
    elif mode == "page" or options.get("chain_field"):
        goes_on = has_records(body, spec)
    else:
        return False
    return not last.where(goes_on).isEmpty()


# ---- chains ----------------------------------------------------------------


def _along(
    responses: DataFrame,
    key: Column,
    edges: DataFrame,
    start: Column | None,
    max_pages: int,
) -> DataFrame:
    """Responses reachable from the start of their chain, renumbered by depth.

    ``edges`` is a narrow table of requests (``key``) and next requests (``next``).
    Chains landed in fetch order, which is how a source lands them, are cut by
    one row of facts per chain. Only chains whose pages are out of order are
    walked: short ones within a task, long ones by pointer doubling.
    """
    keyed = responses.withColumn("_key", key)
    edges = settle(edges)
    at_start = F.col("page_seq") == 0 if start is None else F.col("key") == start
    starts = edges.where(at_start).groupBy(*CHAIN_KEYS).agg(
        F.min("page_seq").alias("_lo"), F.min_by("key", "page_seq").alias("key")
    )
    facts = settle(_ordered_chains(edges, starts, max_pages))
    slow = facts.where(~F.col("_in_order"))
    fast = attach(keyed, facts, CHAIN_KEYS, RESPONSE_KEYS, how="inner", settled=True).where(
        F.col("_in_order") & F.col("page_seq").between(F.col("_lo"), F.col("_hi"))
    )
    out = _renumbered(responses, fast, F.col("page_seq") - F.col("_lo"))
    if slow.isEmpty():
        return out
    walk = _walked(edges, slow, max_pages).withColumnRenamed("key", "_key")
    # (chain, key) occurs once on the page side, and in the walk unless a chain loops.
    walked = attach(keyed, walk, [*CHAIN_KEYS, "_key"], RESPONSE_KEYS, how="inner")
    return out.unionAll(_renumbered(responses, walked, F.col("depth")))


def _walked(edges: DataFrame, chains: DataFrame, max_pages: int) -> DataFrame:
    """Depth of every page of the given chains; ``chains`` tells start and size."""
    short = F.col("_pages") <= SHORT_CHAIN
    begun = chains.select(*CHAIN_KEYS, F.col("key").alias("start"), "_pages")
    begun = attach(edges, begun, CHAIN_KEYS, RESPONSE_KEYS, how="inner")
    walks = walk_short(begun.where(short), CHAIN_KEYS, max_pages)
    long = chains.where(~short)
    if long.isEmpty():
        return walks
    starts = long.select(*CHAIN_KEYS, "key")
    return walks.unionAll(follow_chain(begun.where(~short), starts, CHAIN_KEYS, max_pages))


def _requests(responses: DataFrame, key: Column, *more: Column) -> DataFrame:
    return responses.select(*CHAIN_KEYS, "page_seq", key.alias("key"), *more)


def _edges(
    responses: DataFrame, key: Column, raw: Column, nxt: Callable[[Column], Column]
) -> DataFrame:
    """``raw`` is what is read from a response and ``nxt`` the next request made of
    it; they are apart so that a body is parsed once, however often the value is used."""
    read = _requests(responses, key, "url", raw.alias("_raw"))
    return read.select(*CHAIN_KEYS, "page_seq", "key", nxt(F.col("_raw")).alias("next"))


def _token_of(params: Column, name: str) -> Column:
    """The token a page was asked with, empty for a request without one."""
    return F.coalesce(F.try_element_at(params, F.lit(name)), F.lit(""))


def _renumbered(responses: DataFrame, rows: DataFrame, depth: Column) -> DataFrame:
    return rows.select(
        *[depth.cast("long").alias(c) if c == "page_seq" else c for c in responses.columns]
    )


def _ordered_chains(edges: DataFrame, starts: DataFrame, max_pages: int) -> DataFrame:
    """Per chain: first and last page if each page names the one landed after it."""
    page = [*CHAIN_KEYS, "page_seq"]
    steps = edges.groupBy(*page).agg(
        F.max("key").alias("key"), F.max("next").alias("next"), F.count(F.lit(1)).alias("n")
    )
    after = steps.select(
        *CHAIN_KEYS, (F.col("page_seq") - 1).alias("page_seq"), F.col("key").alias("follows")
    )
    linked = steps.join(after, page, "left").withColumnRenamed("key", "_at")
    linked = attach(linked, starts, CHAIN_KEYS, RESPONSE_KEYS, how="inner")
    goes_on = F.coalesce(F.col("next") == F.col("follows"), F.lit(False))
    # A page may name a request that was never made, as at an early stop: it ends the chain.
    landed = edges.select(*CHAIN_KEYS, F.col("key").alias("next"), F.lit(True).alias("_landed"))
    linked = linked.join(landed.distinct(), [*CHAIN_KEYS, "next"], "left")
    here = F.col("page_seq") >= F.col("_lo")
    in_cap = F.col("page_seq") - F.col("_lo") < max_pages - 1
    ends = F.when(here & ~(goes_on & in_cap), F.struct("page_seq", "next", "_landed"))
    return (
        linked.groupBy(*CHAIN_KEYS)
        .agg(
            F.min("_lo").alias("_lo"),
            F.min("key").alias("key"),
            F.min(ends).alias("_end"),
            F.max(F.when(here, F.col("n"))).alias("_copies"),
            F.sum("n").alias("_pages"),
        )
        .select(
            *CHAIN_KEYS,
            "_lo",
            "key",
            "_pages",
            F.col("_end.page_seq").alias("_hi"),
            (
                (F.col("_copies") == 1)
                & (
                    F.col("_end._landed").isNull()
                    | (F.col("_end.page_seq") - F.col("_lo") >= max_pages - 1)
                )
            ).alias("_in_order"),
        )
    )


def follow_cursor(
    responses: DataFrame,
    next_path: str,
    cursor_param: str = "cursor",
    start: str | Column | None = None,
    max_pages: int = NO_CAP,
) -> DataFrame:
    """Token paging: each body names the token of the page after it.

    A falsy ``start`` means the page that was requested without a token.
    """
    key = _token_of(F.col("params"), cursor_param)
    begin = start if isinstance(start, Column) else F.lit(str(start or ""))
    if next_path:
        edges = _edges(
            responses, key, variant_at(F.col("body"), next_path.split(".")), token_text
        )
    else:
        edges = _requests(responses, key, F.lit(None).cast("string").alias("next"))
    return _along(responses, key, edges, begin, max_pages)


def follow_field(
    responses: DataFrame,
    records: DataFrame,
    chain_field: str,
    cursor_param: str = "cursor",
    start: str | None = None,
    max_pages: int = NO_CAP,
) -> DataFrame:
    """The next token is the last row's value of a field; an empty page ends it."""
    if chain_field not in records.columns:
        return cap(responses, min(max_pages, 1))
    lasts = records.groupBy(
        F.col("_pull").alias("pull"),
        F.col("_window_seq").alias("window_seq"),
        F.col("_page_seq").alias("page_seq"),
    ).agg(F.max_by(F.col(quoted(chain_field)).cast("string"), "_row_seq").alias("next"))
    key = _token_of(F.col("params"), cursor_param)
    # One row per page on both sides, and no bodies.
    edges = _requests(responses, key).join(lasts, RESPONSE_KEYS, "left")
    return _along(responses, key, edges, F.lit(str(start or "")), max_pages)


def follow_headers(responses: DataFrame, max_pages: int = NO_CAP) -> DataFrame:
    """Link-header paging, from the first request of each chain."""
    link = header(F.col("headers"), "link")
    edges = _edges(responses, F.col("url"), link, next_link)
    return _along(responses, F.col("url"), edges, None, max_pages)


def follow_done(
    responses: DataFrame,
    spec: ParseSpec,
    done_path: str = "done",
    next_url_path: str = "nextRecordsUrl",
    max_pages: int = NO_CAP,
) -> DataFrame:
    """Done-flag paging: a true or missing flag, or no next URL, ends the chain.

    Both names are top-level keys. Pages without records are left out.
    """
    ends = bool({done_path, next_url_path} & set(spec.drop_keys))
    both = T.StructType([T.StructField(n, T.VariantType()) for n in (done_path, next_url_path)])

    def nxt(read: Column) -> Column:
        # The flag is typed: only JSON true or a missing key ends the chain.
        flag = read.getField(done_path)
        is_true = (F.schema_of_variant(flag) == "BOOLEAN") & F.coalesce(
            F.try_variant_get(flag, "$", "boolean"), F.lit(False)
        )
        ref = token_text(read.getField(next_url_path))
        return F.when(flag.isNotNull() & ~is_true & ~F.lit(ends), resolve_url(F.col("url"), ref))

    edges = _edges(responses, F.col("url"), F.from_json("body", both), nxt)
    walked = _along(responses, F.col("url"), edges, None, max_pages)
    json_only = ParseSpec("json", spec.record_path, spec.drop_keys)
    return walked.where(has_records(F.col("body"), json_only))


def trim(
    responses: DataFrame,
    options: dict | None,
    spec: ParseSpec,
    max_chains: int | None = None,
) -> DataFrame:
    """The page set a pull with these paging options is made of."""
    options = options or {}
    mode = check_mode(options.get("mode"))
    limit = int(options.get("max_pages") or NO_CAP)
    if mode == "none":
        return single(responses)
    if mode == "page":
        return until_empty(cap(responses, limit), spec, max_chains)
    if mode == "cursor":
        return follow_cursor(
            responses,
            options.get("next_cursor_path"),
            options.get("cursor_param", "cursor"),
            max_pages=limit,
        )
    if mode == "link-header":
        return follow_headers(responses, limit)
    return follow_done(
        responses,
        spec,
        options.get("done_path", "done"),
        options.get("next_url_path", "nextRecordsUrl"),
        limit,
    )


def records_of(
    responses: DataFrame, options: dict | None, spec: ParseSpec, max_chains: int | None = None
) -> DataFrame:
    """Trimmed pages, parsed. Done-flag paging always reads bodies as JSON."""
    if (options or {}).get("mode") == "salesforce":
        spec = ParseSpec("json", spec.record_path, spec.drop_keys, spec.schema, spec.strict)
    return parse(trim(responses, options, spec, max_chains), spec)
