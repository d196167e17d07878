"""Joins of several pulls, with the naming rules of the joined columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pageloom.operators.schemas import widen
from pageloom.operators.skew import joined
from pageloom.operators.sketches import counted_join
from pageloom.runtime import META, fits_broadcast, meta_of, payload_of

HOWS = {"left": "left", "inner": "inner", "right": "right", "outer": "full"}
CASES = ["exact", "lower", "upper", "ignore"]


@dataclass(frozen=True)
class JoinSpec:
    on: Sequence[str]
    how: str = "left"
    case: str = "exact"
    # per right side: {"keep": [...], "rename": {...}}
    select_from: Mapping[str, Mapping[str, Any]] = field(default_factory=dict)
    suffixes: tuple[str, str] = ("_x", "_y")

    def __post_init__(self) -> None:
        if not list(self.on):
            raise ValueError("a join needs at least one key in 'on'")
        if self.how not in HOWS:
            raise ValueError(f"join how {self.how!r} is not one of {sorted(HOWS)}")
        if self.case not in CASES:
            raise ValueError(f"join case {self.case!r} is not one of {CASES}")

    @classmethod
    def from_options(cls, options: dict[str, Any]) -> JoinSpec:
        return cls(
            on=list(options.get("on") or []),
            how=(options.get("how") or "left").lower(),
            case=(options.get("case") or "exact").lower(),
            select_from=options.get("select_from") or {},
            suffixes=tuple(options.get("suffixes") or ("_x", "_y")),
        )


def _select_at(df: DataFrame, at: list[int], names: list[str]) -> DataFrame:
    """Columns by position under new names: safe where names differ only by case."""
    slots = [f"c{i}" for i in range(len(df.columns))]
    return df.toDF(*slots).select(*[F.col(slots[i]).alias(n) for i, n in zip(at, names)])


def _rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.toDF(*[names.get(c, c) for c in df.columns])


def fold_case(df: DataFrame, case: str) -> DataFrame:
    """All payload column names in one case; two names that meet are an error."""
    if case not in ("lower", "upper"):
        return df
    turned = {c: getattr(c, case)() for c in payload_of(df)}
    if len(set(turned.values())) < len(turned):
        raise ValueError(f"columns differ only by case: {sorted(turned)}")
    return _rename(df, turned)


def _align_keys(df: DataFrame, on: list[str], case: str) -> DataFrame:
    """Key columns under the spelling used in ``on``."""
    if case != "ignore":
        return df
    by_lower = {c.lower(): c for c in payload_of(df)}
    spelled = {by_lower[k.lower()]: k for k in on if k.lower() in by_lower}
    return _rename(df, {have: want for have, want in spelled.items() if have != want})


def keep_columns(df: DataFrame, keep: Sequence[str] | None, on: Sequence[str]) -> DataFrame:
    """Listed columns and the keys, in source order; unknown names are ignored."""
    if not keep:
        return df
    wanted = {*keep, *on}
    at = [i for i, c in enumerate(df.columns) if c in wanted]
    return _select_at(df, at, [df.columns[i] for i in at])


def rename_columns(df: DataFrame, names: Mapping[str, str] | None, on: Sequence[str]) -> DataFrame:
    names = {a: b for a, b in (names or {}).items() if a in df.columns and a != b}
    lost = [k for k in on if k in names]
    if lost:
        raise ValueError(f"join keys cannot be renamed: {lost}")
    return _rename(df, names)


def _family(kind: T.DataType) -> str:
    if isinstance(kind, T.NumericType):
        return "number"
    return type(kind).__name__


def _key_type(k: str, lk: T.DataType | None, rk: T.DataType | None) -> T.DataType:
    """Common type of a key; a side that lacks it takes the other side's type."""
    if lk is None or rk is None or lk == rk:
        return lk or rk or T.StringType()
    if _family(lk) != _family(rk):
        raise TypeError(f"join key {k!r} is {lk.simpleString()} and {rk.simpleString()}")
    return widen(lk, rk)


def _no_value(df: DataFrame) -> Column:
    """A null the optimizer cannot see through.

    With a literal null the key comparison would fold into a test of one side,
    and the join would turn into a nested loop over a broadcast side.
    """
    plain = [f.name for f in df.schema.fields if isinstance(f.dataType, T.AtomicType)]
    value = F.col(plain[0]) if plain else F.monotonically_increasing_id()
    return F.nullif(value, value)


def suffix_overlap(
    left: Sequence[str], right: Sequence[str], on: Sequence[str], suffixes: tuple[str, str]
) -> tuple[dict[str, str], dict[str, str]]:
    """New names of the columns both sides have; a taken name gets a number."""
    shared = [c for c in left if c in right and c not in on]
    taken = {c for c in [*left, *right] if c not in shared}
    lnames, rnames = {}, {}
    for c in shared:
        for names, suffix in ((lnames, suffixes[0]), (rnames, suffixes[1])):
            name, n = c + suffix, 3
            while name in taken:
                name, n = f"{c}_{n}", n + 1
            taken.add(name)
            names[c] = name
    return lnames, rnames


def join_pair(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    how: str = "left",
    suffixes: tuple[str, str] = ("_x", "_y"),
    within: Sequence[str] = (),
) -> DataFrame:
    """One join: nulls match nulls, keys once, other shared names suffixed.

    A right side measured to be small is broadcast where that is possible;
    otherwise both sides are landed, counted by the same write, and shuffle with hot keys split. The left side keeps its
    row keys; ``within`` names row keys both sides share (the window).
    """
    keys = [*within, *on]
    lcols, rcols = list(left.columns), list(right.columns)
    lpay = [c for c in lcols if c not in keys]
    rpay = [c for c in rcols if c not in keys and c not in META]
    row_ids = [c for c in rcols if c in META and c not in within]
    lnames, rnames = suffix_overlap(lpay, rpay, on, suffixes)

    def side(df: DataFrame, cols: list[str], mark: str) -> DataFrame:
        slots = df.toDF(*[f"{mark}{i}" for i in range(len(cols))])
        parts = []
        for n, k in enumerate(keys):
            lk = left.schema[lcols.index(k)].dataType if k in lcols else None
            rk = right.schema[rcols.index(k)].dataType if k in rcols else None
            have = F.col(f"{mark}{cols.index(k)}") if k in cols else _no_value(slots)
            parts.append(have.cast(_key_type(k, lk, rk)).alias(f"k{n}"))
        rest = [f"{mark}{i}" for i, c in enumerate(cols) if c not in keys]
        return slots.select(*parts, *rest)

    a, b = side(left, lcols, "l"), side(right, rcols, "r")
    slots = [f"k{n}" for n in range(len(keys))]
    kind = HOWS[how]
    if kind in ("left", "inner") and fits_broadcast(b):
        out = joined(a, F.broadcast(b), slots, kind)
    elif kind == "right" and fits_broadcast(a):
        out = joined(F.broadcast(a), b, slots, kind)
    else:
        left_id = [f"l{lcols.index(c)}" for c in META if c in lpay] or a.columns
        right_id = [f"r{rcols.index(c)}" for c in row_ids] or b.columns
        out = counted_join(a, b, slots, kind, left_id, right_id)
    picked = [
        (f"k{keys.index(c)}", c) if c in keys else (f"l{lcols.index(c)}", lnames.get(c, c))
        for c in [*lcols, *[k for k in keys if k not in lcols]]
    ]
    picked += [(f"r{rcols.index(c)}", rnames.get(c, c)) for c in rpay]
    return out.select(*[slot for slot, _ in picked]).toDF(*[name for _, name in picked])


def multi_join(
    pulls: Sequence[tuple[str, DataFrame]],
    spec: JoinSpec | None,
    within: Sequence[str] = (),
) -> DataFrame:
    """Fold the pulls, first to last, with the same keys and kind of join.

    Without a spec, or with one pull, the first pull is the result; the others
    are never read.
    """
    if not pulls:
        raise ValueError("no pulls to join")
    if spec is None or len(pulls) < 2:
        return pulls[0][1]
    on = [getattr(k, spec.case)() if spec.case in ("lower", "upper") else k for k in spec.on]
    out = _align_keys(fold_case(pulls[0][1], spec.case), on, spec.case)
    for name, df in pulls[1:]:
        right = _align_keys(fold_case(df, spec.case), on, spec.case)
        chosen = spec.select_from.get(name) or {}
        right = keep_columns(right, [*(chosen.get("keep") or ())], [*on, *meta_of(right)])
        right = rename_columns(right, chosen.get("rename"), on)
        out = join_pair(out, right, on, spec.how, spec.suffixes, within)
    return out
