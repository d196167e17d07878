"""Personal data: patterns propose spans, checksums confirm them, context words score them.

All of it is Spark expressions. For each kind ``regexp_extract_all`` gives the leftmost
non-overlapping proposals and ``split`` the texts between them; lengths of both, summed up in
blocks, give positions in code points. The text between two proposals also holds the words near
a proposal, so nothing is ever cut out of the whole text by position, and a text with very many
spans costs in proportion.

A proposal's score is its pattern's prior, plus what a passed checksum adds, plus what a context
word within ``NEAR`` characters adds. Proposals that fail a check are dropped, without a retry
on a shorter match; an IBAN is proposed with its country's length, so what follows is never part
of it. The four base kinds (email, ip, card, phone) need no context: their prior is
already at ``THRESHOLD``. The kinds that the method adds need a checksum (iban: mod 97) or
context (national number) to get there.

The patterns are written so that Java's matcher neither recurses on long runs (possessive
groups) nor tries every start within one (a look-behind, or the end of the match before), and
so that the first thing tried at a place is a single character.

Defined results: null and empty texts have no spans (``redact`` leaves them as they are); spans
of different kinds may overlap; repeated rows are treated one by one; extra columns are kept,
but columns named as the new ones (``spans``) are replaced, and names that begin with
``_pii_`` are reserved.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pageloom.catalog.registry import query
from pageloom.llm.common import table

THRESHOLD = 0.5
NEAR = 48
BLOCK = 128
LOCAL = r"A-Za-z0-9._%+-"


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    prior: float
    #: SQL over a proposal ``m``: it must hold.
    check: str
    #: Words that raise the score when near.
    context: tuple[str, ...]
    #: A text without this character (``0``: without any digit) has no match.
    needs: str = "0"
    #: What the passed check is worth.
    checked: float = 0.0


def _number(part: str) -> str:
    return f"coalesce(try_cast(regexp_replace({part}, '^0+', '') AS int), 0)"


DIGITS = "regexp_replace(m, '[^0-9]', '')"
IP_CHECK = f"forall(split(m, '[.]'), p -> length(regexp_replace(p, '^0+', '')) <= 3 AND {_number('p')} <= 255)"
LUHN = (
    f"length({DIGITS}) BETWEEN 16 AND 19 AND aggregate(sequence(1, length({DIGITS})), 0, (a, i) -> a + "
    f"element_at(IF(i % 2 = 1, array(0, 1, 2, 3, 4, 5, 6, 7, 8, 9), array(0, 2, 4, 6, 8, 1, 3, 5, 7, 9)), "
    f"cast(substring(reverse({DIGITS}), i, 1) AS int) + 1)) % 10 = 0"
)
TIGHT = "replace(m, ' ', '')"
MOD97 = (
    f"length({TIGHT}) BETWEEN 15 AND 34 AND aggregate(split(concat(substring({TIGHT}, 5), substring({TIGHT}, 1, 4)), ''), 0, (a, c) -> "
    "CASE WHEN c = '' THEN a WHEN c <= '9' THEN (a * 10 + ascii(c) - 48) % 97 ELSE (a * 100 + ascii(c) - 55) % 97 END) = 1"
)

#: Characters of an IBAN by country, as registered or in use.
IBAN_LENGTHS = {
    15: "NO", 16: "BE BI", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "AO CV GW LY PT ST",
    26: "DZ IR IS TR", 27: "BI CF CG CM DJ FR GA GQ GR IT KM MC MG MR SM TD", 28: "AL AZ BF BJ BY CI CY DO GT HN HU LB MA ML NE NI PL SN SV TG",
    29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC NI", 33: "RU",
}
IBAN_REST = "|".join(rf"(?<=(?:{'|'.join(of.split())})[0-9]{{2}})(?:\x20?[A-Z0-9]){{{n - 4}}}+(?![A-Za-z0-9])" for n, of in IBAN_LENGTHS.items())

#: In the order in which results list them; the first four are the base.
KINDS = (
    Kind("email", rf"(?:\G|(?<![{LOCAL}]))[{LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", 0.7, "true", ("mail", "contact", "write"), "@"),
    Kind("ip", r"[0-9](?<![0-9]{2})[0-9]*+\.[0-9]++\.[0-9]++\.[0-9]++", 0.5, IP_CHECK, ("ip", "server", "host", "address", "login")),
    Kind("card", r"[0-9](?<![0-9]{2})(?<![0-9][\x20-][0-9])(?:[\x20-]?[0-9]){15,}+", 0.5, LUHN, ("card", "visa", "payment", "credit"), "0", 0.3),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", 0.5, f"length({DIGITS}) BETWEEN 8 AND 15", ("phone", "call", "tel", "mobile", "fax"), "+"),
    Kind("iban", r"[A-Z](?<![A-Za-z0-9][A-Z])[A-Z][0-9]{2}(?:" + IBAN_REST + ")", 0.1, MOD97, ("iban", "bank", "account", "konto"), "0", 0.5),
    Kind("national", r"[0-9](?<![0-9-][0-9])[0-9]{2}-[0-9]{2}-[0-9]{4}(?![0-9-])", 0.2, "substring(m, 1, 3) NOT IN ('000', '666') AND m < '9'", ("ssn", "social security", "national id", "tax id")),
)
BASE = tuple(k.name for k in KINDS[:4])
SPAN = "array<struct<kind:string,start:bigint,end:bigint,score:double>>"


def _proposed(df: DataFrame, text: str, kind: Kind) -> DataFrame:
    """Adds the proposals, the texts between them, and the score of each (null: dropped)."""
    m, g = "_pii_m", "_pii_g"
    pattern = F.lit(kind.pattern)
    found = F.regexp_extract_all(F.col(text), pattern, F.lit(0))
    may = F.col("_pii_digit") if kind.needs == "0" else F.contains(F.col(text), F.lit(kind.needs))
    df = df.withColumn(m, F.when(may, found))
    df = df.withColumn(g, F.when(F.size(m) > 0, F.split(F.col(text), kind.pattern, -1)))
    near = f"lower(concat(right(get({g}, i), {NEAR}), ' ', left(get({g}, i + 1), {NEAR})))"
    words = "|".join(kind.context)
    score = f"{kind.prior}D + {kind.checked}D + IF({near} RLIKE '\\\\b({words})', 0.3D, 0D)"
    return df.withColumn("_pii_s", F.expr(f"transform({m}, (m, i) -> IF({kind.check} AND {score} >= {THRESHOLD}D, least({score}, 1D), NULL))"))


def _starts() -> str:
    """SQL: code point where each proposal starts; running sums in blocks, not one by one."""
    step = f"slice(_pii_l, b * {BLOCK} + 1, {BLOCK})"
    return (
        f"flatten(transform(sequence(0, (size(_pii_l) - 1) div {BLOCK}), b -> aggregate({step}, "
        "named_struct('at', aggregate(slice(_pii_b, 1, b), 0L, (x, y) -> x + y), 'out', cast(array() AS array<bigint>)), "
        "(a, s) -> named_struct('at', a.at + s.g + s.m, 'out', concat(a.out, array(a.at + s.g))), a -> a.out)))"
    )


def _spans(df: DataFrame, text: str, kind: Kind, out: str) -> DataFrame:
    df = _proposed(df, text, kind)
    hit = F.expr("exists(_pii_s, s -> s IS NOT NULL)")
    lengths = F.expr("transform(_pii_m, (m, i) -> named_struct('g', cast(length(get(_pii_g, i)) AS bigint), 'm', cast(length(m) AS bigint)))")
    blocks = F.expr(f"transform(sequence(0, (size(_pii_l) - 1) div {BLOCK}), b -> aggregate(slice(_pii_l, b * {BLOCK} + 1, {BLOCK}), 0L, (a, s) -> a + s.g + s.m))")
    made = f"filter(transform(_pii_at, (at, i) -> named_struct('kind', '{kind.name}', 'start', at, 'end', at + get(_pii_l, i).m, 'score', get(_pii_s, i))), s -> s.score IS NOT NULL)"
    df = df.withColumn("_pii_l", F.when(hit, lengths)).withColumn("_pii_b", F.when(F.col("_pii_l").isNotNull(), blocks))
    df = df.withColumn("_pii_at", F.when(F.col("_pii_l").isNotNull(), F.expr(_starts())))
    df = df.withColumn(out, F.coalesce(F.expr(f"CAST({made} AS {SPAN})"), F.expr(f"CAST(array() AS {SPAN})")))
    return df.drop("_pii_m", "_pii_g", "_pii_s", "_pii_l", "_pii_b", "_pii_at")


def find(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Adds ``spans``: kind, start and end (code points, end exclusive) and score, by kind then start."""
    keep = [c for c in (docs.columns if keep is None else keep) if c != "spans"]
    df = docs.select(*(F.col(f"`{c}`") for c in keep), F.col(text_col).alias("_pii_text"))
    df = df.withColumn("_pii_digit", F.col("_pii_text").rlike("[0-9]"))
    parts = [f"_pii_{k.name}" for k in KINDS]
    for kind, part in zip(KINDS, parts):
        df = _spans(df, "_pii_text", kind, part)
    return df.withColumn("spans", F.concat(*parts)).drop("_pii_text", "_pii_digit", *parts)


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows with every span replaced by the kind's name in brackets; where spans overlap,
    the first one's (of equal starts, the longest's) name stands for all they cover."""
    columns = docs.columns
    df = find(docs, text_col).withColumn("_pii_cut", F.expr("array_sort(spans, (x, y) -> CASE WHEN x.start <> y.start THEN cast(sign(x.start - y.start) AS int) ELSE cast(sign(y.end - x.end) AS int) END)"))
    text = f"`{text_col}`"
    pieces = (
        "aggregate(_pii_cut, named_struct('at', 0L, 'out', cast(array() AS array<string>)), (a, s) -> named_struct('at', greatest(a.at, s.end), "
        f"'out', IF(s.start >= a.at, concat(a.out, array(substring({text}, cast(a.at AS int) + 1, cast(s.start - a.at AS int)), concat('[', upper(s.kind), ']'))), a.out)), "
        f"a -> concat(a.out, array(substring({text}, cast(a.at AS int) + 1))))"
    )
    df = df.withColumn(text_col, F.when(F.size("_pii_cut") > 0, F.array_join(F.expr(pieces), "")).otherwise(F.col(text)))
    return df.select(*(F.col(f"`{c}`") for c in columns))


def listed(kinds: tuple[str, ...] | None = None):
    """kind:start:end of the spans of some kinds (all, if not given), joined by commas."""
    spans = F.col("spans")
    if kinds:
        spans = F.filter(spans, lambda s: s["kind"].isin(*kinds))
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


@query("op3_pii")
def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find(table(spark, sf_dir, "documents"), keep=["doc_id"])
    counts = [F.expr(f"cast(size(filter(spans, s -> s.kind = '{k}')) AS bigint)").alias(f"n_{k}") for k in BASE]
    return found.select("doc_id", *counts, F.sha2(listed(BASE), 256).alias("base_sha256"), listed().alias("spans"))
