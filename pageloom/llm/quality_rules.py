"""Quality rules: an isolation forest on rule statistics.

Every text gives a row of rule statistics. Random trees split a fixed-size subsample of
labelled rows until rows stand alone; a document that is alone after few splits is odd. The
mean path length becomes a score, and the score above which a document goes is set from
labelled rows.

Defined results: a null or empty text has no words, all counts 0, and fails the base rules;
ties, repeated rows and equal ids are scored row by row; extra columns are carried along by
``judge`` unless their names are those of ``STATS`` or ``base_failed``, ``odd``, ``kept``, which
are replaced. With no usable labels the forest is empty and only the base rules decide.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from pageloom.llm.common import SPACES, batches, table
from pageloom.catalog.registry import query

STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
SYMBOLS = "#*$%&|<>"
#: What the forest looks at: by how much a text oversteps what a rule tolerates. Within the
#: tolerance a feature is 0, so ordinary texts cannot be told apart and stay together.
TOLERATED = {"symbols": 0.05, "dup_lines": 0.3, "repeats": 0.25, "upper": 0.2, "digits": 0.15, "marks": 0.1, "not_alpha": 0.15, "long_words": 4.0, "sameness": 0.5}

#: Good rows that calibration may lose beside the share it is given, if that is not 0.
SPARE = 2


def rule_stats(text: str | None) -> tuple[list[int], list[float]]:
    """The counts of the contract, and the features the forest looks at."""
    text = text or ""
    raw = text.encode()
    words = raw.split()  # on bytes: splits at just the six characters
    n = len(words)
    inside = len(text) - sum(map(text.count, SPACES))
    symbols = sum(map(text.count, SYMBOLS))
    lines = [line for line in raw.split(b"\n") if line.strip()]
    dup = len(lines) - len(set(lines))
    grams = list(zip(words, words[1:], words[2:]))
    repeated = 0
    if len(set(grams)) < len(grams):
        seen = Counter(grams)
        until = 0  # words before this one are counted already
        for at, gram in enumerate(grams):
            if seen[gram] > 1:
                repeated += at + 3 - max(until, at)
                until = at + 3
    counts = [n, inside, symbols, dup, repeated]
    of = max(n, 1)
    upper = sum(1 for w in words if len(w) > 1 and w.isupper())
    alpha = sum(1 for w in words if w[:1].isalpha() or w[:1] >= b"\x80")
    rates = {
        "symbols": symbols / of,
        "dup_lines": dup / max(len(lines), 1),
        "repeats": repeated / of,
        "upper": upper / of,
        "digits": sum(map(text.count, "0123456789")) / max(inside, 1),
        "marks": sum(map(text.count, "!?")) / of,
        "not_alpha": 1 - alpha / of,
        "long_words": abs(inside / of - 6),
        "sameness": 1 - min(1, len(set(words)) / of**0.85),
    }
    return counts, [max(0.0, rates[k] - most) for k, most in TOLERATED.items()]


@dataclass
class Forest:
    """Trees as arrays of nodes; a leaf has feature -1 and its path length in ``cut``."""

    feature: np.ndarray = field(default_factory=lambda: np.zeros((0, 1), np.int16))
    cut: np.ndarray = field(default_factory=lambda: np.zeros((0, 1)))
    left: np.ndarray = field(default_factory=lambda: np.zeros((0, 1), np.int32))
    normal: float = 1.0
    threshold: float = 2.0

    def score(self, x: np.ndarray) -> np.ndarray:
        """2 ** (-mean path / expected path): near 1 is odd, below 0.5 is ordinary."""
        if not len(self.feature) or not len(x):
            return np.zeros(len(x))
        total = np.zeros(len(x))
        rows = np.arange(len(x))
        for feature, cut, left in zip(self.feature, self.cut, self.left):
            node = np.zeros(len(x), np.int64)
            while True:
                f = feature[node]
                inner = f >= 0
                if not inner.any():
                    break
                step = left[node] + (x[rows, np.maximum(f, 0)] >= cut[node])
                node = np.where(inner, step, node)
            total += cut[node]
        return 2.0 ** (-(total / len(self.feature)) / self.normal)


def expected_path(n: int | float) -> float:
    """Mean path of an unsuccessful search among n rows."""
    return 0.0 if n <= 1 else 1.0 if n == 2 else 2 * (np.log(n - 1) + 0.5772156649) - 2 * (n - 1) / n


def grow(x: np.ndarray, rng: np.random.Generator, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    size = 2 ** (depth + 1)
    feature, cut, left = np.full(size, -1, np.int16), np.zeros(size), np.zeros(size, np.int32)
    free, stack = 1, [(0, np.arange(len(x)), 0)]
    while stack:
        node, rows, level = stack.pop()
        spread = np.flatnonzero(x[rows].max(0) > x[rows].min(0)) if len(rows) > 1 else []
        if level == depth or not len(spread):
            cut[node] = level + expected_path(len(rows))
            continue
        f = rng.choice(spread)
        low, high = x[rows, f].min(), x[rows, f].max()
        at = rng.uniform(low, high)
        above = x[rows, f] >= at
        if above.all():
            above, at = x[rows, f] > low, high
            above = x[rows, f] >= at
        feature[node], cut[node], left[node] = f, at, free
        stack += [(free, rows[~above], level + 1), (free + 1, rows[above], level + 1)]
        free += 2
    return feature, cut, left


def fit(
    docs: DataFrame,
    labels: DataFrame,
    *,
    max_rows: int = 8_000,
    trees: int = 200,
    subsample: int = 256,
    low_share: float = 0.1,
    lost_good: float = 0.002,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    seed: int = 7,
) -> Forest:
    """Grow the forest and set its threshold on at most ``max_rows`` labelled rows.

    The rows are those whose hashed id is least, so the sample is the same on every run.
    Each tree sees ``subsample`` of them, ``low_share`` labelled low. The threshold is the
    one with the most right decisions among those that lose at most ``lost_good`` of the
    rows labelled good, and ``SPARE`` rows more, so that a few odd good rows do not set it
    where labels are few. Only statistics (about 100 bytes a row) come to the driver.
    """
    picked = (
        labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label"))
        .where("id IS NOT NULL AND label IS NOT NULL")
        .groupBy("id").agg(F.min("label").alias("label"))
        .orderBy(F.xxhash64("id", F.lit(seed)), "id").limit(max_rows)
    )
    some = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(picked), "id")

    def features(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(source):
            made = [rule_stats(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("label"), pa.array([c for c, _ in made], pa.list_(pa.int64())), pa.array([f for _, f in made], pa.list_(pa.float64()))],
                names=["id", "label", "counts", "features"],
            )

    kind = f"id {docs.schema[id_col].dataType.simpleString()}, label int, counts array<bigint>, features array<double>"
    # one row for each id, however often it occurs
    one = F.min(F.struct("features", "counts", "label")).alias("one")
    rows = some.mapInArrow(features, kind).groupBy("id").agg(one).select("id", "one.*").collect()
    rows = sorted((r for r in rows if not fails_base(r["counts"])), key=lambda r: r["id"])
    x = np.array([r["features"] for r in rows]).reshape(len(rows), len(TOLERATED))
    good = np.array([r["label"] for r in rows], int) > 0
    if good.sum() < 8:
        return Forest()
    rng = np.random.default_rng(seed)
    high, low = np.flatnonzero(good), np.flatnonzero(~good)
    n_low = min(len(low), int(subsample * low_share))
    n_high = min(len(high), subsample - n_low)
    depth = int(np.ceil(np.log2(max(n_low + n_high, 2)))) + 2
    grown = [grow(x[np.concatenate([rng.choice(high, n_high, False), rng.choice(low, n_low, False)])], rng, depth) for _ in range(trees)]
    forest = Forest(*(np.stack(part) for part in zip(*grown)), normal=expected_path(n_low + n_high))
    forest.threshold = calibrate(forest.score(x), good, lost_good)
    return forest


def fails_base(counts: list[int]) -> bool:
    return counts[0] < 50 or 100 * counts[4] > 50 * counts[0]


def calibrate(score: np.ndarray, good: np.ndarray, lost_good: float) -> float:
    """Least loss over the scores seen, among cuts that lose few good rows; above: odd."""
    if good.all():
        return float(score.max())
    order = np.argsort(-score, kind="stable")
    s, g = score[order], good[order]
    lost, caught = np.cumsum(g), np.cumsum(~g)
    ends = np.append(s[1:] < s[:-1], True) & (lost <= (lost_good * good.sum() + SPARE if lost_good else 0))
    if not ends.any():
        return float(s[0])
    best = np.flatnonzero(ends)[np.argmax((caught - lost)[ends])]
    if best + 1 == len(s):
        return float(s[best]) - 1e-9
    return float((s[best] + s[best + 1]) / 2)


def judge(docs: DataFrame, forest: Forest, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Each row with its statistics, ``base_failed``, the forest's score ``odd`` and ``kept``.

    ``keep`` names the input columns that are carried along (all, if not given).
    """
    new = [*STATS, "base_failed", "odd", "kept"]
    keep = [c for c in (docs.columns if keep is None else keep) if c not in new]
    # by number on the way through Python, which does not take every name
    docs = docs.select(*(F.col(f"`{c}`").alias(f"_{i}") for i, c in enumerate(keep)), F.col(f"`{text_col}`").alias("_judged"))
    fields = docs.schema.fields[:-1]
    fields += [T.StructField(c, T.LongType()) for c in STATS]
    fields += [T.StructField("base_failed", T.BooleanType()), T.StructField("odd", T.DoubleType()), T.StructField("kept", T.BooleanType())]
    schema = T.StructType(fields)
    arrow = to_arrow_schema(schema)

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(source, 2048):
            if not batch.num_rows:
                continue
            counts, features = [], []
            for part in batches([batch], 256):
                for text in part.column(len(keep)).to_pylist():
                    c, f = rule_stats(text)
                    counts.append(c)
                    features.append(f)
            counts = np.array(counts, np.int64)
            odd = forest.score(np.array(features))
            failed = (counts[:, 0] < 50) | (100 * counts[:, 4] > 50 * counts[:, 0])
            made = [*(pa.array(counts[:, i]) for i in range(5)), pa.array(failed), pa.array(odd), pa.array(~failed & (odd <= forest.threshold))]
            columns = [batch.column(i).cast(arrow.field(i).type) for i in range(len(keep))]
            yield pa.RecordBatch.from_arrays(columns + made, schema=arrow)

    return docs.mapInArrow(run, schema).toDF(*keep, *new)


@query("op10_quality_rules")
def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    forest = fit(docs, table(spark, sf_dir, "labels"))
    return judge(docs, forest, keep=["doc_id"]).select("doc_id", *STATS, "base_failed", "kept", "odd")
