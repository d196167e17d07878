"""Quality classifier: supervised subword embeddings, trained by stochastic gradient descent.

A word's features are the word itself and the character n-grams of ``<word>``, hashed into a
table of learned vectors; a word that repeats the one before it has one more feature. A document is the mean of the vectors of all features of all its
words; a softmax over two classes reads it. Vectors and output weights are trained in numpy.

Since mean and output layer are linear up to the softmax, a document's logit is the mean of one
number per feature (its vector times the output weights). Scoring therefore adds up one number
per word, worked out once per word and task.

Defined results: null, empty and blank texts have no features and get the bias's score; equal texts get
equal scores, whatever their other columns; repeated rows and ids are scored one by one; a
label that is null or whose ids disagree counts as its least value; with no usable labels every
score is the prior 0.5; extra columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain
from operator import eq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pageloom.catalog.registry import query
from pageloom.llm.common import PIECE, batches, byte_pieces, land, table

#: Rows the model is fitted on, at most: those whose hashed id is least.
MAX_ROWS = 6_000
BUCKETS = 1 << 17
DIMS = 8
GRAMS = (3, 4)
FACTOR = np.uint64(0x9E3779B97F4A7C15)
#: Words kept worked out in a task; beyond it they are worked out anew.
KNOWN = 200_000


def features(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of some words, word after word, and how many each word has.

    A word's features are the word and the character n-grams (bytes) of ``<word>``. All are
    polynomials over the joined words, worked out for every place at once.
    """
    raw = np.frombuffer(b"<" + b"><".join(words) + b">", np.uint8).astype(np.uint64)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 2
    first = np.cumsum(sizes) - sizes
    inside = np.arange(len(raw)) - np.repeat(first, sizes)
    left = np.repeat(sizes, sizes) - inside
    whole = np.add.reduceat(raw * powers(int(sizes.max()))[inside], first)
    ids, at = [fold(whole)], [np.arange(len(words))]
    owner = np.repeat(np.arange(len(words)), sizes)
    for n in GRAMS:
        here = np.flatnonzero(left >= n)
        gram = np.full(len(here), n, np.uint64)
        for i in range(n):
            gram = gram * FACTOR + raw[here + i]
        ids.append(fold(gram))
        at.append(owner[here])
    ids, at = np.concatenate(ids), np.concatenate(at)
    order = np.argsort(at, kind="stable")
    return ids[order], np.bincount(at, minlength=len(words))


@lru_cache(maxsize=4)
def powers(n: int) -> np.ndarray:
    return np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n, FACTOR, np.uint64)]))


def fold(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    # the last feature is left free: a word that repeats the one before it
    return ((h >> np.uint64(32)) % np.uint64(BUCKETS - 1)).astype(np.int64)


@dataclass
class Model:
    #: per feature: its vector times the output weights of class 1 less those of class 0
    worth: np.ndarray
    bias: float


class Scorer:
    """Scores texts; a word's sum of worths and its number of features are kept as one complex."""

    def __init__(self, model: Model):
        self.model, self.known = model, {}

    def learn(self, words: set[bytes]) -> None:
        if len(self.known) > KNOWN:
            self.known.clear()
        new = list(words.difference(self.known))
        if new:
            ids, sizes = features(new)
            sums = np.add.reduceat(self.model.worth[ids].astype(np.float64), np.cumsum(sizes) - sizes)
            self.known.update(zip(new, (sums + 1j * sizes).tolist()))

    def score(self, texts: list[str | None]) -> np.ndarray:
        """Probability of class 1 for each text; texts are taken together only to learn words."""
        logits = np.full(len(texts), self.model.bias)
        many, size = [], 0
        for i, text in enumerate(texts):
            many.append(i)
            size += len(text or "")
            if size > PIECE or i == len(texts) - 1:
                self._score(texts, many, logits)
                many, size = [], 0
        return 1 / (1 + np.exp(-np.clip(logits, -30, 30)))

    def _score(self, texts: list[str | None], many: list[int], logits: np.ndarray) -> None:
        repeats = float(self.model.worth[BUCKETS - 1])
        split = [(i, piece.split()) for i in many for piece in byte_pieces((texts[i] or "").encode())] if len(many) > 1 else None
        if split:
            self.learn(set(chain.from_iterable(words for _, words in split)))
        totals: dict[int, complex] = {}
        for i, words in split or ((i, piece.split()) for i in many for piece in byte_pieces((texts[i] or "").encode())):
            if not split:
                self.learn(set(words))
            again = sum(map(eq, words, words[1:]))
            totals[i] = sum(map(self.known.__getitem__, words), totals.get(i, 0j)) + again * complex(repeats, 1)
        for i, total in totals.items():
            if total.imag:
                logits[i] += total.real / total.imag


def counted(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Features of a text and how often each occurs."""
    total = np.zeros(BUCKETS)
    for piece in byte_pieces((text or "").encode()):
        words = piece.split()
        if words:
            times = Counter(words)
            ids, sizes = features(list(times))
            total += np.bincount(ids, np.repeat(np.fromiter(times.values(), np.float64), sizes), BUCKETS)
            total[BUCKETS - 1] += sum(map(eq, words, words[1:]))
    ids = np.flatnonzero(total)
    return ids, total[ids].astype(np.float32)


def train(texts: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, *, epochs: int = 12, rate: float = 0.5, seed: int = 3) -> Model:
    """Vectors and softmax by SGD, a document a step; both classes weigh the same in sum."""
    if not len(labels) or labels.min() == labels.max():
        return Model(np.zeros(BUCKETS, np.float32), 0.0)
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / DIMS, 1 / DIMS, (BUCKETS, DIMS)).astype(np.float32)
    out, bias = np.zeros((2, DIMS), np.float32), np.zeros(2, np.float32)
    weight = np.where(labels == 1, 0.5 / labels.mean(), 0.5 / (1 - labels.mean()))
    weight = np.minimum(weight, 4.0).astype(np.float32)
    for epoch in range(epochs):
        step = rate * (1 - epoch / epochs)
        for i in rng.permutation(len(labels)):
            ids, times = texts[i]
            if not len(ids):
                continue
            share = times / times.sum()
            hidden = share @ vectors[ids]
            z = out @ hidden + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[labels[i]] -= 1
            p *= step * weight[i]
            back = p @ out
            out -= np.outer(p, hidden)
            bias -= 0.1 * p
            # the mean spreads the gradient over all features; scaled up as if over twenty
            vectors[ids] -= np.outer(share * min(20.0, len(ids)), back)
    return Model((vectors @ (out[1] - out[0])).astype(np.float32), float(bias[1] - bias[0]))


def remainder(id_col: str) -> Column:
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % 5


def fit(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", max_rows: int = MAX_ROWS, seed: int = 3) -> Model:
    """Fit on at most ``max_rows`` labelled rows that are not held out, in one task.

    Their texts are read and turned into feature counts where they lie; the task that trains
    gets only these counts, and the driver gets the trained table (512 KB).
    """
    picked = (
        labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label"))
        .where(F.col("id").isNotNull() & F.col("label").isin(0, 1) & (remainder("id") != 0))
        .groupBy("id").agg(F.min("label").alias("label"))
        .orderBy(F.xxhash64("id", F.lit(seed)), "id").limit(max_rows)
    )
    some = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(picked), "id")

    def count(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(source):
            made = [counted(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").cast(pa.string()), batch.column("label"), pa.array([i.astype("<i4").tobytes() for i, _ in made], pa.binary()), pa.array([t.tobytes() for _, t in made], pa.binary())],
                names=["id", "label", "features", "times"],
            )

    counts = some.mapInArrow(count, "id string, label int, features binary, times binary")
    # one row for each id, however often it occurs
    counts = counts.groupBy("id").agg(F.min(F.struct("features", "times", "label")).alias("one")).select("id", "one.*")

    def learn(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("id")
        texts = [(np.frombuffer(f, "<i4"), np.frombuffer(t, np.float32)) for f, t in zip(rows["features"], rows["times"])]
        model = train(texts, rows["label"].to_numpy())
        return pd.DataFrame({"worth": [model.worth.tobytes()], "bias": [model.bias]})

    made = land(counts.groupBy(F.lit(1).alias("one")).applyInPandas(lambda rows: learn(rows), "worth binary, bias double"), "model").first()
    if made is None:
        return Model(np.zeros(BUCKETS, np.float32), 0.0)
    return Model(np.frombuffer(made["worth"], np.float32), made["bias"])


def classify(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """(id, held_out, score, predicted) of every row."""
    kind = docs.schema[id_col].dataType.simpleString()
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        scorer = Scorer(model)
        for batch in batches(source):
            made = scorer.score(batch.column(2).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(made, pa.float64()), pa.array((made >= threshold).astype(np.int32))], names=[id_col, "held_out", "score", "predicted"])

    rows = docs.select(F.col(id_col), (remainder(id_col) == 0).alias("held_out"), F.col(text_col).alias("_text"))
    return rows.mapInArrow(run, f"`{id_col}` {kind}, held_out boolean, score double, predicted int")


@query("op7_classifier")
def op7_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return classify(docs, fit(docs, table(spark, sf_dir, "labels")))
