"""Embedding whitening by Golub-Kahan-Lanczos bidiagonalisation.

Entries become whole numbers, x = floor(64 c) + 1000000, and each different vector x is fitted on
once. With X the centred fit list, one row a vector, the bidiagonalisation builds orthonormal
v1, v2, ... (a side of the dimensions) and u1, u2, ... (a side of the vectors), with X V = U B and
B upper bidiagonal: u_k comes from X v_k, v_(k+1) from X'u_k, each made orthogonal to all before it.
The SVD of the small B gives the components (V times its right vectors) and the deviations.

Both products of a step, and the inner products with all earlier u that the full
reorthogonalisation needs, are one pass over the landed fit list: a task multiplies its own rows
with numpy and returns one vector of sums; a task has up to 64 MB of them, so that a pass over a small
table is not many tasks of nothing but their start. No u is ever stored: each is X times a vector a_k of as
many numbers as there are dimensions, so it is made anew for the rows at hand and no executor holds
state. The driver keeps V, the a_k and X'u_k: numbers in the order of dimensions squared, and none
in the order of rows. Steps go on until the leading deviations have converged, and, as a single
start misses copies of a repeated deviation, a new start orthogonal to all before changes nothing.

Rows are centred by whole numbers first: x less the rounded mean is exact, the rest of the mean is
below 1. Sums are exact: 64 bits in a task, decimals beyond.

Defined results: rows whose vector is null, empty, or holds null or non-finite entries go; entries
beyond 2**46 are held at it; vectors of unlike lengths raise an error; equal vectors, from whatever
rows, count once in the fit and each row gets its result; null ids are kept; components with no
deviation (fewer different vectors than dimensions, constant or dependent dimensions) are not
returned, so a single different vector, or an empty table, gives no rows; columns may have any names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pageloom.catalog.registry import query
from pageloom.llm.common import land, table, tasks_for
from pageloom.runtime import quoted

SCALE, SHIFT = 64, 1_000_000
LARGEST = float(2**46 * SCALE)
COMPONENTS = 16
#: Vectors of one landed block (2 MB at 64 dimensions).
BLOCK_ROWS = 4096
#: Bytes of blocks that a task reads in a pass at most, where it has several files: a pass over less
#: takes a task no longer than its start.
TASK_BYTES = 64 << 20
#: Partial sums are brought together by Spark first where there are more tasks than this.
DIRECT_TASKS = 256
#: Relative size below which a product has nothing new; part of the residual that ends the steps.
NOTHING, CONVERGED = 1e-11, 1e-13
#: Passes of one step at most; one is usual, a new start takes two.
PASSES = 3


def whole(vector: Column) -> Column:
    """The vector as whole numbers, null if it goes."""
    good = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    held = lambda c: F.greatest(F.least(c.cast("double") * SCALE, F.lit(LARGEST)), F.lit(-LARGEST))
    return F.when((F.size(vector) > 0) & good, F.transform(vector, lambda c: F.floor(held(c)) + F.lit(SHIFT).cast("long")))


def blocks(vectors: DataFrame) -> DataFrame:
    """(rows, d, low, high, x) of different vectors (one column, array<long>) packed into binary."""

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0

        def out() -> pa.RecordBatch:
            x = np.concatenate(held)
            made = [[len(x)], [x.shape[1]], [int(x.min())], [int(x.max())]]
            return pa.RecordBatch.from_arrays([*(pa.array(m, pa.int64()) for m in made), pa.array([x.tobytes()], pa.binary())], names=["rows", "d", "low", "high", "x"])

        for batch in source:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                held.append(matrix(batch.column(0).slice(at, BLOCK_ROWS)))
                if held[-1].shape[1] != held[0].shape[1]:
                    raise ValueError("vectors of unlike lengths")
                rows += len(held[-1])
                if rows >= BLOCK_ROWS:
                    yield out()
                    held, rows = [], 0
        if held:
            yield out()

    return vectors.mapInArrow(run, "rows long, d long, low long, high long, x binary")


def matrix(lists: pa.Array) -> np.ndarray:
    sizes = np.diff(lists.offsets.to_numpy())
    if len(sizes) and (sizes != sizes[0]).any():
        raise ValueError("vectors of unlike lengths")
    return lists.flatten().to_numpy().astype(np.int64).reshape(len(lists), -1)


@dataclass
class Fit:
    """The different vectors, landed, with the exact mean of each dimension."""

    landed: DataFrame
    n: int
    sums: list[int]
    low: int
    high: int

    @property
    def base(self) -> np.ndarray:
        return np.array([round(Fraction(s, self.n)) for s in self.sums], np.int64)

    @property
    def rest(self) -> np.ndarray:
        """What the mean has beside ``base``, below 1, correctly rounded."""
        return np.array([float(Fraction(s, self.n) - int(b)) for s, b in zip(self.sums, self.base)])

    def centred(self):
        base, rest = self.base, self.rest
        return lambda x: (x - base).astype(np.float64) - rest

    def total(self, part, size: int) -> np.ndarray:
        """Sum over all blocks of ``part(centred rows)``, a vector of ``size`` numbers."""
        d, centred = len(self.sums), self.centred()

        def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            made, any_ = np.zeros(size), False
            for batch in source:
                for raw in batch.column(0).to_pylist():
                    made += part(centred(np.frombuffer(raw, np.int64).reshape(-1, d)))
                    any_ = True
            if any_:
                task = TaskContext.get().partitionId()
                yield pa.RecordBatch.from_arrays([pa.array([task], pa.int64()), pa.array([made.tolist()], pa.list_(pa.float64()))], names=["task", "made"])

        parts = self.blocks.mapInArrow(run, "task long, made array<double>")
        if self.tasks > DIRECT_TASKS:
            summed = parts.select(F.posexplode("made").alias("task", "one")).groupBy("task").agg(F.sum("one").alias("one"))
            return np.array([r.one for r in summed.orderBy("task").collect()])
        return np.sum([r.made for r in parts.orderBy("task").collect()] if self.tasks > 1 else [r.made for r in parts.collect()], axis=0)

    def __post_init__(self):
        self.blocks = self.landed.select("x")
        self.tasks = min(self.blocks.rdd.getNumPartitions(), tasks_for(8 * self.n * len(self.sums), TASK_BYTES, 1)) if self.n else 0
        if self.tasks:
            self.blocks = self.blocks.coalesce(self.tasks)


def fit_list(rows: DataFrame, vector_col: str) -> Fit:
    vectors = rows.select(whole(F.col(quoted(vector_col))).alias("v")).where("v IS NOT NULL").distinct()
    landed = land(blocks(vectors), "fit")
    seen = landed.agg(F.sum("rows"), F.min("d"), F.max("d"), F.min("low"), F.max("high")).first()
    if not seen[0]:
        return Fit(landed, 0, [], 0, 0)
    if seen[1] != seen[2]:
        raise ValueError("vectors of unlike lengths")
    d = seen[1]

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = [0] * d
        for batch in source:
            for raw in batch.column(0).to_pylist():
                x = np.frombuffer(raw, np.int64).reshape(-1, d)
                high, low = (x >> 24).sum(0), (x & (2**24 - 1)).sum(0)  # neither passes 64 bits
                made = [m + (int(h) << 24) + int(w) for m, h, w in zip(made, high, low)]
        yield pa.RecordBatch.from_arrays([pa.array(range(d), pa.int64()), pa.array(list(map(str, made)), pa.string())], names=["dim", "s"])

    exact = F.sum(F.col("s").cast("decimal(38,0)")).alias("s")
    sums = landed.select("x").mapInArrow(run, "dim long, s string").groupBy("dim").agg(exact).orderBy("dim").collect()
    return Fit(landed, seen[0], [int(r.s) for r in sums], seen[3], seen[4])


@dataclass
class Components:
    directions: np.ndarray  # one column a component, unit length
    eigenvalues: np.ndarray  # falling
    trace: float
    steps: int


def bidiagonalise(fit: Fit, components: int = COMPONENTS) -> Components:
    d = len(fit.sums)
    if not d:
        return Components(np.zeros((0, 0)), np.zeros(0), 0.0, 0)
    squares = fit.total(lambda x: np.array([np.einsum("ij,ij->", x, x)]), 1)[0]
    scale = np.sqrt(squares)
    if scale == 0:
        return Components(np.zeros((d, 0)), np.zeros(0), 0.0, 0)
    rng = np.random.default_rng(0)
    v_all, a_all, z_all = np.zeros((d, 0)), np.zeros((d, 0)), np.zeros((d, 0))
    b = np.zeros((0, 0))
    before = None

    def product(w: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        """Of y = X w: y'y, U'y and X'y."""
        coefficients = np.column_stack([a_all, w])
        k = a_all.shape[1]

        def part(x: np.ndarray) -> np.ndarray:
            both = x @ coefficients
            y = both[:, -1]
            return np.concatenate([[y @ y], both[:, :-1].T @ y, x.T @ y])

        made = fit.total(part, 1 + k + d)
        return made[0], made[1 : 1 + k], made[1 + k :]

    def fresh() -> np.ndarray:
        return unit(rng.standard_normal(d))[1]

    def unit(r: np.ndarray) -> tuple[float, np.ndarray]:
        for _ in range(2):
            r = r - v_all @ (v_all.T @ r)
        norm = float(np.linalg.norm(r))
        return norm, r / norm if norm else r

    v, known = fresh(), np.zeros(0)
    w = v
    while True:
        k = a_all.shape[1]
        # X v = U known + what is new; known is what the recurrence tells, the rest is measured
        for _ in range(PASSES):
            yy, c, z = product(w)
            known = known + c
            w = w - a_all @ c
            if np.linalg.norm(c) <= 1e-6 * np.sqrt(max(yy, 0.0)):
                break  # nothing was cancelled, so what was measured is exact
        z = z - z_all @ c
        alpha = np.sqrt(max(yy - c @ c, 0.0))
        grown = np.zeros((k + 1, b.shape[1] + 1))
        grown[:k, :-1], grown[:k, -1] = b, known
        v_all = np.column_stack([v_all, v])
        beta = 0.0
        if alpha > NOTHING * scale:
            grown[k, -1] = alpha
            b = grown
            a_all, z_all = np.column_stack([a_all, w / alpha]), np.column_stack([z_all, z / alpha])
            beta, v = unit(z / alpha)
        else:  # X v lies in U already
            b = grown[:k]
        steps = v_all.shape[1]
        left, sigma, right = np.linalg.svd(b)
        if steps == d:
            break
        restart = beta <= NOTHING * scale
        if steps >= components:
            error = beta * np.abs(left[-1, :components]) if not restart else 0.0
            if np.all(error <= CONVERGED * sigma[0]):
                leading = sigma[:components]
                if before is not None and len(before) == len(leading) and np.allclose(before, leading, rtol=1e-10, atol=NOTHING * scale):
                    break
                before, restart = leading, True
        if restart:
            v, known = fresh(), np.zeros(a_all.shape[1])
            w = v
        else:
            known = np.zeros(a_all.shape[1])
            known[-1] = beta
            w = v - a_all[:, -1] * beta
    some = sigma[:components] > NOTHING * scale
    sigma = sigma[:components][some]
    directions = v_all @ right[: len(sigma)].T
    return Components(directions, sigma**2 / fit.n, squares / fit.n, steps)


def identity_error(fit: Fit, project: np.ndarray) -> float:
    """Largest absolute entry of the whitened fit list's covariance less the identity."""
    k = project.shape[1]

    def part(x: np.ndarray) -> np.ndarray:
        y = x @ project
        return np.concatenate([y.sum(0), (y.T @ y).ravel()])

    made = fit.total(part, k + k * k)
    mean = made[:k] / fit.n
    return float(np.abs(made[k:].reshape(k, k) / fit.n - np.outer(mean, mean) - np.eye(k)).max())


def whiten(rows: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """(id, component, n, deviation decimal, whitened, explained, identity_error) of each row that
    does not go and each component up to ``components``."""
    kind = rows.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    fit = fit_list(rows, vector_col)
    found = bidiagonalise(fit, components)
    k = len(found.eigenvalues)
    if not k:
        return rows.sparkSession.createDataFrame([], schema)
    project = found.directions / np.sqrt(found.eigenvalues)
    explained, error = found.eigenvalues / found.trace, identity_error(fit, project)
    n, base, centred = fit.n, fit.base, fit.centred()
    left = np.array([n * int(b) - s for b, s in zip(base, fit.sums)], object)  # n x - S = n (x - base) + left
    furthest = n * (max(abs(fit.low - int(b)) for b in base) + max(abs(fit.high - int(b)) for b in base) + 1)
    small = furthest * furthest * len(base) < 2**63

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(at, BLOCK_ROWS)
                x = matrix(part.column(1))
                if small:
                    far = n * (x - base) + left.astype(np.int64)
                    deviation = pa.array((far * far).sum(1)).cast(pa.decimal128(38, 0))
                else:
                    far = n * (x - base).astype(object) + left
                    deviation = pa.array([str(int(s)) for s in (far * far).sum(1)], pa.string()).cast(pa.decimal128(38, 0))
                m = len(x)
                every = pa.array(np.repeat(np.arange(m), k))
                tile = lambda values, t: pa.array(np.tile(values, m), t)
                columns = [part.column(0).take(every), tile(np.arange(1, k + 1), pa.int32()), pa.array(np.full(m * k, n)), deviation.take(every)]
                columns += [pa.array((centred(x) @ project).ravel()), tile(explained, pa.float64()), pa.array(np.full(m * k, error))]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    kept = rows.select(F.col(quoted(id_col)).alias("id"), whole(F.col(quoted(vector_col))).alias("v")).where("v IS NOT NULL")
    return kept.mapInArrow(run, schema)


@query("op13_whitening")
def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No SQL: singular vectors have none; tests compare with a dense eigendecomposition."""
    found = whiten(table(spark, sf_dir, "embeddings"))
    return found.select(F.col("id").alias("vec_id"), "component", "n", F.col("deviation").cast("long").alias("deviation"), "whitened", "explained", "identity_error")
