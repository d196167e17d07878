"""Joins of two large sides that read each side once.

A side is written to the shared folder, and the same write counts it: its rows, and its most
frequent keys by a heavy-hitter sketch whose partial results merge (``approx_top_k``). The second
side is filtered while it is written, where the kind of join drops its unmatched rows: the keys of
the first are a Bloom bitmap, made of 64-bit words by ``bit_or``, and small enough to be sent to
every task or not made at all. Then one join over both landed sides gives all rows.

A hot key is spread over a grid: its left rows are cut into as many parts as its counts ask for, its
right rows likewise, and each part is sent to the whole row or column of the grid, so every pair
meets once. Outer rows need no second pass: a row sent to several cells has a partner somewhere,
for the sketch lists only keys it saw, so unmatched copies of it are false; a row sent to one cell
is unmatched exactly if it is there. Counts of a sketch are estimates: they decide how many ways a
key is cut, and never what the result is. The same holds for the bitmap, which errs to one side.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pageloom.runtime import quoted, scratch_path

#: A key with more rows than this on a side is cut there.
HOT_ROWS = 1_000_000
#: Keys listed by a sketch, and items it tracks to find them: 40,000 keys of up to a hundred bytes.
LISTED, TRACKED = 1_000, 40_000
#: Words of a bitmap at most (8 MB), and keys a word stands for: about 11 bits each, 4 set.
BLOOM_WORDS, KEYS_A_WORD = 1 << 20, 6
BITS = 4


@dataclass
class Landed:
    """A side as it was written, with what the write counted."""

    rows: DataFrame
    n: int
    top: dict[str, int]


def plain_key(df: DataFrame, k: str) -> Column:
    """A key whose equal values have one form."""
    fractional = isinstance(df.schema[k].dataType, (T.FloatType, T.DoubleType))
    return F.col(quoted(k)) + F.lit(0) if fractional else F.col(quoted(k))


def key_text(df: DataFrame, on: list[str]) -> Column:
    """The keys as one text, different for different keys, nulls included."""
    return F.to_json(F.array(*[plain_key(df, k).cast("string") for k in on]))


def land_counted(df: DataFrame, on: list[str], label: str) -> Landed:
    """Write a side and count it in the same pass."""
    spark, seen = df.sparkSession, Observation()
    path = scratch_path(spark, label)
    items = F.call_function("approx_top_k", key_text(df, on), F.lit(LISTED), F.lit(TRACKED))
    df.observe(seen, F.count(F.lit(1)).alias("n"), items.alias("top")).write.parquet(path)
    told = seen.get
    top = {r["item"]: r["count"] for r in told["top"] or []}
    return Landed(spark.read.schema(df.schema).parquet(path), told["n"], top)


def _marks(df: DataFrame, on: list[str], words: int) -> tuple[Column, Column]:
    """Word of the bitmap and the bits in it that a row's key sets."""
    keys = [plain_key(df, k) for k in on]
    word = F.pmod(F.xxhash64(*keys), F.lit(words))
    second = F.xxhash64(F.lit("bits"), *keys)
    bits = [F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(second, 6 * i).bitwiseAND(F.lit(63)).cast("int")) for i in range(BITS)]
    mask = bits[0]
    for b in bits[1:]:
        mask = mask.bitwiseOR(b)
    return word.alias("_word"), mask.alias("_bits")


def bloom(side: Landed, on: list[str]) -> DataFrame | None:
    """(_word, _bits) of the keys of a side; nothing if it has too many rows for a small bitmap."""
    words = bloom_words(side)
    if words > BLOOM_WORDS:
        return None
    marked = side.rows.select(*_marks(side.rows, on, words))
    return marked.groupBy("_word").agg(F.bit_or("_bits").alias("_bits"))


def bloom_words(side: Landed) -> int:
    return 1 << max(6, (side.n // KEYS_A_WORD).bit_length())


def filtered(df: DataFrame, on: list[str], by: Landed) -> DataFrame:
    """Rows whose key may be among those of the other side; no other row has a partner."""
    bitmap = bloom(by, on)
    if bitmap is None:
        return df
    word, mask = _marks(df, on, bloom_words(by))
    found = bitmap.select(F.col("_word"), F.col("_bits").alias("_set"))
    row = F.struct(*[F.col(quoted(c)) for c in df.columns]).alias("_row")
    marked = df.select(row, word, mask).join(F.broadcast(found), "_word")
    return marked.where(F.col("_set").bitwiseAND(F.col("_bits")) == F.col("_bits")).select("_row.*")


def hot_ways(left: Landed, right: Landed, hot_rows: int) -> dict[str, tuple[int, int]]:
    """For each key that is hot on a side: into how many parts its left and right rows are cut."""
    ways = {}
    for key in {*left.top, *right.top}:
        cut = tuple(-(-side.top.get(key, 1) // hot_rows) for side in (left, right))
        if max(cut) > 1:
            ways[key] = cut
    return ways


def counted_join(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    how: str,
    left_id: list[str],
    right_id: list[str],
    hot_rows: int | None = None,
) -> DataFrame:
    """Equi-join of two large sides: nulls match nulls, key columns come out once.

    ``how`` is inner, left, right or full. ``*_id`` name columns that tell rows apart, so that many
    equal rows still spread.
    """
    if how == "right":
        b = land_counted(right, on, "right")
        a = land_counted(filtered(left, on, b), on, "left")
    elif how == "left":
        a = land_counted(left, on, "left")
        b = land_counted(filtered(right, on, a), on, "right")
    else:
        b = land_counted(right, on, "right")
        a = land_counted(filtered(left, on, b) if how == "inner" else left, on, "left")
    ways = hot_ways(a, b, hot_rows or HOT_ROWS)
    return _grid_join(a.rows, b.rows, on, how, left_id, right_id, ways)


def _grid_join(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    how: str,
    left_id: list[str],
    right_id: list[str],
    ways: dict[str, tuple[int, int]],
) -> DataFrame:
    lcols, rcols = left.columns, right.columns

    def side(df: DataFrame, mark: str, row_id: list[str], own: int) -> DataFrame:
        slots = df.select(*[F.col(quoted(c)).alias(f"{mark}{i}") for i, c in enumerate(df.columns)], key_text(df, on).alias("_key"), F.xxhash64(*[F.col(quoted(c)) for c in row_id]).alias("_row"))
        if not ways:
            return slots.drop("_key", "_row").withColumns({f"_{mark}here": F.lit(True), f"_{mark}sent": F.lit(1)})
        table = df.sparkSession.createDataFrame([(k, *w) for k, w in ways.items()], "_key string, _w0 int, _w1 int")
        known = slots.join(F.broadcast(table), "_key", "left").withColumns({"_w0": F.coalesce("_w0", F.lit(1)), "_w1": F.coalesce("_w1", F.lit(1))})
        mine, other = f"_w{own}", f"_w{1 - own}"
        part = F.pmod("_row", F.col(mine)).cast("int")
        sent = known.withColumns({f"_{mark}p{own}": part, f"_{mark}sent": F.col(other), f"_{mark}here": F.lit(True)})
        sent = sent.withColumn(f"_{mark}p{1 - own}", F.explode(F.sequence(F.lit(0), F.col(other) - 1)))
        return sent.drop("_key", "_row", "_w0", "_w1")

    a, b = side(left, "l", left_id, 0), side(right, "r", right_id, 1)
    same = None
    for k in on:
        one = a[f"l{lcols.index(k)}"].eqNullSafe(b[f"r{rcols.index(k)}"])
        same = one if same is None else same & one
    if ways:
        same = same & (a["_lp0"] == b["_rp0"]) & (a["_lp1"] == b["_rp1"])
    pairs = a.join(b, same, how)
    # a row sent to several cells has partners in one of them
    if ways and how in ("left", "full"):
        pairs = pairs.where(F.col("_rhere").isNotNull() | (F.col("_lsent") == 1))
    if ways and how in ("right", "full"):
        pairs = pairs.where(F.col("_lhere").isNotNull() | (F.col("_rsent") == 1))

    def key(k: str) -> Column:
        mine, other = F.col(f"l{lcols.index(k)}"), F.col(f"r{rcols.index(k)}")
        return (other if how == "right" else F.coalesce(mine, other) if how == "full" else mine).alias(k)

    return pairs.select(
        *[key(c) if c in on else F.col(f"l{i}").alias(c) for i, c in enumerate(lcols)],
        *[F.col(f"r{i}").alias(c) for i, c in enumerate(rcols) if c not in on],
    )
