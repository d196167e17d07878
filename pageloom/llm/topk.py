"""Exact top-k search in binary codes by incremental multi-index hashing.

A vector's code has the sign of each component as a bit. A code is cut into segments, and a table
per segment lists codes by the segment's value. A query looks up, in turn for each segment, the
values at distance r of its own, r = 0, 1, 2, ...; every code found is verified by its whole
Hamming distance. When radius r is done for segments 0..j (of m), a code not found differs by at
least r + 1 in each of these and r in the others: every code within m * r + j is known. A query
ends as soon as its kth verified distance is within that, ties included.

Equal codes are folded to one row with their least k ids, so copies cost nothing. Codes are dealt
into blocks, each with its own tables, and the stated queries (folded by code, too) are sent to
every block, in blocks; the best k of each block meet in a limited window per query.

Defined results: a null or empty vector has no code: it is not found, and as a query finds
nothing; components that are null or not a number count as not positive; vectors of more than 64 components
raise an error; ties go by id, null ids last; rows of equal id and code are found once; k beyond
the number of rows finds all of them; extra columns are ignored.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pageloom.catalog.registry import query
from pageloom.llm.common import land, table, tasks_for

SEGMENTS = 4
WIDTH = 64 // SEGMENTS
#: Codes whose tables one task holds (about 6 MB), and queries it answers with them.
BLOCK_CODES = 100_000
BLOCK_QUERIES = 2_000


def codes(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    code = "aggregate(transform(v, (x, i) -> IF(coalesce(x > 0, false) AND NOT isnan(x), shiftleft(1L, i), 0L)), 0L, (a, b) -> a | b)"
    """(id, code) of every row with a vector; bit i is set if component i is above 0."""
    rows = rows.select(F.col(id_col).alias("id"), F.col(vector_col).alias("v")).where("size(v) > 0")
    checked = F.when(F.size("v") > 64, F.raise_error(F.lit("codes have 64 bits at most")).cast("long")).otherwise(F.expr(code))
    return rows.select("id", checked.alias("code"))


class Tables:
    """For each segment, the codes of a block in order of its value there."""

    def __init__(self, block: np.ndarray):
        self.block = block
        self.order, self.first = [], []
        for s in range(SEGMENTS):
            value = (block >> np.uint64(WIDTH * s)) & np.uint64(2**WIDTH - 1)
            self.order.append(np.argsort(value, kind="stable"))
            self.first.append(np.searchsorted(value[self.order[-1]], np.arange(2**WIDTH + 1)))
        self.flips = [np.array([sum(1 << b for b in bits) for bits in combinations(range(WIDTH), r)], np.int64) for r in range(WIDTH + 1)]

    def at(self, code: np.uint64, segment: int, radius: int) -> np.ndarray:
        """Places of the codes whose segment is at just this distance of the query's."""
        values = ((int(code) >> (WIDTH * segment)) & (2**WIDTH - 1)) ^ self.flips[radius]
        begin, end = self.first[segment][values], self.first[segment][values + 1]
        some = end > begin
        begin, sizes = begin[some], (end - begin)[some]
        if not len(sizes):
            return np.zeros(0, np.int64)
        shift = np.repeat(begin - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes)
        return self.order[segment][np.arange(len(shift)) + shift]

    def search(self, code: np.uint64, weight: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and distances of all codes up to the distance at which k rows are reached."""
        seen = np.zeros(len(self.block), bool)
        tally = np.zeros(65, np.int64)
        found, distances = [], []
        for radius in range(WIDTH + 1):
            for segment in range(SEGMENTS):
                here = self.at(code, segment, radius)
                here = here[~seen[here]]
                seen[here] = True
                distance = np.bitwise_count(self.block[here] ^ code).astype(np.int64)
                found.append(here)
                distances.append(distance)
                tally += np.bincount(distance, weight[here], 65).astype(np.int64)
                covered = SEGMENTS * radius + segment
                if tally[: covered + 1].sum() >= k:
                    kth = int(np.searchsorted(np.cumsum(tally), k))
                    place, distance = np.concatenate(found), np.concatenate(distances)
                    return place[distance <= kth], distance[distance <= kth]
        return np.concatenate(found), np.concatenate(distances)


def search(rows: DataFrame, queries: DataFrame, *, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, id, distance) of the k rows nearest to each query, itself included if it
    is a row. ``queries`` has the columns of ``rows``."""
    kind = rows.schema[id_col].dataType.simpleString()
    by_id = [F.col("id").asc_nulls_last()]
    least = Window.partitionBy("code").orderBy(*by_id)
    coded = codes(rows, id_col, vector_col).withColumn("n", F.row_number().over(Window.partitionBy("code", "id").orderBy("id"))).where("n = 1")
    folded = coded.withColumn("n", F.row_number().over(least)).where(F.col("n") <= k).groupBy("code").agg(F.array_sort(F.collect_list(F.struct(F.isnull("id").alias("no"), "id"))).alias("ids"))
    folded = land(folded.select("code", F.col("ids.id").alias("ids")), "codes")
    asked = land(codes(queries, id_col, vector_col), "asked")
    wanted = land(asked.select("code").distinct(), "wanted")
    blocks, groups = tasks_for(folded.count(), BLOCK_CODES), tasks_for(wanted.count(), BLOCK_QUERIES)
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = folded.withColumns({"block": F.pmod(F.xxhash64("code"), F.lit(blocks)).cast("int"), "part": each(groups)})
    right = wanted.withColumns({"block": each(blocks), "part": F.pmod(F.xxhash64("code", F.lit(1)), F.lit(groups)).cast("int")})

    def meet(block: pa.Table, some: pa.Table) -> pa.Table:
        code = block.column("code").to_numpy().view(np.uint64)
        ids = block.column("ids").combine_chunks()
        weight = np.diff(ids.offsets.to_numpy()) if len(code) else np.zeros(0, np.int64)
        tables = Tables(code) if len(code) else None
        out_code, out_place, out_distance = [], [], []
        for q in some.column("code").to_numpy().view(np.uint64) if tables else ():
            place, distance = tables.search(q, weight, k)
            out_code.append(np.full(len(place), q))
            out_place.append(place)
            out_distance.append(distance)
        join = lambda parts, t: np.concatenate(parts) if parts else np.zeros(0, t)
        place = pa.array(join(out_place, np.int64))
        return pa.table([pa.array(join(out_code, np.uint64).view(np.int64)), ids.take(place), pa.array(join(out_distance, np.int64))], names=["code", "ids", "distance"])

    met = left.groupBy("block", "part").cogroup(right.groupBy("block", "part")).applyInArrow(meet, f"code long, ids array<{kind}>, distance long")
    near = met.select("code", F.explode("ids").alias("id"), "distance")
    best = Window.partitionBy("code").orderBy("distance", *by_id)
    near = land(near.withColumn("rank", F.row_number().over(best).cast("long")).where(F.col("rank") <= k), "nearest")
    return asked.withColumnRenamed("id", "query_id").join(near, "code").select("query_id", "rank", "id", "distance")


SQL = """
WITH met AS (
  SELECT q.vec_id AS query_id, v.vec_id AS vec_id,
    CAST(list_sum(list_transform(range(1, 65), lambda i: CAST((coalesce(q.embedding[i], 0) > 0) <> (coalesce(v.embedding[i], 0) > 0) AS BIGINT))) AS BIGINT) AS distance
  FROM embeddings q, embeddings v WHERE q.vec_id % 20 = 0
)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) AS rank, vec_id, distance
FROM met QUALIFY rank <= 10
"""


@query("op8_topk", SQL)
def op8_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return search(rows, rows.where("vec_id % 20 = 0")).withColumnRenamed("id", "vec_id")
