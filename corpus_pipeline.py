"""From raw documents to packed sequences, in five stages.

Each stage takes (spark, docs, folder of the tables) and returns a DataFrame, which is written
and reread as the next one's docs. All but the last keep the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pageloom.catalog.registry import query
from pageloom.llm import mixing, packing, pii, quality_rules, similar
from pageloom.llm.common import land, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules or the isolation forest reject go."""
    forest = quality_rules.fit(docs, table(spark, sf_dir, "labels"))
    return quality_rules.judge(docs, forest, keep=COLUMNS).where("kept").select(COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-copies (5-word Jaccard of 0.8 or more) stays."""
    return similar.drop_similar(docs.select(COLUMNS))


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data gives way to the name of its kind."""
    return counted(pii.redact(docs.select(COLUMNS)))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources are drawn to their targets: rows repeat, or lose words, as the mix takes them."""
    return counted(mixing.draw(mixing.mix(docs.select(COLUMNS))).select(COLUMNS))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's ids, in pieces, in sequences of at most 2048."""
    return packing.pack(docs, keep_ids=True)


def counted(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast("long")).select(COLUMNS)


STAGES = [
    ("quality rules", quality),
    ("near-dedup", near_dedup),
    ("PII", redact),
    ("mixing", mix),
    ("packing", pack),
]

#: Packing and the forest cannot be said in SQL; the stages are tested against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = land(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)


query("pipeline", ORACLE_SQL)(run)
