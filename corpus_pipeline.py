"""From raw documents to packed training bins: five stages, each written and read again.

Every stage but the last returns the columns of ``documents``. Stages decide about rows by their
place in the files, so repeated rows and NULL ids are decided one by one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnmart.llm import exact, mixing, packing, simhash, toxicity
from txnmart.llm.common import read, rows_at
from txnmart.session import written


def keep_clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model doesn't reject."""
    scored = written(toxicity.score(docs, toxicity.learn(docs, read(spark, sf_dir, "labels"))))
    return rows_at(docs, scored.filter("score < 0.5").select("_file", "_row"))


def keep_distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the largest id."""
    return rows_at(docs, exact.groups(docs).filter("kept").select("_file", "_row"))


def keep_dissimilar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near-duplicates, the row with the smallest id."""
    return rows_at(docs, simhash.components(docs).filter("kept").select("_file", "_row"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: not at all, once or twice."""
    mixed = mixing.mix(docs).filter("copies > 0")
    return rows_at(docs, mixed.select("_file", "_row", F.col("copies").alias("_copies")), "_copies")


def pack_bins(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document goes."""
    return packing.pack(docs).select("doc_id", "source", "piece", "start", "length", "bin", "offset")


STAGES = [
    ("toxicity", keep_clean),
    ("exact_dedup", keep_distinct),
    ("simhash", keep_dissimilar),
    ("mix", mix_sources),
    ("pack", pack_bins),
]
#: SQL can't express the recurrent network, and what follows depends on its rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir))
    return docs
