"""A corpus pipeline: each stage calls one operator and works on all that the stage before kept.

``run`` writes every stage's result as Parquet in the shared folder and reads it again, so that a lost
executor costs at most a part of one stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from foulee.llm import decontaminate, exact_dedup, language, packing, simhash
from foulee.llm.frames import read
from foulee.session import scratch_path, staging


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known; texts without letters go."""
    return language.identified(docs)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the longest original with the smallest id."""
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that SimHash links, the one with the smallest id."""
    return simhash.keep_first(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of a benchmark item."""
    return decontaminate.remove(docs, read(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' tokens and their places in sequences."""
    return packing.best_fit(docs)


STAGES = [
    ("language", identify_language),
    ("exact_dedup", drop_exact_copies),
    ("simhash", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("packing", pack_sequences),
]

#: SQL has no tokenizer and no fingerprint: tests compare with a brute-force version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        with staging(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
