"""From raw documents to token records, in five stages over the whole corpus.

Each stage takes what its predecessor kept and returns documents with the same
columns; the last returns what the record files hold.  ``run`` writes each result to
the shared folder and reads it again as the next stage's input.

Defined cases, as of the stages' operators: documents with NULL, empty or blank texts fail
the quality rules.  Repeated rows and rows that share an id are documents of their own
until the second stage, which keeps one row of each class of near copies.  Very long texts
are documents like others.  All columns but those of the last stage's result are kept as
they are, whatever their names.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from monthfusion.llm import decontaminate, minhash, mixing, quality_rules, token_records
from monthfusion.llm.queries import production_encoding, table
from monthfusion.sources.scratch import scratch_dir


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality_rules.keep_good(spark, docs)


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return minhash.keep_one(spark, docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.drop_contaminated(spark, docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources meet their target weights; a document taken twice is there twice."""
    return mixing.mixture(spark, docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token records are written; returns what the files hold."""
    index = token_records.write_records(spark, docs, scratch_dir(spark, "corpus-records"), production_encoding())
    return token_records.read_files(spark, index)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality),
    ("near_dedup", deduplicate),
    ("decontamination", decontaminated),
    ("mixing", mixed),
    ("token_records", tokens),
]

#: The stages iterate and write files; tests hold each against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    folder = scratch_dir(spark, "corpus-pipeline")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
