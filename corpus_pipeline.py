"""From raw documents to a mixed training set, stage by stage.

A stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; it is written as Parquet and read back
before the next. All return the columns of ``documents``, and the last further ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from placelytics.llm import decontaminate, exact_dedup, mixing, ngram_join, toxicity
from placelytics.llm.shared import stored


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the model of ``labels`` scores below its threshold."""
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.drop_toxic(docs, model)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text, that with the largest id."""
    return exact_dedup.drop_exact_duplicates(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of five-word shingle sets of a similarity of 0.8 or more."""
    return ngram_join.drop_near_duplicates(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of ``benchmark``."""
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that are taken so that the sources meet their targets, whole, with their copies.

    A document with two copies is one row; ``mixing.mixed`` without ``repeat=False`` makes it two.
    """
    return mixing.mixed(docs, repeat=False)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("ngram_jaccard_join", drop_near_copies),
    ("benchmark_decontamination", drop_leaks),
    ("source_mixing", mix),
]

#: The first stage is a trained model.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
