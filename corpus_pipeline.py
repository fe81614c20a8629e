"""A training corpus from the documents: filter, deduplicate, decontaminate, mix.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes the result of
each to the shared folder and hands it to the next. All stages but the last return the columns
of ``docs``; the last adds what the mix takes of each document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillsight.llm import decontaminate, exactdedup, mixing, quality, simhash
from tillsight.llm.common import stored


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{str(sf_dir).rstrip('/')}/{name}.parquet")


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts. It is trained on the labelled documents
    of the stage's input."""
    return quality.accepted(docs, _table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exactdedup.deduplicated(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return simhash.one_of_each(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    return decontaminate.decontaminated(docs, _table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which the mix takes words, with size, target of the source and words taken."""
    return mixing.mixed(docs)


STAGES = [
    ("quality classifier", good_quality),
    ("exact dedup", exact_dedup),
    ("SimHash near-dedup", near_dedup),
    ("benchmark decontamination", without_benchmark),
    ("mixing sources", mix),
]

#: a classifier trained in numpy and 64-bit shingle hashes have no SQL form
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), "stage")
    return docs
