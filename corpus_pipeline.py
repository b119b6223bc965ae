"""The documents as training sequences: four stages over the whole table, each from what the one before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidewell.llm import compression_score, jaccard_links, queries, repetition
from tidewell.llm.ship import ship_package
from tidewell.session import apply_defaults, materialize


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules on repeated text."""
    return repetition.keep_clean(docs)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier calls good; it learns from the labelled rows of the whole table."""
    source = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = compression_score.train(source, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return compression_score.keep_good(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of the similarity join."""
    return jaccard_links.keep_one(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of each piece of each document in sequences of 2048 tokens."""
    return queries.packed_rows(docs)


def _ready(stage):
    return lambda spark, docs, sf_dir: stage(ship_package(apply_defaults(spark)), docs, sf_dir)


STAGES = [
    ("quality rules", _ready(quality_rules)),
    ("quality classifier", _ready(quality_classifier)),
    ("near duplicates", _ready(near_duplicates)),
    ("packing", _ready(packing)),
]

#: Suffix arrays, dictionaries, exact components and packing by plan are beyond SQL; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result but the last is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), "stage")
    return STAGES[-1][1](spark, docs, sf_dir)
