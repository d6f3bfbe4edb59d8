"""From raw documents to shards of a training mixture.

Each stage takes ``(spark, docs, sf_dir)``. What it returns is written as
Parquet and read again as the documents of the next one. All but the last
return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from labelloom.llm import decontamination, mixing, ngram_join, quality, sharding
from labelloom.llm.common import table
from labelloom.llm.settings import N_SHARDS, OTHER_WEIGHT, SOURCE_WEIGHTS
from labelloom.storage import write_table

NEAR_DUPLICATE = ngram_join.Similarity(words=5, num=80, den=100)

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the field over lines holds to be good. It learns from the
    labels of the documents that are here."""
    field = quality.fit_quality_model(docs, table(spark, sf_dir, "labels"))
    return quality.score_quality(docs, field).where("predicted = 1").select(docs.columns)


def keep_one_of_similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of similar ones."""
    return ngram_join.keep_one(docs, NEAR_DUPLICATE)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    return decontamination.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, stored in an order that holds the target shares."""
    return mixing.in_mixed_order(docs, SOURCE_WEIGHTS, default_weight=OTHER_WEIGHT)


def cut_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with ``size``, ``shard`` and ``slot``: shards are stretches
    of the mixed order, which the weights and the ids give again."""
    sizes = docs.select("doc_id", "source", sharding.text_size("text").alias("size"))
    narrow = mixing.mix(sizes, SOURCE_WEIGHTS, OTHER_WEIGHT).select("position", "size")
    whole = mixing.mix(docs, SOURCE_WEIGHTS, OTHER_WEIGHT)
    return sharding.shard_stream(docs, narrow, whole, N_SHARDS)


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", drop_low_quality),
    ("n-gram Jaccard join", keep_one_of_similar),
    ("benchmark decontamination", drop_benchmark_leaks),
    ("mixing sources to target weights", mix_sources),
    ("sharding", cut_shards),
]

# Trained models and similarity joins have no counterpart in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = write_table(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return docs
