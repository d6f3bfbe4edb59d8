"""Labelled views over the shared test tables, used by the registered queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A declared vocabulary; not alphabetical, so that ids and names sort apart.
LANGS = ("en", "fr", "de", "es")


def hash_digit(col: str) -> Column:
    """First hex digit of the md5 of an id: an even, reproducible 16-way cut."""
    return F.substring(F.md5(F.col(col).cast("string")), 1, 1)


def labelled_documents(spark: SparkSession, sf_dir: str, category: str = "source") -> DataFrame:
    """``(row_id, text, category, split)``; a quarter of the rows is test."""
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select(
        F.col("doc_id").alias("row_id"),
        "text",
        F.col(category).alias("category"),
        F.when(hash_digit("doc_id") < "4", "test").otherwise("train").alias("split"),
    )


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two phases of ten logits per embedding: ``(row_id, phase, split, label, logits)``."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    digit = hash_digit("vec_id")
    phases = F.array(
        F.struct(F.lit("baseline").alias("phase"), F.slice("embedding", 1, 10).alias("logits")),
        F.struct(F.lit("after_lora").alias("phase"), F.slice("embedding", 11, 10).alias("logits")),
    )
    return vectors.select(
        F.col("vec_id").alias("row_id"),
        F.when(digit < "4", "test").when(digit < "8", "validation").otherwise("train").alias("split"),
        "label",
        F.inline(phases),
    )


def quality_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with a 0/1 label: ``(row_id, text, label, split)``."""
    digit = hash_digit("doc_id")
    return (
        spark.read.parquet(f"{sf_dir}/documents.parquet")
        .select("doc_id", "text")
        .join(spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality"), "doc_id")
        .select(
            F.col("doc_id").alias("row_id"),
            "text",
            F.col("quality").cast("long").alias("label"),
            F.when(digit < "3", "test").when(digit < "5", "validation").otherwise("train").alias("split"),
        )
    )
