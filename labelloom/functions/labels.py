"""Label vocabulary as a small dimension table, and joins against it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelloom.functions.vocabulary import DEFAULT_LABELS
from labelloom.operators.sizing import broadcast_rows
from labelloom.schema import LABEL_DIM


# Up to here a vocabulary is written into the plan; beyond, it is a table of rows.
MAX_LITERAL_LABELS = 1_000


def label_dim(spark: SparkSession, labels: Sequence[str] = DEFAULT_LABELS) -> DataFrame:
    """``(label, category)`` with the position in ``labels`` as the id.

    The size is known here, so the broadcast hint is set only below the bound.
    """
    names = list(labels)
    if len(set(names)) != len(names):
        raise ValueError("label names must be unique")
    if 0 < len(names) <= MAX_LITERAL_LABELS:
        dim = spark.range(0, 1, 1, 1).select(
            F.posexplode(F.lit(names)).alias("label", "category")
        )
        dim = dim.select(F.col("label").cast("long"), "category")
    else:
        dim = spark.createDataFrame(list(enumerate(names)), LABEL_DIM)
    return broadcast_rows(dim, len(names))


def label_maps(labels: Sequence[str] = DEFAULT_LABELS) -> tuple[dict[str, int], dict[int, str]]:
    """The vocabulary as two plain dictionaries."""
    return {n: i for i, n in enumerate(labels)}, dict(enumerate(labels))


def encode_labels(
    df: DataFrame, dim: DataFrame, category_col: str = "category", label_col: str = "label"
) -> DataFrame:
    """Add the id of each category. An unknown category gets a null id: no
    row is lost, and ``require_known_labels`` reports it."""
    side = dim.select(F.col("category").alias(category_col), F.col("label").alias(label_col))
    return df.join(side, category_col, "left")


def decode_labels(
    df: DataFrame, dim: DataFrame, label_col: str = "label", category_col: str = "category"
) -> DataFrame:
    """Add the name of each label id."""
    side = dim.select(F.col("label").alias(label_col), F.col("category").alias(category_col))
    return df.join(side, label_col, "left")


__all__ = [
    "DEFAULT_LABELS",
    "decode_labels",
    "encode_labels",
    "label_dim",
    "label_maps",
]
