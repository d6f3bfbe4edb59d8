"""Load a labelled train/test pair."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelloom.functions.labels import DEFAULT_LABELS, encode_labels, label_dim
from labelloom.operators.guards import (
    category_summary,
    require_columns,
    require_coverage,
    require_known_labels,
    require_text,
)
from labelloom.sources.readers import land_raw, read_csv
from labelloom.storage import cut_lineage


def stack_splits(**splits: DataFrame) -> DataFrame:
    """Several tables as one, with the keyword as the ``split`` column."""
    named = [df.withColumn("split", F.lit(name)) for name, df in splits.items()]
    return reduce(DataFrame.unionByName, named)


def load_labelled_pair(
    spark: SparkSession,
    train_path: str,
    test_path: str,
    cache_dir: str | None = None,
    encode: bool = True,
    validate: bool = True,
    labels: Sequence[str] = DEFAULT_LABELS,
) -> DataFrame:
    """``(row_id, text, category[, label], split)`` from two CSV paths.

    With ``cache_dir`` the parsed tables are landed there once and reused.
    Encoding fails on unknown categories; validation fails unless train holds
    every label, test holds no others, and no text is null.
    """
    parts = {}
    for name, path in (("train", train_path), ("test", test_path)):
        df = require_columns(read_csv(spark, path), ("text", "category"), name)
        if cache_dir is not None:
            df = land_raw(df, f"{cache_dir.rstrip('/')}/{name}")
        parts[name] = df.select("row_id", "text", "category")
    pair = stack_splits(**parts)
    dim = label_dim(spark, labels)
    if encode or validate:
        # One scan feeds all checks: a row per split and category.
        summary = cut_lineage(category_summary(pair))
    if encode:
        require_known_labels(summary, dim)
        pair = encode_labels(pair, dim)
    if validate:
        require_coverage(summary, dim, ("train",))
        require_text(summary)
    return pair
