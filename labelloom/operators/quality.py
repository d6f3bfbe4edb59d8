"""Duplicates, leakage, label conflicts and blank texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelloom.functions.text import compare_key, digest


def key_table(df: DataFrame, text_col: str = "text", category_col: str = "category") -> DataFrame:
    """One row per comparison key, with all that the checks need.

    The buffers are plain numbers, so the aggregate is a hash aggregate that
    combines before the shuffle: a text holding a third of all rows arrives as
    one row per map task. Only digests are shuffled. Whether a key has more
    than one category shows in the smallest and largest category hash.
    """
    train, test = F.col("split") == "train", F.col("split") == "test"
    key = compare_key(text_col)
    named = train & F.col("category").isNotNull()
    return (
        df.where(F.col("split").isin("train", "test"))
        .select("split", F.col(category_col).alias("category"), key.alias("key"))
        .select(
            "split",
            digest("key").alias("digest"),
            (F.length("key") == 0).alias("blank"),
            F.when(named, F.xxhash64("category")).alias("category_hash"),
        )
        .groupBy("digest")
        .agg(
            F.count_if(train).alias("n_train"),
            F.count_if(test).alias("n_test"),
            F.max("blank").alias("blank"),
            F.min("category_hash").alias("low"),
            F.max("category_hash").alias("high"),
        )
    )


def quality_checks(
    df: DataFrame, text_col: str = "text", category_col: str = "category"
) -> DataFrame:
    """Ten counts as ``(check, value)`` for a table with a ``split`` column of
    train and test rows.

    Leakage counts test rows, conflicts count keys. A null text is a key of
    its own for duplicates and leakage, but never a conflict.
    """
    n_train, n_test, blank = F.col("n_train"), F.col("n_test"), F.col("blank")
    zero = F.lit(0).cast("long")

    def total(value: Column) -> Column:
        return F.coalesce(F.sum(value), zero)

    texts = key_table(df, text_col, category_col).agg(
        total(F.greatest(n_train - 1, zero)).alias("duplicate_texts_train"),
        total(F.greatest(n_test - 1, zero)).alias("duplicate_texts_test"),
        total(F.when(n_train > 0, n_test)).alias("train_test_overlap_texts"),
        F.count_if(F.col("digest").isNotNull() & (F.col("low") != F.col("high"))).alias(
            "label_conflicts_train"
        ),
        total(F.when(blank, n_train)).alias("empty_texts_train"),
        total(F.when(blank, n_test)).alias("empty_texts_test"),
    )
    # Reads no text: one row per split and category leaves each map task.
    classes = (
        df.where(F.col("split").isin("train", "test"))
        .groupBy("split", F.col(category_col).alias("category"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    train, test = F.col("split") == "train", F.col("split") == "test"
    sizes = classes.agg(
        total(F.when(train, F.col("n"))).alias("train_rows"),
        total(F.when(test, F.col("n"))).alias("test_rows"),
        F.count_if(train).alias("n_intents_train"),
        F.count_if(test).alias("n_intents_test"),
    )
    return _to_rows(sizes).unionByName(_to_rows(texts))


def _to_rows(one_row: DataFrame) -> DataFrame:
    names = one_row.columns
    return one_row.unpivot([], names, "check", "value")
