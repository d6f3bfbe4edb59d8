"""Class balance and text length.

``length_table`` is the only step that touches texts: it counts rows per
(split, category, number of words). Every report below is an aggregate of
that small table, so profiling costs one scan and one combined shuffle no
matter how many reports are drawn from it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from labelloom.functions.rounding import round_scaled
from labelloom.functions.text import word_count


def length_table(
    df: DataFrame, text_col: str = "text", category_col: str = "category"
) -> DataFrame:
    """``(split, category, n_words, n)``."""
    return (
        df.select("split", F.col(category_col).alias("category"), word_count(text_col).alias("n_words"))
        .groupBy("split", "category", "n_words")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def class_table(df: DataFrame, category_col: str = "category") -> DataFrame:
    """``(split, category, n)``: what the reports on class sizes need. Reads no
    text, so it is the cheaper start if lengths are not asked for."""
    return df.groupBy("split", F.col(category_col).alias("category")).agg(
        F.count(F.lit(1)).alias("n")
    )


def _mean_words(when: Column | None = None) -> Column:
    counted = F.when(F.col("n_words").isNotNull(), F.col("n"))
    words = F.col("n_words").cast("long") * F.col("n")
    if when is not None:
        counted, words = F.when(when, counted), F.when(when, words)
    return F.sum(words) / F.sum(counted)


def per_class_stats(lengths: DataFrame) -> DataFrame:
    """Count, mean and longest text per class, train beside test, with the
    class's share of train in percent.

    Conditional aggregates over both splits give the rows of a full outer
    join of two per-split tables without that join: a class absent from one
    side has nulls there.
    """
    columns = []
    for side in ("train", "test"):
        here = F.col("split") == side
        columns += [
            F.sum(F.when(here, F.col("n"))).alias(f"{side}_count"),
            round_scaled(_mean_words(here)).alias(f"{side}_avg_words"),
            F.max(F.when(here, F.col("n_words"))).cast("long").alias(f"{side}_max_words"),
        ]
    per_class = (
        lengths.where(F.col("category").isNotNull() & F.col("split").isin("train", "test"))
        .groupBy("category")
        .agg(*columns)
    )
    # One row per class.
    total = F.sum("train_count").over(Window.partitionBy())
    share = round_scaled(F.lit(100) * F.col("train_count") / total)
    return per_class.withColumn("train_share_%", share).orderBy(
        F.desc_nulls_last("train_count"), "category"
    )


def split_sizes(classes: DataFrame) -> DataFrame:
    """Rows and distinct categories per split; null is a category. Takes a
    class table or a length table, as do the next two."""
    return (
        classes.groupBy("split", "category")
        .agg(F.sum("n").alias("n"))
        .groupBy("split")
        .agg(F.sum("n").alias("n_rows"), F.count(F.lit(1)).alias("n_categories"))
    )


def class_distribution(classes: DataFrame, split: str = "train", ascending: bool = False) -> DataFrame:
    """Rows per class of one split, sorted by size."""
    order = F.asc("n_rows") if ascending else F.desc("n_rows")
    return (
        classes.where((F.col("split") == split) & F.col("category").isNotNull())
        .groupBy("category")
        .agg(F.sum("n").alias("n_rows"))
        .orderBy(order, "category")
    )


def imbalance(classes: DataFrame, split: str = "train") -> DataFrame:
    """Largest and smallest class and the ratio of their sizes; of equal
    classes the alphabetically first is named."""
    sizes = (
        classes.where((F.col("split") == split) & F.col("category").isNotNull())
        .groupBy("category")
        .agg(F.sum("n").alias("n_rows"))
    )
    return sizes.agg(
        F.min(F.struct((-F.col("n_rows")).alias("k"), "category"))["category"].alias("largest_class"),
        F.max("n_rows").alias("largest_count"),
        F.min(F.struct(F.col("n_rows").alias("k"), "category"))["category"].alias("smallest_class"),
        F.min("n_rows").alias("smallest_count"),
        (F.max("n_rows") / F.min("n_rows")).alias("imbalance_ratio"),
    )


def mean_length_by_class(lengths: DataFrame, split: str = "train") -> DataFrame:
    return (
        lengths.where((F.col("split") == split) & F.col("category").isNotNull())
        .groupBy("category")
        .agg(_mean_words().alias("avg_words"))
    )


def top_classes_by_length(
    lengths: DataFrame, top_n: int = 20, split: str = "train", ascending: bool = False
) -> DataFrame:
    """The ``top_n`` classes with the longest texts on average; ``ascending``
    only turns the display order round."""
    top = (
        mean_length_by_class(lengths, split)
        .orderBy(F.desc_nulls_last("avg_words"), "category")
        .limit(top_n)
    )
    return top.orderBy("avg_words", F.desc("category")) if ascending else top


def _per_length(lengths: DataFrame) -> DataFrame:
    # The filter stands on an aggregate: on the grouping column itself it would
    # be pushed to the texts, and words would be counted twice.
    return (
        lengths.groupBy("split", "n_words")
        .agg(F.sum("n").alias("n"), F.max("n_words").alias("known"))
        .where(F.col("known").isNotNull())
        .drop("known")
    )


def length_summary(lengths: DataFrame) -> DataFrame:
    """Mean, median, 95th percentile and maximum of the word count per split.

    The percentiles are exact and interpolated; they run over distinct
    lengths weighted by their frequency, not over rows.
    """
    return (
        _per_length(lengths)
        .groupBy("split")
        .agg(
            _mean_words().alias("mean_words"),
            F.percentile("n_words", 0.5, F.col("n")).alias("median_words"),
            F.percentile("n_words", 0.95, F.col("n")).alias("p95_words"),
            F.max("n_words").cast("long").alias("max_words"),
        )
    )


def length_histogram(lengths: DataFrame, bins: int = 40) -> DataFrame:
    """Equal-width histogram of the word count per split, empty bins included.

    Bin edges are numpy's floating-point ones, and a value belongs to the bin
    whose edges enclose it; the last bin includes its right edge. A constant
    column gets a range of plus and minus one half.
    """
    by_split = Window.partitionBy("split")
    low, high = F.min("n_words").over(by_split), F.max("n_words").over(by_split)
    half = F.when(low == high, F.lit(0.5)).otherwise(F.lit(0.0))
    ranged = _per_length(lengths).select(
        "split",
        "n",
        F.col("n_words").cast("double").alias("x"),
        (F.col("n_words") == low).alias("is_first"),
        (low - half).alias("lo"),
        (high + half).alias("hi"),
    )
    lo, hi, x = F.col("lo"), F.col("hi"), F.col("x")

    def edge(k: Column) -> Column:
        return F.when(k == bins, hi).otherwise(k * ((hi - lo) / F.lit(float(bins))) + lo)

    # A first guess by division, then moved to the bin whose edges enclose x.
    guess = F.least(F.floor((x - lo) / (hi - lo) * bins), F.lit(bins - 1))
    down = (x < edge(F.col("k"))).cast("long")
    up = ((x >= edge(F.col("k") + 1)) & (F.col("k") < bins - 1)).cast("long")
    placed = (
        ranged.withColumn("k", guess).withColumn("k", F.col("k") - down).withColumn("k", F.col("k") + up)
    )
    # The row of the smallest length also brings every bin with a count of 0.
    own = F.array(F.struct(F.col("k").alias("k"), F.col("n").alias("n")))
    empty = F.transform(
        F.sequence(F.lit(0).cast("long"), F.lit(bins - 1).cast("long")),
        lambda k: F.struct(k.alias("k"), F.lit(0).cast("long").alias("n")),
    )
    filled = F.when(F.col("is_first"), F.concat(own, empty)).otherwise(own)
    return (
        placed.select("split", "lo", "hi", F.inline(filled))
        .groupBy("split", "lo", "hi", "k")
        .agg(F.sum("n").alias("n_rows"))
        .select(
            "split",
            (F.col("k") + 1).alias("bin"),
            edge(F.col("k")).alias("bin_start"),
            edge(F.col("k") + 1).alias("bin_end"),
            "n_rows",
        )
    )
