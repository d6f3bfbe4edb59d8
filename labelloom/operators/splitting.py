"""Exact stratified train/validation split."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from labelloom.operators.sizing import broadcast_if_small, broadcast_rows
from labelloom.storage import cut_lineage

HASH_DIGITS = 4  # 65,536 buckets per label


def order_hash(seed: int, id_col: str = "row_id") -> Column:
    """The seeded pseudo-random order of rows: an md5, equal on every engine."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")))


def class_quotas(counts: DataFrame, n_rows: int, n_val: int, label_col: str = "label") -> DataFrame:
    """Validation rows per class, by largest remainder of the training share.

    ``counts`` holds ``(label, n)``. Remainders are compared as integers, in
    38-digit decimals so that the product of two row counts cannot overflow;
    ties go to the smaller label.
    """
    n_train = n_rows - n_val
    exact = F.col("n").cast("decimal(19,0)") * F.lit(n_train).cast("decimal(19,0)")
    total = F.lit(n_rows).cast("decimal(19,0)")
    shares = counts.select(
        label_col, "n", exact.alias("exact"), total.alias("total")
    ).select(
        label_col,
        "n",
        F.expr("exact div total").alias("base"),
        F.expr("exact % total").alias("remainder"),
    )
    # One row per class, so windows over the whole table are small.
    rank = F.row_number().over(Window.orderBy(F.desc("remainder"), label_col))
    spare = F.lit(n_train) - F.sum("base").over(Window.partitionBy())
    return shares.select(
        label_col,
        "n",
        (F.col("n") - F.col("base") - (rank <= spare).cast("long")).alias("n_val"),
    )


def validation_cutoffs(
    df: DataFrame,
    val_size: float,
    seed: int = 42,
    label_col: str = "label",
    id_col: str = "row_id",
) -> DataFrame:
    """``(label, n, n_val, cut_hash, cut_id)``: the last validation row of
    each class in hash order.

    Rows are counted per label and leading hash digits; only the rows of the
    one bucket per label in which the quota runs out are ranked. No class is
    sorted as a whole, so a class with a third of all rows is no hot spot.
    ``df`` is read twice here and once more by ``assign_split``, labels and ids
    only; materialise it first if it is costly to compute.
    """
    if not 0.0 < val_size < 1.0:
        raise ValueError("val_size must lie strictly between 0 and 1")
    hashed = df.select(label_col, id_col, order_hash(seed, id_col).alias("h")).withColumn(
        "bucket", F.substring("h", 1, HASH_DIGITS)
    )
    counts = hashed.groupBy(label_col, "bucket").count().persist()
    classes = counts.groupBy(label_col).agg(F.sum("count").alias("n"))
    n_rows, smallest, n_classes, nulls = classes.agg(
        F.coalesce(F.sum("n"), F.lit(0)),
        F.min("n"),
        F.count(F.lit(1)),
        F.count_if(F.col(label_col).isNull()),
    ).first()
    n_val = math.ceil(val_size * n_rows)
    if nulls:
        raise ValueError("cannot stratify on null labels")
    if n_rows == 0 or smallest < 2:
        raise ValueError("every class needs at least 2 rows to be split")
    if n_val < n_classes or n_rows - n_val < n_classes:
        raise ValueError(
            f"{n_rows - n_val} training and {n_val} validation rows cannot cover "
            f"{n_classes} classes"
        )
    quotas = class_quotas(classes, n_rows, n_val, label_col)
    running = F.sum("count").over(
        Window.partitionBy(label_col).orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    )
    edges = (
        counts.withColumn("upto", running)
        .join(broadcast_rows(quotas, n_classes), label_col)
        .where((F.col("upto") >= F.col("n_val")) & (F.col("upto") - F.col("count") < F.col("n_val")))
        .select(
            label_col,
            "bucket",
            (F.col("n_val") - F.col("upto") + F.col("count")).alias("need"),
        )
    )
    in_edge = hashed.join(broadcast_rows(edges, n_classes), [label_col, "bucket"])
    place = F.row_number().over(Window.partitionBy(label_col).orderBy("h", id_col))
    cuts = (
        in_edge.withColumn("place", place)
        .where(F.col("place") == F.col("need"))
        .select(label_col, F.col("h").alias("cut_hash"), F.col(id_col).alias("cut_id"))
    )
    # A class whose quota is 0 has no last validation row; keep it with nulls.
    # One row per class in all three tables.
    cutoffs = cut_lineage(quotas.join(broadcast_rows(cuts, n_classes), label_col, "left"))
    counts.unpersist()
    return cutoffs


def assign_split(
    df: DataFrame,
    cutoffs: DataFrame,
    seed: int = 42,
    label_col: str = "label",
    id_col: str = "row_id",
) -> DataFrame:
    """Add ``split``: a row up to its class's cutoff is validation, the others
    train. A join with one row per class and a comparison; rows do not move
    while the classes fit a broadcast."""
    h = order_hash(seed, id_col)
    is_val = (h < F.col("cut_hash")) | ((h == F.col("cut_hash")) & (F.col(id_col) <= F.col("cut_id")))
    side = broadcast_if_small(cutoffs.select(label_col, "cut_hash", "cut_id"))
    return (
        df.join(side, label_col, "left")
        .withColumn("split", F.when(is_val, "validation").otherwise("train"))
        .drop("cut_hash", "cut_id")
    )


def stratified_split(
    df: DataFrame,
    val_size: float = 0.1,
    seed: int = 42,
    label_col: str = "label",
    id_col: str = "row_id",
) -> DataFrame:
    """``df`` with a ``split`` column of exact stratified sizes."""
    cutoffs = validation_cutoffs(df, val_size, seed, label_col, id_col)
    return assign_split(df, cutoffs, seed, label_col, id_col)


def split_summary(df: DataFrame, label_col: str = "label") -> DataFrame:
    """Rows, labels, smallest and largest class of each split."""
    return (
        df.groupBy("split", label_col)
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("split")
        .agg(
            F.sum("n").alias("n_rows"),
            F.count(label_col).alias("n_labels"),
            F.min("n").alias("min_per_class"),
            F.max("n").alias("max_per_class"),
        )
    )
