"""Clean, de-duplicate, split, check and save."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelloom.functions.labels import DEFAULT_LABELS, label_dim
from labelloom.functions.text import clean_text
from labelloom.operators.dedup import first_ids, keep_first
from labelloom.operators.guards import require_all_labels
from labelloom.operators.splitting import assign_split, validation_cutoffs
from labelloom.schema import SPLITS
from labelloom.sources.writers import write_label_map, write_splits
from labelloom.storage import cut_lineage, write_table


@dataclass(frozen=True)
class Preprocessed:
    splits: DataFrame  # row_id, text, category, label, split
    summary: DataFrame  # one row per split
    removed: int  # exact duplicates taken out of train


def preprocess(
    pair: DataFrame,
    val_size: float = 0.1,
    seed: int = 42,
    out_dir: str | None = None,
    dedupe: bool = True,
    labels: Sequence[str] = DEFAULT_LABELS,
    fmt: str = "parquet",
    layout: str | None = None,
) -> Preprocessed:
    """From ``(row_id, text, category, label, split)`` with train and test rows
    to train, validation and test.

    Duplicates are taken out of train only, after cleaning; test rows stay as
    they are. Which row goes where is decided on ids and digests alone; that
    narrow table is materialised once. The pass that writes the texts drops
    copies against a broadcast of the copied texts and compares each row with
    its class's cutoff, so it shuffles no text unless the copied texts are too
    many to broadcast.
    """
    spark = pair.sparkSession
    dim = label_dim(spark, labels)
    cleaned = pair.withColumn("text", clean_text("text"))
    train = cleaned.where(F.col("split") == "train").drop("split")
    test = cleaned.where(F.col("split") == "test")
    every = cleaned

    removed = 0
    kept = train.select("row_id", "label")
    if dedupe:
        firsts = write_table(first_ids(train), "firsts")
        removed = firsts.agg(F.coalesce(F.sum(F.col("copies") - 1), F.lit(0))).first()[0]
        kept = firsts.select("row_id", "label")
        every = keep_first(every, firsts, among=F.col("split") == "train")
    cutoffs = validation_cutoffs(kept, val_size, seed)
    assigned = assign_split(kept, cutoffs, seed)

    # Counts per split and class come from the narrow table and the test labels.
    sizes = cut_lineage(
        assigned.select("split", "label")
        .unionByName(test.select("split", "label"))
        .groupBy("split", "label")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    require_all_labels(sizes, dim, SPLITS)
    summary = sizes.groupBy("split").agg(
        F.sum("n").alias("n_rows"),
        F.count("label").alias("n_labels"),
        F.min("n").alias("min_per_class"),
        F.max("n").alias("max_per_class"),
    )

    # Train and test rows go through one branch, so the texts are scanned once.
    is_test = F.col("given") == "test"
    assigned = assign_split(every.withColumnRenamed("split", "given"), cutoffs, seed)
    splits = assigned.withColumn("split", F.when(is_test, "test").otherwise(F.col("split"))).select(
        "row_id", "text", "category", "label", "split"
    )

    if out_dir is not None:
        write_splits(splits, out_dir, fmt, layout)
        write_label_map(dim, f"{out_dir.rstrip('/')}/label_mapping.json")
    return Preprocessed(splits, summary, removed)


