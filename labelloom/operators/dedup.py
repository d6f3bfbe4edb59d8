"""Exact de-duplication that keeps the first row of each group of copies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelloom.functions.text import digest
from labelloom.storage import write_table

# A copied text costs about 50 bytes on each executor: digest, label and id.
MAX_BROADCAST_COPIED = 500_000


def first_ids(
    df: DataFrame, text_col: Column | str = "text", label_col: str = "label", id_col: str = "row_id"
) -> DataFrame:
    """``(digest, label, row_id, copies)``: the first row of each distinct
    (text, label).

    Only a digest, the label and the id are shuffled, and ``min`` and
    ``count`` combine before the shuffle, so a text holding a third of all
    rows leaves each map task as one row.
    """
    return (
        df.select(digest(text_col).alias("digest"), label_col, id_col)
        .groupBy("digest", label_col)
        .agg(F.min(id_col).alias(id_col), F.count(F.lit(1)).alias("copies"))
    )


def keep_first(
    df: DataFrame,
    firsts: DataFrame,
    text_col: Column | str = "text",
    label_col: str = "label",
    id_col: str = "row_id",
    max_broadcast: int = MAX_BROADCAST_COPIED,
    among: Column | None = None,
) -> DataFrame:
    """Rows of ``df`` that are listed in ``firsts``, its materialised first ids.
    With ``among``, only rows for which it holds are judged; the others stay.

    Rows have to be compared only with texts that occur more than once. While
    these are few, however many copies they have, they are broadcast and no
    text is shuffled. Beyond the bound it is a semi-join on the unique id,
    whose shuffle has no hot key.
    """
    copied = firsts.where("copies > 1").select(
        F.col("digest").alias("copied_digest"),
        F.col(label_col).alias("copied_label"),
        F.col(id_col).alias("first_id"),
    )
    others = F.lit(False) if among is None else ~among
    if copied.count() > max_broadcast:
        listed = firsts.select(id_col, F.lit(True).alias("is_first"))
        kept = df.join(listed, id_col, "left").where(others | F.col("is_first"))
        return kept.select(df.columns)
    same = F.col("own_digest").eqNullSafe(F.col("copied_digest")) & F.col(label_col).eqNullSafe(
        F.col("copied_label")
    )
    return (
        df.withColumn("own_digest", digest(text_col))
        .join(F.broadcast(copied), same, "left")
        .where(others | F.col("first_id").isNull() | (F.col("first_id") == F.col(id_col)))
        .select(df.columns)
    )


def deduplicate(
    df: DataFrame, text_col: Column | str = "text", label_col: str = "label", id_col: str = "row_id"
) -> DataFrame:
    """Rows of ``df`` without later exact duplicates of (text, label), in the
    order of the unique ``id_col``. ``text_col`` may be an expression, such as
    the cleaned text."""
    firsts = write_table(first_ids(df, text_col, label_col, id_col), "firsts")
    return keep_first(df, firsts, text_col, label_col, id_col)


def duplicate_count(
    df: DataFrame, text_col: Column | str = "text", label_col: str = "label", id_col: str = "row_id"
) -> DataFrame:
    """One row: rows before, rows after and rows removed."""
    return first_ids(df, text_col, label_col, id_col).agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("n_before"),
        F.count(F.lit(1)).alias("n_after"),
        F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("n_removed"),
    )
