"""Checks that a table is fit for the next step.

Every check comes as a table of offenders and, where the job has to stop, as
a ``require_*`` function that raises. The message names every offender; if
there are very many, it gives their number, the first ones, and where the whole
table lies.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from labelloom.functions.text import compare_key
from labelloom.storage import lasting_path

SHOWN_IN_ERRORS = 200


class MissingColumnError(ValueError):
    pass


class UnknownLabelError(ValueError):
    pass


class MissingLabelError(RuntimeError):
    pass


class NullTextError(ValueError):
    pass


def _offenders(bad: DataFrame) -> tuple[list[Row], str]:
    """The rows of ``bad`` to name, and what to say of the others."""
    rows = bad.take(SHOWN_IN_ERRORS + 1)
    if len(rows) <= SHOWN_IN_ERRORS:
        return rows, ""
    path = lasting_path(bad.sparkSession, "offenders")  # read after the job has failed
    bad.write.parquet(path)
    total = bad.sparkSession.read.parquet(path).count()
    return rows[:SHOWN_IN_ERRORS], f" and others, {total} in all; the whole list: {path}"


def require_columns(df: DataFrame, columns: Sequence[str], split: str) -> DataFrame:
    """Schema check only; runs no job."""
    for name in columns:
        if name not in df.columns:
            raise MissingColumnError(f"{split}: column {name!r} is required")
    return df


def unknown_labels(df: DataFrame, dim: DataFrame) -> DataFrame:
    """Distinct ``(split, category)`` outside the vocabulary; a null category
    counts as unknown. The distinct runs before the join, so the join sees at
    most one row per split and category."""
    return df.select("split", "category").distinct().join(dim, "category", "left_anti").select(
        "split", "category"
    )


def missing_labels(
    df: DataFrame, dim: DataFrame, splits: Iterable[str], by: str = "label"
) -> DataFrame:
    """``(split, label)`` of the vocabulary that do not occur in the split;
    ``by="category"`` compares names in place of ids."""
    wanted = dim.select(F.explode(F.lit(list(splits))).alias("split"), by)
    present = df.select("split", by).distinct()
    return wanted.join(present, ["split", by], "left_anti")


def label_coverage(
    df: DataFrame, dim: DataFrame, full_splits: Sequence[str] = ("train",)
) -> DataFrame:
    """Vocabulary against data in both directions: names absent from a split
    that has to hold them all, and names of any split outside the vocabulary."""
    absent = missing_labels(df, dim, full_splits, by="category").select(
        "split", F.lit("absent").alias("problem"), "category"
    )
    unknown = unknown_labels(df, dim).select(
        "split", F.lit("unknown").alias("problem"), "category"
    )
    return absent.unionByName(unknown)


def text_problems(df: DataFrame, text_col: str = "text") -> DataFrame:
    """Null and blank texts per split."""
    return df.groupBy("split").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col(text_col).isNull()).alias("null_texts"),
        F.count_if(F.length(compare_key(text_col)) == 0).alias("empty_texts"),
    )


def category_summary(df: DataFrame, text_col: str = "text") -> DataFrame:
    """Rows and null texts per split and category. Every ``require_*`` check on
    categories and texts can read this table in place of the rows."""
    return df.groupBy("split", "category").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col(text_col).isNull()).alias("null_texts"),
    )


def require_known_labels(df: DataFrame, dim: DataFrame) -> DataFrame:
    bad, more = _offenders(unknown_labels(df, dim).orderBy("split", "category"))
    if bad:
        names: dict[str, list] = {}
        for row in bad:
            names.setdefault(row["split"], []).append(row["category"])
        text = "; ".join(f"{s}: {v}" for s, v in names.items())
        raise UnknownLabelError(f"categories outside the vocabulary: {text}{more}")
    return df


def require_coverage(
    df: DataFrame, dim: DataFrame, full_splits: Sequence[str] = ("train",)
) -> DataFrame:
    bad, more = _offenders(label_coverage(df, dim, full_splits))
    if bad:
        raise MissingLabelError(f"labels do not match the vocabulary: {[tuple(r) for r in bad]}{more}")
    return df


def require_all_labels(df: DataFrame, dim: DataFrame, splits: Sequence[str]) -> DataFrame:
    bad, more = _offenders(missing_labels(df, dim, splits).orderBy("split", "label"))
    if bad:
        ids: dict[str, list] = {}
        for row in bad:
            ids.setdefault(row["split"], []).append(row["label"])
        text = "; ".join(f"{s}: {v}" for s, v in ids.items())
        raise MissingLabelError(
            f"labels without a row: {text}{more}; a smaller val_size or keeping duplicates may help"
        )
    return df


def require_text(summary: DataFrame) -> DataFrame:
    """Takes a category summary."""
    nulls = summary.groupBy("split").agg(F.sum("null_texts").alias("n"))
    rows, more = _offenders(nulls.where("n > 0"))
    bad = {r["split"]: r["n"] for r in rows}
    if bad:
        raise NullTextError(f"null texts per split: {bad}{more}")
    return summary
