"""First-N rows without a global sort."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def nth_smallest(df: DataFrame, n: int, id_col: str = "row_id") -> int | None:
    """The ``n``-th smallest value of a unique column, or None if there are no
    more than ``n`` rows: the engine's top-k over the ids alone."""
    if n < 1:
        raise ValueError("n must be at least 1")
    ids = df.select(id_col).where(F.col(id_col).isNotNull())
    last = ids.orderBy(id_col).offset(n - 1).limit(2).collect()
    return None if len(last) < 2 else last[0][0]


def first_rows(df: DataFrame, n: int | None, id_col: str = "row_id") -> DataFrame:
    """The first ``n`` rows in id order; everything if ``n`` is None or not
    below the row count. The result is a filter on the id: it is pushed into the
    scan, and moves no row."""
    if n is None:
        return df
    if n == 0:
        return df.limit(0)
    cutoff = nth_smallest(df, n, id_col)
    return df if cutoff is None else df.where(F.col(id_col) <= F.lit(cutoff))


def preview(df: DataFrame, n: int = 5, id_col: str = "row_id") -> DataFrame:
    """A handful of first rows to look at (top-k, no full sort)."""
    return df.orderBy(id_col).limit(n)
