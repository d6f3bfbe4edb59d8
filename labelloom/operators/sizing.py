"""Broadcasting behind a size check."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_BROADCAST_ROWS = 100_000
MAX_BROADCAST_BYTES = 64 * 1024 * 1024


def broadcast_rows(df: DataFrame, rows: int, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast for a table of narrow rows whose count is known."""
    return F.broadcast(df) if rows <= max_rows else df


def broadcast_if_small(
    df: DataFrame,
    max_rows: int = MAX_BROADCAST_ROWS,
    max_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """Hint a broadcast if ``df`` is shown to be small; otherwise return it as
    it is, and the join becomes a shuffle join whose hot keys AQE splits.

    Meant for tables of one row per class: the check reads at most
    ``max_rows + 1`` rows.
    """
    text_bytes = [F.octet_length(c) for c, kind in df.dtypes if kind in ("string", "binary")]
    width = F.lit(16 * len(df.columns))
    for size in text_bytes:
        width = width + F.coalesce(size, F.lit(0))
    rows, total = (
        df.limit(max_rows + 1).agg(F.count(F.lit(1)), F.coalesce(F.sum(width), F.lit(0))).first()
    )
    return F.broadcast(df) if rows <= max_rows and total <= max_bytes else df


def most_frequent_rows(df: DataFrame, count_col: str, bound: int) -> DataFrame:
    """The rows with the largest counts, at most ``bound`` of them and all of an
    equal count or none: a threshold found from a histogram of the counts."""
    histogram = df.groupBy(F.col(count_col).alias("c")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("c"))
    total, least = 0, None
    for row in histogram.toLocalIterator():
        total += row["n"]
        if total > bound:
            break
        least = row["c"]
    return df.limit(0) if least is None else df.where(F.col(count_col) >= least)


def collect_longs(df: DataFrame, *columns: str) -> dict[str, np.ndarray]:
    """Columns of longs without nulls as arrays on the driver, for tables of a
    bounded number of rows: they travel as bytes, eight a value."""

    def pack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame({c: [frame[c].to_numpy(np.int64).tobytes()] for c in columns})

    rows = df.select(*[F.col(c).cast("long").alias(c) for c in columns]).mapInPandas(pack, ", ".join(f"{c} binary" for c in columns)).collect()
    return {c: np.concatenate([np.zeros(0, np.int64), *[np.frombuffer(r[c], np.int64) for r in rows]]) for c in columns}
