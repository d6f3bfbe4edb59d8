"""Reading the tables and small column helpers shared by the operators."""

from __future__ import annotations

import ctypes
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU C library

DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc_remainder(id_col: str, parts: int) -> Column:
    """``crc32(id as text) mod parts``; a null id counts as an empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % F.lit(parts)


def unit_hash(*cols: Column | str, seed: int = 0) -> Column:
    """A reproducible number in [0, 1) for a row."""
    return F.pmod(F.xxhash64(F.lit(seed), *cols), F.lit(1 << 40)) / F.lit(float(1 << 40))


def bounded_sample(df: DataFrame, rows: int, bound: int, *key: str, seed: int = 42) -> DataFrame:
    """``bound`` of the ``rows`` rows of ``df`` (all, if fewer), the first by a hash
    of ``key``, then by ``key``: the same for every layout of ``df``."""
    chance = unit_hash(*key, seed=seed)
    # Nearly always enough for ``bound``, so that few rows are sorted.
    share = min(1.0, (bound + 6 * bound**0.5 + 20) / max(1, rows))
    return df.where(chance < share).orderBy(chance, *key).limit(bound)


def most_frequent(df: DataFrame, count_col: str, bound: int) -> DataFrame:
    """The rows with the largest counts, as many as fit ``bound`` without parting
    rows of equal counts. A threshold on the count, found from a histogram of
    the counts: no sort, and no more than ``bound`` rows."""
    total = 0
    histogram = df.groupBy(F.col(count_col).alias("c")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("c"))
    least = None
    for row in histogram.toLocalIterator():
        total += row["n"]
        if total > bound:
            break
        least = row["c"]
    return df.where(F.col(count_col) >= F.lit(least)) if least is not None else df.limit(0)


def release_memory() -> None:
    """Give what the allocators hold free back to the system, where they can."""
    pa.default_memory_pool().release_unused()
    if _trim is not None:
        _trim(0)


def slices(frames: Iterable[pd.DataFrame], column: str, chars: int = 4_000_000) -> Iterator[pd.DataFrame]:
    """Arrow batches cut so that a piece holds about ``chars`` characters of
    ``column``, however long its texts are; a single text is never cut. After
    each batch, memory that is free goes back to the system: workers live on
    from stage to stage, and would keep the most that they have ever used."""
    for frame in frames:
        sizes = np.cumsum([len(t) if t else 0 for t in frame[column]])
        start = 0
        while start < len(frame):
            before = sizes[start - 1] if start else 0
            stop = max(start + 1, int(sizes.searchsorted(before + chars, side="right")))
            yield frame.iloc[start:stop]
            start = stop
        release_memory()


def text_slices(texts: pa.Array, chars: int) -> Iterator[list[str | None]]:
    """The same cuts for an Arrow column of texts, which become Python's strings
    a slice at a time."""
    sizes = np.cumsum(pc.fill_null(pc.utf8_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    start = 0
    while start < len(texts):
        before = sizes[start - 1] if start else 0
        stop = max(start + 1, int(sizes.searchsorted(before + chars, side="right")))
        yield texts.slice(start, stop - start).to_pylist()
        start = stop
