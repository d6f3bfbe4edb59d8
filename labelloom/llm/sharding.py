"""Sharding by sampled splitters.

Rows are ordered by a key. A size-weighted sample of the keys gives quantile
boundaries, the splitters, which cut the rows into many ranges of about equal
bytes. Ranges whose exact size turns out too large are subdivided by further
splitters from a sample of their own, down to single rows. Shards are
consecutive ranges; the range in which a boundary between shards falls is cut
at the group of equal keys whose middle passes it.

All of this runs on narrow rows (key, size). Splitters are bounded by the
parameters and the row count over ``rows_per_range``; no task sorts more than
one range.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from labelloom.llm.common import unit_hash
from labelloom.operators.sizing import broadcast_if_small
from labelloom.storage import write_table

RANGES_PER_SHARD = 64
ROWS_PER_RANGE = 1_000_000
SAMPLES_PER_RANGE = 64
OVERFULL = 1.5
MAX_ROUNDS = 40
LOWEST = -(1 << 63)

Splitter = tuple[int, int, int]


def text_size(text: Column | str) -> Column:
    """UTF-8 bytes plus one; a null text has none."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


def quantile_keys(keys: np.ndarray, weights: np.ndarray, parts: int) -> list[int]:
    """Positions in the sorted ``keys`` at which ``parts`` parts of equal weight begin."""
    total = np.cumsum(weights, dtype=np.float64)
    wanted = np.arange(1, parts) * (total[-1] / parts)
    return sorted({int(i) for i in np.searchsorted(total, wanted, side="left")})


def range_of(splitters: Sequence[Splitter]) -> Column:
    """The number of splitters at or below a row's key."""
    bounds = list(splitters)

    def place(group: pd.Series, tie: pd.Series, uid: pd.Series) -> pd.Series:
        return pd.Series([bisect_right(bounds, k) for k in zip(group, tie, uid, strict=True)], dtype="int32")

    # Found once a row: a filter on it would have it found again by a second worker
    # of the task, and executors keep as many workers as were ever busy at once.
    found = F.pandas_udf(place, "int").asNondeterministic()
    return found(F.col("group_key"), F.col("tie_key"), F.col("uid"))


def find_splitters(
    keyed: DataFrame, rows: int, total: int, parts: int, samples_per_range: int, seed: int
) -> list[Splitter]:
    """Splitters for about ``parts`` ranges of equal size over ``keyed``, a
    materialised table of ``(group_key, tie_key, uid, size)``.

    First boundaries fall between groups of equal ``group_key``; an overfull
    range, such as one that holds a hot key, is cut between its rows.
    """
    chance = F.col("size") * F.lit(samples_per_range * parts / total)
    drawn = keyed.where(unit_hash("group_key", "tie_key", "uid", seed=seed) < chance).select(
        "group_key", "size"
    )
    sample = drawn.toPandas().sort_values("group_key")
    splitters: list[Splitter] = []
    if len(sample):
        sizes = sample["size"].to_numpy(dtype=np.float64)
        weights = np.maximum(sizes, total / (samples_per_range * parts))
        keys = sample["group_key"].to_numpy()
        splitters = sorted({(int(keys[i]), LOWEST, LOWEST) for i in quantile_keys(keys, weights, parts)})
    mean = total / parts
    for number in range(1, MAX_ROUNDS + 1):
        own_range = range_of(splitters)
        full = (
            keyed.withColumn("range", own_range)
            .groupBy("range")
            .agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n"))
            .where((F.col("bytes") > OVERFULL * mean) & (F.col("n") > 1))
            .collect()
        )
        if not full:
            break
        wanted = {r["range"]: max(2, round(r["bytes"] / mean)) for r in full}
        rate = F.lit(samples_per_range * number / mean)
        again = unit_hash("group_key", "tie_key", "uid", seed=seed + number) < F.col("size") * rate
        part = keyed.where(again).withColumn("range", own_range)
        drawn = part.where(F.col("range").isin(list(wanted))).toPandas()
        # All their rows, with their own sizes for weights: later rounds draw the same.
        floor = mean / (samples_per_range * number)
        settled = len(drawn) == sum(r["n"] for r in full) and drawn["size"].min() >= floor
        more = set()
        for name, rowset in drawn.groupby("range"):
            rowset = rowset.sort_values(["group_key", "tie_key", "uid"])
            weights = np.maximum(rowset["size"].to_numpy(dtype=np.float64), floor)
            for i in quantile_keys(rowset["uid"].to_numpy(), weights, wanted[name]):
                more.add(tuple(int(rowset[c].iloc[i]) for c in ("group_key", "tie_key", "uid")))
        if settled and more <= set(splitters):
            break
        splitters = sorted(set(splitters) | more)
    return splitters


def assign_shards(
    df: DataFrame,
    n_shards: int,
    group_key: Column,
    tie_key: Column,
    size: Column,
    keep: Sequence[str] = (),
    ranges_per_shard: int = RANGES_PER_SHARD,
    rows_per_range: int = ROWS_PER_RANGE,
    samples_per_range: int = SAMPLES_PER_RANGE,
    seed: int = 42,
) -> DataFrame:
    """Every row of ``df`` as ``(*keep, group_key, tie_key, size, shard, slot)``.

    Shards hold near equal sizes. Rows with one ``group_key`` stay together
    unless they fill more than a range (one ``ranges_per_shard``-th of a
    shard), in which case they are cut where the sizes ask for it. ``slot``
    counts a shard's rows from 0 in key order. Keys must not be null; sizes
    must be positive. Equal rows are told apart by their place in the
    materialised key table. An empty ``df`` gives an empty result.
    """
    keyed = write_table(
        df.select(
            *keep,
            group_key.cast("long").alias("group_key"),
            tie_key.cast("long").alias("tie_key"),
            size.cast("long").alias("size"),
            F.monotonically_increasing_id().alias("uid"),
        ),
        "shard_keys",
    )
    rows, total = keyed.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()
    parts = max(n_shards * ranges_per_shard, -(-rows // rows_per_range))
    splitters = find_splitters(keyed, rows, total, parts, samples_per_range, seed) if rows else []
    ranged = keyed.withColumn("range", range_of(splitters))

    # One row per range.
    sizes = ranged.groupBy("range").agg(F.sum("size").alias("bytes"))
    earlier = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("range", F.coalesce(F.sum("bytes").over(earlier), F.lit(0)).alias("range_start"))

    in_range = Window.partitionBy("range").orderBy("group_key", "tie_key", "uid")
    group = Window.partitionBy("range", "group_key")
    upto = F.sum("size").over(in_range.rowsBetween(Window.unboundedPreceding, 0))
    middle = F.col("range_start") + F.min(F.col("upto") - F.col("size")).over(group) + F.sum("size").over(group) / 2
    shard = F.least(F.lit(n_shards - 1), F.floor(middle * n_shards / max(1, total))).cast("int")
    in_shard = Window.partitionBy("range", "shard").orderBy("group_key", "tie_key", "uid")
    placed = write_table(
        ranged.join(broadcast_if_small(starts), "range")
        .withColumn("upto", upto)
        .withColumn("shard", shard)
        .withColumn("place", F.row_number().over(in_shard))
        .drop("upto", "range_start", "uid"),
        "shard_places",
    )
    counts = placed.groupBy("shard", "range").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    return placed.join(broadcast_if_small(offsets), ["shard", "range"]).select(
        *keep,
        "group_key",
        "tie_key",
        "size",
        "shard",
        (F.col("before") + F.col("place") - 1).cast("long").alias("slot"),
    )


def shard_documents(docs: DataFrame, n_shards: int, **options: int) -> DataFrame:
    """``(doc_id, text_crc32, size, shard, slot)`` for every document.

    The key is a hash of the text, then the id: equal texts lie side by side.
    A null text has size 1, no checksum and a group of its own with the other
    null texts; a null id sorts first.
    """
    rows = docs.select(
        "doc_id",
        F.crc32(F.col("text").cast("binary")).cast("long").alias("text_crc32"),
        F.xxhash64("text").alias("text_hash"),
        text_size("text").alias("bytes"),
    )
    placed = assign_shards(
        rows,
        n_shards,
        F.col("text_hash"),
        F.coalesce(F.col("doc_id"), F.lit(LOWEST)),
        F.col("bytes"),
        keep=("doc_id", "text_crc32"),
        **options,
    )
    return placed.select("doc_id", "text_crc32", "size", "shard", "slot")


def shard_stream(docs: DataFrame, narrow: DataFrame, whole: DataFrame, n_shards: int, place: str = "position") -> DataFrame:
    """``docs`` with ``size``, ``shard`` and ``slot``, where the key is a place in
    a stream: shards are consecutive stretches of it of near equal bytes.

    ``narrow`` holds ``(place, size)`` of all rows, ``whole`` the rows of
    ``docs`` with their ``place``, which counts from 0 without gaps. Where the
    stretches begin is worked out on the narrow rows; the texts aren't moved
    for it. A shard that gets no row is left out.
    """
    shards = assign_shards(narrow, n_shards, F.col(place), F.lit(0), F.col("size"))
    # One row per shard.
    begins = sorted(r["b"] for r in shards.groupBy("shard").agg(F.min("group_key").alias("b")).collect())
    names = sorted(r["shard"] for r in shards.select("shard").distinct().collect())
    shard, begin = F.lit(None).cast("int"), F.lit(None).cast("long")
    for name, b in zip(names, begins, strict=True):
        shard = F.when(F.col(place) >= b, F.lit(name)).otherwise(shard)
        begin = F.when(F.col(place) >= b, F.lit(b).cast("long")).otherwise(begin)
    kept = [c for c in docs.columns if c not in ("size", "shard", "slot")]
    return whole.select(*kept, text_size("text").alias("size"), shard.alias("shard"), (F.col(place) - begin).alias("slot"))


def write_shards(docs: DataFrame, placed: DataFrame, path: str, id_col: str = "doc_id") -> None:
    """Write ``docs`` as one folder per shard, rows in slot order within files.
    ``placed`` holds ``(id_col, shard, slot)`` of unique ids; each shard is
    written by as many tasks as the range partitioning gives it."""
    (
        docs.join(placed.select(id_col, "shard", "slot"), id_col)
        .repartitionByRange("shard", "slot")
        .sortWithinPartitions("shard", "slot")
        .write.partitionBy("shard")
        .parquet(path)
    )
