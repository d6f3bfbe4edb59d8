"""Semantic cache: the nearest entry above a threshold, by sign-hash buckets.

A table is a set of random directions at right angles to each other; the signs
of a vector along them are its bucket. Two vectors at an angle differ in a sign
with a probability of angle / pi, so a query looks into all buckets that differ
from its own in at most ``FLIPS`` signs, in as many tables as the threshold
needs for the recall that is asked for. Entries lie in one bucket a table.

What meets in a bucket is scored exactly, in blocks of both sides, and a block
gives back the best entry of each query: no pairs are written, and a bucket
that holds a third of all entries is as many blocks as it needs.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelloom.operators.sizing import broadcast_if_small
from labelloom.storage import write_table

FLIPS = 2
BUCKET_ROWS = 128  # entries meant to lie in a bucket
MAX_BITS = 30
ENTRIES_AT_ONCE, QUERIES_AT_ONCE = 4_096, 1_024


@dataclass(frozen=True)
class Buckets:
    """``planes[t]`` is ``(bits, dimension)``; ``masks`` are the signs flipped."""

    planes: np.ndarray
    masks: list[int]

    def numbers(self, vectors: np.ndarray) -> np.ndarray:
        """``(tables, rows)``: each vector's bucket in each table."""
        tables, bits, _ = self.planes.shape
        signs = np.einsum("tbd,nd->tnb", self.planes, vectors) > 0 if bits else np.zeros((tables, len(vectors), 0), bool)
        return (signs * (1 << np.arange(bits, dtype=np.int64))).sum(axis=2).astype(np.int64)


def chance_to_meet(bits: int, cosine: float, flips: int = FLIPS) -> float:
    """That two vectors of this cosine differ in at most ``flips`` of ``bits`` signs."""
    differ = math.acos(max(-1.0, min(1.0, cosine))) / math.pi
    return sum(math.comb(bits, k) * differ**k * (1 - differ) ** (bits - k) for k in range(min(bits, flips) + 1))


def plan_buckets(entries: int, dimension: int, threshold: float, recall: float, seed: int = 42) -> Buckets:
    """Bits from the number of entries, tables from threshold and recall. Few
    entries make few bits, all of whose buckets a query looks into."""
    bits = min(MAX_BITS, dimension, max(0, int(math.log2(max(1, entries) / BUCKET_ROWS)) if entries > BUCKET_ROWS else 0))
    met = chance_to_meet(bits, threshold)
    tables = 1 if met > 1 - 1e-12 else max(1, math.ceil(math.log(1 - recall) / math.log(1 - met)))
    rng = np.random.default_rng(seed)
    planes = np.stack([np.linalg.qr(rng.normal(size=(dimension, max(1, bits))))[0].T[:bits] for _ in range(tables)])
    masks = [sum(1 << b for b in range(bits) if m >> b & 1) for m in _few_ones(bits)]
    return Buckets(planes, masks)


def _few_ones(bits: int) -> list[int]:
    ones = [1 << b for b in range(bits)]
    return [0, *ones, *[a | b for i, a in enumerate(ones) for b in ones[i + 1 :]]]


def _placed(rows: DataFrame, buckets: Buckets, probing: bool) -> DataFrame:
    """``(t, bucket, id, vector)`` for every bucket a row lies in or looks into."""
    shared = rows.sparkSession.sparkContext.broadcast(buckets)

    def number(part: pd.Series) -> pd.Series:
        known = shared.value
        return pd.Series(list(known.numbers(np.stack(part.to_list()).astype(np.float64)).T))

    own = F.pandas_udf(number, "array<long>")(F.col("vector"))
    numbered = rows.withColumn("own", own).select("id", "vector", F.posexplode("own").alias("t", "bucket"))
    if not probing:
        return numbered
    masks = F.array(*[F.lit(m).cast("long") for m in buckets.masks])
    probed = F.transform(masks, lambda m: F.col("bucket").bitwiseXOR(m))
    return numbered.withColumn("bucket", F.explode(probed))


def _best_in_block(threshold: float):
    def best(frame: pd.DataFrame) -> pd.DataFrame:
        asked, held = frame[frame["query"]], frame[~frame["query"]]
        empty = pd.DataFrame({"query_id": [], "vec_id": [], "cosine": []})
        if not len(asked) or not len(held):
            return empty
        q = np.stack(asked["vector"].to_list()).astype(np.float64)
        x = np.stack(held["vector"].to_list()).astype(np.float64)
        x_ids = held["id"].to_numpy()
        order = np.argsort(x_ids, kind="stable")
        x, x_ids = x[order], x_ids[order]
        scores = q @ x.T / (np.linalg.norm(q, axis=1)[:, None] * np.linalg.norm(x, axis=1)[None, :])
        q_ids = asked["id"].to_numpy()
        scores[q_ids[:, None] == x_ids[None, :]] = -np.inf
        at = scores.argmax(axis=1)
        top = scores[np.arange(len(q)), at]
        keep = top >= threshold - 1e-9
        return pd.DataFrame({"query_id": q_ids[keep], "vec_id": x_ids[at[keep]], "cosine": top[keep]})

    return best


def usable(vector: Column, dimension: int) -> Column:
    """Of the right length, finite, and not zero."""
    finite = ~F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return (F.size(vector) == dimension) & finite & F.exists(vector, lambda x: x != 0)


def cache_lookup(
    entries: DataFrame,
    is_query: Column,
    threshold: float,
    recall: float = 0.95,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    seed: int = 42,
) -> DataFrame:
    """``(query_id, vec_id, cosine)``: for every query that has one, the most
    similar other entry with a cosine of ``threshold`` or more; ties go to the
    smaller id.

    ``is_query`` tells which rows ask; all rows can answer, but not themselves.
    A query whose best entry just reaches the threshold finds it with the
    probability ``recall``, one with a nearer entry with a larger. Vectors that
    are null, zero, not finite or of another length than most take no part,
    neither do rows with a null id.
    """
    vector = F.col(vector_col)
    known = entries.where(F.col(id_col).isNotNull() & vector.isNotNull())
    # One row per length.
    sizes = known.groupBy(F.size(vector).alias("d")).agg(F.count(F.lit(1)).alias("n"))
    most = sizes.orderBy(F.desc("n"), F.desc("d")).first()
    id_type = entries.schema[id_col].dataType.simpleString()
    schema = f"query_id {id_type}, vec_id {id_type}, cosine double"
    if most is None or most["d"] == 0:
        return entries.sparkSession.createDataFrame([], schema)
    rows = known.where(usable(vector, most["d"])).select(F.col(id_col).alias("id"), vector.alias("vector"), is_query.alias("asks"))
    buckets = plan_buckets(most["n"], most["d"], threshold, recall, seed)
    held = _placed(rows.select("id", "vector"), buckets, False)
    asked = _placed(rows.where("asks").select("id", "vector"), buckets, True)
    both = write_table(
        held.withColumn("query", F.lit(False)).unionByName(asked.withColumn("query", F.lit(True))), "cache_buckets"
    )
    # A row per bucket that both sides are in: into how many blocks it is cut.
    counts = both.groupBy("t", "bucket").agg(
        F.ceil(F.count_if(~F.col("query")) / ENTRIES_AT_ONCE).cast("int").alias("rows"),
        F.ceil(F.count_if("query") / QUERIES_AT_ONCE).cast("int").alias("asked"),
    )
    blocks = broadcast_if_small(write_table(counts.where("rows > 0 AND asked > 0"), "cache_blocks"))
    # An entry meets every block of queries, a query every block of entries.
    own = F.when(F.col("query"), F.col("asked")).otherwise(F.col("rows"))
    other = F.when(F.col("query"), F.col("rows")).otherwise(F.col("asked"))
    cut = both.join(blocks, ["t", "bucket"]).withColumn("own", F.pmod(F.xxhash64("id"), own).cast("int"))
    cut = cut.withColumn("other", F.explode(F.sequence(F.lit(0), other - 1)))
    cut = cut.select(
        "t", "bucket", "id", "vector", "query",
        F.when(F.col("query"), F.col("other")).otherwise(F.col("own")).alias("row_block"),
        F.when(F.col("query"), F.col("own")).otherwise(F.col("other")).alias("query_block"),
    )
    found = cut.groupBy("t", "bucket", "row_block", "query_block").applyInPandas(_best_in_block(threshold), schema)
    # Equal scores of different blocks may differ in their last digits.
    best = F.max(F.struct(F.round("cosine", 12).alias("r"), (-F.col("vec_id")).alias("v"), F.col("cosine")))
    top = found.groupBy("query_id").agg(best.alias("best")).where(F.col("best.r") >= threshold)
    return top.select("query_id", (-F.col("best.v")).cast(id_type).alias("vec_id"), F.col("best.cosine").alias("cosine"))
