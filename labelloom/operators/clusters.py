"""Clusters of vectors: Lloyd's rounds from a fixed start, and their centers.

Centers are rounded after every round, so the order in which floating point
sums are made, and with it the partitioning, leaves no trace in them: the same
rows give the same centers everywhere, and they can be saved and read back.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from labelloom.storage import cut_lineage

DIGITS = 6


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def nearest_center(vector: Column | str, centers: Sequence[Sequence[float]]) -> Column:
    """Index of the center at the smallest squared distance, ties to the
    smaller. ``centers`` are literals, some hundreds at most."""
    vector = F.col(vector) if isinstance(vector, str) else vector
    # Less the vector's own square, which is the same for all centers.
    scores = F.array(*[F.lit(sum(x * x for x in c)) - 2 * dot(vector, F.lit([float(x) for x in c])) for c in centers])
    return (F.array_position(scores, F.array_min(scores)) - 1).cast("int")


def mean_vectors(df: DataFrame, group: Column, vector_col: str = "embedding") -> DataFrame:
    """``(group, center)``: the mean of each position, combined before the
    shuffle."""
    spread = df.select(group.alias("group"), F.posexplode(vector_col).alias("pos", "x"))
    means = spread.groupBy("group", "pos").agg(F.avg(F.col("x").cast("double")).alias("x"))
    listed = F.array_sort(F.collect_list(F.struct("pos", "x")))
    return means.groupBy("group").agg(F.transform(listed, lambda p: p["x"]).alias("center"))


def fit_centers(df: DataFrame, k: int, rounds: int = 5, vector_col: str = "embedding", id_col: str = "vec_id") -> list[list[float]]:
    """``k`` centers, or as many as there are rows: the vectors of the first ids,
    moved ``rounds`` times to the mean of the rows nearest to them. A center
    nearest to no row stays. Null vectors take no part."""
    rows = df.where(F.col(vector_col).isNotNull()).select(id_col, vector_col)
    first = rows.orderBy(F.asc_nulls_last(id_col), vector_col).limit(k).collect()
    centers = [[round(float(x), DIGITS) for x in r[vector_col]] for r in first]
    for _ in range(rounds if centers else 0):
        # A row a center.
        for r in mean_vectors(rows, nearest_center(vector_col, centers), vector_col).collect():
            centers[r["group"]] = [round(x, DIGITS) for x in r["center"]]
    return centers


def cluster_counts(df: DataFrame, centers: Sequence[Sequence[float]], vector_col: str = "embedding") -> DataFrame:
    """``(cluster, n)`` for every center, those without rows included."""
    spark = df.sparkSession
    every = spark.createDataFrame([(i,) for i in range(len(centers))], "cluster int")
    rows = df.where(F.col(vector_col).isNotNull())
    counts = rows.groupBy(nearest_center(vector_col, centers).alias("cluster")).agg(F.count(F.lit(1)).alias("n"))
    return every.join(F.broadcast(counts), "cluster", "left").select("cluster", F.coalesce("n", F.lit(0)).alias("n"))


def save_baseline(df: DataFrame, path: str, k: int, rounds: int = 5, vector_col: str = "embedding", id_col: str = "vec_id") -> None:
    """``(cluster, center, n, centroid)`` of a baseline as parquet: a row a
    center, the centroid of all rows beside it."""
    centers = fit_centers(df, k, rounds, vector_col, id_col)
    if not centers:
        raise ValueError("the baseline has no vectors")
    spark = df.sparkSession
    whole = mean_vectors(df.where(F.col(vector_col).isNotNull()), F.lit(0), vector_col).first()["center"]
    table = spark.createDataFrame(list(enumerate(centers)), "cluster int, center array<double>")
    counted = table.join(F.broadcast(cluster_counts(df, centers, vector_col)), "cluster")
    out = counted.withColumn("centroid", F.lit([float(x) for x in whole]))
    cut_lineage(out).coalesce(1).write.mode("overwrite").parquet(path)


def read_baseline(spark: SparkSession, path: str) -> tuple[list[list[float]], list[int], list[float]]:
    """Centers, their numbers of baseline rows, and the baseline's centroid."""
    rows = spark.read.parquet(path).orderBy("cluster").collect()
    return [list(r["center"]) for r in rows], [r["n"] for r in rows], list(rows[0]["centroid"])
