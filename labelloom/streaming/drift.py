"""Drift of every batch of a stream against a saved baseline."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelloom.operators.clusters import mean_vectors, read_baseline
from labelloom.operators.monitoring import cosine, stability_rows

SCHEMA = "batch_id long, n long, psi double, cosine double"


def batch_drift(live: DataFrame, baseline: tuple, vector_col: str = "embedding") -> DataFrame:
    """One row ``(n, psi, cosine)``: rows with a vector, the stability index over
    all saved centers, and the cosine between the centroids; both are null for
    a batch without vectors."""
    centers, counts, centroid = baseline
    rows = live.where(F.col(vector_col).isNotNull())
    index = stability_rows(rows, centers, counts, vector_col).agg(F.sum("psi").alias("psi"), F.sum("live").alias("n"))
    mean = mean_vectors(rows, F.lit(0), vector_col).select(cosine(F.col("center"), F.lit(centroid)).alias("cosine"))
    # One row on either side.
    joined = index.join(F.broadcast(mean), F.lit(True), "left")
    return joined.select("n", F.when(F.col("n") > 0, F.col("psi")).alias("psi"), "cosine")


def drift_per_batch(
    stream: DataFrame, baseline_path: str, out_dir: str, checkpoint_dir: str, vector_col: str = "embedding"
) -> DataFrame:
    """Judge what has arrived, batch by batch, and return ``(batch_id, n, psi,
    cosine)`` of all batches so far.

    A batch's row lies in a folder of its id, which is overwritten: a batch that
    is run again, because the run before was cut off between writing and
    committing, leaves one row. The baseline is read once a run, so all batches
    of a run are held against the same centers.
    """
    spark = stream.sparkSession
    baseline = read_baseline(spark, baseline_path)

    def judge(batch: DataFrame, batch_id: int) -> None:
        row = batch_drift(batch, baseline, vector_col)
        row.coalesce(1).write.mode("overwrite").parquet(f"{out_dir.rstrip('/')}/batch_id={batch_id}")

    query = (
        stream.writeStream.foreachBatch(judge)
        .option("checkpointLocation", checkpoint_dir)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return read_drift(spark, out_dir)


def read_drift(spark: SparkSession, out_dir: str) -> DataFrame:
    return spark.read.schema(SCHEMA).option("basePath", out_dir).parquet(out_dir).select("batch_id", "n", "psi", "cosine")
