"""Statistics over event time windows of a stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def windowed_stats(
    stream: DataFrame, flagged: Column, period: str = "1 hour", delay: str = "10 minutes", ts_col: str = "ts", value_col: str = "value"
) -> DataFrame:
    """``(period, n, n_flagged, mean_value)`` per tumbling window. Rows later than
    ``delay`` behind the newest one may be left out; state is kept for open
    windows only."""
    timed = stream.withColumn(ts_col, F.col(ts_col).cast("timestamp"))
    return (
        timed.withWatermark(ts_col, delay)
        .groupBy(F.window(ts_col, period))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count_if(flagged).alias("n_flagged"),
            F.avg(value_col).alias("mean_value"),
        )
        .select(F.col("window")["start"].alias("period"), "n", "n_flagged", "mean_value")
    )


def land_closed_windows(stats: DataFrame, out_dir: str, checkpoint_dir: str) -> DataFrame:
    """Append the windows that are closed by now, and return the table. Each
    window is written once; open ones wait in the checkpoint for later rows."""
    query = (
        stats.writeStream.format("parquet")
        .outputMode("append")
        .option("path", out_dir)
        .option("checkpointLocation", checkpoint_dir)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return stats.sparkSession.read.schema(stats.schema).parquet(out_dir)
