"""Land raw labelled files as they arrive."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from labelloom.functions.labels import encode_labels
from labelloom.functions.text import clean_text


def stream_files(
    spark: SparkSession,
    path: str,
    schema: StructType,
    fmt: str = "parquet",
    pattern: str | None = None,
    max_files_per_trigger: int = 1000,
) -> DataFrame:
    """A stream over the files of a folder; each file is delivered once."""
    reader = (
        spark.readStream.schema(schema).format(fmt).option("maxFilesPerTrigger", max_files_per_trigger)
    )
    if pattern is not None:
        reader = reader.option("pathGlobFilter", pattern)
    if fmt == "csv":
        reader = reader.option("header", True).option("escape", '"').option("multiLine", True)
    return reader.load(path)


def land_new_files(stream: DataFrame, dim: DataFrame, out_dir: str, checkpoint_dir: str) -> DataFrame:
    """Clean and encode whatever is new, append it, and return the table.

    The checkpoint remembers the files already taken, so a second run adds
    only new ones and a run that was cut off resumes without repeats. Both
    steps are stateless; the label dimension is a static broadcast side.
    """
    ready = encode_labels(stream.withColumn("text", clean_text(F.col("text"))), dim)
    query = (
        ready.writeStream.format("parquet")
        .outputMode("append")
        .option("path", out_dir)
        .option("checkpointLocation", checkpoint_dir)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return stream.sparkSession.read.schema(ready.schema).parquet(out_dir)


@dataclass(frozen=True)
class Checked:
    """``landed`` rows, ``rejected`` rows with their ``reason``, and ``counts``,
    ``(batch_id, n, n_landed, n_unknown, n_null_text)``."""

    landed: DataFrame
    rejected: DataFrame
    counts: DataFrame


COUNTED = ("batch_id", "n", "n_landed", "n_unknown", "n_null_text")
COUNTS = ", ".join(f"{c} long" for c in COUNTED)


def land_checked(stream: DataFrame, dim: DataFrame, out_dir: str, checkpoint_dir: str) -> Checked:
    """As ``land_new_files``, with rows that can't be used set apart.

    A row with a null text or a category outside the vocabulary is rejected;
    its ``reason`` names both, if both hold. No row is lost: every row of a
    batch is in one of the two folders that the batch writes in one pass, and
    the counts are observed in that pass. The folders have the batch's id and
    are overwritten, so a batch that is run again leaves no second copy. A
    rejected row keeps its text as it came.
    """
    spark = stream.sparkSession
    base = out_dir.rstrip("/")
    columns = stream.columns
    reasons = F.array_compact(
        F.array(
            F.when(F.col("text").isNull(), F.lit("null text")),
            F.when(F.col("label").isNull(), F.lit("unknown category")),
        )
    )

    def marked(rows: DataFrame) -> DataFrame:
        known = encode_labels(rows, dim).withColumn("reason", F.nullif(F.array_join(reasons, ", "), F.lit("")))
        cleaned = F.when(F.col("reason").isNull(), clean_text("text")).otherwise(F.col("text"))
        side = F.when(F.col("reason").isNull(), F.lit("landed")).otherwise(F.lit("rejected"))
        return known.withColumns({"text": cleaned, "outcome": side}).select(*columns, "label", "reason", "outcome")

    def judge(batch: DataFrame, batch_id: int) -> None:
        seen = Observation()
        observed = marked(batch).observe(
            seen,
            F.count(F.lit(1)).alias("n"),
            F.count_if(F.col("reason").isNull()).alias("n_landed"),
            F.count_if(F.col("label").isNull()).alias("n_unknown"),
            F.count_if(F.col("text").isNull()).alias("n_null_text"),
        )
        observed.write.mode("overwrite").partitionBy("outcome").parquet(f"{base}/rows/batch_id={batch_id}")
        counts = spark.createDataFrame([(batch_id, *(seen.get[c] for c in COUNTED[1:]))], COUNTS)
        counts.drop("batch_id").coalesce(1).write.mode("overwrite").parquet(f"{base}/counts/batch_id={batch_id}")

    query = (
        stream.writeStream.foreachBatch(judge)
        .option("checkpointLocation", checkpoint_dir)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()

    # The folders stand before the first batch, so that they can be read.
    none = spark.createDataFrame([], marked(spark.createDataFrame([], stream.schema)).schema)
    for name, schema in (("rows", none.drop("outcome").schema), ("counts", spark.createDataFrame([], COUNTS).drop("batch_id").schema)):
        folder = "batch_id=-1/outcome=none" if name == "rows" else "batch_id=-1"
        spark.createDataFrame([], schema).write.mode("ignore").parquet(f"{base}/{name}/{folder}")
    stored = none.withColumn("batch_id", F.lit(0).cast("long")).schema
    rows = spark.read.schema(stored).option("basePath", f"{base}/rows").parquet(f"{base}/rows")
    return Checked(
        rows.where("outcome = 'landed'").select(*columns, "label"),
        rows.where("outcome = 'rejected'").select(*columns, "label", "reason"),
        spark.read.schema(COUNTS).option("basePath", f"{base}/counts").parquet(f"{base}/counts").select(*COUNTED),
    )
