import os

import pandas as pd
from pyspark.sql import functions as F

from labelloom.storage import BATCH_BYTES, BATCH_CONF, clear_scratch, scratch_path, write_table


def test_scratch_is_deleted(spark):
    kept = write_table(spark.range(3), "rows")
    path = scratch_path(spark, "more")
    spark.range(1).write.parquet(path)
    assert kept.count() == 3 and os.path.exists(path.removeprefix("file:"))
    clear_scratch(spark)
    assert not os.path.exists(path.removeprefix("file:"))
    clear_scratch(spark)


def test_written_tables_pass_python_in_small_batches(spark):
    """10,000 rows of long texts would be one batch, whatever its size."""

    def sizes(frames):
        yield pd.DataFrame({"size": [int(f["text"].str.len().sum()) for f in frames]})

    before = spark.conf.get(BATCH_CONF, None)
    rows = spark.range(0, 4_000, 1, 1).select(F.expr("repeat('abcd', 1000)").alias("text"))
    got = [r["size"] for r in write_table(rows.mapInPandas(sizes, "size long"), "sizes").collect()]
    assert sum(got) == 16_000_000 and max(got) < 1.1 * BATCH_BYTES
    assert spark.conf.get(BATCH_CONF, None) == before
