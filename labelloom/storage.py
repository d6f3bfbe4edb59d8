"""Shared folder used for checkpoints and intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 4 << 20

_made: list[str] = []  # scratch folders of this process


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach.

    Taken from the session. Only a local session without the setting gets a
    temporary folder of its own: on a cluster such a folder is lost with its
    machine, so there the setting is required.
    """
    sc = spark.sparkContext
    configured = spark.conf.get(CHECKPOINT_CONF, None) or sc.getConf().get(CHECKPOINT_CONF)
    current = sc.getCheckpointDir()
    if configured is None and current is None:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder shared by all executors")
        configured = tempfile.mkdtemp(prefix="labelloom-")
    if current is None:
        sc.setCheckpointDir(configured)
    return (configured or current).rstrip("/")


def lasting_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder that ``clear_scratch`` leaves alone."""
    return f"{shared_dir(spark)}/labelloom-kept-{uuid.uuid4().hex}/{name}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path for one intermediate table; never reused between calls."""
    folder = f"{shared_dir(spark)}/labelloom-{uuid.uuid4().hex}"
    _made.append(folder)
    return f"{folder}/{name}"


def clear_scratch(spark: SparkSession) -> None:
    """Delete the intermediate tables that this process has written. For the end
    of a job: tables that were read from them can't be read any more."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    while _made:
        path = jvm.org.apache.hadoop.fs.Path(_made.pop())
        path.getFileSystem(conf).delete(path, True)


def release_shuffles(spark: SparkSession) -> None:
    """Let executors delete the shuffle files of tables that are written and of
    plans that nobody holds. Spark does so when the driver collects its garbage,
    which a job with large shuffles and little work on the driver rarely needs."""
    spark.sparkContext._jvm.System.gc()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise a small ``df`` in the shared folder, so that losing an
    executor costs a re-read and not a recomputation."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Actions in here hand rows to Python in Arrow batches of ``BATCH_BYTES``
    or the session's bound, if that is less. Without it a batch is 10,000 rows
    whatever their length, held by the executor and the worker several times."""
    before = spark.conf.get(BATCH_CONF, None)
    set_by_session = before is not None and before.isdigit()
    spark.conf.set(BATCH_CONF, str(min(BATCH_BYTES, int(before)) if set_by_session and int(before) > 0 else BATCH_BYTES))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(BATCH_CONF)
        else:
            spark.conf.set(BATCH_CONF, before)


def write_table(df: DataFrame, name: str) -> DataFrame:
    """The same for a table with one row per input row: written as parquet, so
    that later reads are columnar and know its size."""
    path = scratch_path(df.sparkSession, name)
    with small_batches(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
