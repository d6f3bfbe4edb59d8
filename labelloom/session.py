"""A session with the settings the operators are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(app_name: str = "labelloom", master: str | None = None, **conf: str) -> SparkSession:
    """Adaptive execution with skew handling, UTC and Arrow. Values in ``conf``
    (with ``_`` for ``.``) win, as do settings of an existing session; sizes
    and shared folders are left to the cluster."""
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        # A join whose narrow side turns out to fit per partition is hashed, so
        # that the side with the texts is not sorted.
        "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
        # Lets a task write its train, validation and test rows side by side
        # in place of sorting all rows by split first.
        "spark.sql.maxConcurrentOutputFileWriters": "16",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    settings.update({k.replace("_", "."): v for k, v in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
