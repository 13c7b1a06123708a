"""The size of the batches in which rows pass between Spark and Python."""

from __future__ import annotations

from pyspark.sql import SparkSession


def small_batches(spark: SparkSession, most: int = 8 << 20) -> None:
    """Bounds the bytes of this session's Arrow batches: texts and images can be large, and a batch stands whole in the JVM and in Python."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark.conf.get(key, None)
    if not (now and now.isdigit() and 0 < int(now) <= most):
        spark.conf.set(key, str(most))
