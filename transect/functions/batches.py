"""The size of Arrow batches that Python workers get."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: One limit for all Arrow functions of this package, so that it doesn't matter which of a session's lazy plans was made last.
BATCH_BYTES = 4 << 20
LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"


def small_batches(spark: SparkSession) -> None:
    """Have the session's Arrow batches hold BATCH_BYTES at most; a smaller limit stays. A longer row is a batch of its own."""
    now = spark.conf.get(LIMIT, None)
    if now is None or not now.isdigit() or not 0 < int(now) <= BATCH_BYTES:
        spark.conf.set(LIMIT, str(BATCH_BYTES))
