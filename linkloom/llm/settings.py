"""Session settings that keep Python workers small."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: Batches between Spark and Python: by default they may hold 10,000 texts or 64 MB, and a task has
#: several copies of one at a time, in the executor and in each Python worker that it uses.
SMALL_BATCHES = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.execution.arrow.maxBytesPerBatch": "8m",
}


def small_batches(spark: SparkSession) -> SparkSession:
    """Set them for a running session; results do not depend on them."""
    for key, value in SMALL_BATCHES.items():
        spark.conf.set(key, value)
    return spark
