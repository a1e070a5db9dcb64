"""Session settings and the shared folder that jobs write intermediate tables to."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from linkloom.sources.folders import delete

# Settings the jobs rely on.  Joins keep no broadcast hints: Catalyst broadcasts a
# side only when its measured size is under autoBroadcastJoinThreshold, and AQE
# splits partitions that one hot url has blown up.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}

#: Spark removes the shuffle files of a query when it ends.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

#: Temporary folders of local sessions that name none, by application.
_TEMPORARY: dict[str, str] = {}


def apply_settings(spark: SparkSession) -> SparkSession:
    """Apply the recommended settings to a running session.

    Joins on links rely on them: a second join on the same key has no shuffle of its own, and
    only with forceOptimizeSkewedJoin does Spark split the partition of a hot link there too.
    """
    for key, value in RECOMMENDED_CONF.items():
        spark.conf.set(key, value)
    return spark


def configure(builder: SparkSession.Builder) -> SparkSession.Builder:
    """Apply the recommended settings to a session builder."""
    for key, value in RECOMMENDED_CONF.items():
        builder = builder.config(key, value)
    return builder


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, for checkpoints and intermediate tables.

    It is the one named in ``spark.checkpoint.dir``.  Only a local session without
    that setting gets a temporary folder; on a cluster a missing setting is an error,
    because a folder on one machine would be lost with it.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    app = spark.sparkContext.applicationId  # Spark lets no running session change the setting
    if app not in _TEMPORARY:
        _TEMPORARY[app] = tempfile.mkdtemp(prefix="linkloom-")
    return _TEMPORARY[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that no other job uses."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Cut the lineage of ``df`` by writing it to the shared folder and reading it back.

    Unlike an in-memory cache it survives lost executors, and the files give the
    optimizer a true size for the joins that follow.  Shuffle files of the write go when it has
    ended, not when the driver collects garbage.  The folder stays until :func:`discard`, or until
    whoever owns the shared folder empties it; an expiry of a few days there is enough, for no job
    reads another's.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)
    table = spark.read.schema(df.schema).parquet(path)
    table._scratch = path
    return table


def discard(*tables: DataFrame) -> None:
    """Delete tables that :func:`materialize` returned, once nothing that is still to run reads them."""
    for table in tables:
        delete(table.sparkSession, table._scratch)
