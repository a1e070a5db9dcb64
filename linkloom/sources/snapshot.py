"""The last answer of each url, kept up from new log files only and joined where it lies."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from linkloom.operators.routing import error_column, status_classify
from linkloom.sources import folders


@dataclass(frozen=True)
class AnswerSnapshot:
    """Versions of a table bucketed and sorted by url: url, the columns of ``order``, status.

    Each version is the one before merged with the last answers of some new log rows.  Both the merge
    and a join with links read the buckets as they lie: only new answers, or the links, are shuffled,
    to as many partitions as there are buckets.  Spark leaves a bucketed side in place if it has at
    least ``spark.sql.shuffle.partitions`` buckets, so choose no fewer.

    A version counts once its ``_SUCCESS`` is written; writing it again overwrites it.
    """

    spark: SparkSession
    path: str
    schema: T.StructType
    buckets: int

    @classmethod
    def of(
        cls, log: DataFrame, path: str, *, order: Sequence[str] = ("fetched_at",), buckets: int | None = None
    ) -> AnswerSnapshot:
        """The snapshot of logs of this schema."""
        spark = log.sparkSession
        fields = [T.StructField("url", T.StringType())]
        fields += [T.StructField(c, log.schema[c].dataType) for c in order]
        buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        return cls(spark, path, T.StructType([*fields, T.StructField("status", T.IntegerType())]), buckets)

    @property
    def place(self) -> list[str]:
        """What decides which of two answers is the last."""
        return self.schema.names[1:]

    def versions(self) -> list[int]:
        """Finished versions, oldest first."""
        done = folders.found(self.spark, self.path, "version=*/_SUCCESS")
        return sorted(int(folders.values(p)["version"]) for p in done)

    def read(self, as_of: int | None = None) -> DataFrame:
        """The latest version, or the latest up to ``as_of``; no rows before the first."""
        versions = [v for v in self.versions() if as_of is None or v <= as_of]
        if not versions:
            return self.spark.createDataFrame([], self.schema)
        name = self._name(versions[-1])
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema.fields)
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet CLUSTERED BY (url) SORTED BY (url) "
            f"INTO {self.buckets} BUCKETS LOCATION '{self._folder(versions[-1])}'"
        )
        return self.spark.table(name)

    def update(self, log: DataFrame, version: int) -> None:
        """Write ``version``: the one before with the last answers of ``log``.

        New answers are reduced to one per url inside each task first.  An answer older than the one
        kept changes nothing.  Rows without a url are not kept.
        """
        classified = status_classify(log, error=error_column(log)).filter(F.col("url").isNotNull())
        last = classified.groupBy("url").agg(F.max(F.struct(*self.place)).alias("new"))
        known = self.read(version - 1).select("url", F.struct(*self.place).alias("old"))
        merged = known.join(last.repartition(self.buckets, "url"), "url", "full_outer")
        kept = F.when(F.col("old").isNull() | (F.col("new") > F.col("old")), F.col("new")).otherwise(F.col("old"))
        rows = merged.select("url", kept.alias("kept")).select("url", "kept.*")
        name = self._name(version)
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        writer = rows.write.bucketBy(self.buckets, "url").sortBy("url").mode("overwrite")
        writer.option("path", self._folder(version)).format("parquet").saveAsTable(name)

    def forget(self, version: int) -> None:
        """Delete the versions that no reader of ``version`` or a later one needs."""
        for old in [v for v in self.versions() if v <= version][:-1]:
            self.spark.sql(f"DROP TABLE IF EXISTS {self._name(old)}")
            folders.delete(self.spark, self._folder(old))

    def follow(self, log: DataFrame, checkpoint: str) -> StreamingQuery:
        """Start a run that takes up the log files landed since the last one, then stops.

        ``log`` is a stream of files; its checkpoint knows which have been read.  A batch that runs
        again after a failure starts from the same version and writes the same.
        """

        def merge(batch: DataFrame, batch_id: int) -> None:
            self.update(batch, batch_id + 1)

        return (
            log.writeStream.foreachBatch(merge)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )

    def _folder(self, version: int) -> str:
        return f"{self.path}/version={version}"

    def _name(self, version: int) -> str:
        return f"answers_{hashlib.sha256(self.path.encode()).hexdigest()[:16]}_{version}"
