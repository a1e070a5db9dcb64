"""Tables changed by key: hash buckets, deltas with delete markers, merged when read."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkloom.sources import folders

#: Partition columns of the files, in order of the folders.
PLACE = ("kind", "version", "bucket")


@dataclass(frozen=True)
class KeyedTable:
    """A table whose rows are replaced by key without being rewritten.

    Files lie at ``kind=base|delta/version=N/bucket=B``; a row's bucket is the hash of its key.  A base holds
    all rows of its buckets as of its version.  A delta holds, for each key it changes, a marker and the key's
    new rows: from its version on they are all that the key has.  A reader takes, for each bucket, the latest
    base and the deltas after it.  Work and bytes of a change go with the rows changed, those of a compaction
    with the buckets compacted.

    A version is written by one job, which leaves ``_SUCCESS`` last; readers ignore versions without it, and
    writing a version again overwrites it.  So a batch that runs again after a failure leaves its rows once.
    Rows without a key are never replaced.
    """

    spark: SparkSession
    path: str
    schema: T.StructType
    key: str = "url"
    buckets: int = 64

    # Writing.

    def create(self, rows: DataFrame, version: int = 0) -> None:
        """The table's first rows, as a base."""
        self._write(self._shaped(rows), "base", version)

    def apply(self, keys: DataFrame, rows: DataFrame, version: int) -> None:
        """From ``version`` on the ``keys`` (a column named as the table's key) have ``rows`` only.

        Rows of other keys must not be among ``rows``.
        """
        marks = keys.select(self.key).filter(F.col(self.key).isNotNull()).distinct()
        others = [F.lit(None).cast(f.dataType).alias(f.name) for f in self.schema.fields if f.name != self.key]
        marks = marks.select(F.col(self.key).cast(self.schema[self.key].dataType), *others, F.lit(True).alias("removed"))
        self._write(self._shaped(rows).unionByName(marks), "delta", version)

    def compact(self, version: int, *, least: int = 8) -> list[int]:
        """Write anew, as bases of ``version``, the buckets with at least ``least`` deltas after their base.

        ``version`` is the latest one; other buckets' files are not touched.  Returns the buckets compacted.
        """
        _, deltas = self._live(version)
        behind: dict[int, int] = {}
        for _, bucket in deltas:
            behind[bucket] = behind.get(bucket, 0) + 1
        due = sorted(b for b, n in behind.items() if n >= least)
        if due:
            rows = self._shaped(self.read(version, only=due))
            # A bucket may have no rows left; its mark says that it was compacted all the same.
            null = [F.lit(None).cast(f.dataType).alias(f.name) for f in self.schema.fields]
            marks = self.spark.createDataFrame([(b,) for b in due], "bucket int")
            self._write(rows, "base", version, marks.select(*null, F.lit(True).alias("removed"), "bucket"))
        return due

    def vacuum(self, version: int) -> int:
        """Delete folders that no reader of ``version`` or a later one needs; returns how many."""
        live = {(k, *place) for k, found in zip(("base", "delta"), self._live(version)) for place in found}
        gone = [x for x in self._folders() if x[1] <= version and x not in live]
        for place in gone:
            folders.delete(self.spark, self._folder(*place))
        return len(gone)

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")

    def _shaped(self, rows: DataFrame) -> DataFrame:
        return rows.select(*[F.col(f.name).cast(f.dataType) for f in self.schema.fields], F.lit(False).alias("removed"))

    def _write(self, rows: DataFrame, kind: str, version: int, marks: DataFrame | None = None) -> None:
        rows = rows.withColumn("bucket", self._bucket())
        if marks is not None:
            rows = rows.unionByName(marks)
        # Rebalanced, not repartitioned: the rows of a large bucket, or of one hot key, go to several tasks.
        out = rows.hint("rebalance", "bucket").write.partitionBy("bucket").mode("overwrite")
        out.parquet(f"{self.path}/kind={kind}/version={version}")

    # Reading.

    def read(self, as_of: int | None = None, *, only: Iterable[int] | None = None) -> DataFrame:
        """The table's rows as of a version (else the latest), of all buckets or only some.

        Keys that deltas change are few beside the base, so the base is filtered by them, and only the deltas'
        own rows are compared with the last version of their key.
        """
        base, deltas = self._live(as_of)
        names = [f.name for f in self.schema.fields]
        stored = self._scan("base", base, only).filter(~F.col("removed"))
        if not deltas:
            return stored.select(*names)
        changed = self._scan("delta", deltas, only)
        last = changed.filter(F.col(self.key).isNotNull()).groupBy(self.key).agg(F.max("version").alias("version"))
        current = changed.join(last, [self.key, "version"], "left_semi").filter(~F.col("removed"))
        keyless = changed.filter(F.col(self.key).isNull() & ~F.col("removed"))
        kept = stored.join(last, self.key, "left_anti")
        return kept.select(*names).unionByName(current.select(*names)).unionByName(keyless.select(*names))

    def _scan(self, kind: str, places: list[tuple[int, int]], only: Iterable[int] | None) -> DataFrame:
        wanted = None if only is None else set(only)
        paths = [self._folder(kind, *p) for p in places if wanted is None or p[1] in wanted]
        schema = T.StructType([*self.schema.fields, T.StructField("removed", T.BooleanType())])
        for name, of in zip(PLACE, (T.StringType(), T.LongType(), T.IntegerType())):
            schema = T.StructType([*schema.fields, T.StructField(name, of)])
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", self.path).parquet(*paths)

    def _folder(self, kind: str, version: int, bucket: int) -> str:
        return f"{self.path}/kind={kind}/version={version}/bucket={bucket}"

    def _live(self, as_of: int | None) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
        """(version, bucket) of the bases and of the deltas that a reader needs."""
        found = [x for x in self._folders() if as_of is None or x[1] <= as_of]
        floor: dict[int, int] = {}
        for kind, version, bucket in found:
            if kind == "base":
                floor[bucket] = max(version, floor.get(bucket, version))
        deltas = [(v, b) for kind, v, b in found if kind == "delta" and v > floor.get(b, -1)]
        return sorted((v, b) for b, v in floor.items()), sorted(deltas)

    def _folders(self) -> list[tuple[str, int, int]]:
        """(kind, version, bucket) of all folders of finished versions; as many as buckets times live versions."""
        finished = folders.found(self.spark, self.path, "kind=*/version=*/_SUCCESS")
        done = {tuple(folders.values(p).values()) for p in finished}
        places = [folders.values(p) for p in folders.found(self.spark, self.path, "kind=*/version=*/bucket=*")]
        kept = [p for p in places if (p["kind"], p["version"]) in done]
        return [(p["kind"], int(p["version"]), int(p["bucket"])) for p in kept]
