"""Stored link tables: scans, the re-check feed, and appends."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.constants import READY_STATUS
from linkloom.functions.dates import run_stamp, stamp_timestamp
from linkloom.functions.text import keyword_json
from linkloom.schemas import RECHECK_RECORD


def read_table(
    spark: SparkSession, path: str | None = None, *, fmt: str = "parquet", **options: str
) -> DataFrame:
    """A stored table in any format Spark reads (parquet, orc, json, csv, jdbc, ...)."""
    reader = spark.read.format(fmt).options(**options)
    return reader.load(path) if path else reader.load()


def ready_urls(ready: DataFrame, *, url: str = "url") -> DataFrame:
    """The stored urls, one per row; the scan reads that column alone."""
    return ready.select(F.col(url).alias("url"))


def recheck_feed(table: DataFrame, *, output: str = "value") -> DataFrame:
    """One JSON object per stored row: id, link, title, date (to the second)."""
    stamp = stamp_timestamp(F.regexp_replace(F.col("created_at"), r"\.\d+$", ""))
    return table.select(
        F.to_json(
            F.struct("id", F.col("url").alias("link"), "title", run_stamp(stamp).alias("date"))
        ).alias(output)
    )


def json_records(
    rows: DataFrame, *, value: str = "value", keys: Sequence[str] = ()
) -> DataFrame:
    """Parse JSON texts to records; ``malformed`` marks text that is not a JSON object."""
    parsed = F.from_json(
        F.col(value), RECHECK_RECORD, {"mode": "PERMISSIVE"}
    )
    kind = F.schema_of_variant(F.try_parse_json(F.col(value)))
    is_object = F.coalesce(F.startswith(kind, F.lit("OBJECT")), F.lit(False))
    return rows.select(
        *keys, F.col(value), F.when(is_object, parsed).alias("r"), (~is_object).alias("malformed")
    ).select(*keys, F.col(value), "r.*", "malformed")


def total_url_rows(links: DataFrame) -> DataFrame:
    """Rows of the table of all collected links, duplicates included."""
    return links.select(F.col("link").alias("url"), F.col("date").alias("created_at"))


def ready_rows(links: DataFrame, run_ts: str | Column) -> DataFrame:
    """Rows of the ready table from enriched links."""
    stamp = run_ts if isinstance(run_ts, Column) else F.lit(run_ts)
    return links.select(
        F.lit(READY_STATUS).alias("status_code"),
        F.col("link").alias("url"),
        "title",
        "content",
        keyword_json(F.col("keyword")).alias("keyword"),
        "score",
        F.col("date").alias("created_at"),
        stamp.alias("updated_at"),
    )


def not_ready_rows(links: DataFrame) -> DataFrame:
    """Rows of the not-ready table from classified links."""
    return links.select(
        F.col("status").cast("int").alias("status_code"),
        F.col("link").alias("url"),
        "title",
        F.col("date").alias("created_at"),
        "updated_at",
    )


def write_table(
    df: DataFrame,
    path: str | None,
    columns: Sequence[str] | None = None,
    *,
    mode: str = "append",
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
    **options: str,
) -> None:
    """Append the named columns to a table in any format Spark writes."""
    chosen = df.select(*columns) if columns else df
    writer = chosen.write.format(fmt).mode(mode).options(**options)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path) if path else writer.save()


def split_rejects(rows: DataFrame, required: Mapping[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Rows that meet every named condition, and the others with the name they failed."""
    reason = F.coalesce(
        *[F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in required.items()]
    )
    marked = rows.withColumn("reject_reason", reason)
    accepted = marked.filter(F.col("reject_reason").isNull()).drop("reject_reason")
    return accepted, marked.filter(F.col("reject_reason").isNotNull())
