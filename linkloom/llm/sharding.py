"""Contiguous shards of near equal size, cut by global prefix sums."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from linkloom.session import materialize

#: Bytes counted for a row besides its text.
ROW_BYTES = 16


def byte_shards(docs: DataFrame, n_shards: int) -> DataFrame:
    """Each row's shard: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    Rows are ordered by doc_id (nulls first; ties by checksum of the text, then as the rows were
    read).  Each range partition sums its bytes; the running total of these sums, one row per
    partition, gives where each partition starts.  A row goes to the shard in which its middle byte
    falls when all bytes are cut into n_shards equal parts, so shards are contiguous and differ by
    one row's size at most.  slot counts a shard's rows from 0.  A shard stays empty only if one row
    is larger than a part.  grown_shard is always null, for the law is ``bytes``.

    Null text counts as no bytes.  Repeated rows each get a place.  Other columns are not read.  No
    rows in, no rows out.
    """
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    order = ["doc_id", "text_crc32", "uid"]
    light = materialize(
        docs.select(
            F.col("doc_id").cast("long"),
            (F.octet_length(text) + F.lit(ROW_BYTES)).cast("long").alias("size"),
            F.crc32(text).alias("text_crc32"),
            F.monotonically_increasing_id().alias("uid"),
        ),
        "shard-rows",
    )
    ranged = materialize(
        light.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "shard-ranges"
    )
    parts = Window.orderBy("part")
    before = parts.rowsBetween(Window.unboundedPreceding, -1)
    everything = parts.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    zero = F.lit(0).cast("long")
    starts = (
        ranged.groupBy("part")
        .agg(F.sum("size").alias("part_bytes"), F.count(F.lit(1)).alias("part_rows"))
        .select(
            "part",
            F.coalesce(F.sum("part_bytes").over(before), zero).alias("bytes_before"),
            F.coalesce(F.sum("part_rows").over(before), zero).alias("rows_before"),
            F.sum("part_bytes").over(everything).alias("total"),
        )
    )
    inside = Window.partitionBy("part").orderBy(*order)
    own = inside.rowsBetween(Window.unboundedPreceding, -1)
    first = (F.col("bytes_before") + F.coalesce(F.sum("size").over(own), zero)).alias("first")
    placed = materialize(
        # One row per partition: bounded by the number of partitions, not by the rows.
        ranged.join(F.broadcast(starts), "part")
        .select(
            *["doc_id", "size", "text_crc32", "total", first],
            (F.col("rows_before") + F.row_number().over(inside) - 1).alias("place"),
        )
        .withColumn(
            "shard",
            F.expr(f"cast(least((2 * first + size) * {n_shards} div (2 * total), {n_shards - 1}) as int)"),
        )
        .drop("first", "total"),
        "shard-places",
    )
    heads = placed.groupBy("shard").agg(F.min("place").alias("head"))  # one row per shard
    return placed.join(F.broadcast(heads), "shard").select(
        *["doc_id", "size", "text_crc32"],
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("place") - F.col("head")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
