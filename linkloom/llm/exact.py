"""Exact deduplication: counting quotient filters route rows to byte verification."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.llm.bitmap import hash_bitmap, may_hold
from linkloom.llm.copies import NO_ID, keyed, with_decisions, without
from linkloom.llm.quotient import repeated
from linkloom.session import materialize


def exact_duplicates(docs: DataFrame) -> DataFrame:
    """For each row its group of equal texts: doc_id, keep_id, group_size, kept, text_sha256,
    text_hash.

    A counting quotient filter of 64-bit fingerprints is built for each partition, and the filters
    are merged.  Only rows whose fingerprint counts above one go on: their texts are grouped byte by
    byte, reduced in each task first, so that a group of any size moves one text per task.  Of
    equal texts the largest doc_id stays.

    Null text counts as empty.  A null doc_id is smaller than any other; a group of nothing but
    such rows has keep_id null and keeps them.  Rows equal in doc_id and text are counted in
    group_size and share one decision.  Other columns are not read.  No rows in, no rows out.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long"), text.alias("text"))
    light = materialize(
        rows.select("doc_id", F.xxhash64("text").alias("fp"), F.sha2("text", 256).alias("sha")),
        "exact-light",
    )
    counted = repeated(light, "fp", light.count())
    table = hash_bitmap(counted.select("print"), "print")
    groups = (
        rows.withColumn("fp", F.xxhash64("text"))
        .filter(may_hold(table, F.col("fp"), spark))
        .groupBy("fp", "text")
        .agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        .filter("group_size > 1")
        .select("fp", F.sha2("text", 256).alias("sha"), "keep_id", "group_size")
    )
    return light.join(groups, ["fp", "sha"], "left").select(
        "doc_id",
        F.when(F.col("group_size").isNull(), F.col("doc_id"))
        .otherwise(F.col("keep_id"))
        .alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        F.when(F.col("group_size").isNull(), F.lit(True))
        .otherwise(F.col("doc_id").eqNullSafe(F.col("keep_id")))
        .alias("kept"),
        F.col("sha").alias("text_sha256"),
        F.col("fp").alias("text_hash"),
    )


def drop_exact_duplicates(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each group of equal texts, one with the largest doc_id.

    Of rows repeated with doc_id and text (null ids count as one) any one stays, with its other
    columns.  Null text counts as empty.  No rows in, no rows out.
    """
    key = F.coalesce(F.col("doc_id"), F.lit(NO_ID)).alias("_k")
    found = materialize(exact_duplicates(docs).select(key, F.col("text_hash").alias("_h"), "kept"), "exact-found")
    dropped = materialize(found.filter("not kept").select("_k", "_h").distinct(), "dropped")
    twice = found.filter("kept").groupBy("_k", "_h").count().filter("count > 1")
    twice = materialize(twice.select("_k", "_h", F.lit(True).alias("_twice")), "exact-twice")
    rows = with_decisions(without(keyed(docs), dropped), twice)
    once = rows.filter("_twice").groupBy("_k", "_h").agg(F.first("_row").alias("_row"))
    return rows.filter("_twice is null").select("_row.*").unionByName(once.select("_row.*"))
