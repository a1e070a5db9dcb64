"""What the two substring operators share: equal texts, and joins that move few texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkloom.llm.bitmap import bitmap_parts, hash_bitmap, may_hold, part_holds
from linkloom.session import discard, materialize

#: Stands for a null doc_id: smaller than any other.
NO_ID = -(2**63)


def keyed(docs: DataFrame) -> DataFrame:
    """_row (the row as it is), _k (doc_id, never null), _h (hash of the text)."""
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID))
    text_hash = F.xxhash64(F.coalesce(F.col("text"), F.lit("")))
    return docs.select(F.struct(*docs.columns).alias("_row"), key.alias("_k"), text_hash.alias("_h"))


def texts(rows: DataFrame) -> DataFrame:
    """_k, _h and _text (never null) of keyed rows."""
    return rows.select("_k", "_h", F.coalesce(F.col("_row.text"), F.lit("")).alias("_text"))


def copies(rows: DataFrame) -> DataFrame:
    """(_k, _h) of rows whose text, by its SHA-256, also stands in a row with a smaller _k."""
    light = materialize(rows.select("_k", "_h", F.sha2("_text", 256).alias("sha")), "copy-light")
    first = light.groupBy("sha").agg(F.min("_k").alias("first"), F.max("_k").alias("last"))
    first = first.filter("first < last").select("sha", "first")
    found = light.join(first, "sha").filter("_k > first").select("_k", "_h").distinct()
    found = materialize(found, "copies")
    discard(light)
    return found


def without(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """Rows whose keys (the columns of ``keys``: _k, or _k and _h) are not among ``keys``.

    Rows that a bitmap of fixed size rules out pass as they are; only the others, the keys' own and
    few more, are joined.
    """
    maybe = _may_have(rows, keys, keys.columns)
    return rows.filter(~maybe).unionByName(rows.filter(maybe).join(keys, keys.columns, "left_anti"))


def with_decisions(rows: DataFrame, decisions: DataFrame) -> DataFrame:
    """Rows with the columns of ``decisions`` (by _k and _h; null where there are none).

    As in :func:`without`, texts of rows that surely have none are not moved.
    """
    maybe = _may_have(rows, decisions, ["_k", "_h"])
    joined = rows.filter(maybe).join(decisions, ["_k", "_h"], "left")
    added = [f for f in decisions.schema.fields if f.name not in ("_k", "_h")]
    plain = rows.filter(~maybe).withColumns({f.name: F.lit(None).cast(f.dataType) for f in added})
    return joined.unionByName(plain)


def apart(rows: DataFrame, keys: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows whose _k and _h may be among those of ``keys``, rows for which a bitmap of fixed size rules
    that out, and the table of that bitmap, which both read.

    The bitmap is broadcast and tested in the JVM, so a task that goes on in Python needs no second worker.
    """
    parts = bitmap_parts(keys.select(F.xxhash64("_k", "_h").alias("h")), "h", 25)
    bucket, held = part_holds(F.xxhash64("_k", "_h"), 25)
    marked = rows.join(F.broadcast(parts), bucket, "left").select(*rows.columns, F.coalesce(held, F.lit(False)).alias("_may"))
    return marked.filter("_may").drop("_may"), marked.filter("not _may").drop("_may"), parts


def _may_have(rows: DataFrame, keys: DataFrame, on: list[str]) -> Column:
    table = hash_bitmap(keys.select(F.xxhash64(*on).alias("h")), "h", 25)
    return may_hold(table, F.xxhash64(*on), rows.sparkSession)
