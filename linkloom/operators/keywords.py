"""Keywords of documents as tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from linkloom.functions.binding import exploded
from linkloom.functions.text import tokens, top_words


def noun_tokens(
    docs: DataFrame,
    *,
    keys: Sequence[str] = ("link",),
    text: str = "content",
    lexicon: DataFrame | None = None,
    **rules: object,
) -> DataFrame:
    """One row per token: keys, pos, word.

    With a ``lexicon`` (column ``word``) only its words are kept.  The lexicon side is
    broadcast only if Catalyst finds it small enough; otherwise both sides shuffle and
    AQE splits the partitions of frequent words.
    """
    rows = exploded(docs, keys, tokens(F.col(text), **rules), item="word")
    if lexicon is None:
        return rows
    return rows.join(lexicon.select("word").distinct(), "word", "left_semi").select(
        *keys, "pos", "word"
    )


def compound_parts(words: DataFrame, lexicon: DataFrame, *, min_length: int = 2) -> DataFrame:
    """Words cut into lexicon words, longest first from left to right: word, part (from 0), text.

    At each place of a word the longest lexicon word that begins there (of ``min_length`` characters or more) is
    taken and the next place is behind it; where none begins, a character is passed over.  A word in the lexicon is
    its own only part; a word without any part, or null, gives no rows.

    Only distinct words are cut, and their pieces are compared with the lexicon by a join.  What is gathered of a
    word is one length for each of its places.
    """
    known = lexicon.select(F.col("word").alias("text")).filter(F.length("word") >= min_length).distinct()
    longest = F.least(F.length("word") - F.col("place") + 1, F.lit(known.agg(F.max(F.length("text"))).first()[0] or 0))
    places = words.select("word").distinct().select(
        "word", F.explode(F.sequence(F.lit(1), F.greatest(F.length("word"), F.lit(1)))).alias("place")
    )
    pieces = places.filter(longest >= min_length).select(
        "word", "place", F.explode(F.sequence(F.lit(min_length), longest)).alias("size")
    )
    pieces = pieces.withColumn("text", F.substring("word", F.col("place"), F.col("size")))
    begun = pieces.join(known, "text", "left_semi").groupBy("word", "place").agg(F.max("size").alias("size"))
    by_word = begun.groupBy("word").agg(F.array_sort(F.collect_list(F.struct("place", "size"))).alias("begun"))
    none = F.struct(F.lit(1).alias("next"), F.array().cast("array<struct<place:int,size:int>>").alias("taken"))
    taken = F.aggregate(
        "begun",
        none,
        lambda so_far, b: F.when(
            b["place"] >= so_far["next"],
            F.struct((b["place"] + b["size"]).alias("next"), F.array_append(so_far["taken"], b).alias("taken")),
        ).otherwise(so_far),
        lambda so_far: so_far["taken"],
    )
    rows = by_word.select("word", F.posexplode(taken).alias("part", "at"))
    return rows.select("word", "part", F.substring("word", F.col("at.place"), F.col("at.size")).alias("text"))


def compound_tokens(
    docs: DataFrame,
    lexicon: DataFrame,
    *,
    keys: Sequence[str] = ("link",),
    text: str = "content",
    min_length: int = 2,
    **rules: object,
) -> DataFrame:
    """One row per lexicon word inside a token: keys, pos, part, word; tokens without any give no rows."""
    rows = noun_tokens(docs, keys=keys, text=text, **rules)
    parts = compound_parts(rows, lexicon, min_length=min_length)
    return rows.join(parts, "word").select(*keys, "pos", "part", F.col("text").alias("word"))


def top_keywords(
    docs: DataFrame, k: int = 1, *, text: str = "content", output: str = "keyword", **rules: object
) -> DataFrame:
    """Add the ``k`` most frequent tokens as ``array<struct<word, n>>``; no shuffle."""
    return docs.withColumn(output, top_words(tokens(F.col(text), **rules), k))


def lexicon_keywords(
    docs: DataFrame,
    lexicon: DataFrame,
    k: int = 1,
    *,
    keys: Sequence[str] = ("link",),
    text: str = "content",
    **rules: object,
) -> DataFrame:
    """The ``k`` most frequent lexicon words of each document: keys, rank, word, n.

    Tokens are counted inside each task before they shuffle, and the lexicon is
    joined to the counts, not to the tokens.
    """
    keys = list(keys)
    counts = (
        noun_tokens(docs, keys=keys, text=text, **rules)
        .groupBy(*keys, "word")
        .agg(F.count("*").alias("n"), F.min("pos").alias("first"))
        .join(lexicon.select("word").distinct(), "word", "left_semi")
    )
    order = Window.partitionBy(*keys).orderBy(F.desc("n"), "first")
    return (
        counts.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select(*keys, "rank", "word", "n")
    )
