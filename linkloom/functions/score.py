"""Score parts as expressions, in whole tenths and hundredths."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from linkloom.constants import (
    BASE_TENTHS,
    CLEAN_LENGTH_BOUNDS,
    COIN_TENTHS,
    COIN_WORDS,
    NEITHER_TENTHS,
    OTHER_TENTHS,
    OTHER_WORDS,
    RECENCY_TENTHS,
    SHARE_BOUNDS,
    STALE_TENTHS,
    TITLE_HIT_TENTHS,
)
from linkloom.functions.text import contains_any


def share_hundredths(n: Column, length: Column) -> Column:
    """``min(round(n / length * 100, 2), 1)`` in hundredths, halves to even.

    No text (length 0) gives 0; no keyword (null n) gives null.
    """
    scaled = n.cast("bigint") * 10000
    safe = F.when(length > 0, length.cast("bigint"))
    whole = F.try_divide(scaled - scaled % safe, safe).cast("bigint")
    twice = (scaled % safe) * 2
    rounded = whole + F.when(
        (twice > safe) | ((twice == safe) & (whole % 2 == 1)), F.lit(1)
    ).otherwise(F.lit(0))
    bounded = F.when(length > 0, F.least(rounded, F.lit(100))).otherwise(F.lit(0))
    return F.when(n.isNotNull(), bounded).cast("int")


def keyword_share(n: Column, length: Column) -> Column:
    """Share of the keyword in the cleaned text, 0.00 to 1.00."""
    return share_hundredths(n, length) / F.lit(100.0)


def title_hit(
    title: Column, coin: Sequence[str] = COIN_WORDS, *, fold_case: bool = False
) -> Column:
    """Whether the title holds any coin word."""
    searched = F.lower(title) if fold_case else title
    return F.coalesce(contains_any(searched, coin), F.lit(False))


def tier_name(
    word: Column, coin: Sequence[str] = COIN_WORDS, other: Sequence[str] = OTHER_WORDS
) -> Column:
    """``coin``, ``other`` or ``none``; a word in both lists counts as coin."""
    return (
        F.when(word.isin(*coin), F.lit("coin")).when(word.isin(*other), F.lit("other"))
        .otherwise(F.lit("none"))
    )


def tier_of(links: DataFrame, tiers: DataFrame, word: Column) -> DataFrame:
    """Links with the ``tier`` of a word by a table of word and tier (``coin`` or ``other``); ``none`` if it has none.

    A word in both tiers, or listed twice, counts once, as coin if it is one.  Catalyst broadcasts the table if
    it finds it small; a large one is joined by word.
    """
    one = tiers.groupBy(F.col("word").alias("word_")).agg(F.min("tier").alias("tier"))  # coin comes before other
    keyed = links.withColumn("word__", word)
    joined = keyed.join(one, F.col("word__") == F.col("word_"), "left").drop("word__", "word_")
    return joined.withColumn("tier", F.coalesce("tier", F.lit("none")))


def tier_tenths(tier: Column, length: Column, hundredths: Column) -> Column:
    """Effect of the keyword's tier; 0 outside the length and share bounds."""
    counted = length.between(*CLEAN_LENGTH_BOUNDS) & hundredths.between(*SHARE_BOUNDS)
    effect = (
        F.when(tier == "coin", F.lit(COIN_TENTHS))
        .when(tier == "other", F.lit(OTHER_TENTHS))
        .otherwise(F.lit(NEITHER_TENTHS))
    )
    return F.when(counted, effect).otherwise(F.lit(0))


def _ymd_to_date(ymd: Column) -> Column:
    return F.to_date(F.try_make_timestamp_ntz(
        F.floor(ymd / 10000).cast("int"), (F.floor(ymd / 100) % 100).cast("int"),
        (ymd % 100).cast("int"), F.lit(0), F.lit(0), F.lit(0),
    ))


def recency_tenths(ymd: Column, as_of: int | Column, *, calendar_days: bool = False) -> Column:
    """Effect of the link's age.

    The age is the difference of the two yyyymmdd integers, so month ends count as
    stale and so does an age of one; ``calendar_days`` uses real days instead.
    """
    today = as_of if isinstance(as_of, Column) else F.lit(as_of)
    age = (
        F.datediff(_ymd_to_date(today), _ymd_to_date(ymd)) if calendar_days else today - ymd
    )
    effect = F.lit(STALE_TENTHS)
    for days, tenths in RECENCY_TENTHS.items():
        effect = F.when(age == days, F.lit(tenths)).otherwise(effect)
    return effect


def score(hit: Column, tier: Column, recency: Column) -> Column:
    """0.4 plus the parts, kept between 0 and 1."""
    total = F.lit(BASE_TENTHS) + F.when(hit, TITLE_HIT_TENTHS).otherwise(0) + tier + recency
    return F.greatest(F.lit(0), F.least(F.lit(10), total)) / F.lit(10.0)
