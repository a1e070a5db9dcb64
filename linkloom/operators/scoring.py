"""Relevance scores of links and the enrichment of ready links."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.constants import COIN_WORDS, OTHER_WORDS
from linkloom.functions import score as S
from linkloom.functions.dates import date_int
from linkloom.functions.html import visible_text
from linkloom.functions.text import clean_length, clean_pieces, tokens, top_words


#: Bits of the filter of wanted pages: 2**25 bits are 4 MB, on the driver and on each executor.
FILTER_BITS = 25
_BITMAP_BITS = 15  # bitmap_construct_agg makes bitmaps of 32,768 bits


@dataclass(frozen=True)
class ScoreRules:
    """Words and switches of the score."""

    as_of: int
    coin: Sequence[str] = COIN_WORDS
    other: Sequence[str] = OTHER_WORDS
    fold_case: bool = False
    calendar_days: bool = False
    token_rules: Mapping[str, object] = field(default_factory=dict)

    @property
    def words(self) -> tuple[str, ...]:
        return tuple(dict.fromkeys([*self.coin, *self.other]))


def content_features(
    docs: DataFrame, rules: ScoreRules, *, content: str = "content"
) -> DataFrame:
    """Add what the score needs from a text: its keyword and its cleaned length."""
    text = F.col(content)
    return docs.withColumn(
        "keyword",
        top_words(tokens(text, fold_case=rules.fold_case, **rules.token_rules), 1),
    ).withColumn(
        "clean_length",
        clean_length(clean_pieces(text, rules.words, fold_case=rules.fold_case)),
    )


def score_links(
    links: DataFrame, rules: ScoreRules, *, tiers: DataFrame | None = None
) -> DataFrame:
    """Add ``share``, ``title_hit``, ``tier``, ``recency`` and ``score`` to links with features.

    The tier of a link's keyword follows from the words of ``rules`` or, if given, from ``tiers``, a
    table of word and tier of any size.

    A date that cannot be read gives a null score; the caller routes it to rejects.
    """
    word = F.get("keyword", F.lit(0))["word"]
    n = F.get("keyword", F.lit(0))["n"]
    length = F.coalesce("clean_length", F.lit(0))
    parts = links.withColumns(
        {
            "hundredths_": S.share_hundredths(n, length),
            "title_hit": S.title_hit(F.col("title"), rules.coin, fold_case=rules.fold_case),
            "ymd_": date_int(F.col("date")),
        }
    )
    if tiers is None:
        parts = parts.withColumn("tier", S.tier_name(word, rules.coin, rules.other))
    else:
        parts = S.tier_of(parts, tiers, word)
    scored = parts.withColumns(
        {
            "tier_effect": F.coalesce(
                S.tier_tenths(F.col("tier"), length, F.col("hundredths_")), F.lit(0)
            ),
            "recency": S.recency_tenths(
                F.col("ymd_"), rules.as_of, calendar_days=rules.calendar_days
            ),
            "share": F.col("hundredths_") / F.lit(100.0),
        }
    )
    final = F.when(
        F.col("ymd_").isNotNull(),
        S.score(F.col("title_hit"), F.col("tier_effect"), F.col("recency")),
    )
    return scored.withColumn("score", final).drop("hundredths_", "ymd_")


def relevance_score(
    docs: DataFrame, rules: ScoreRules, *, content: str = "content", tiers: DataFrame | None = None
) -> DataFrame:
    """Features and score of links that carry their text; a map over the table, but for a join with ``tiers``."""
    return score_links(content_features(docs, rules, content=content), rules, tiers=tiers)


def wanted_pages(pages: DataFrame, links: DataFrame, *, bits: int = FILTER_BITS) -> DataFrame:
    """Pages whose url a link names, and of those the latest of each url; a few others may pass.

    Urls and times of all pages (no html) are reduced to the latest of each url and joined with the
    links; hashes of what is left make a bitmap of fixed size, which is broadcast and tested where
    the pages are scanned.  So html of other pages is neither parsed nor moved.  The fuller the
    bitmap, the more pages pass in vain; what follows must be exact without it.
    """
    order = [c for c in ("fetched_at",) if c in pages.columns]
    light = pages.select("url", *order)
    if order:
        light = light.groupBy("url").agg(*[F.max(c).alias(c) for c in order])
    named = links.select(F.col("link").alias("url")).distinct()
    place = F.shiftrightunsigned(F.xxhash64("url", *order), 64 - bits)
    bit = F.expr(f"place & {(1 << _BITMAP_BITS) - 1}")
    bitmaps = (
        light.join(named, "url", "left_semi")
        .select(place.alias("place"))
        .groupBy(F.shiftright("place", _BITMAP_BITS).alias("bucket"))
        .agg(F.bitmap_construct_agg(bit).alias("bitmap"))
    )
    byte = F.conv(F.hex(F.expr(f"substring(bitmap, cast((place & {(1 << _BITMAP_BITS) - 1}) >> 3 as int) + 1, 1)")), 16, 10)
    held = F.expr("cast(byte as int) >> cast(place & 7 as int) & 1") == 1
    placed = pages.withColumn("place", place).join(
        F.broadcast(bitmaps), F.shiftright("place", _BITMAP_BITS) == F.col("bucket")
    )
    return placed.withColumn("byte", byte).filter(held).select(*pages.columns)


def page_features(
    pages: DataFrame, rules: ScoreRules, *, links: DataFrame | None = None
) -> DataFrame:
    """Url, content, keyword and cleaned length of the latest page of each url.

    With ``links`` only pages that they name are read for text, and their latest ones.
    Text is read where the pages are scanned, so html is never shuffled.  The latest is
    the one with the largest ``fetched_at``, if pages have it; ties, and pages without,
    go by the text.  Pages are reduced to one per url inside each task first.
    """
    order = [c for c in ("fetched_at",) if c in pages.columns]
    if links is not None:
        pages = wanted_pages(pages, links)
    content = pages.select("url", *order, visible_text(F.col("html")).alias("content"))
    features = content_features(content, rules)
    found = ["content", "keyword", "clean_length"]
    last = features.groupBy("url").agg(F.max(F.struct(*order, *found)).alias("last"))
    return last.select("url", *[F.col(f"last.{c}") for c in found])


def enrich_links(links: DataFrame, pages: DataFrame, rules: ScoreRules) -> DataFrame:
    """Add content, keyword and score to links; other fields are kept.

    A page is read for text once, however often its link was collected, and not at all
    if no link names it: a link met a million times repeats only the finished features.  Of several pages of one url the
    latest counts.
    """
    keyed = page_features(pages, rules, links=links).withColumnRenamed("url", "link")
    joined = links.join(keyed, "link", "left").withColumns(
        {
            "content": F.coalesce("content", F.lit("")),
            "keyword": F.coalesce(
                "keyword", F.array().cast("array<struct<word:string,n:bigint>>")
            ),
            "clean_length": F.coalesce("clean_length", F.lit(0)),
        }
    )
    return score_links(joined, rules).select(*links.columns, "content", "keyword", "score")
