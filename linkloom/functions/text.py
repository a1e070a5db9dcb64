"""Text expressions: cleaning, tokens, keyword counting, sentence filtering.

Everything here works inside one row.  A page's tokens are counted where its text
already is, so keywords cost no shuffle however many pages there are.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from linkloom.functions.binding import bind
from linkloom.constants import COIN_WORDS, LONG_PIECE, OTHER_WORDS, PARTICLES, WHITESPACE

_HEADLINE_NOISE = (
    r"(?U)(?<![\p{L}\p{N}_])\p{Nd}+시간 전(?![\p{L}\p{N}_])|[^\p{L}\p{N}_\s\x1c-\x1f]"
)
_HANGUL = "[가-힣]"
_STEM_AND_PARTICLE = "^(" + _HANGUL + "{2,}?)(?:" + "|".join(PARTICLES) + ")$"

# Parts words in one string; a token consists of letters and never holds it.
SEPARATOR = "\u0001"


def strip(text: Column) -> Column:
    """Remove Unicode white space from both ends."""
    return F.btrim(text, F.lit(WHITESPACE))


#: Up to so many words are looked for one after the other, more by their beginnings.
FEW_WORDS = 32


def contains_any(text: Column, words: Sequence[str]) -> Column:
    """Whether any word is a case-sensitive substring of ``text``; the cost of many does not grow with their number."""
    words = list(dict.fromkeys(words))
    if len(words) <= FEW_WORDS or "" in words:
        return _contains_each(text, words)
    return _contains_by_beginnings(text, words)


def _contains_by_beginnings(text: Column, words: Sequence[str]) -> Column:
    """Every place of the text is looked up by its first characters in a set of all words' beginnings.

    As many characters count as the shortest word has.  Only where they begin a word are the places
    compared with the words, by one set for each length.  Sets are built once and looked up by hash.
    """
    by_length: dict[int, list[str]] = {}
    for word in words:
        by_length.setdefault(len(word), []).append(word)
    short, long = min(by_length), max(by_length)
    places = F.regexp_extract_all(text, F.lit("(?s)(?=(.{%d,%d}))" % (short, long)), F.lit(1))
    starts = sorted({w[:short] for w in words})

    def begins(place: Column) -> Column:
        whole = [F.left(place, F.lit(n)).isin(*by_length[n]) for n in sorted(by_length)]
        return F.left(place, F.lit(short)).isin(*starts) & reduce(or_, whole)

    return F.exists(places, begins)


def _contains_each(text: Column, words: Sequence[str]) -> Column:
    return reduce(
        lambda a, b: a | b, [F.contains(text, F.lit(w)) for w in words], F.lit(False)
    )


def headline_clean(text: Column) -> Column:
    """Drop ``N시간 전`` stamps and everything that is neither word character nor space.

    Runs of dots are among the dropped characters.
    """
    return F.regexp_replace(text, _HEADLINE_NOISE, "")


def title_squash(text: Column) -> Column:
    """Remove spaces, then strip other white space from the ends."""
    return strip(F.replace(text, F.lit(" "), F.lit("")))


def tokens(
    text: Column,
    *,
    min_length: int = 2,
    fold_case: bool = False,
    particles: bool = True,
) -> Column:
    """Letter tokens of at least ``min_length`` characters in text order.

    A Hangul token loses its trailing particle when two syllables remain before it.
    """
    source = F.lower(text) if fold_case else text
    words = F.regexp_extract_all(source, F.lit(r"\p{L}{%d,}" % min_length), F.lit(0))
    if not particles:
        return words
    stems = lambda ws: F.filter(
        F.transform(ws, lambda w: F.regexp_replace(w, _STEM_AND_PARTICLE, "$1")),
        lambda w: F.length(w) >= min_length,
    )
    return F.when(F.rlike(text, F.lit(_HANGUL)), stems(words)).otherwise(words)


def _runs(words: Column) -> Column:
    """Distinct words with their counts: ``array<struct<word, n>>``.

    Sorted and joined, equal words stand in runs that one pattern finds; a run's
    length over its word's gives the count.  Work per distinct word, not per token.
    """
    joined = F.concat(F.array_join(F.sort_array(words), SEPARATOR), F.lit(SEPARATOR))
    found = F.regexp_extract_all(joined, F.lit(rf"([^{SEPARATOR}]+{SEPARATOR})\1*+"), F.lit(0))

    def counted(run: Column, word: Column) -> Column:
        n = F.octet_length(run) / (F.octet_length(word) + 1)
        return F.struct(word.alias("word"), n.cast("bigint").alias("n"))

    return F.transform(found, lambda run: counted(run, F.substring_index(run, SEPARATOR, 1)))


def top_words(words: Column, k: int = 1) -> Column:
    """The ``k`` most frequent tokens, ties to the one seen first.

    Returns ``array<struct<word, n>>``.  Words above the k-th count are all taken; the
    places left go to words with exactly that count, in text order, which is the order
    ``array_intersect`` keeps.
    """

    def pick(words: Column, runs: Column) -> Column:
        counts = F.sort_array(F.transform(runs, lambda r: r["n"]), asc=False)
        least = F.element_at(counts, F.least(F.size(counts), F.lit(k)))
        return bind(least, lambda n: taken(words, runs, n))

    def in_text_order(words: Column, runs: Column) -> Column:
        return F.array_intersect(words, F.transform(runs, lambda r: r["word"]))

    def taken(words: Column, runs: Column, least: Column) -> Column:
        level = in_text_order(words, F.filter(runs, lambda r: r["n"] == least))
        at_level = F.transform(level, lambda w: F.struct(w.alias("word"), least.alias("n")))
        if k == 1:
            return F.slice(at_level, 1, 1)
        above = F.filter(runs, lambda r: r["n"] > least)
        ranked = bind(
            in_text_order(words, above),
            lambda order: F.sort_array(
                F.transform(
                    above,
                    lambda r: F.struct(
                        (-r["n"]).alias("fewer"),
                        F.array_position(order, r["word"]).alias("first"),
                        r["word"].alias("word"),
                    ),
                )
            ),
        )
        leading = F.transform(
            ranked, lambda r: F.struct(r["word"].alias("word"), (-r["fewer"]).alias("n"))
        )
        return F.slice(F.concat(leading, at_level), 1, k)

    none = F.array().cast("array<struct<word:string,n:bigint>>")
    return bind(
        words,
        lambda ws: F.when(
            F.size(ws) > 0, bind(_runs(ws), lambda runs: pick(ws, runs))
        ).otherwise(none),
    )


def keyword_json(keywords: Column) -> Column:
    """``[["word", n], ...]`` text of an ``array<struct<word, n>>``."""
    pair = lambda k: F.concat(
        F.lit("["),
        F.regexp_replace(F.to_json(F.array(k["word"])), r"^\[|\]$", ""),
        F.lit(", "),
        k["n"].cast("string"),
        F.lit("]"),
    )
    return F.concat(F.lit("["), F.array_join(F.transform(keywords, pair), ", "), F.lit("]"))


def clean_pieces(
    text: Column,
    words: Sequence[str] = COIN_WORDS + OTHER_WORDS,
    *,
    fold_case: bool = False,
    long_piece: int = LONG_PIECE,
) -> Column:
    """Comma-separated pieces that are long or mention a keyword, unstripped."""

    def keep(piece: Column) -> Column:
        searched = F.lower(piece) if fold_case else piece
        is_long = F.when(F.length(piece) <= long_piece, F.lit(False)).otherwise(
            F.length(strip(piece)) > long_piece
        )
        return is_long | contains_any(searched, words)

    return F.filter(F.split(text, ","), keep)


def clean_length(pieces: Column) -> Column:
    """Characters in the pieces joined by one space."""
    return F.length(F.array_join(pieces, " "))
