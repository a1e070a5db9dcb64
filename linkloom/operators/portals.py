"""News blocks of search-portal result pages."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkloom.constants import CARD_CLASSES, RESULT_BLOCK_ID
from linkloom.functions import html as H
from linkloom.functions.binding import bind, exploded
from linkloom.functions.text import title_squash
from linkloom.sources.api import api_items


@dataclass(frozen=True)
class ListProfile:
    """Where a list portal keeps a news item's link, date and title."""

    container: H.Selector = H.Selector("ul", "class", token="c-list-basic")
    item: H.Selector = H.Selector("li", "data-docid", pattern="^26")
    title: H.Selector = H.Selector("strong", "class", token="tit-g clamp-g")
    info: H.Selector | None = H.Selector("span", "class", token="gem-subinfo")
    date: H.Selector = H.Selector("span", "class", token="txt_info")


def class_detect(html: Column, candidates: Sequence[str] = CARD_CLASSES) -> Column:
    """Candidate class values that occur in the page, in candidate order."""
    return F.array_intersect(
        F.array(*[F.lit(c) for c in candidates]),
        F.regexp_extract_all(html, F.lit('class="([^"]+)"'), 1),
    )


def _zip_to_shortest(*columns: str) -> Column:
    """Array columns side by side, cut to the shortest."""
    length = F.least(*[F.size(c) for c in columns])
    return F.arrays_zip(*[F.slice(c, F.lit(1), length).alias(c) for c in columns])


def list_blocks(
    pages: DataFrame,
    profile: ListProfile = ListProfile(),
    *,
    keys: Sequence[str] = ("url",),
    html: str = "html",
    title: Callable[[Column], Column] = title_squash,
) -> DataFrame:
    """Items of a list portal: keys, block, item, pair, pos, link, date, title.

    Title and info elements of an item pair up by position; inside a pair the hrefs,
    dates and anchor texts are zipped to the shortest.  A title anchor without href
    has a text but no link, as in the page it comes from.
    """
    keys = list(keys)
    body = H.drop_hidden(F.col(html))
    containers = exploded(pages, keys, H.selected(body, profile.container), pos="block")
    keys = [*keys, "block"]
    inside = H.selected(H.inside(F.col("item")), profile.item)
    items = exploded(containers, keys, inside, pos="item", item="html_")
    titles = H.flat_elements(F.col("html_"), profile.title)
    infos = (
        F.transform(titles, lambda _: F.lit(""))
        if profile.info is None
        else H.selected(F.col("html_"), profile.info)
    )
    keys = [*keys, "item"]
    found = items.select(*keys, titles.alias("titles"), infos.alias("infos"))
    pairs = exploded(
        found, keys, _zip_to_shortest("titles", "infos"), pos="pair", item="p"
    )
    anchors = H.starting_tags(F.col("p.titles"), "a")
    links = F.filter(
        F.transform(anchors, lambda a: H.attribute(a, "href")), lambda h: h.isNotNull()
    )
    texts = F.transform(anchors, lambda a: title(H.inner_text(H.until_close(a, "a"))))
    if profile.info is None:
        dates = F.transform(anchors, lambda _: F.lit(None).cast("string"))
    else:
        dates = F.transform(H.flat_elements(F.col("p.infos"), profile.date), H.inner_text)
    keys = [*keys, "pair"]
    zipped = pairs.select(*keys, links.alias("link"), dates.alias("date"), texts.alias("title"))
    rows = exploded(zipped, keys, _zip_to_shortest("link", "date", "title"), item="row")
    return rows.select(*keys, "pos", "row.link", "row.date", "row.title")


def result_blocks(
    pages: DataFrame,
    *,
    keys: Sequence[str] = ("url",),
    html: str = "html",
    first_block_only: bool = True,
    outer: H.Selector = H.Selector("div", "data-hveid", pattern=RESULT_BLOCK_ID),
    inner: H.Selector = H.Selector("div", "class", token="MjjYud"),
    anchor: H.Selector = H.Selector("a", "jsname", value="YKoRaf"),
) -> DataFrame:
    """Links of a result portal: keys, block, pos, link (null without href).

    Only the first inner block is read unless ``first_block_only`` is off.
    """
    keys = list(keys)
    outers = H.selected(H.drop_hidden(F.col(html)), outer)
    found = F.flatten(F.transform(outers, lambda o: H.selected(H.inside(o), inner)))
    if first_block_only:
        found = F.slice(found, 1, 1)
    block_rows = exploded(pages, keys, found, pos="block", item="html_")
    anchors = F.filter(
        H.starting_tags(F.col("html_"), "a"), lambda a: H.matches(a, anchor)
    )
    return exploded(block_rows, [*keys, "block"], anchors, item="a").select(
        *keys, "block", "pos", H.attribute(F.col("a"), "href").alias("link")
    )


def card_blocks(
    pages: DataFrame,
    *,
    keys: Sequence[str] = ("url",),
    html: str = "html",
    candidates: Sequence[str] = CARD_CLASSES,
    attribute: str = "url",
) -> DataFrame:
    """Links of a card portal: keys, pos, link (null when the card has none).

    Cards count once for each container that holds them.  The first two candidate classes present are container and card; a page with
    fewer gives no rows.
    """
    keys = list(keys)
    detected = class_detect(F.col(html), candidates)
    staged = pages.select(
        *keys, detected.alias("detected"), H.drop_hidden(F.col(html)).alias("html_")
    ).filter(F.size("detected") >= 2)

    def has_class(div: Column, wanted: Column) -> Column:
        is_token = ~F.contains(wanted, F.lit(" "))
        return F.coalesce(
            bind(
                H.attribute(div, "class"),
                lambda own: (own == wanted)
                | (is_token & F.array_contains(F.split(own, r"\s+"), wanted)),
            ),
            F.lit(False),
        )

    container, card = F.col("detected")[0], F.col("detected")[1]
    containers = H.whole_elements(F.col("html_"), "div", lambda d: has_class(d, container))
    cards = F.flatten(
        F.transform(
            containers,
            lambda c: F.filter(
                H.starting_tags(H.inside(c), "div"), lambda d: has_class(d, card)
            ),
        )
    )
    return exploded(staged, keys, cards, item="card").select(
        *keys, "pos", H.attribute(F.col("card"), attribute).alias("link")
    )


def _link_rows(rows: DataFrame) -> DataFrame:
    for column in ("title", "date"):
        if column not in rows.columns:
            rows = rows.withColumn(column, F.lit(None).cast("string"))
    return rows.select("title", "link", "date")


SITES: Mapping[str, Callable[[DataFrame], DataFrame]] = {
    "naver": api_items,
    "daum": list_blocks,
    "google": result_blocks,
    "bing": card_blocks,
}


def collect_sites(
    landed: Mapping[str, DataFrame],
    sites: Mapping[str, Callable[[DataFrame], DataFrame]] = SITES,
) -> DataFrame:
    """Link rows of several sites, each read by its own extraction, with a site column."""
    unknown = sorted(set(landed) - set(sites))
    if unknown:
        raise ValueError(f"no extraction for site(s): {', '.join(unknown)}")
    parts = [
        _link_rows(sites[site](rows)).withColumn("site", F.lit(site))
        for site, rows in landed.items()
    ]
    return reduce(DataFrame.unionByName, parts)
