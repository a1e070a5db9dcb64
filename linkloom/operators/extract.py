"""Links and text out of pages.  All row-local: a scan of pages, never a shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkloom.constants import SKIPPED_PREFIXES, SKIPPED_SUBSTRING
from linkloom.functions import html as H
from linkloom.functions.binding import exploded
from linkloom.functions.urls import url_join


def page_text(pages: DataFrame, *, html: str = "html", output: str = "content") -> DataFrame:
    """Add the visible text of each page."""
    return pages.withColumn(output, H.visible_text(F.col(html)))


def page_scan(raw: DataFrame, *, body: str = "body", output: str = "html") -> DataFrame:
    """Decode raw bodies as UTF-8; a body that is not valid UTF-8 becomes null."""
    return raw.withColumn(output, F.try_validate_utf8(F.col(body).cast("string"))).drop(body)


def page_anchors(
    pages: DataFrame, *, keys: Sequence[str] = ("url",), html: str = "html"
) -> DataFrame:
    """One row per anchor with an href: keys, pos, href, text in document order."""
    anchors = F.filter(
        F.transform(
            H.starting_tags(H.drop_hidden(F.col(html)), "a"),
            lambda e: F.struct(H.attribute(e, "href").alias("href"), e.alias("element")),
        ),
        lambda a: a["href"].isNotNull(),
    )
    return exploded(pages, keys, anchors, item="anchor").select(
        *keys,
        "pos",
        F.col("anchor.href").alias("href"),
        H.inner_text(H.until_close(F.col("anchor.element"), "a")).alias("text"),
    )


def keeps_href(
    href: Column,
    prefixes: Sequence[str] = SKIPPED_PREFIXES,
    substring: str = SKIPPED_SUBSTRING,
) -> Column:
    """Whether a raw href survives the link filter."""
    keep = ~F.contains(href, F.lit(substring))
    for prefix in prefixes:
        keep = keep & ~F.startswith(href, F.lit(prefix))
    return keep


def link_filter(anchors: DataFrame, *, href: str = "href", **rules: object) -> DataFrame:
    """Drop script, fragment, dash and i-prefixed hrefs and index pages."""
    return anchors.filter(keeps_href(F.col(href), **rules))


def link_resolve(
    anchors: DataFrame, *, base: str = "url", href: str = "href", output: str = "link"
) -> DataFrame:
    """Resolve root-relative hrefs against the page's root."""
    return anchors.withColumn(output, url_join(F.col(base), F.col(href)))


def page_link_records(
    pages: DataFrame,
    run_ts: str | Column,
    *,
    keys: Sequence[str] = ("url",),
    base: str = "url",
    html: str = "html",
) -> DataFrame:
    """Title, link and date of every anchor that passes the filter, duplicates included."""
    stamp = run_ts if isinstance(run_ts, Column) else F.lit(run_ts)
    wanted = list(dict.fromkeys([*keys, base]))
    anchors = link_filter(page_anchors(pages, keys=wanted, html=html))
    return link_resolve(anchors, base=base).select(
        *keys, "pos", F.col("text").alias("title"), "link", stamp.alias("date")
    )


def page_link_set(
    pages: DataFrame,
    *,
    keys: Sequence[str] = ("page_id",),
    base: str = "url",
    html: str = "html",
) -> DataFrame:
    """Distinct http links of each page, one page per row of ``pages``.

    A page's links meet in its own row, so they are made distinct there instead of
    in a shuffle of all anchors.
    """
    hrefs = F.filter(
        F.transform(
            H.starting_tags(H.drop_hidden(F.col(html)), "a"), lambda e: H.attribute(e, "href")
        ),
        lambda h: h.isNotNull() & keeps_href(h),
    )
    base_url = F.col(base)
    links = F.array_distinct(
        F.filter(
            F.transform(hrefs, lambda h: url_join(base_url, h)),
            lambda link: F.startswith(link, F.lit("http")),
        )
    )
    return exploded(pages, keys, links, item="link").drop("pos")


def element_search(
    pages: DataFrame,
    selector: H.Selector,
    *,
    keys: Sequence[str] = ("url",),
    html: str = "html",
    nested: bool = False,
) -> DataFrame:
    """Elements matching a selector: keys, pos, element.

    ``nested`` is for elements that may hold their own tag.  Otherwise an element ends at
    its first closing tag.
    """
    find = H.selected if nested else H.flat_elements
    found = find(H.drop_hidden(F.col(html)), selector)
    return exploded(pages, keys, found, item="element")


def with_attribute(
    elements: DataFrame, name: str, *, element: str = "element", output: str | None = None
) -> DataFrame:
    """Add an attribute of each element's opening tag; null when absent."""
    return elements.withColumn(output or name, H.attribute(F.col(element), name))


def merge_lists(*lists: DataFrame, first_seen: bool = False) -> DataFrame:
    """Per-page lists as one table of (list_id, pos, link).

    ``first_seen`` keeps each link once, at its earliest list and position.  The
    minimum is taken before and after the shuffle, so a link repeated by every list
    costs one row per task.
    """
    merged = lists[0]
    for other in lists[1:]:
        merged = merged.unionByName(other)
    if not first_seen:
        return merged.select("list_id", "pos", "link")
    return (
        merged.groupBy("link")
        .agg(F.min(F.struct("list_id", "pos")).alias("first"))
        .select("first.list_id", "first.pos", "link")
    )
