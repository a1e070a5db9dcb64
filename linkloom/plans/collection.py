"""First and deep collection: links in, rows of the three stored tables out."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.functions.dates import date_int

from linkloom.operators.crawl import deep_crawl
from linkloom.operators.routing import classify_links, route_not_ready, route_ready
from linkloom.operators.scoring import ScoreRules, enrich_links
from linkloom.session import materialize
from linkloom.sources import tables


@dataclass(frozen=True)
class StoredTables:
    """Rows of the stored tables: ready links, not-ready links, all links, rejected links."""

    ready: DataFrame
    not_ready: DataFrame
    total: DataFrame | None = None
    rejected: DataFrame | None = None

    def write(
        self, base: str, *, suffix: str = "", mode: str = "append", fmt: str = "parquet"
    ) -> None:
        """Write each table to its folder under ``base``.

        A run that may be repeated after a failure gives its own ``suffix`` and the mode
        ``overwrite``, so that it leaves its rows once.
        """
        named = {
            "total_url": self.total,
            "request_url": self.ready,
            "not_request_url": self.not_ready,
            "reject_url": self.rejected,
        }
        for name, rows in named.items():
            if rows is not None:
                tables.write_table(rows, f"{base}/{name}{suffix}", mode=mode, fmt=fmt)


def classified_links(
    links: DataFrame, fetch_log: DataFrame, run_ts: str, *, order: Sequence[str] = ("fetched_at",)
) -> DataFrame:
    """Links with status, updated_at and ``reject_reason``, written to the shared folder once.

    A link is rejected if it has no address or a date that cannot be read.
    """
    reason = F.when(F.col("link").isNull(), F.lit("link")).when(
        date_int(F.col("date")).isNull(), F.lit("date")
    )
    classified = classify_links(links, fetch_log, run_ts, order=order)
    return materialize(classified.withColumn("reject_reason", reason), "classified")


def _stored(
    classified: DataFrame, pages: DataFrame, rules: ScoreRules, run_ts: str
) -> StoredTables:
    accepted = classified.filter("reject_reason is null").drop("reject_reason")
    enriched = enrich_links(route_ready(accepted), pages, rules)
    return StoredTables(
        ready=tables.ready_rows(enriched, run_ts),
        not_ready=tables.not_ready_rows(route_not_ready(accepted)),
        rejected=classified.filter("reject_reason is not null").select(
            F.col("link").alias("url"), "title", F.col("date").alias("created_at"), "reject_reason"
        ),
    )


def status_flow(
    links: DataFrame,
    fetch_log: DataFrame,
    pages: DataFrame,
    rules: ScoreRules,
    run_ts: str,
    *,
    order: Sequence[str] = ("fetched_at",),
) -> StoredTables:
    """Classify links by fetch status, then shape both routes and the rejects for storage.

    All of them read the classified links where they were written, so links and log are
    read once.
    """
    return _stored(classified_links(links, fetch_log, run_ts, order=order), pages, rules, run_ts)


def first_collection(
    links: DataFrame,
    fetch_log: DataFrame,
    pages: DataFrame,
    rules: ScoreRules,
    run_ts: str,
    *,
    order: Sequence[str] = ("fetched_at",),
) -> StoredTables:
    """Keep every collected link, and route each by the status of its fetch."""
    classified = classified_links(links, fetch_log, run_ts, order=order)
    routed = _stored(classified, pages, rules, run_ts)
    return replace(routed, total=tables.total_url_rows(classified))


def deep_collection(
    ready: DataFrame,
    records: DataFrame,
    fetch_log: DataFrame,
    pages: DataFrame,
    rules: ScoreRules,
    run_ts: str,
    *,
    max_pages: int = 1,
    max_depth: int = 1,
    **options: object,
) -> StoredTables:
    """Follow the links of every ready url and route what is found."""
    found = deep_crawl(
        tables.ready_urls(ready), records, max_pages=max_pages, max_depth=max_depth
    ).select("title", "link", "date")
    return status_flow(found, fetch_log, pages, rules, run_ts, **options)
