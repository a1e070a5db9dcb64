"""Re-check of stored links: move each to the table its latest answer belongs in."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.functions.dates import run_stamp
from linkloom.operators.routing import (
    delete_remaining,
    error_column,
    latest_fetch,
    route_not_ready,
    route_ready,
    status_classify,
)
from linkloom.operators.scoring import ScoreRules, enrich_links
from linkloom.plans.collection import StoredTables
from linkloom.schemas import NOT_REQUEST_URL, REQUEST_URL
from linkloom.session import materialize
from linkloom.sources import tables
from linkloom.sources.keyed import KeyedTable


def latest_checks(
    fetch_log: DataFrame, *, order: Sequence[str] = ("fetched_at",)
) -> DataFrame:
    """The last answer of each re-checked url: url, status, updated_at."""
    latest = latest_fetch(status_classify(fetch_log, error=error_column(fetch_log)), order=order)
    return latest.withColumn("updated_at", run_stamp(F.col("updated_at")))


def replace_rows(table: DataFrame, urls: DataFrame, rows: DataFrame) -> DataFrame:
    """The table with every row of ``urls`` removed and ``rows`` added."""
    added = rows.select(*[F.col(f.name).cast(f.dataType) for f in table.schema.fields])
    return delete_remaining(table, urls).unionByName(added)


def checked_links(
    ready: DataFrame, not_ready: DataFrame, checks: DataFrame
) -> DataFrame:
    """Checked urls as links: title, link, date, status, updated_at.

    Title and date come from the stored row, the latest one if a url was stored more
    than once.  Stored rows are reduced to one per url inside each task before they
    meet the checks.
    """
    have = ["url", "created_at", "title"]
    stored = ready.select(*have).unionByName(not_ready.select(*have))
    last = stored.groupBy("url").agg(F.max(F.struct("created_at", "title")).alias("row"))
    return checks.join(last, "url", "left").select(
        F.col("row.title").alias("title"),
        F.col("url").alias("link"),
        F.col("row.created_at").alias("date"),
        "status",
        "updated_at",
    )


def rechecked_rows(
    ready: DataFrame,
    not_ready: DataFrame,
    checks: DataFrame,
    pages: DataFrame,
    rules: ScoreRules,
    run_ts: str,
) -> tuple[DataFrame, DataFrame]:
    """Ready and not-ready rows of the checked urls, to take the place of all they had."""
    links = materialize(checked_links(ready, not_ready, checks), "checked")
    enriched = enrich_links(route_ready(links), pages, rules)
    return tables.ready_rows(enriched, run_ts), tables.not_ready_rows(route_not_ready(links))


def recheck(
    ready: DataFrame,
    not_ready: DataFrame,
    checks: DataFrame,
    pages: DataFrame,
    rules: ScoreRules,
    run_ts: str,
) -> StoredTables:
    """New ready and not-ready tables after ``checks`` (url, status, updated_at).

    Every checked url leaves both tables and enters one of them once, enriched anew if
    it answers, so running the same checks again changes nothing.  Rows of unchecked
    urls pass through as they are.
    """
    checks = materialize(checks, "checks")
    new_ready, new_not_ready = rechecked_rows(ready, not_ready, checks, pages, rules, run_ts)
    return StoredTables(
        ready=replace_rows(ready, checks, new_ready),
        not_ready=replace_rows(not_ready, checks, new_not_ready),
    )


def _both(spark: SparkSession, *writes: Callable[[], None]) -> None:
    """Run two writes side by side; neither waits for the other's last task."""
    with ThreadPoolExecutor(len(writes)) as pool:
        for done in [pool.submit(inheritable_thread_target(spark)(write)) for write in writes]:
            done.result()


@dataclass(frozen=True)
class LinkStore:
    """The ready and not-ready tables, kept by url: a re-check writes what it changes, no whole table."""

    ready: KeyedTable
    not_ready: KeyedTable

    @classmethod
    def at(cls, spark: SparkSession, base: str, *, buckets: int = 64) -> LinkStore:
        return cls(
            KeyedTable(spark, f"{base}/request_url", REQUEST_URL, buckets=buckets),
            KeyedTable(spark, f"{base}/not_request_url", NOT_REQUEST_URL, buckets=buckets),
        )

    def create(self, stored: StoredTables, version: int = 0) -> None:
        _both(
            self.ready.spark,
            lambda: self.ready.create(stored.ready, version),
            lambda: self.not_ready.create(stored.not_ready, version),
        )

    def read(self, as_of: int | None = None) -> StoredTables:
        return StoredTables(ready=self.ready.read(as_of), not_ready=self.not_ready.read(as_of))

    def recheck(
        self, checks: DataFrame, pages: DataFrame, rules: ScoreRules, run_ts: str, version: int
    ) -> None:
        """Write version ``version``: what :func:`recheck` makes of the version before.

        Each table gets a delta with a marker for every checked url and the new rows.  Reading
        the tables as of the version before makes a repeated run write the same.
        """
        checks = materialize(checks, "checks")
        before = self.read(version - 1)
        ready, not_ready = rechecked_rows(before.ready, before.not_ready, checks, pages, rules, run_ts)
        _both(
            self.ready.spark,
            lambda: self.ready.apply(checks, ready, version),
            lambda: self.not_ready.apply(checks, not_ready, version),
        )

    def compact(self, version: int, *, least: int = 8) -> None:
        self.ready.compact(version, least=least)
        self.not_ready.compact(version, least=least)
