"""Fetch status, routes between the ready and not-ready tables, batches and buckets."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkloom.constants import FAILED_STATUS, READY_STATUS


def fetch_status(status: Column, error: Column | None = None) -> Column:
    """The answered status; 500 for a request that raised or never answered."""
    failed = status.isNull() if error is None else status.isNull() | error.isNotNull()
    return F.when(failed, F.lit(FAILED_STATUS)).otherwise(status).cast("int")


def status_classify(
    fetch_log: DataFrame, *, status: str = "status", error: str | None = None
) -> DataFrame:
    """Give every fetch a status and a route, ``ready`` or ``not_ready``."""
    return fetch_log.withColumn(
        "status", fetch_status(F.col(status), F.col(error) if error else None)
    ).withColumn(
        "route",
        F.when(F.col("status") == READY_STATUS, F.lit("ready")).otherwise(F.lit("not_ready")),
    )


def error_column(fetch_log: DataFrame) -> str | None:
    """The log's column of error texts, if it has one."""
    return "error" if "error" in fetch_log.columns else None


def latest_fetch(
    fetch_log: DataFrame,
    *,
    url: str = "url",
    order: Sequence[str] = ("fetched_at",),
    keep: Sequence[str] = ("status",),
) -> DataFrame:
    """The last fetch of each url: url, the kept columns, ``updated_at``.

    The maximum is taken inside each task first, so a url fetched constantly sends
    one row per task through the shuffle.
    """
    last = F.max(F.struct(*order, *keep)).alias("last")
    return fetch_log.groupBy(F.col(url).alias("url")).agg(last).select(
        "url", *[F.col(f"last.{c}") for c in keep], F.col(f"last.{order[0]}").alias("updated_at")
    )


def classify_links(
    links: DataFrame,
    fetch_log: DataFrame,
    run_ts: str,
    *,
    order: Sequence[str] = ("fetched_at",),
) -> DataFrame:
    """Add ``status`` and ``updated_at`` to links from the last fetch of each.

    A link without an answer in the log counts as failed, and so does one whose last
    fetch has an ``error``, if the log has that column.
    """
    answered = latest_fetch(status_classify(fetch_log, error=error_column(fetch_log)), order=order)
    return classify_by_answers(links, answered, run_ts)


def classify_by_answers(links: DataFrame, answers: DataFrame, run_ts: str) -> DataFrame:
    """Add ``status`` and ``updated_at`` to links from the one answer each url has: url, status."""
    answered = answers.select(F.col("url").alias("link"), F.col("status").alias("answer"))
    return links.join(answered, "link", "left").select(
        *links.columns,
        fetch_status(F.col("answer")).alias("status"),
        F.lit(run_ts).alias("updated_at"),
    )


def route_ready(classified: DataFrame) -> DataFrame:
    """Links that answered 200."""
    return classified.filter(F.col("status") == READY_STATUS)


def route_not_ready(classified: DataFrame) -> DataFrame:
    """Links that answered anything else."""
    return classified.filter(F.col("status") != READY_STATUS)


def route_mixed(results: DataFrame, *, result: str = "result") -> DataFrame:
    """Route JSON results by type: text is ready, an object not ready, the rest rejected."""
    kind = F.schema_of_variant(F.try_parse_json(F.col(result)))
    return results.withColumn(
        "route",
        F.when(kind == "STRING", F.lit("ready"))
        .when(F.startswith(kind, F.lit("OBJECT")), F.lit("not_ready"))
        .otherwise(F.lit("reject")),
    )


def delete_flags(table: DataFrame, urls: DataFrame, *, key: str = "url") -> DataFrame:
    """For each requested url, whether the table holds it."""
    present = table.select(key).distinct().withColumn("deleted", F.lit(True))
    return urls.join(present, key, "left").select(
        *urls.columns, F.coalesce("deleted", F.lit(False)).alias("deleted")
    )


def delete_remaining(table: DataFrame, urls: DataFrame, *, key: str = "url") -> DataFrame:
    """The table without any row of the requested urls."""
    return table.join(urls.select(key).distinct(), key, "left_anti").select(*table.columns)


def batch_assign(
    rows: DataFrame,
    size: int,
    *,
    list_id: str = "list_id",
    pos: str = "pos",
    dense: bool = False,
    span: int = 1 << 20,
) -> DataFrame:
    """Number consecutive batches of ``size`` rows within each list, from 0.

    With ``dense`` positions (0, 1, 2, ... as ``posexplode`` gives them) the batch
    follows from the position alone.  Otherwise rows are ranked per list and span of
    positions, and the spans before it are added as an offset: one list can be most
    of the table and still spread over many tasks.  Rows of one position go by their other
    columns (maps and variants apart), and rows alike in all of them may change places.
    Rows without a position come first.  Rows without a list form a list of their own.
    """
    if dense:
        return rows.withColumn("batch", F.floor(F.col(pos) / size).cast("bigint"))
    spans = rows.withColumn("span_", F.floor(F.col(pos) / span))
    before = (
        spans.groupBy(list_id, "span_")
        .agg(F.count("*").alias("rows_"))
        .withColumn(
            "offset_",
            F.sum("rows_").over(Window.partitionBy(list_id).orderBy("span_")) - F.col("rows_"),
        )
        .drop("rows_")
    )
    others = [
        f.name
        for f in rows.schema.fields
        if f.name not in (list_id, pos) and not isinstance(f.dataType, (T.MapType, T.VariantType))
    ]
    ranked = spans.withColumn(
        "rank_", F.row_number().over(Window.partitionBy(list_id, "span_").orderBy(pos, *others))
    )
    here, there = ranked.alias("r"), before.alias("b")
    same = F.col(f"r.{list_id}").eqNullSafe(F.col(f"b.{list_id}"))
    same &= F.col("r.span_").eqNullSafe(F.col("b.span_"))
    return here.join(there, same).select(
        *[F.col(f"r.{c}") for c in rows.columns],
        F.floor((F.col("rank_") - 1 + F.col("offset_")) / size).cast("bigint").alias("batch"),
    )


SLOTS = 10


def bucket_assign(
    lists: DataFrame, *, collection: str = "collection", order: str = "list_id"
) -> DataFrame:
    """Slot and group of each list of a collection; lists after the tenth are rejected.

    The n-th list takes slot n.  Slots 1-4 form group 1, 5-6 group 2, 7-8 group 3 and
    9-10 group 4.  Equal order values are told apart by the other columns, equal rows by
    their number; lists without a collection form one.  Only the first ten lists are
    ranked, and each task passes on no more than ten per collection, so the size of a
    collection does not matter.
    """
    others = [c for c in lists.columns if c not in (collection, order)]
    key = [collection, order, *others, "copy_"]
    alike = Window.partitionBy(*lists.columns).orderBy(F.lit(0))
    numbered = lists.withColumn("copy_", F.row_number().over(alike))
    first = Window.partitionBy(collection).orderBy(order, *others, "copy_")
    slots = (
        numbered.select(*key)
        .withColumn("slot", F.row_number().over(first))
        .filter(F.col("slot") <= SLOTS)
    )
    slot = F.col("slot")
    group = (
        F.when(slot >= 9, 4).when(slot >= 7, 3).when(slot >= 5, 2).when(slot >= 1, 1)
    )
    here, there = numbered.alias("r"), slots.alias("s")
    same = reduce(and_, [F.col(f"r.{c}").eqNullSafe(F.col(f"s.{c}")) for c in key])
    return here.join(there, same, "left").select(
        *[F.col(f"r.{c}") for c in lists.columns], "slot", group.alias("group_no"), slot.isNull().alias("rejected")
    )
