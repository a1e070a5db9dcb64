"""Re-check over a stream of fetch results."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from linkloom.functions.dates import run_stamp
from linkloom.operators.routing import error_column, status_classify
from linkloom.operators.scoring import ScoreRules
from linkloom.plans.recheck import LinkStore
from linkloom.session import materialize
from linkloom.sources.keyed import KeyedTable


def latest_status(log: DataFrame, *, order: Sequence[str] = ("fetched_at",)) -> DataFrame:
    """Running last status of each url: url, status, updated_at.

    On a stream the state is one row per url for as long as it runs; :func:`run_latest_status`
    keeps none.
    """
    last = F.max(F.struct(*order, "status")).alias("last")
    return status_classify(log, error=error_column(log)).groupBy("url").agg(last).select(
        "url", "last.status", run_stamp(F.col(f"last.{order[0]}")).alias("updated_at")
    )


def answers_table(
    spark: SparkSession, path: str, log: DataFrame, *, order: Sequence[str] = ("fetched_at",), buckets: int = 64
) -> KeyedTable:
    """Where the last answer of each url is kept: url, the columns of ``order``, status."""
    fields = [T.StructField("url", T.StringType())]
    fields += [T.StructField(c, log.schema[c].dataType) for c in order]
    return KeyedTable(spark, path, T.StructType([*fields, T.StructField("status", T.IntegerType())]), buckets=buckets)


def run_latest_status(
    log: DataFrame,
    checkpoint: str,
    apply: Callable[[DataFrame, int], None],
    answers: KeyedTable,
    *,
    order: Sequence[str] = ("fetched_at",),
    compact_every: int = 16,
) -> StreamingQuery:
    """Hand each batch's changed urls to ``apply(checks, batch_id)``; stop when caught up.

    The stream has no state.  A batch's last answers are compared with those kept in ``answers``;
    older ones are ignored, newer ones handed on and kept, as version ``batch_id + 1``.  A batch
    run again reads the same version and writes the same.
    """
    place = [*order, "status"]

    def merge(batch: DataFrame, batch_id: int) -> None:
        classified = status_classify(batch, error=error_column(batch))
        last = classified.groupBy("url").agg(F.max(F.struct(*place)).alias("last"))
        known = answers.read(batch_id).select("url", F.struct(*place).alias("known"))
        newer = last.join(known, "url", "left").filter(F.col("known").isNull() | (F.col("last") > F.col("known")))
        newer = materialize(newer.select("url", "last.*"), "newer")
        answers.apply(newer, newer, batch_id + 1)
        apply(newer.select("url", "status", run_stamp(F.col(order[0])).alias("updated_at")), batch_id)
        if (batch_id + 1) % compact_every == 0:
            answers.compact(batch_id + 1)

    return (
        log.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def recheck_batches(
    store: LinkStore, pages: DataFrame, rules: ScoreRules, run_ts: str, *, compact_every: int = 16
) -> Callable[[DataFrame, int], None]:
    """A batch function that writes version ``n + 1`` of the tables: the changes to version ``n``.

    The version follows from the batch id alone: a batch run again reads the same version and
    overwrites the same folders.  Version 0 holds the tables at the start.
    """

    def apply(checks: DataFrame, batch_id: int) -> None:
        store.recheck(checks, pages, rules, run_ts, batch_id + 1)
        if (batch_id + 1) % compact_every == 0:
            store.compact(batch_id + 1)

    return apply
