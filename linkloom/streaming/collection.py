"""First collection over a folder that API responses keep landing in."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from linkloom.operators.scoring import ScoreRules
from linkloom.plans.collection import first_collection
from linkloom.schemas import API_RESPONSE
from linkloom.sources.api import api_items


def stream_first_collection(
    spark: SparkSession,
    responses: str,
    base: str,
    checkpoint: str,
    fetch_log: DataFrame,
    pages: DataFrame,
    rules: ScoreRules,
    run_ts: str,
    *,
    max_files: int | None = None,
    order: tuple[str, ...] = ("fetched_at",),
) -> StreamingQuery:
    """Start a run that collects every response landed since the last one, then stops.

    A batch writes to folders named by its id and overwrites them, so a batch that is
    run again after a failure leaves its rows once.
    """
    reader = spark.readStream.schema(API_RESPONSE)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    links = api_items(reader.json(responses)).select("title", "link", "date")

    def collect(batch: DataFrame, batch_id: int) -> None:
        stored = first_collection(batch, fetch_log, pages, rules, run_ts, order=order)
        stored.write(base, suffix=f"/batch_id={batch_id}", mode="overwrite")

    return (
        links.writeStream.foreachBatch(collect)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
