"""The snapshot of last answers."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from linkloom.operators.routing import classify_by_answers
from linkloom.sources.snapshot import AnswerSnapshot

SCHEMA = "url string, status int, error string, fetched_at timestamp_ntz"


def answers(spark, rows):
    return spark.createDataFrame([(u, s, e, dt.datetime(2024, 1, 1, h)) for u, s, e, h in rows], SCHEMA)


def kept(snapshot, version=None):
    return {r.url: (r.status, r.fetched_at.hour) for r in snapshot.read(version).collect()}


def test_versions(spark, tmp_path):
    first = answers(spark, [("a", 200, None, 1), ("a", 404, None, 2), ("b", None, None, 3), ("c", 200, "cut", 4), (None, 200, None, 1)])
    snapshot = AnswerSnapshot.of(first, str(tmp_path / "s"), buckets=4)
    assert kept(snapshot) == {}
    snapshot.update(first, 1)
    one = {"a": (404, 2), "b": (500, 3), "c": (500, 4)}
    assert kept(snapshot) == one
    later = answers(spark, [("a", 200, None, 1), ("b", 200, None, 9), ("d", 301, None, 5)])  # a's is late
    for _ in range(2):  # the same batch again
        snapshot.update(later, 2)
        assert kept(snapshot) == {**one, "b": (200, 9), "d": (301, 5)}
    assert kept(snapshot, 1) == one
    again = AnswerSnapshot.of(first, str(tmp_path / "s"), buckets=4)
    spark.sql(f"DROP TABLE {again._name(2)}")  # as in a new session, which has to find the files
    assert kept(again) == kept(snapshot)
    snapshot.forget(2)
    assert snapshot.versions() == [2]


def test_second_run_reads_new_files_and_moves_only_new_answers(spark, tmp_path):
    landed, checkpoint = str(tmp_path / "log"), str(tmp_path / "checkpoint")
    frame = spark.range(3000).select(
        F.concat(F.lit("u"), F.col("id") % 1000).alias("url"), F.lit(200).alias("status"), F.lit(None).cast("string").alias("error"),
        F.timestamp_seconds(F.col("id")).cast("timestamp_ntz").alias("fetched_at"),
    )
    shuffles = int(spark.conf.get("spark.sql.shuffle.partitions"))
    snapshot = AnswerSnapshot.of(frame, str(tmp_path / "s"))
    assert snapshot.buckets == shuffles
    read = []
    for part in (frame, frame.limit(5)):
        part.coalesce(1).write.mode("append").parquet(landed)
        run = snapshot.follow(spark.readStream.schema(frame.schema).parquet(landed), checkpoint)
        run.awaitTermination()
        read.append(sum(p["numInputRows"] for p in run.recentProgress))
        assert all(not p.get("stateOperators") for p in run.recentProgress)
    assert read == [3000, 5]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        links = frame.select(F.col("url").alias("link"))
        joined = classify_by_answers(links, snapshot.read(), "now")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert joined.count() == 3000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange") == 1  # the links'
    assert "Bucketed: true" in plan
