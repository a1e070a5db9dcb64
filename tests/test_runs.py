"""Whole runs: re-check twice, streams against batch, plans, and SQL for every query."""

from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import catalog
import fixtures as fx
import oracles
from check import compare, oracle_connection
from linkloom.operators import scoring
from linkloom.plans import recheck
from linkloom.session import SHUFFLE_CLEANUP, discard, materialize, scratch_path, shared_folder
from linkloom.streaming.recheck import answers_table, latest_status, run_latest_status

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def sql():
    return oracle_connection(SMALL)


@pytest.mark.parametrize("name", list(catalog.QUERIES))
def test_query_equals_its_sql(spark, sql, name):
    assert compare(spark, sql, name, SMALL) == ""


def test_every_query_has_sql():
    assert set(catalog.QUERIES) == set(oracles.ORACLES)
    assert set(entry.queries()) >= set(catalog.QUERIES)


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_scores_cover_their_range(spark):
    found = catalog.relevance_score(spark, "/root/testdata/sf0.01").select("score").distinct()
    assert sorted(r[0] for r in found.collect()) == [n / 10 for n in range(10)]


def test_recheck_twice_changes_nothing(spark):
    first = catalog._rechecked(spark, SMALL)
    path = scratch_path(spark, "once")
    first.write(path)
    ready = spark.read.parquet(f"{path}/request_url")
    not_ready = spark.read.parquet(f"{path}/not_request_url")
    checks = recheck.latest_checks(fx.recheck_log(spark, SMALL), order=("fetched_at", "event_id"))
    again = recheck.recheck(
        ready, not_ready, checks, fx.site_pages(spark, SMALL), fx.RECHECK_RULES, fx.RUN_TS
    )
    for before, after in ((ready, again.ready), (not_ready, again.not_ready)):
        assert sorted(map(tuple, before.collect()), key=str) == sorted(map(tuple, after.collect()), key=str)
    both = ready.select("url").unionByName(not_ready.select("url"))
    assert both.count() == both.distinct().count()


def test_recheck_writes_what_it_changes(spark, tmp_path):
    """A re-check of 1 % of the urls adds about 1 % of the bytes, and the whole form gives the same rows."""
    n = 20_000
    url = F.concat(F.lit("u"), F.col("id"))
    stamp = F.lit("2024-01-01 00:00:00")
    ready = spark.range(n).select(
        F.lit(200).alias("status_code"), url.alias("url"), F.sha2(url, 256).alias("title"), F.sha2(url, 512).alias("content"),
        F.lit("[]").alias("keyword"), F.lit(0.4).alias("score"), stamp.alias("created_at"), stamp.alias("updated_at"),
    )
    not_ready = ready.limit(0).select("status_code", "url", "title", "created_at", "updated_at")
    checks = spark.range(0, n, 100).select(
        url.alias("url"), F.when(F.col("id") % 200 == 0, 200).otherwise(404).alias("status"), stamp.alias("updated_at")
    )
    pages = checks.select("url", F.concat(F.lit("<p>word "), "url", F.lit("</p>")).alias("html"))
    store = recheck.LinkStore.at(spark, str(tmp_path / "store"), buckets=8)
    store.create(recheck.StoredTables(ready, not_ready))

    def size():
        return sum(f.stat().st_size for f in (tmp_path / "store").rglob("*.parquet"))

    before = size()
    store.recheck(checks, pages, fx.RECHECK_RULES, fx.RUN_TS, 1)
    assert size() - before < 0.05 * before
    whole = recheck.recheck(ready, not_ready, checks, pages, fx.RECHECK_RULES, fx.RUN_TS)
    for got, want in ((store.read().ready, whole.ready), (store.read().not_ready, whole.not_ready)):
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_pages_no_link_names_are_not_read(spark):
    stamps = [("a", 1, "old"), ("a", 2, "new"), ("b", 5, "b"), ("c", 1, "c"), (None, 1, "none"), ("d", None, "d"), ("e", None, "e")]
    pages = spark.createDataFrame([(u, t, f"<p>{h}</p>") for u, t, h in stamps], "url string, fetched_at long, html string")
    links = spark.createDataFrame([("a",), ("a",), ("c",), ("x",), (None,), ("d",)], "link string")
    found = scoring.wanted_pages(pages, links)
    assert sorted(r.html for r in found.collect()) == ["<p>c</p>", "<p>d</p>", "<p>new</p>"]
    untimed = scoring.wanted_pages(pages.drop("fetched_at"), links)
    assert sorted(r.html for r in untimed.collect()) == ["<p>c</p>", "<p>d</p>", "<p>new</p>", "<p>old</p>"]
    links = links.selectExpr("'t' as title", "link", "'2024-01-01' as date")
    plan = scoring.enrich_links(links, pages, fx.RULES)._jdf.queryExecution().optimizedPlan().toString()
    assert "bitmap_construct_agg" in plan
    # The plan reads from the top down: text is made above the filter by bitmap, out of what passed.
    assert plan.index("regexp_replace(html") < plan.index("bitmap#", plan.index("regexp_replace(html"))


def test_late_answers_do_not_replace_later_ones(spark, tmp_path):
    landed = str(tmp_path / "log")
    schema = "url string, status int, fetched_at timestamp_ntz"

    def land(url, status, hour):
        stamp = F.lit(f"2024-01-01 {hour:02d}:00:00").cast("timestamp_ntz")
        spark.range(1).select(
            F.lit(url).alias("url"), F.lit(status).alias("status"), stamp.alias("fetched_at")
        ).write.mode("append").parquet(landed)

    seen = {}

    def apply(checks, batch_id):
        seen.update({r["url"]: r["status"] for r in checks.collect()})

    for url, status, hour in (("a", 404, 5), ("a", 200, 3), ("b", 200, 1), ("b", 503, 2)):
        land(url, status, hour)
        stream = spark.readStream.schema(schema).parquet(landed)
        answers = answers_table(spark, str(tmp_path / "answers"), stream, buckets=4)
        query = run_latest_status(stream, str(tmp_path / "checkpoint"), apply, answers, compact_every=2)
        query.awaitTermination()
        assert all(not p.get("stateOperators") for p in query.recentProgress)
    assert seen == {"a": 404, "b": 503}
    assert {r.url: r.status for r in answers.read().collect()} == seen
    batch = latest_status(spark.read.schema(schema).parquet(landed)).collect()
    assert {r["url"]: r["status"] for r in batch} == seen


ROW_LOCAL = [
    "api_items", "page_anchors", "link_resolve", "page_link_set", "visible_text", "block_extract",
    "top_keyword", "top_k_keywords", "relevance_score", "status_classify",
]


@pytest.mark.parametrize("name", list(catalog.QUERIES))
def test_plans(spark, name):
    df = catalog.QUERIES[name](spark, SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for forbidden in ("PythonUDF", "ArrowEvalPython", "BatchEvalPython", "CartesianProduct",
                      "BroadcastNestedLoopJoin"):
        assert forbidden not in plan
    if name in ROW_LOCAL:
        assert "Exchange" not in plan


class _Unnamed:
    """A session in which no one has named a shared folder."""

    def __init__(self, spark, master):
        self.conf = self
        self.sparkContext = type("Context", (), {"master": master, "applicationId": spark.sparkContext.applicationId})

    def get(self, key, default):
        return default


def test_shared_folder(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert named is None or shared_folder(spark) == named.rstrip("/")
    assert scratch_path(spark, "x").startswith(shared_folder(spark))
    folder = shared_folder(_Unnamed(spark, "local[4]"))
    assert folder == shared_folder(_Unnamed(spark, "local[4]"))
    spark.range(3).write.parquet(f"{folder}/numbers")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(_Unnamed(spark, "spark://somewhere"))


def test_written_tables_leave_no_shuffle_files_and_go(spark):
    before = spark.conf.get(SHUFFLE_CLEANUP)
    counts = spark.range(1000).groupBy((F.col("id") % 10).alias("k")).count()
    shuffles = spark._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker().shuffleStatuses()
    held = shuffles.size()
    table = materialize(counts, "counts")
    assert table.count() == 10 and spark.conf.get(SHUFFLE_CLEANUP) == before
    folder = Path(table._scratch.removeprefix("file:"))
    assert folder.exists()
    discard(table)
    assert not folder.exists()
    again = materialize(counts, "counts")
    assert again.count() == 10
    discard(again)
    assert shuffles.size() <= held + 2  # those of the two counts, not of the writes


def test_stream_collection_lands_as_many_files_as_the_input_is_read_in(spark, tmp_path, monkeypatch):
    import catalog

    rows = [(i, f"line {i}\nthe end", "en", "s", 10) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.repartition(9).write.parquet(f"{tmp_path}/documents.parquet")
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(60)], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    monkeypatch.setattr(catalog, "scratch_path", lambda spark, label: f"{tmp_path}/{label}")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4m")
    try:
        stored = catalog.QUERIES["stream_collection"](spark, str(tmp_path))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(list(tmp_path.glob("landed/part-*"))) >= 9
    assert len(list(tmp_path.glob("stream/total_url/batch_id=*"))) == 2
    assert stored.filter("stored_in = 'total_url'").count() == 120
