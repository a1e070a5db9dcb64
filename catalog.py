"""Every operator as a query over the driver's tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import fixtures as fx
from linkloom.functions import dates, text, urls
from linkloom.functions import score as S
from linkloom.functions.binding import exploded
from linkloom.functions.html import Selector, inner_text
from linkloom.operators import crawl, extract, keywords, portals, reshape, routing, scoring
from linkloom.plans import collection, recheck
from linkloom.session import apply_settings, materialize, scratch_path
from linkloom.sources import api, csvfiles, tables
from linkloom.sources.snapshot import AnswerSnapshot
from linkloom.streaming.collection import stream_first_collection
from linkloom.streaming.recheck import answers_table, recheck_batches, run_latest_status

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

TOKEN_RULES = {"fold_case": True}
WORDS = fx.RULES.words


def query(run: Query) -> Query:
    QUERIES[run.__name__] = lambda spark, sf: run(apply_settings(spark), sf)
    return run


def _pages(spark: SparkSession, sf: str) -> DataFrame:
    return fx.text_table(spark, sf, "pages")


def _anchors(spark: SparkSession, sf: str) -> DataFrame:
    return extract.page_anchors(_pages(spark, sf), keys=("page_id", "url"))


def _variants(rows: DataFrame, *shapes: Column, output: str = "href") -> DataFrame:
    """Each row once per shape, so that every branch of a rule meets every row."""
    return rows.select(
        *[c for c in rows.columns if c != output],
        F.posexplode(F.array(*shapes)).alias("variant", output),
    )


def _written(spark: SparkSession, rows: DataFrame, label: str) -> DataFrame:
    path = scratch_path(spark, label)
    tables.write_table(rows, path, rows.columns)
    return spark.read.schema(rows.schema).parquet(path)


def _href_shapes() -> list[Column]:
    href = F.col("href")
    lit = F.lit
    return [
        href,
        F.concat(lit("javascript:"), href),
        F.concat(lit("JavaScript:"), href),
        F.concat(lit("#"), href),
        F.concat(lit("-"), href),
        F.concat(lit("img"), href),
        F.concat(lit("Img"), href),
        F.concat(href, lit("/index.html?x=1")),
        F.concat(lit("mailto:"), href),
        F.concat(lit("http://h.com"), href),
        lit(""),
    ]


# Sources and sinks.


@query
def request_plan(spark: SparkSession, sf: str) -> DataFrame:
    items = fx.table(spark, sf, "lineitem").groupBy("l_partkey").agg(F.count("*").alias("n"))
    parts = fx.table(spark, sf, "part").select("p_partkey", "p_name")
    searched = (
        parts.join(items, parts.p_partkey == items.l_partkey)
        .groupBy(F.col("p_name").alias("keyword"))
        .agg(F.sum("n").alias("found"))
    )
    return api.request_plan(searched, "https://api.example.org/v1/search", last="found")


@query
def api_items(spark: SparkSession, sf: str) -> DataFrame:
    return api.api_items(fx.api_bodies(spark, sf), keys=("doc_id",))


@query
def api_rejects(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.col("doc_id") % 5
    body = (
        F.when(kind == 0, F.lit(None))
        .when(kind == 1, F.lit("not json"))
        .when(kind == 2, F.lit('{"total": 3}'))
        .otherwise(F.col("body"))
    )
    responses = fx.api_responses(spark, sf).withColumn("body", body)
    return api.api_rejects(api.parse_api_body(responses), keys=("doc_id",))


@query
def page_scan(spark: SparkSession, sf: str) -> DataFrame:
    body = F.encode("html", "UTF-8")
    raw = _variants(
        _pages(spark, sf).select("page_id", "url", body.alias("body")),
        F.col("body"),
        F.concat(F.col("body"), F.unhex(F.lit("FF"))),
        output="body",
    )
    return extract.page_scan(raw)


@query
def ready_urls(spark: SparkSession, sf: str) -> DataFrame:
    return tables.ready_urls(_written(spark, fx.ready_table(spark, sf), "request_url"))


def _feed(spark: SparkSession, sf: str) -> DataFrame:
    state = fx.stored_state(spark, sf).withColumn(
        "created_at", F.concat("created_at", F.lit(".250000"))
    )
    return tables.recheck_feed(state)


@query
def recheck_feed(spark: SparkSession, sf: str) -> DataFrame:
    return _feed(spark, sf)


@query
def json_records(spark: SparkSession, sf: str) -> DataFrame:
    texts = _variants(
        _feed(spark, sf),
        F.col("value"),
        F.concat(F.lit("["), "value"),
        F.to_json(F.array("value")),
        output="value",
    )
    return tables.json_records(texts, keys=("variant",))


@query
def total_url_rows(spark: SparkSession, sf: str) -> DataFrame:
    links = api.api_items(fx.api_bodies(spark, sf))
    return _written(spark, tables.total_url_rows(links), "total_url")


@query
def ready_rows(spark: SparkSession, sf: str) -> DataFrame:
    scored = scoring.relevance_score(fx.docs(spark, sf), fx.RULES)
    return _written(spark, tables.ready_rows(scored, fx.RUN_TS), "request_url")


@query
def not_ready_rows(spark: SparkSession, sf: str) -> DataFrame:
    log = routing.status_classify(fx.fetch_log(spark, sf))
    links = routing.route_not_ready(log).select(
        "status",
        F.col("url").alias("link"),
        F.concat(F.lit("fetch "), F.col("event_id")).alias("title"),
        F.lit(fx.RUN_TS).alias("date"),
        dates.run_stamp(F.col("fetched_at")).alias("updated_at"),
    )
    return _written(spark, tables.not_ready_rows(links), "not_request_url")


@query
def log_export(spark: SparkSession, sf: str) -> DataFrame:
    log = fx.table(spark, sf, "events").withColumn("ts", dates.run_stamp(F.col("ts")))
    path = csvfiles.log_export(
        log, scratch_path(spark, "export"), dt.datetime(2024, 6, 24, 9, 0, 0)
    )
    return spark.read.schema(log.schema).option("escape", '"').csv(path)


@query
def csv_saving(spark: SparkSession, sf: str) -> DataFrame:
    """Every document's record with its whole text, saved with a header and read back."""
    records = fx.docs(spark, sf).select("doc_id", "title", "link", "date", "content")
    path = scratch_path(spark, "saved")
    csvfiles.csv_saving(records, path)
    return csvfiles.csv_reading(spark, path, records.schema)


# Links and pages.


@query
def page_anchors(spark: SparkSession, sf: str) -> DataFrame:
    return _anchors(spark, sf).drop("url")


@query
def link_filter(spark: SparkSession, sf: str) -> DataFrame:
    anchors = _anchors(spark, sf).drop("url", "text")
    return extract.link_filter(_variants(anchors, *_href_shapes()))


@query
def link_resolve(spark: SparkSession, sf: str) -> DataFrame:
    anchors = _anchors(spark, sf).drop("text")
    return extract.link_resolve(_variants(anchors, *_href_shapes())).drop("url", "href")


@query
def page_link_set(spark: SparkSession, sf: str) -> DataFrame:
    return extract.page_link_set(_pages(spark, sf))


@query
def page_link_records(spark: SparkSession, sf: str) -> DataFrame:
    return extract.page_link_records(_pages(spark, sf), fx.RUN_TS, keys=("page_id",))


@query
def visible_text(spark: SparkSession, sf: str) -> DataFrame:
    return extract.page_text(_pages(spark, sf)).select("page_id", "content")


@query
def element_search(spark: SparkSession, sf: str) -> DataFrame:
    found = extract.element_search(
        _pages(spark, sf), Selector("div", "class", token="ad"), keys=("page_id",)
    )
    return found.select("page_id", "pos", inner_text(F.col("element")).alias("text"))


@query
def attribute_get(spark: SparkSession, sf: str) -> DataFrame:
    found = extract.element_search(_pages(spark, sf), Selector("a"), keys=("page_id",))
    with_href = extract.with_attribute(found, "href")
    return extract.with_attribute(with_href, "title").drop("element")


@query
def block_extract(spark: SparkSession, sf: str) -> DataFrame:
    profile = portals.ListProfile(
        container=Selector("nav"), item=Selector("li"), title=Selector("li"), info=None
    )
    return portals.list_blocks(_pages(spark, sf), profile, keys=("page_id",)).select(
        "page_id", "item", "link", "title"
    )


@query
def list_portal(spark: SparkSession, sf: str) -> DataFrame:
    found = portals.list_blocks(fx.list_pages(spark, sf), keys=("page_id",))
    return found.select("page_id", "item", "link", "date", "title")


@query
def result_portal(spark: SparkSession, sf: str) -> DataFrame:
    return portals.result_blocks(fx.result_pages(spark, sf), keys=("page_id",)).drop("block")


@query
def card_portal(spark: SparkSession, sf: str) -> DataFrame:
    return portals.card_blocks(fx.card_pages(spark, sf), keys=("page_id",))


@query
def site_dispatch(spark: SparkSession, sf: str) -> DataFrame:
    return portals.collect_sites(
        {
            "naver": fx.api_bodies(spark, sf),
            "daum": fx.list_pages(spark, sf),
            "google": fx.result_pages(spark, sf),
            "bing": fx.card_pages(spark, sf),
        }
    )


@query
def portal_requests(spark: SparkSession, sf: str) -> DataFrame:
    words = fx.table(spark, sf, "part").select(F.col("p_name").alias("keyword")).distinct()
    forms = [api.portal_requests(words, form).withColumn("form", F.lit(form)) for form in ("list", "result", "card")]
    return forms[0].unionByName(forms[1]).unionByName(forms[2])


@query
def class_detect(spark: SparkSession, sf: str) -> DataFrame:
    candidates = ("algocore", "ad", "lead story")
    worn = F.concat(
        F.lit('class="'),
        F.element_at(F.array(*[F.lit(c) for c in (*candidates, "other")]),
                     (F.col("page_id") % 4 + 1).cast("int")),
        F.lit('"><i class="ad"></i>'),
    )
    html = F.replace(F.col("html"), F.lit('class="ad">'), worn)
    found = portals.class_detect(html, candidates)
    return _pages(spark, sf).select("page_id", F.array_join(found, "|").alias("classes"))


@query
def merge_lists(spark: SparkSession, sf: str) -> DataFrame:
    lists = _anchors(spark, sf).select(
        F.col("page_id").alias("list_id"), "pos", F.col("href").alias("link")
    )
    reread = lists.withColumn("list_id", F.col("list_id") + 1)
    return extract.merge_lists(lists, reread, first_seen=True)


# Scalars.


@query
def url_root(spark: SparkSession, sf: str) -> DataFrame:
    rest = F.regexp_replace("url", "^[a-z]+:", "")
    shaped = _variants(
        _pages(spark, sf).select("page_id", "url"),
        F.col("url"),
        rest,
        F.substring(rest, F.lit(3), F.length(rest)),
        F.concat(F.lit("HTTP:"), rest),
        F.concat(F.lit("localhost:8080/"), F.col("url")),
        F.lit(""),
        output="url",
    )
    return shaped.select("page_id", "variant", urls.url_root(F.col("url")).alias("root"))


@query
def url_join(spark: SparkSession, sf: str) -> DataFrame:
    href = F.col("href")
    shaped = _variants(
        _anchors(spark, sf).drop("text"),
        href,
        F.concat(F.lit("//cdn.x"), href),
        F.concat(F.lit("/.."), href),
        F.concat(F.lit("/a/./b/.."), href, F.lit("?q=1#f")),
        F.concat(F.lit("/a"), href, F.lit("/..")),
        F.concat(F.lit("foo"), href),
    )
    joined = urls.url_join(F.col("url"), F.col("href"))
    return shaped.select("page_id", "pos", "variant", joined.alias("link"))


@query
def headline_clean(spark: SparkSession, sf: str) -> DataFrame:
    stamped = F.concat(F.lit("비트코인, 상승! 12시간 전... "), "text")
    return fx.text_table(spark, sf, "documents").select(
        "doc_id", text.headline_clean(stamped).alias("cleaned")
    )


@query
def pubdate_norm(spark: SparkSession, sf: str) -> DataFrame:
    shaped = _variants(
        fx.table(spark, sf, "events").select("event_id", "ts"),
        F.date_format("ts", "EEE, dd MMM yyyy HH:mm:ss '+0900'"),
        F.date_format("ts", "EEE, d MMM yyyy H:m:s '-0330'"),
        F.date_format("ts", "dd MMM yyyy HH:mm:ss '+0900'"),
        F.date_format("ts", "EEE, dd MMM yyyy 25:mm:ss '+0900'"),
        output="pub",
    )
    return shaped.select("event_id", "variant", dates.pubdate_norm(F.col("pub")).alias("date"))


@query
def date_int(spark: SparkSession, sf: str) -> DataFrame:
    shaped = _variants(
        fx.table(spark, sf, "events").select("event_id", "ts"),
        F.date_format("ts", "yyyy-MM-dd: HH:mm:ss"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss"),
        F.date_format("ts", "yyyy/MM/dd HH:mm:ss"),
        output="stamp",
    )
    return shaped.select("event_id", "variant", dates.date_int(F.col("stamp")).alias("ymd"))


@query
def title_squash(spark: SparkSession, sf: str) -> DataFrame:
    framed = F.concat(F.lit("\t　"), "text", F.lit(" \n\xa0"))
    return fx.table(spark, sf, "documents").select(
        "doc_id", text.title_squash(framed).alias("title")
    )


@query
def seoul_date(spark: SparkSession, sf: str) -> DataFrame:
    return fx.table(spark, sf, "events").select(
        "event_id", dates.seoul_date(F.col("ts")).alias("day")
    )


@query
def keyword_json(spark: SparkSession, sf: str) -> DataFrame:
    found = keywords.top_keywords(fx.docs(spark, sf), 3, **TOKEN_RULES)
    return found.select("doc_id", text.keyword_json(F.col("keyword")).alias("keyword"))


# Keywords and scores.


def _lexicon(spark: SparkSession, sf: str) -> DataFrame:
    words = text.tokens(F.col("text"), **TOKEN_RULES)
    return fx.table(spark, sf, "benchmark").select(F.explode(words).alias("word")).distinct()


@query
def noun_tokens(spark: SparkSession, sf: str) -> DataFrame:
    return keywords.noun_tokens(
        fx.docs(spark, sf), keys=("doc_id",), lexicon=_lexicon(spark, sf), **TOKEN_RULES
    )


@query
def compound_tokens(spark: SparkSession, sf: str) -> DataFrame:
    return keywords.compound_tokens(
        fx.docs(spark, sf), _lexicon(spark, sf), keys=("doc_id",), min_length=3, **TOKEN_RULES
    )


@query
def lexicon_keywords(spark: SparkSession, sf: str) -> DataFrame:
    return keywords.lexicon_keywords(
        fx.docs(spark, sf), _lexicon(spark, sf), 3, keys=("doc_id",), **TOKEN_RULES
    )


@query
def top_keyword(spark: SparkSession, sf: str) -> DataFrame:
    found = keywords.top_keywords(fx.docs(spark, sf), 1, **TOKEN_RULES)
    return exploded(found, ["doc_id"], F.col("keyword")).select("doc_id", "item.word", "item.n")


@query
def top_k_keywords(spark: SparkSession, sf: str) -> DataFrame:
    found = keywords.top_keywords(fx.docs(spark, sf), 3, **TOKEN_RULES)
    return exploded(found, ["doc_id"], F.col("keyword"), pos="rank").select(
        "doc_id", "rank", "item.word", "item.n"
    )


def _pieces(content: Column) -> Column:
    return text.clean_pieces(content, WORDS, fold_case=True)


@query
def sentence_filter(spark: SparkSession, sf: str) -> DataFrame:
    return exploded(fx.docs(spark, sf), ["doc_id"], _pieces(F.col("content")), item="piece")


@query
def clean_length(spark: SparkSession, sf: str) -> DataFrame:
    return fx.docs(spark, sf).select(
        "doc_id", text.clean_length(_pieces(F.col("content"))).alias("clean_length")
    )


def _scored(spark: SparkSession, sf: str) -> DataFrame:
    return scoring.relevance_score(fx.docs(spark, sf), fx.RULES)


@query
def keyword_share(spark: SparkSession, sf: str) -> DataFrame:
    return _scored(spark, sf).select("doc_id", "share")


@query
def title_hit(spark: SparkSession, sf: str) -> DataFrame:
    hit = S.title_hit(F.col("title"), fx.RULES.coin, fold_case=True)
    return fx.docs(spark, sf).select("doc_id", hit.alias("title_hit"))


@query
def keyword_tier(spark: SparkSession, sf: str) -> DataFrame:
    # The words' tiers as a table: nations' names, which no text has, and the rules' own words.
    rows = [(w, t) for t in ("coin", "other") for w in getattr(fx.RULES, t)]
    own = spark.createDataFrame(rows, "word string, tier string")
    names = fx.table(spark, sf, "nation").select(F.col("n_name").alias("word"), F.lit("other").alias("tier"))
    found = scoring.relevance_score(fx.docs(spark, sf), fx.RULES, tiers=own.unionByName(names))
    return found.select("doc_id", "tier", "tier_effect")


@query
def recency_adjust(spark: SparkSession, sf: str) -> DataFrame:
    ymd = dates.date_int(F.col("date"))
    days = F.explode(F.sequence(F.lit(20240620), F.lit(20240630)))
    shaped = fx.docs(spark, sf).select("doc_id", ymd.alias("ymd"), days.alias("as_of"))
    return shaped.select(
        "doc_id",
        "as_of",
        S.recency_tenths(F.col("ymd"), F.col("as_of")).alias("tenths"),
        S.recency_tenths(F.col("ymd"), F.col("as_of"), calendar_days=True).alias("by_days"),
    )


@query
def relevance_score(spark: SparkSession, sf: str) -> DataFrame:
    return _scored(spark, sf).select(
        "doc_id", text.keyword_json(F.col("keyword")).alias("keyword"), "clean_length", "score"
    )


@query
def enrich_links(spark: SparkSession, sf: str) -> DataFrame:
    pages = fx.table(spark, sf, "pages")
    found = pages.select(
        F.col("url").alias("title"), F.col("url").alias("link"), F.lit(fx.RUN_TS).alias("date")
    )
    links = found.unionByName(found).unionByName(fx.doc_links(spark, sf))
    enriched = scoring.enrich_links(links, _pages(spark, sf).select("url", "html"), fx.RULES)
    return enriched.withColumn("keyword", text.keyword_json(F.col("keyword")))


# Status and routes.


@query
def status_classify(spark: SparkSession, sf: str) -> DataFrame:
    return routing.status_classify(fx.fetch_log(spark, sf)).drop("fetched_at")


@query
def answer_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    """Site pages classified by a snapshot that took up the log in several runs."""
    landed, order = scratch_path(spark, "log"), ("fetched_at", "event_id")
    log = fx.fetch_log(spark, sf)
    snapshot = AnswerSnapshot.of(log, scratch_path(spark, "snapshot"), order=order)
    checkpoint = scratch_path(spark, "checkpoint")
    for early in (True, False):  # each run reads what landed since the one before
        before = F.col("fetched_at") < F.lit(fx.RECHECK_FROM).cast("timestamp_ntz")
        log.filter(before if early else ~before).repartition(3).write.mode("append").parquet(landed)
        stream = spark.readStream.schema(log.schema).option("maxFilesPerTrigger", 2).parquet(landed)
        snapshot.follow(stream, checkpoint).awaitTermination()
    links = fx.site_pages(spark, sf).select(F.col("fetched_at").alias("doc_id"), F.col("url").alias("link"))
    return routing.classify_by_answers(links, snapshot.read(), fx.RUN_TS)


@query
def route_ready(spark: SparkSession, sf: str) -> DataFrame:
    return routing.route_ready(status_classify(spark, sf)).select("event_id", "url")


@query
def route_not_ready(spark: SparkSession, sf: str) -> DataFrame:
    return routing.route_not_ready(status_classify(spark, sf)).select("event_id", "url", "status")


@query
def route_mixed(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.col("event_type")
    result = (
        F.when(kind == "click", F.concat(F.lit('"http://x/'), "event_id", F.lit('"')))
        .when(kind == "view", F.concat(F.lit('{"status": '), "event_id", F.lit("}")))
        .when(kind == "signup", F.col("event_id").cast("string"))
        .when(kind == "purchase", F.concat(F.lit('{"status": '), "event_id"))
    )
    rows = fx.table(spark, sf, "events").select("event_id", result.alias("result"))
    return routing.route_mixed(rows).select("event_id", "route")


def _checked(spark: SparkSession, sf: str) -> DataFrame:
    return fx.recheck_log(spark, sf).select("url").distinct()


@query
def delete_flags(spark: SparkSession, sf: str) -> DataFrame:
    return routing.delete_flags(fx.ready_table(spark, sf), _checked(spark, sf))


@query
def delete_remaining(spark: SparkSession, sf: str) -> DataFrame:
    early = fx.fetch_log(spark, sf).filter(
        F.col("fetched_at") < F.lit(fx.RECHECK_FROM).cast("timestamp_ntz")
    )
    return routing.delete_remaining(early.select("event_id", "url"), _checked(spark, sf))


def _stored_links(spark: SparkSession, sf: str) -> recheck.LinkStore:
    store = recheck.LinkStore.at(spark, scratch_path(spark, "links"), buckets=8)
    store.create(collection.StoredTables(fx.ready_table(spark, sf), fx.not_ready_table(spark, sf)))
    return store


def _rechecked(spark: SparkSession, sf: str) -> collection.StoredTables:
    store = _stored_links(spark, sf)
    checks = recheck.latest_checks(fx.recheck_log(spark, sf), order=("fetched_at", "event_id"))
    store.recheck(checks, fx.site_pages(spark, sf), fx.RECHECK_RULES, fx.RUN_TS, version=1)
    return store.read()


@query
def migrate_ready(spark: SparkSession, sf: str) -> DataFrame:
    return _rechecked(spark, sf).ready


@query
def migrate_not_ready(spark: SparkSession, sf: str) -> DataFrame:
    return _rechecked(spark, sf).not_ready


@query
def batch_assign(spark: SparkSession, sf: str) -> DataFrame:
    pos = F.when(F.col("event_id") % 100 == 0, None).otherwise(F.col("event_id"))
    lists = F.when(F.col("user_id") % 10 != 0, F.col("user_id"))
    rows = fx.table(spark, sf, "events").select(lists.alias("list_id"), pos.alias("pos"))
    return routing.batch_assign(rows, 20, span=4096)


@query
def bucket_assign(spark: SparkSession, sf: str) -> DataFrame:
    lists = (
        fx.table(spark, sf, "events")
        .groupBy(
            F.when(F.col("user_id") % 5 != 0, F.col("user_id")).alias("collection"),
            (F.dayofmonth("ts") % 4).alias("list_id"),
            F.dayofmonth("ts").alias("day"),
        )
        .agg(F.count("*").alias("links"))
    )
    return routing.bucket_assign(lists)


# Crawls and nested results.


@query
def frontier_step(spark: SparkSession, sf: str) -> DataFrame:
    sellers = fx.table(spark, sf, "supplier").select(
        F.lit("all").alias("seed"),
        F.concat(F.lit("s"), "s_suppkey").alias("url"),
        F.lit(0).alias("depth"),
        F.array("s_suppkey").alias("order_key"),
    )
    buyers = fx.table(spark, sf, "customer").filter("c_acctbal > 5000").select(
        F.lit("all").alias("seed"), F.concat(F.lit("c"), "c_custkey").alias("url")
    )
    visited = sellers.select("seed", "url").unionByName(buyers)
    reached = crawl.frontier_step(sellers, fx.edges(spark, sf), visited)
    return reached.select("url", "depth", F.array_join("order_key", "/").alias("order_key"))


CRAWL = {"max_pages": 1000, "max_depth": 2}


def _crawled(spark: SparkSession, sf: str) -> DataFrame:
    start = fx.graph_seeds(spark, sf).agg(F.max("url").alias("url"))
    return crawl.bfs_crawl(start, materialize(fx.edges(spark, sf), "edges"), **CRAWL)


@query
def bfs_crawl(spark: SparkSession, sf: str) -> DataFrame:
    return _crawled(spark, sf).withColumn("order_key", F.array_join("order_key", "/"))


@query
def crawl_results(spark: SparkSession, sf: str) -> DataFrame:
    return crawl.crawl_results(
        _crawled(spark, sf), fx.graph_records(spark, sf), max_depth=CRAWL["max_depth"]
    ).drop("order_key")


@query
def deep_crawl(spark: SparkSession, sf: str) -> DataFrame:
    found = crawl.deep_crawl(
        fx.graph_seeds(spark, sf), fx.graph_records(spark, sf), edges=fx.edges(spark, sf)
    )
    return found.select("seed", "page_url", "pos", "title", "link")


@query
def deep_crawl_wide(spark: SparkSession, sf: str) -> DataFrame:
    return crawl.multi_seed_crawl(
        fx.graph_seeds(spark, sf), fx.edges(spark, sf), max_pages=36, max_depth=2
    )


@query
def flatten_maps(spark: SparkSession, sf: str) -> DataFrame:
    lines = F.transform(
        F.split("text", "\n"),
        lambda line, i: F.struct(line.alias("title"), F.concat(F.lit("l"), i).alias("link")),
    )
    halves = F.create_map(
        F.concat(F.lit("a"), "doc_id"), lines, F.concat(F.lit("b"), "doc_id"), F.reverse(lines)
    )
    maps = fx.table(spark, sf, "documents").select("doc_id", halves.alias("results"))
    return reshape.flatten_maps(maps, keys=("doc_id",))


@query
def flatten_nested(spark: SparkSession, sf: str) -> DataFrame:
    lines = F.split("text", "\n")
    nested = fx.table(spark, sf, "documents").select(
        "doc_id",
        lines.alias("flat"),
        F.transform(
            lines, lambda line, i: F.when(i != 1, F.split(line, ","))
        ).alias("lists"),
    )
    one = reshape.flatten_nested(nested, column="flat", keys=("doc_id",))
    two = reshape.flatten_nested(nested, column="lists", keys=("doc_id",))
    return one.withColumn("levels", F.lit(1)).unionByName(two.withColumn("levels", F.lit(2)))


# Whole runs.


def _all_rows(stored: collection.StoredTables) -> DataFrame:
    """The stored tables as one, for comparison."""
    missing = F.lit(None)
    ready = stored.ready.select(
        F.lit("request_url").alias("stored_in"), "url", "status_code", "title", "content",
        "keyword", "score", "created_at", "updated_at",
    )
    not_ready = stored.not_ready.select(
        F.lit("not_request_url").alias("stored_in"), "url", "status_code", "title",
        missing.cast("string").alias("content"), missing.cast("string").alias("keyword"),
        missing.cast("double").alias("score"), "created_at", "updated_at",
    )
    rows = ready.unionByName(not_ready)
    if stored.rejected is not None:
        rejected = stored.rejected.select(
            F.lit("reject_url").alias("stored_in"),
            *["url", "title", "created_at"],
            F.col("reject_reason").alias("content"),
        )
        rows = rows.unionByName(rejected, allowMissingColumns=True)
    if stored.total is None:
        return rows
    total = stored.total.select(F.lit("total_url").alias("stored_in"), "url", "created_at")
    return rows.unionByName(total, allowMissingColumns=True)


def _doc_links(spark: SparkSession, sf: str) -> DataFrame:
    return api.api_items(fx.api_bodies(spark, sf, per_line=False)).select("title", "link", "date")


@query
def status_flow(spark: SparkSession, sf: str) -> DataFrame:
    return _all_rows(
        collection.status_flow(
            fx.odd_links(spark, sf), fx.doc_fetch_log(spark, sf), fx.doc_pages(spark, sf), fx.RULES, fx.RUN_TS
        )
    )


def _read_stored(spark: SparkSession, base: str, total: bool = True) -> collection.StoredTables:
    read = lambda name: spark.read.parquet(f"{base}/{name}")
    return collection.StoredTables(
        read("request_url"),
        read("not_request_url"),
        read("total_url") if total else None,
        read("reject_url") if total else None,
    )


@query
def first_collection(spark: SparkSession, sf: str) -> DataFrame:
    stored = collection.first_collection(
        _doc_links(spark, sf),
        fx.doc_fetch_log(spark, sf),
        fx.doc_pages(spark, sf),
        fx.RULES,
        fx.RUN_TS,
    )
    base = scratch_path(spark, "first")
    stored.write(base)
    return _all_rows(_read_stored(spark, base))


@query
def deep_collection(spark: SparkSession, sf: str) -> DataFrame:
    records = materialize(fx.html_records(spark, sf), "records")
    stored = collection.deep_collection(
        fx.table(spark, sf, "pages"),
        records,
        fx.html_fetch_log(records),
        fx.html_link_pages(records, _pages(spark, sf)),
        fx.RULES,
        fx.RUN_TS,
    )
    return _all_rows(stored)


@query
def stream_collection(spark: SparkSession, sf: str) -> DataFrame:
    landed, base = scratch_path(spark, "landed"), scratch_path(spark, "stream")
    bodies = fx.api_bodies(spark, sf, per_line=False).select("keyword", "start", "body")
    files = max(4, bodies.rdd.getNumPartitions())  # as many as the input is read in, so that none grows with it
    bodies.repartition(files).write.json(landed)
    run = stream_first_collection(
        spark,
        landed,
        base,
        scratch_path(spark, "checkpoint"),
        fx.doc_fetch_log(spark, sf),
        fx.doc_pages(spark, sf),
        fx.RULES,
        fx.RUN_TS,
        max_files=-(-files // 2),
    )
    run.awaitTermination()
    return _all_rows(_read_stored(spark, base))


@query
def stream_latest_status(spark: SparkSession, sf: str) -> DataFrame:
    landed, order = scratch_path(spark, "log"), ("fetched_at", "event_id")
    log = fx.recheck_log(spark, sf)
    log.repartition(3).write.parquet(landed)
    store = _stored_links(spark, sf)
    answers = answers_table(spark, scratch_path(spark, "answers"), log, order=order, buckets=8)
    migrate = recheck_batches(store, fx.site_pages(spark, sf), fx.RECHECK_RULES, fx.RUN_TS, compact_every=2)
    stream = spark.readStream.schema(log.schema).option("maxFilesPerTrigger", 2).parquet(landed)
    run_latest_status(
        stream, scratch_path(spark, "checkpoint"), migrate, answers, order=order
    ).awaitTermination()
    return _all_rows(store.read())
