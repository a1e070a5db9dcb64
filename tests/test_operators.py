"""Operators on the small rows of FIXTURES.md."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from linkloom.functions.html import Selector, inner_text
from linkloom.operators import crawl, extract, keywords, portals, reshape, routing, scoring, topk
from linkloom.plans import collection
from linkloom.sources import api, csvfiles, tables

BASE = "https://a.b/news/1"


def page(spark, *sources):
    rows = [(f"https://a.b/news/{i + 1}", s) for i, s in enumerate(sources)]
    return spark.createDataFrame(rows, "url string, html string")


def rows(df, *order):
    found = df.orderBy(*order) if order else df
    return [tuple(r) for r in found.collect()]


ANCHORS = [
    "/x", "//cdn.x/y", "http://h.com/", "http://h.com/", "httpx://z", "/index.html",
    "http://h.com/index.html?x=1", "javascript:void(0)", "#top", "-", "img/a.png",
    "JavaScript:void(0)", "Img/a.png", "mailto:a@b.c", "foo/bar", "",
]
KEPT = [
    "https://a.b/x", "https://cdn.x/y", "http://h.com/", "http://h.com/", "httpx://z",
    "JavaScript:void(0)", "Img/a.png", "mailto:a@b.c", "foo/bar", "",
]


def test_anchors(spark):
    source = '<a name="n">no</a>' + "".join(f'<a href="{h}"> t<b>{i}</b> </a>' for i, h in enumerate(ANCHORS))
    source += '<!-- <a href="/hidden">h</a> --><script>"<a href=/s>s</a>"</script><abbr href="/no">z</abbr>'
    pages = page(spark, source, None)
    found = rows(extract.page_anchors(pages), "pos")
    assert [r[2] for r in found] == ANCHORS
    assert [r[3] for r in found][:2] == [" t0 ", " t1 "]
    records = rows(extract.page_link_records(pages, "now"), "pos")
    assert [r[3] for r in records] == KEPT
    assert {r[4] for r in records} == {"now"}
    links = rows(extract.page_link_set(pages, keys=("url",)))
    assert sorted(r[1] for r in links) == sorted({k for k in KEPT if k.startswith("http")})


def test_page_scan(spark):
    raw = spark.createDataFrame([(1, bytearray("가".encode())), (2, bytearray(b"\xff\xfe"))], "i int, body binary")
    assert rows(extract.page_scan(raw), "i") == [(1, "가"), (2, None)]


def test_element_search(spark):
    pages = page(spark, '<div class="x ad">a</div><div class="ads">b</div><p id=q>c</p><div class=ad>d</div>')
    find = lambda sel: [
        r[0] for r in rows(extract.element_search(pages, sel).select(inner_text(F.col("element"))))
    ]
    assert find(Selector("div", "class", token="ad")) == ["a", "d"]
    assert find(Selector("div", "class", value="ad")) == ["d"]
    assert find(Selector("div", "class", pattern="^ad")) == ["b", "d"]
    assert find(Selector("p", "id")) == ["c"]
    assert find(Selector("div", "id")) == []


ITEM = (
    '<li data-docid="{0}"><strong class="tit-g clamp-g">{1}</strong>'
    '<span class="gem-subinfo"><span class="txt_info">{2}</span></span></li>'
)


def test_list_portal(spark):
    one = ITEM.format("26A1", '<a href="https://n.example/1"> 첫 기사 </a>', "3시간 전")
    two = ITEM.format("99X", '<a href="https://n.example/2">둘</a>', "어제")
    three = ITEM.format("26B", '<a name="x">이름</a><a href="https://n.example/3">셋</a>', "1분 전")
    html = f'<ul class="c-list-basic">{one}{two}{three}</ul><ul><li data-docid="26Z">no</li></ul>'
    found = rows(portals.list_blocks(page(spark, html)).select("link", "date", "title"))
    # The anchor without href lends its text to the next link.
    assert found == [("https://n.example/1", "3시간 전", "첫기사"), ("https://n.example/3", "1분 전", "이름")]


def test_result_portal(spark):
    html = (
        '<div data-hveid="CAEQ"><div class="MjjYud"><a jsname="YKoRaf" href="https://n.example/1">x</a>'
        '<a jsname="o" href="https://n.example/2">y</a></div><div class="MjjYud">'
        '<a jsname="YKoRaf" href="https://n.example/3">z</a></div></div>'
    )
    pages = page(spark, html, html.replace("CAEQ", "CB"), html.replace("CAEQ", "xCAy"))
    first = rows(portals.result_blocks(pages).select("url", "link"), "url")
    assert first == [("https://a.b/news/1", "https://n.example/1"), ("https://a.b/news/3", "https://n.example/1")]
    both = rows(portals.result_blocks(page(spark, html), first_block_only=False).select("link"))
    assert both == [("https://n.example/1",), ("https://n.example/3",)]


def test_card_portal(spark):
    card = "news-card newsitem cardcommon"
    html = f'<div class="algocore"><div class="{card}" url="https://n.example/1"></div><div class="{card}"></div></div>'
    pages = page(spark, html, '<div class="algocore"></div>')
    detected = rows(pages.select(portals.class_detect(F.col("html"))))
    assert detected == [(["algocore", card],), (["algocore"],)]
    assert rows(portals.card_blocks(pages).select("url", "link"), "pos") == [
        ("https://a.b/news/1", "https://n.example/1"), ("https://a.b/news/1", None),
    ]


def test_portal_blocks_end_at_their_own_tags(spark):
    item = '<li data-docid="26{0}"><strong class="tit-g clamp-g"><a href="http://{0}">t</a></strong>'
    item += '<span class="gem-subinfo"><span class="txt_info">d</span></span></li>'
    html = f'{item.format("a")}<ul class="c-list-basic">{item.format("b")}<ul><li>z</li></ul>{item.format("c")}</ul>'
    html += f'<ul>{item.format("d")}</ul>'
    got = rows(portals.list_blocks(page(spark, html)).select("link"))
    assert got == [("http://b",), ("http://c",)]
    link = '<a jsname="YKoRaf" href="http://{0}">t</a>'
    html = f'<div data-hveid="CA"><div class="MjjYud"><div>{link.format("in")}</div></div>{link.format("x")}</div>'
    html = f'<div data-hveid="CA"></div>{html}<div class="MjjYud">{link.format("y")}</div>'
    assert rows(portals.result_blocks(page(spark, html)).select("link")) == [("http://in",)]
    html = f'<div data-hveid="CA" class="MjjYud"><div class="MjjYud"></div>{link.format("x")}</div>{link.format("y")}'
    assert rows(portals.result_blocks(page(spark, html))) == []
    card = '<div class="newscard vr" url="{0}"></div>'
    html = f'{card.format("a")}<div class="nwscnt"><div>{card.format("b")}</div><div class="nwscnt">{card.format("c")}'
    html += f'</div></div>{card.format("d")}'
    assert sorted(rows(portals.card_blocks(page(spark, html)).select("link"))) == [("b",), ("c",), ("c",)]


def test_a_hubs_links_are_ranked_by_spans(spark, monkeypatch):
    monkeypatch.setattr(crawl, "SPAN", 4)
    edges = spark.createDataFrame([("h", f"p{i}", i * 3) for i in range(20)], "url string, link string, pos long")
    seeds = spark.createDataFrame([("h",)], "url string")
    got = crawl.multi_seed_crawl(seeds, edges, max_pages=7, max_depth=1)
    assert rows(got.select("visit", "url")) == [(0, "h"), *[(i + 1, f"p{i}") for i in range(6)]]


def test_site_dispatch(spark):
    html = '<div class="nwscnt"><div class="newscard vr" url="u1"></div></div>'
    got = rows(portals.collect_sites({"bing": page(spark, html), "google": page(spark, "<p></p>")}))
    assert got == [(None, "u1", None, "bing")]
    with pytest.raises(ValueError, match="nowhere"):
        portals.collect_sites({"nowhere": page(spark, html)})


def test_merge_lists(spark):
    one = spark.createDataFrame([(1, 0, "a"), (1, 1, "b")], "list_id int, pos int, link string")
    two = spark.createDataFrame([(2, 0, "a"), (2, 1, "c"), (2, 2, None)], one.schema)
    assert len(rows(extract.merge_lists(one, two))) == 5
    assert rows(extract.merge_lists(one, two, first_seen=True), "list_id", "pos") == [
        (1, 0, "a"), (1, 1, "b"), (2, 1, "c"), (2, 2, None),
    ]


def test_request_plan(spark):
    words = spark.createDataFrame([("BTC 1", 250)], "keyword string, found int")
    got = rows(api.request_plan(words, "https://h/v1", last="found"), "start")
    assert [r[1] for r in got] == [1, 101, 201]
    assert got[0][2] == "https://h/v1/news.json?query=BTC 1&start=1&display=100"
    assert "query=BTC+1&" in rows(api.request_plan(words, "https://h/v1", encode=True))[0][2]
    form = api.portal_requests(words, "https://p/search?q=%s&tbm=nws")
    assert rows(form) == [("BTC 1", "https://p/search?q=BTC 1&tbm=nws")]


def test_api_items_from_files(spark, tmp_path):
    (tmp_path / "r.json").write_text(
        '{"keyword": "BTC", "start": 1, "body": {"items": [{"title": "<b>t</b>", "originallink": "u",'
        ' "pubDate": "Fri, 21 Jun 2024 10:11:12 +0900"}, {"title": "x"}]}}\n'
    )
    got = rows(api.api_items(api.read_api_responses(spark, str(tmp_path)), keys=("keyword",)), "pos")
    assert got == [("BTC", 0, "<b>t</b>", "u", "2024-06-21: 10:11:12"), ("BTC", 1, "x", None, None)]


SCORES = [
    # title, date, as_of, keyword, n, clean length, score
    ("비트코인 급등", "2024-06-24", 20240624, "비트코인", 20, 4000, 0.9),
    ("BTC", "2024-06-22", 20240624, "달러", 10, 2000, 0.6),
    ("날씨", "2024-06-23", 20240624, None, None, 3000, 0.0),
    ("날씨", "2024-06-24", 20240624, "정부", 90, 10000, 0.2),
    ("날씨", "2024-06-24", 20240624, "정부", 91, 10000, 0.4),
    ("날씨", "2024-06-24", 20240624, "코인", 10, 1999, 0.4),
    ("날씨", "2024-06-30", 20240701, "코인", 20, 4000, 0.4),
    ("날씨", "2024-06-25", 20240624, None, None, 3000, 0.0),
    ("날씨", "2024-06-24", 20240624, "코인", 3, 0, 0.4),
]


def test_scores(spark):
    for title, date, as_of, word, n, length, want in SCORES:
        keyword = [] if word is None else [(word, n)]
        link = spark.createDataFrame(
            [(title, f"{date}: 08:00:00", keyword, length)],
            "title string, date string, keyword array<struct<word:string,n:bigint>>, clean_length int",
        )
        got = scoring.score_links(link, scoring.ScoreRules(as_of=as_of)).first()
        assert got["score"] == want, (title, date, word)


def test_enrich_keeps_every_link(spark):
    pages = page(spark, "<p>" + "비트코인 상승, " * 300 + "</p>")
    links = spark.createDataFrame(
        [("비트코인", BASE, "2024-06-24 10:00:00"), ("other", BASE, "2024-06-24 10:00:00"),
         ("lost", "https://none", "2024-06-24 10:00:00"), ("undated", BASE, "soon")],
        "title string, link string, date string",
    )
    got = {r["title"]: r for r in scoring.enrich_links(links, pages, scoring.ScoreRules(as_of=20240624)).collect()}
    assert got["비트코인"]["keyword"][0]["word"] == "비트코인"
    assert got["비트코인"]["score"] > got["other"]["score"]
    assert got["lost"]["content"] == "" and got["lost"]["keyword"] == [] and got["lost"]["score"] == 0.4
    assert got["undated"]["score"] is None


def test_lexicon_keywords(spark):
    docs = spark.createDataFrame([("d", "aa bb bb cc cc aa dd dd dd")], "link string, content string")
    lexicon = spark.createDataFrame([("aa",), ("cc",), ("aa",)], "word string")
    assert rows(keywords.lexicon_keywords(docs, lexicon, 2), "rank") == [("d", 1, "aa", 2), ("d", 2, "cc", 2)]
    assert [r[2] for r in rows(keywords.noun_tokens(docs, lexicon=lexicon), "pos")] == ["aa", "cc", "cc", "aa"]


def test_status(spark):
    log = spark.createDataFrame(
        [("a", 200, None), ("b", 404, None), ("c", 301, None), ("d", None, "timeout"), ("e", 200, "reset")],
        "url string, status int, error string",
    )
    got = rows(routing.status_classify(log, error="error").select("url", "status", "route"), "url")
    assert got == [
        ("a", 200, "ready"), ("b", 404, "not_ready"), ("c", 301, "not_ready"),
        ("d", 500, "not_ready"), ("e", 500, "not_ready"),
    ]


def test_route_mixed(spark):
    results = spark.createDataFrame([('"http://x"',), ('{"status": 404}',), ("12",), ("{oops",), (None,)], "result string")
    got = [r["route"] for r in routing.route_mixed(results).collect()]
    assert got == ["ready", "not_ready", "reject", "reject", "reject"]


def test_delete(spark):
    table = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "url string, n int")
    urls = spark.createDataFrame([("a",), ("z",)], "url string")
    assert rows(routing.delete_flags(table, urls), "url") == [("a", True), ("z", False)]
    assert rows(routing.delete_remaining(table, urls)) == [("b", 3)]


@pytest.mark.parametrize("span", [1, 3, 1 << 20])
def test_batches(spark, span):
    lists = spark.createDataFrame(
        [("x", p * 7) for p in range(5)] + [("y", p) for p in (2, 9)], "list_id string, pos int"
    )
    got = rows(routing.batch_assign(lists, 2, span=span), "list_id", "pos")
    assert [r[2] for r in got] == [0, 0, 1, 1, 2, 0, 0]
    dense = spark.createDataFrame([("x", p) for p in range(5)], lists.schema)
    assert [r[2] for r in rows(routing.batch_assign(dense, 2, dense=True), "pos")] == [0, 0, 1, 1, 2]


def test_buckets(spark):
    lists = spark.createDataFrame([("c", n * 10) for n in range(1, 13)], "collection string, list_id int")
    got = rows(routing.bucket_assign(lists), "list_id")
    assert [r[2] for r in got] == [*range(1, 11), None, None]
    assert [r[3] for r in got] == [1, 1, 1, 1, 2, 2, 3, 3, 4, 4, None, None]
    assert [r[4] for r in got] == [False] * 10 + [True] * 2


GRAPH = [("A", "B", 0), ("A", "C", 1), ("B", "D", 0), ("C", "D", 0), ("C", "A", 1), ("D", "E", 0)]


@pytest.mark.parametrize(
    "depth, pages, want",
    [(2, 10, "A0 B1 C1 D2"), (2, 3, "A0 B1 C1"), (0, 10, "A0"), (9, 99, "A0 B1 C1 D2 E3"), (1, 1, "A0")],
)
def test_crawl(spark, depth, pages, want):
    edges = spark.createDataFrame(GRAPH, "url string, link string, pos bigint")
    start = spark.createDataFrame([("A",)], "url string")
    limits = {"max_pages": pages, "max_depth": depth}
    one = crawl.bfs_crawl(start, edges, **limits)
    many = crawl.multi_seed_crawl(start, edges, **limits)
    for visited in (one, many.withColumn("order_key", F.col("visit"))):
        got = rows(visited.select("url", "depth"), "depth", "order_key")
        assert " ".join(f"{u}{d}" for u, d in got) == want
    records = edges.withColumnRenamed("url", "page_url").withColumn("title", F.lit("t"))
    parents = {r["page_url"] for r in crawl.crawl_results(one, records, max_depth=depth).collect()}
    visited = [w for w in want.split() if int(w[1:]) < depth]
    assert parents == {w[0] for w in visited if w[0] != "E"}


def queue_crawl(edges, start, max_pages, max_depth):
    """First in, first out, by hand."""
    links = {}
    for url, link, pos in sorted(edges, key=lambda e: (e[0], e[2])):
        links.setdefault(url, []).append(link)
    queue, visited = [(start, 0)], {}
    while queue and len(visited) < max_pages:
        url, depth = queue.pop(0)
        if url in visited or depth > max_depth:
            continue
        visited[url] = depth
        if depth < max_depth:
            queue += [(link, depth + 1) for link in links.get(url, []) if link not in visited]
    return visited


def test_crawl_equals_a_queue(spark):
    import random

    rng = random.Random(5)
    edges = []
    for node in range(40):
        targets = rng.sample(range(40), rng.randint(0, 9 if node else 30))
        edges += [(f"n{node}", f"n{t}", i) for i, t in enumerate(targets)]
    frame = spark.createDataFrame(edges, "url string, link string, pos bigint").cache()
    seeds = [f"n{i}" for i in (0, 3, 7, 11)]
    for max_pages, max_depth in [(2, 2), (4, 3), (7, 3), (20, 2), (100, 4)]:
        limits = {"max_pages": max_pages, "max_depth": max_depth}
        many = crawl.multi_seed_crawl(spark.createDataFrame([(s,) for s in seeds], "url string"), frame, **limits)
        got = {}
        for row in many.collect():
            got.setdefault(row["seed"], {})[row["url"]] = row["depth"]
        for seed in seeds:
            assert got[seed] == queue_crawl(edges, seed, max_pages, max_depth)
        single = crawl.bfs_crawl(spark.createDataFrame([("n0",)], "url string"), frame, **limits)
        assert {r["url"]: r["depth"] for r in single.collect()} == got["n0"]


@pytest.mark.parametrize("span", [8, 1 << 16])
def test_crawl_by_spans_and_by_seeds_equals_a_queue(spark, monkeypatch, span):
    import random

    monkeypatch.setattr(crawl, "SPAN", span)
    rng = random.Random(9)
    edges = [("h", f"n{i}", i) for i in range(30)] + [("n2", "n2", 0)]
    for node in range(30):
        targets = rng.sample([*range(node), *range(node + 1, 30)], rng.randint(0, 8))
        edges += [(f"n{node}", f"n{t}", i + 1) for i, t in enumerate(targets)]
    frame = spark.createDataFrame(edges, "url string, link string, pos bigint").cache()
    seeds = ["h", "n1", "n2", "n9", "nowhere"]
    for max_pages, max_depth in [(3, 2), (9, 3), (28, 4)]:
        start = spark.createDataFrame([(s,) for s in seeds], "url string")
        got = rows(crawl.multi_seed_crawl(start, frame, max_pages=max_pages, max_depth=max_depth), "seed", "visit")
        for seed in seeds:
            want = queue_crawl(edges, seed, max_pages, max_depth)
            assert [r[1:] for r in got if r[0] == seed] == [(u, d, i) for i, (u, d) in enumerate(want.items())]


def test_a_crawl_moves_each_levels_rows_once(spark, monkeypatch):
    moves, write = [], crawl.materialize

    def counted(df, label):
        if label in ("crawl-level", "crawl-reached"):
            plan = df._jdf.queryExecution().executedPlan().toString()
            moves.append(plan.count("Exchange hashpartitioning"))
        return write(df, label)

    monkeypatch.setattr(crawl, "materialize", counted)
    edges = spark.createDataFrame(GRAPH, "url string, link string, pos bigint")
    seeds = spark.createDataFrame([("A",), ("C",)], "url string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        crawl.multi_seed_crawl(seeds, edges, max_pages=4, max_depth=2)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # seeds; links with full pages, parents with links, arrivals; the last level without full pages
    assert moves == [1, 5, 3]


def test_first_rows(spark):
    numbers = spark.range(1000).select((F.col("id") * 37 % 1000).alias("v"))
    for k in (0, 1, 499, 1000, 2000):
        got = sorted(r["v"] for r in topk.first_rows(numbers, "v", k).collect())
        assert got == list(range(min(k, 1000)))


def test_flatten(spark):
    maps = spark.createDataFrame(
        [({"p": [("t", "l", "d"), ("u", "m", "d")], "q": []},)],
        "results map<string, array<struct<title:string,link:string,date:string>>>",
    )
    assert rows(reshape.flatten_maps(maps), "pos") == [("p", 0, "t", "l", "d"), ("p", 1, "u", "m", "d")]
    nested = spark.createDataFrame([([[1, 2], [], [3]], [4])], "two array<array<int>>, one array<int>")
    assert rows(reshape.flatten_nested(nested, column="two"), "pos") == [(0, 1), (1, 2), (2, 3)]
    assert rows(reshape.flatten_nested(nested, column="one")) == [(0, 4)]


def test_json_records_reject(spark):
    texts = spark.createDataFrame([('{"id": 1, "link": "u"}',), ("[1]",), ("{",), (None,)], "value string")
    got = [(r["id"], r["link"], r["malformed"]) for r in tables.json_records(texts).collect()]
    assert got == [(1, "u", False), (None, None, True), (None, None, True), (None, None, True)]


def test_split_rejects(spark):
    links = spark.createDataFrame([("u", 0.4), (None, 0.1), ("v", None)], "url string, score double")
    good, bad = tables.split_rejects(
        links, {"url": F.col("url").isNotNull(), "score": F.col("score").between(0, 1)}
    )
    assert rows(good) == [("u", 0.4)]
    assert [r["reject_reason"] for r in bad.collect()] == ["url", "score"]


def test_csv(spark, tmp_path):
    log = spark.createDataFrame([(1, 'say "hi", you'), (2, None)], "id int, text string")
    path = csvfiles.log_export(log, str(tmp_path), dt.datetime(2024, 6, 24, 9, 8, 7))
    assert path.endswith("access_log_20240624-090807.csv")
    back = spark.read.schema(log.schema).option("escape", '"').csv(path)
    assert rows(back, "id") == [(1, 'say "hi", you'), (2, None)]
    csvfiles.csv_saving(log, str(tmp_path / "named"))
    named = spark.read.option("header", True).option("escape", '"').csv(str(tmp_path / "named"))
    assert named.columns == ["id", "text"] and named.count() == 2


@pytest.mark.parametrize("fmt", ["parquet", "orc", "json"])
def test_write_table(spark, tmp_path, fmt):
    links = spark.createDataFrame([("u", "t", 1)], "url string, title string, n int")
    path = str(tmp_path / fmt)
    for _ in range(2):
        tables.write_table(links, path, ("url", "title"), fmt=fmt)
    assert rows(tables.read_table(spark, path, fmt=fmt).select("url", "title")) == [("u", "t")] * 2


def test_lossless_on_odd_rows(spark):
    rows_ = [(1, 5), (1, None), (None, 7), (None, 3), (1, 2)]
    got = routing.batch_assign(spark.createDataFrame(rows_, "list_id int, pos int"), 2, span=2)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(
        [(1, None, 0), (1, 2, 0), (1, 5, 1), (None, 3, 0), (None, 7, 0)], key=str
    )
    ties = [("y", 1, "b"), ("y", 1, "a"), ("y", 1, "a"), ("y", None, "c"), ("y", None, "c"), ("y", 2, "a")]
    got = routing.batch_assign(spark.createDataFrame(ties, "list_id string, pos int, x string"), 2)
    assert sorted(((r.batch, r.pos or 0, r.x) for r in got.collect())) == [
        (0, 0, "c"), (0, 0, "c"), (1, 1, "a"), (1, 1, "a"), (2, 1, "b"), (2, 2, "a")
    ]
    tied = [("c", 1, "a"), ("c", 1, "b"), ("c", 1, "b"), (None, 2, "z")]
    got = routing.bucket_assign(spark.createDataFrame(tied, "collection string, list_id int, x string"))
    assert sorted((r.collection or "", r.x, r.slot, r.rejected) for r in got.collect()) == [
        ("", "z", 1, False), ("c", "a", 1, False), ("c", "b", 2, False), ("c", "b", 3, False)
    ]
    nested = spark.createDataFrame([(1, [[1, 2], None, [3]])], "k int, x array<array<int>>")
    got = reshape.flatten_nested(nested, column="x", keys=("k",))
    assert [r.item for r in got.orderBy("pos").collect()] == [1, 2, 3]


def test_unreadable_bodies_are_kept_apart(spark):
    bodies = [(1, None), (2, "<html>"), (3, '{"items": []}'), (4, '{"items": [{"title": "t"}]}')]
    parsed = api.parse_api_body(spark.createDataFrame(bodies, "k int, body string"))
    assert rows(api.api_rejects(parsed, keys=("k",))) == [(1, "no body"), (2, "unreadable body")]
    assert [r.k for r in api.api_items(parsed, keys=("k",)).collect()] == [4]


def test_the_latest_page_of_a_url_counts(spark):
    links = spark.createDataFrame([("t", "u", "2024-06-24 00:00:00")] * 2, "title string, link string, date string")
    pages = [("u", 1, "<p>old</p>"), ("u", 3, "<p>new</p>"), ("u", 2, "<p>mid</p>")]
    pages = spark.createDataFrame(pages, "url string, fetched_at int, html string")
    got = scoring.enrich_links(links, pages, scoring.ScoreRules(as_of=20240624)).collect()
    assert [r.content for r in got] == ["new"] * 2


def test_errors_are_failures(spark):
    links = spark.createDataFrame([("t", "u", "d"), ("t", "v", "d")], "title string, link string, date string")
    log = [("u", 200, None, 1), ("u", 200, "timeout", 2), ("v", 200, "timeout", 1), ("v", 200, None, 2)]
    log = spark.createDataFrame(log, "url string, status int, error string, fetched_at int")
    got = routing.classify_links(links, log, "now").collect()
    assert {r.link: r.status for r in got} == {"u": 500, "v": 200}


def test_status_flow_with_hot_links(spark):
    links = spark.range(0, 90, numPartitions=4).select(
        F.lit("t").alias("title"),
        F.concat(F.lit("u"), F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id"))).alias("link"),
        F.lit("2024-06-24 00:00:00").alias("date"),
    )
    log = spark.createDataFrame(
        [("u0", 200), ("u1", 404), ("u2", 200)], "url string, status int"
    ).withColumn("fetched_at", F.lit("2024-06-24").cast("timestamp_ntz"))
    pages = spark.createDataFrame([("u0", "<p>코인</p>"), ("u5", "x")], "url string, html string")
    rules = scoring.ScoreRules(as_of=20240624)
    flow = collection.status_flow(links, log, pages, rules, "now")
    assert flow.ready.count() == 31 and flow.not_ready.count() == 59
    for rows_ in (flow.ready, flow.not_ready):
        plan = rows_._jdf.queryExecution().executedPlan().toString()
        assert "SinglePartition" not in plan
