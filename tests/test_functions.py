"""Column functions on hand-made rows and against the standard library."""

from __future__ import annotations

import html as stdlib_html
import json
import random
from collections import Counter
from html.parser import HTMLParser
from urllib.parse import urljoin, urlparse

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from linkloom.functions import dates, html, score, text, urls


def column(spark, values, expr, kind="string"):
    """Values of ``expr`` over one column ``x``, in input order."""
    rows = spark.createDataFrame(list(enumerate(values)), f"i int, x {kind}")
    return [r[0] for r in rows.orderBy("i").select(expr.alias("y")).collect()]


def root(url):
    parts = urlparse(url)
    if not parts.scheme:
        return f"https://{parts.netloc or url}/"
    return f"{parts.scheme}://{parts.netloc}/"


def test_url_root(spark):
    expected = {
        "naver.com": "https://naver.com/",
        "naver.com/x/y": "https://naver.com/x/y/",
        "//a.b/c": "https://a.b/",
        "http://a.b/c?d": "http://a.b/",
        "https://u:p@h.com:80/x": "https://u:p@h.com:80/",
        "localhost:8080/x": "localhost:///",
        "HTTP://A.b/c": "http://A.b/",
        "": "https:///",
    }
    got = column(spark, list(expected), urls.url_root(F.col("x")))
    assert got == list(expected.values()) == [root(u) for u in expected]
    again = column(spark, got[:5], urls.url_root(F.col("x")))
    assert again[0] == got[0] and again[2:] == got[2:5]


def test_url_join_matches_the_standard_library(spark):
    hrefs = [
        "/x", "//cdn.x/y", "/../x", "/a/./b/../c?q=1#f", "/", "/a b", "/a/..", "/a/.", "/..//a",
        "/a//b", "/../../..", "//h/a/../b", "/x?", "/x#", "/x?#", "/x?a#", "/.hidden/x", "/a/...",
        "foo/bar", "", "#x", "mailto:a@b.c", "/x?y=/../z",
    ]
    for base in ("https://a.b/news/1", "naver.com/x/y", "http://h:80", "localhost:8080/x", "//q.r/s"):
        got = column(spark, hrefs, urls.url_join(F.lit(base), F.col("x")))
        want = [urljoin(root(base), h) if h.startswith("/") else h for h in hrefs]
        assert got == want, base


def test_headline_clean_and_squash(spark):
    samples = {
        "비트코인, 상승! 12시간 전...": "비트코인 상승 ",
        "a_b-c v1.2 <b>é</b>": "a_bc v12 béb",
        "x12시간 전": "x12시간 전",
        "3시간 전후": "3시간 전후",
    }
    assert column(spark, list(samples), text.headline_clean(F.col("x"))) == list(samples.values())
    assert column(spark, [" a b \t", "　첫 기사\xa0"], text.title_squash(F.col("x"))) == [
        "ab", "첫기사",
    ]


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(max_size=20), min_size=20, max_size=40))
def test_strip_is_the_standard_strip(spark, samples):
    assert column(spark, samples, text.strip(F.col("x"))) == [s.strip() for s in samples]


def test_dates(spark):
    pub = [
        "Fri, 21 Jun 2024 10:11:12 +0900", "Fri, 1 Jun 2024 1:2:3 Z", "21 Jun 2024 10:11:12 +0900",
        "Fri, 31 Jun 2024 10:11:12 +0900", "Fri, 21 Foo 2024 10:11:12 +0900", "", None,
    ]
    got = column(spark, pub, dates.pubdate_norm(F.col("x")))
    assert got == ["2024-06-21: 10:11:12", "2024-06-01: 01:02:03", None, None, None, None, None]
    stamps = ["2024-06-21: 10:11:12", "2024-06-21 10:11:12", "2024-02-30 00:00:00", "soon", None]
    assert column(spark, stamps, dates.date_int(F.col("x"))) == [20240621, 20240621, None, None, None]


def test_dates_do_not_depend_on_the_session_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        # 02:30 does not exist on that day in New York.
        pub = ["Sun, 10 Mar 2024 02:30:00 +0900"]
        assert column(spark, pub, dates.pubdate_norm(F.col("x"))) == ["2024-03-10: 02:30:00"]
        late = F.lit("2024-06-23 15:00:00").cast("timestamp_ntz")
        assert str(column(spark, [""], dates.seoul_date(late))[0]) == "2024-06-24"
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_keywords(spark):
    samples = ["코인 달러 코인 달러 채굴", "가 나 다", "", "b1 b2 aa bb aa bb cc", "비트코인은 비트코인이 달러를"]
    words = text.tokens(F.col("x"))
    one = column(spark, samples, text.top_words(words))
    assert [[tuple(k) for k in ks] for ks in one] == [
        [("코인", 2)], [], [], [("aa", 2)], [("비트코인", 2)],
    ]
    three = column(spark, samples, text.top_words(words, 3))
    assert [tuple(k) for k in three[0]] == [("코인", 2), ("달러", 2), ("채굴", 1)]
    json_text = column(spark, samples, text.keyword_json(text.top_words(words)))
    assert json_text[:2] == ['[["코인", 2]]', "[]"]


@pytest.mark.parametrize("k", [1, 2, 3, 7])
def test_top_words_equals_a_counter(spark, k):
    rng = random.Random(k)
    texts = [
        " ".join(rng.choice(["aa", "bb", "cc", "dd", "aaa", "éé", "비트"]) for _ in range(n))
        for n in [0, 1, 2, 3, 5, 8, 13, 40, 200]
        for _ in range(6)
    ]
    got = column(spark, texts, text.top_words(text.tokens(F.col("x"), particles=False), k))
    for sample, found in zip(texts, got):
        assert [tuple(f) for f in found] == Counter(sample.split()).most_common(k), sample


def test_keyword_json_escapes_like_json(spark):
    rows = spark.createDataFrame([([('a"b\\c', 3), ("비트", 1)],)], "k array<struct<word:string,n:bigint>>")
    got = rows.select(text.keyword_json(F.col("k"))).first()[0]
    assert got == json.dumps([['a"b\\c', 3], ["비트", 1]], ensure_ascii=False)


def test_sentence_filter(spark):
    sample = "비트코인 상승, 날씨 맑음, 달러 약세"
    pieces = column(spark, [sample], text.clean_pieces(F.col("x")))[0]
    assert pieces == ["비트코인 상승", " 달러 약세"]
    assert column(spark, [sample], text.clean_length(text.clean_pieces(F.col("x")))) == [14]
    edge = ["x" * 30, "x" * 31, "  " + "x" * 30 + "\t", "😀" * 31]
    assert [len(p) for p in column(spark, edge, text.clean_pieces(F.col("x")))] == [0, 1, 0, 1]


def test_share_rounds_halves_to_even(spark):
    cases = [(1, 800), (3, 800), (20, 4000), (91, 10000), (5, 3), (3, 0), (None, 10)]
    rows = spark.createDataFrame([(i, *c) for i, c in enumerate(cases)], "i int, n bigint, len int")
    got = [r[0] for r in rows.orderBy("i").select(score.share_hundredths(F.col("n"), F.col("len"))).collect()]
    assert got == [12, 38, 50, 91, 100, 0, None]


SAMPLES = [
    "<p>a<!-- x -->b</p><script>1</script> <b> c </b>",
    "x &amp;lt; y &#44060; &#x1F600; &eacute;&nbsp;&unknown; & z &#xD800;",
    '<a title="a>b" href=\'/q\'>in</a>out <style>p > a {}</style><br>end',
    "no tags",
    "<div><p>one\n two</p>　<p>\xa0three</p></div>",
    "a < b and c",
    "open <script>never closed <b>x</b>",
    "",
]


class Reader(HTMLParser):
    """Visible text nodes by the standard library's parser."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.nodes, self.hidden = [], 0

    def handle_starttag(self, tag, attrs):
        self.hidden += tag in ("script", "style")
        self.nodes.append("\x00")

    def handle_endtag(self, tag):
        self.hidden -= tag in ("script", "style")
        self.nodes.append("\x00")

    def handle_comment(self, data):
        self.nodes.append("\x00")

    def handle_data(self, data):
        if not self.hidden:
            self.nodes.append(data)


def parsed_text(source):
    reader = Reader()
    reader.feed(source)
    reader.close()
    nodes = "".join(reader.nodes).split("\x00")
    return " ".join(n.strip() for n in nodes if n.strip())


def test_visible_text(spark):
    got = column(spark, SAMPLES, html.visible_text(F.col("x")))
    assert got[0] == "a b c"
    assert got[1] == "x &lt; y 개 😀 é\xa0&unknown; & z &#xD800;"
    assert got[2] == "in out end"
    assert got[5:] == ["a < b and c", "open", ""]
    assert column(spark, [None], html.visible_text(F.col("x"))) == [""]


def test_visible_text_equals_a_parser_on_every_page(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    rows = pages.select("html", html.visible_text(F.col("html"))).collect()
    assert len(rows) == 250
    for source, got in rows:
        assert got == parsed_text(source)


def test_entities_match_the_standard_library(spark):
    names = ["&amp;", "&lt;", "&Eacute;", "&hellip;", "&#39;", "&apos;", "&#x41;", "&euro;", "&&amp;"]
    got = column(spark, names, html.decode_entities(F.col("x")))
    assert got == [stdlib_html.unescape(n) for n in names]


def test_attribute(spark):
    tags = {
        '<a href="/x">': "/x",
        "<a class=b href='/y' id=z>": "/y",
        "<a\n HREF = /z>": "/z",
        '<a data-href="/no" title=" href=\'/no\' ">': None,
        '<a href="">': "",
        "<a href>": "",
        '<a hrefx="1">t</a> href="/no"': None,
        '<a href="/a?x=1&amp;y=2">': "/a?x=1&y=2",
        '<a href="it\'s">': "it's",
        '<a/href="/slash">': "/slash",
    }
    assert column(spark, list(tags), html.attribute(F.col("x"), "href")) == list(tags.values())


def test_long_attributes_do_not_overflow(spark):
    long = "<a " + " ".join(f'd{i}="{"x>" * 50}"' for i in range(5000)) + ' href="/end">t</a>'
    assert column(spark, [long], html.attribute(F.col("x"), "href")) == ["/end"]
    assert column(spark, [long], html.visible_text(F.col("x"))) == ["t"]
