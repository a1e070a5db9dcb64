"""Many keywords at once, tiers as a table, and crawls whose seed reaches most pages."""

from __future__ import annotations

import random
import time

from pyspark.sql import functions as F

import fixtures as fx
from linkloom.functions import text as X
from linkloom.operators import crawl, keywords, scoring


def test_many_words_equal_one_by_one(spark):
    rng = random.Random(6)
    letters = "abc 가나다\U0001f600\n.("
    words = ["".join(rng.choices(letters, k=rng.randint(2, 5))) for _ in range(60)]
    texts = ["".join(rng.choices(letters, k=rng.randint(0, 12))) for _ in range(400)] + [None, "", "a", words[0], words[1][:-1]]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    got = frame.select("t", X.contains_any(F.col("t"), words).alias("found"), X._contains_each(F.col("t"), words).alias("plain")).collect()
    assert [r.found for r in got] == [r.plain for r in got]
    assert {r.found for r in got} == {True, False, None}
    long = ["x" * n + "y" for n in range(1, 60)]
    assert frame.select(X.contains_any(F.lit("a" + "x" * 30 + "y"), long).alias("f")).first().f
    assert not frame.select(X.contains_any(F.lit("x" * 80), long).alias("f")).first().f
    assert X.clean_pieces(F.lit("a, b"), words) is not None


def test_cost_does_not_grow_with_the_words(spark):
    rng = random.Random(7)
    word = lambda: "".join(rng.choices("abcdefghijklmnop", k=rng.randint(6, 9)))
    words = [word() for _ in range(10_000)]
    texts = spark.createDataFrame([(" ".join(rng.choices("qrstuvwxyz", k=1)[0] + word()[1:] for _ in range(60)),) for _ in range(300)], "t string")
    texts = texts.crossJoin(spark.range(40)).select("t").cache()
    texts.count()

    def seconds(some):
        found, took = texts.filter(X.contains_any(F.col("t"), some)), []  # the plan is made once, whatever the rows
        for _ in range(3):
            start = time.perf_counter()
            found.count()
            took.append(time.perf_counter() - start)
        return min(took)

    few, many = seconds(words[:100]), seconds(words)
    assert many < 3 * max(few, 0.3), (few, many)


def test_tiers_from_a_table(spark):
    tiers = spark.createDataFrame(
        [("the", "coin"), ("the", "other"), ("de", "coin"), ("der", "other"), ("la", "other"), ("la", "other")]
        + [(f"w{i}", "other") for i in range(5000)], "word string, tier string",
    )
    docs = fx.docs(spark, "/root/testdata/sf0.001")
    by_rules = scoring.relevance_score(docs, fx.RULES).select("doc_id", "tier", "tier_effect", "score")
    by_table = scoring.relevance_score(docs, fx.RULES, tiers=tiers).select("doc_id", "tier", "tier_effect", "score")
    assert sorted(map(tuple, by_rules.collect())) == sorted(map(tuple, by_table.collect()))
    assert {r.tier for r in by_table.collect()} >= {"coin", "other"}


def test_a_seed_that_reaches_most_pages(spark, monkeypatch):
    """One of three seeds reaches 900 of 940 pages; its arrivals are ranked 64 at a time."""
    monkeypatch.setattr(crawl, "SPAN", 64)
    pairs = [("h", f"m{i}", i) for i in range(30)] + [(f"m{i}", f"p{i * 31 + j}", j) for i in range(30) for j in range(29)]
    pairs += [("a", f"q{i}", i) for i in range(20)] + [("b", f"r{i}", i) for i in range(17)]
    edges = spark.createDataFrame(pairs, "url string, link string, pos long")
    seeds = spark.createDataFrame([("h",), ("a",), ("b",)], "url string")
    got = crawl.multi_seed_crawl(seeds, edges, max_pages=700, max_depth=2)
    want = {}
    out = {}
    for url, link, _ in sorted(pairs, key=lambda p: (p[0], p[2])):
        out.setdefault(url, []).append(link)
    for seed in ("h", "a", "b"):
        queue = [(seed, 0)]
        for url, depth in queue:
            if depth < 2:
                queue += [(link, depth + 1) for link in out.get(url, []) if all(link != u for u, _ in queue)]
        want |= {(seed, u): (d, v) for v, (u, d) in enumerate(queue[:700])}
    assert {(r.seed, r.url): (r.depth, r.visit) for r in got.collect()} == want
    reached = spark.range(900).select(F.lit("h").alias("seed"), (F.col("id") * 3).alias("arrival"))
    placed = crawl._first_of_each(reached, "seed", "arrival", 1 << 40)
    assert [r["rank"] for r in placed.orderBy("arrival").collect()] == list(range(1, 901))
    sizes = reached.groupBy(F.floor(F.col("arrival") / crawl.SPAN)).count().collect()
    assert max(r["count"] for r in sizes) <= 900 / 4


def test_compounds(spark):
    lexicon = spark.createDataFrame([(w,) for w in ["비트코인", "비트", "코인", "가격", "시장", "가", "코인시장", None, "비트"]], "word string")
    words = ["비트코인가격", "비트코인시장", "코인시장가격", "새코인값", "시장", "모름", "비트트비트", "", None, "비트" * 50]
    frame = spark.createDataFrame([(w,) for w in words] * 2, "word string")
    got = {}
    for r in keywords.compound_parts(frame, lexicon).orderBy("word", "part").collect():
        got.setdefault(r.word, []).append(r.text)
    assert got == {
        "비트코인가격": ["비트코인", "가격"],
        "비트코인시장": ["비트코인", "시장"],
        "코인시장가격": ["코인시장", "가격"],
        "새코인값": ["코인"],
        "시장": ["시장"],
        "비트트비트": ["비트", "비트"],
        "비트" * 50: ["비트"] * 50,
    }
    docs = spark.createDataFrame([(1, "새 비트코인가격이 시장에서"), (2, None), (3, "x")], "link int, content string")
    found = keywords.compound_tokens(docs, lexicon).orderBy("pos", "part").collect()
    assert [(r.link, r.part, r.word) for r in found] == [(1, 0, "비트코인"), (1, 1, "가격"), (1, 0, "시장")]
    assert keywords.compound_parts(frame, lexicon.limit(0)).count() == 0
