"""Elements by depth of tags: against a plain stack, and in time that goes with the page."""

from __future__ import annotations

import random
import re
import time

from pyspark.sql import functions as F

from linkloom.functions import html as H


def plain(html, tag, wanted):
    """Whole elements by the rule: up to the tag where the depth falls below the element's own."""
    parts = re.split(rf"(?i)(?=</?{tag}[\s/>])", html)
    found = []
    for i, part in enumerate(parts):
        if not re.match(rf"(?i)<{tag}[\s/>]", part) or wanted not in part:
            continue
        depth, end = 1, len(parts)
        for j in range(i + 1, len(parts)):
            depth += bool(re.match(rf"(?i)<{tag}[\s/>]", parts[j])) - bool(re.match(rf"(?i)</{tag}[\s>]", parts[j]))
            if depth < 1:
                end = j
                break
        found.append("".join(parts[i:end]))
    return found


def test_running_sums(spark):
    for n in (0, 1, 2, H.SUM_BLOCK - 1, H.SUM_BLOCK, H.SUM_BLOCK + 1, 5 * H.SUM_BLOCK + 3):
        values = [(i * 7) % 5 - 2 for i in range(n)]
        frame = spark.createDataFrame([(values,)], "v array<int>")
        want = [sum(values[: i + 1]) for i in range(n)]
        assert frame.select(H.running_sums(F.col("v")).alias("s")).first().s == want


def test_elements_of_unbalanced_pages(spark):
    rng = random.Random(2)
    pieces = ["<div>", "<div class=x>", "</div>", "</div>", "text", "<p>", "</DIV >", "<DIV/>", "<divx>", ""]
    pages = ["".join(rng.choices(pieces, k=rng.randint(0, 400))) for _ in range(60)]
    frame = spark.createDataFrame([(i, p) for i, p in enumerate(pages)], "i int, html string")
    wanted = lambda p: F.contains(p, F.lit("class"))
    got = {r.i: r.found for r in frame.select("i", H.whole_elements(F.col("html"), "div", wanted).alias("found")).collect()}
    assert got == {i: plain(p, "div", "class") for i, p in enumerate(pages)}


def test_time_goes_with_the_number_of_tags(spark):
    def seconds(items):
        page = "<ul class='l'>" + "<li id='26'><ul><li>x</li></ul></li>" * items + "</ul>"
        frame = spark.createDataFrame([(page,)], "html string").cache()
        frame.count()
        found = H.whole_elements(F.col("html"), "li", lambda p: F.contains(p, F.lit("26")))
        took = []
        for _ in range(3):
            start = time.perf_counter()
            assert frame.select(F.size(found).alias("n")).first().n == items
            took.append(time.perf_counter() - start)
        return min(took)

    seconds(4000)
    assert seconds(16_000) < 5 * seconds(4000)
