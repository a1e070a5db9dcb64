"""Breadth-first crawling over landed links, for one start or many at once.

A crawl is a loop of at most ``max_depth + 1`` joins.  The driver holds only the loop:
frontiers and visited pages stay tables, written to the shared folder between levels.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkloom.operators.topk import first_rows
from linkloom.session import materialize


def frontier_step(frontier: DataFrame, edges: DataFrame, visited: DataFrame) -> DataFrame:
    """Pages reached from ``frontier`` and not visited: seed, url, depth, order_key.

    ``frontier`` has seed, url, depth, order_key; ``edges`` url, link, pos; ``visited``
    seed, url.  A page reached twice keeps its first arrival, the smallest order key.
    A key is the parent's key and the link's position, so keys sort as a queue would.
    """
    reached = frontier.join(edges, "url").select(
        "seed",
        F.col("link").alias("url"),
        (F.col("depth") + 1).alias("depth"),
        F.array_append("order_key", F.col("pos").cast("bigint")).alias("order_key"),
    )
    first = reached.groupBy("seed", "url", "depth").agg(F.min("order_key").alias("order_key"))
    return first.join(visited.select("seed", "url"), ["seed", "url"], "left_anti")


#: Values (positions of a page's links, arrivals in a crawl) that are ranked together.
SPAN = 1 << 16


def _first_of_each(rows: DataFrame, group: str, value: str, limit: int) -> DataFrame:
    """The first ``limit`` rows of each group by ``value``, with their ``rank`` from 1.

    Values are distinct in a group and rows are counted by span of values, so a row's rank is
    its place in its span after all earlier spans.  Spans that start beyond the limit are
    dropped.  No task ranks more than SPAN rows of a group, however large the group.
    """
    spans = rows.withColumn("span_", F.floor(F.col(value) / SPAN))
    earlier = Window.partitionBy(group).orderBy("span_")
    before = (
        spans.groupBy(group, "span_")
        .agg(F.count("*").alias("n_"))
        .withColumn("before_", F.sum("n_").over(earlier) - F.col("n_"))
        .filter(F.col("before_") < limit)
        .drop("n_")
    )
    inside = Window.partitionBy(group, "span_").orderBy(value)
    ranked = spans.withColumn("rank_", F.row_number().over(inside)).filter(F.col("rank_") <= limit)
    placed = ranked.join(before, [group, "span_"]).withColumn("rank", F.col("rank_") + F.col("before_"))
    return placed.filter(F.col("rank") <= limit).select(*rows.columns, "rank")


def _leading_edges(edges: DataFrame, limit: int) -> DataFrame:
    """The first ``limit`` links of each page with their rank from 1: url, link, rank.

    Exact for a crawl of at most ``limit`` pages: a later link of the page has
    ``limit`` distinct pages queued or visited before it, so it is never visited.
    A hub's links never meet in one task.
    """
    first = _first_of_each(edges.select("url", "link", "pos"), "url", "pos", limit)
    return first.select("url", "link", F.col("rank").cast("int").alias("rank"))


def _numbered(arrivals: DataFrame, max_pages: int, *, last_level: bool) -> DataFrame:
    """The pages that a level takes, from its arrivals: seed, url, arrival, taken, full.

    ``taken`` pages of the seed were visited before; those come along with arrival -1, so no join
    leaves them out.  A page counts by its first arrival.  Adds visit, brings taken up to date and
    sets ``open`` if the page is to be followed: the seed has room, and no earlier page of the level
    is ``full``, for a page with ``max_pages`` links leaves no room for the links of later ones.
    So crawls through hubs follow one hub and not the product of all.

    While a seed has at most SPAN arrivals they move once, to a task of the seed.  Otherwise
    they are ranked by spans, so a seed that reaches most pages is ranked by many tasks.
    """
    bounded = (max_pages + 1) ** 2 <= SPAN
    if bounded:
        arrivals = arrivals.repartition("seed")
    first = [F.min("arrival").alias("arrival"), F.max("taken").alias("taken"), F.max("full").alias("full")]
    reached = arrivals.groupBy("seed", "url").agg(*first).filter("arrival >= 0")
    if bounded:
        queue = Window.partitionBy("seed").orderBy("arrival")
        ranked = reached.withColumn("rank", F.row_number().over(queue))
    else:
        ranked = _first_of_each(materialize(reached, "crawl-reached"), "seed", "arrival", max_pages)
    visit = (F.col("taken") + F.col("rank") - 1).alias("visit")
    pages = ranked.select("seed", "url", visit, "taken", "full").filter(F.col("visit") < max_pages)
    if last_level:
        return pages
    counts = {"n": F.count(F.lit(1)), "last": F.min(F.when(F.col("full"), F.col("visit")))}
    if bounded:
        own = Window.partitionBy("seed")
        pages = pages.withColumns({name: count.over(own) for name, count in counts.items()})
    else:
        pages = materialize(pages, "crawl-pages")
        pages = pages.join(pages.groupBy("seed").agg(*[c.alias(name) for name, c in counts.items()]), "seed")
    before_last = F.col("last").isNull() | (F.col("visit") <= F.col("last"))
    pages = pages.withColumn("taken", F.col("taken") + F.col("n"))
    return pages.withColumn("open", (F.col("taken") < max_pages) & before_last)


def multi_seed_crawl(
    seeds: DataFrame, edges: DataFrame, *, max_pages: int, max_depth: int
) -> DataFrame:
    """Pages visited from every seed: seed, url, depth, visit (0, 1, 2, ...).

    ``seeds`` has one column ``url``; all seeds advance together, one join per level.
    ``edges`` holds url, link, pos with distinct positions and links per url.  The
    order of a level is one number, the parent's visit and the link's rank, so the
    first arrival of a page is a plain hash aggregation.  Each level row carries how many
    pages its seed has taken and whether it is followed, so a level moves the pages that
    it follows, their links, and what they reach, each once.
    """
    columns = ["seed", "url", "depth", "visit"]
    level = seeds.select(
        F.col("url").alias("seed"),
        "url",
        F.lit(0).alias("depth"),
        F.lit(0).cast("bigint").alias("visit"),
    ).distinct()
    if max_pages < 1 or max_depth < 0:
        return level.limit(0)
    if max_depth == 0 or max_pages == 1:
        return materialize(level, "crawl-level")
    level = level.withColumns({"taken": F.lit(1).cast("bigint"), "open": F.lit(True)})
    level = materialize(level, "crawl-level")
    levels = [level]
    followed = materialize(_leading_edges(edges, max_pages), "crawl-edges")
    full = followed.filter(F.col("rank") == max_pages).select(F.col("url").alias("link"), F.lit(True).alias("full"))
    full = materialize(full, "crawl-full")
    arrival = F.col("visit") * (max_pages + 1) + F.col("rank")
    for depth in range(1, max_depth + 1):
        last_level = depth == max_depth
        links = followed.withColumn("full", F.lit(False)) if last_level else followed.join(full, "link", "left")
        reached = (
            level.filter("open")
            .select("seed", "url", "visit", "taken")
            .join(links, "url")
            .select("seed", F.col("link").alias("url"), arrival.alias("arrival"), "taken", F.coalesce("full", F.lit(False)).alias("full"))
        )
        visited = (
            reduce(DataFrame.unionByName, levels)
            .filter((F.col("taken") < max_pages) & F.col("url").isNotNull())
            .select("seed", "url", F.lit(-1).cast("bigint").alias("arrival"), F.lit(0).cast("bigint").alias("taken"), F.lit(False).alias("full"))
        )
        taken = _numbered(reached.unionByName(visited), max_pages, last_level=last_level)
        if last_level:
            taken = taken.withColumn("open", F.lit(False))
        taken = taken.withColumn("depth", F.lit(depth)).select(*columns, "taken", "open")
        level = materialize(taken, "crawl-level")
        if level.isEmpty():
            break
        levels.append(level)
    return reduce(DataFrame.unionByName, levels).select(*columns)


def bfs_crawl(
    start: DataFrame, edges: DataFrame, *, max_pages: int, max_depth: int
) -> DataFrame:
    """Pages visited from one start url (a one-row table): url, depth, order_key.

    One crawl may visit any number of pages: its limit is a distributed top-k.
    """
    level = start.select(
        "url", F.lit(0).alias("depth"), F.array().cast("array<bigint>").alias("order_key")
    ).distinct()
    if max_pages < 1 or max_depth < 0:
        return level.limit(0)
    level = materialize(level, "crawl-level")
    levels, visited_pages = [level], 1
    for _ in range(max_depth):
        room = max_pages - visited_pages
        if room < 1:
            break
        visited = reduce(DataFrame.unionByName, levels)
        reached = frontier_step(
            level.withColumn("seed", F.lit(0)), edges, visited.withColumn("seed", F.lit(0))
        ).drop("seed")
        level = materialize(reached, "crawl-level")
        found = level.count()
        if found > room:
            level, found = first_rows(level, "order_key", room), room
        if found == 0:
            break
        levels.append(level)
        visited_pages += found
    return reduce(DataFrame.unionByName, levels)


def crawl_results(
    visited: DataFrame, records: DataFrame, *, max_depth: int, page: str = "page_url"
) -> DataFrame:
    """Link records of the visited pages above ``max_depth``.

    ``records`` is keyed by ``page``; a page without a body has none.
    """
    parents = visited.filter(F.col("depth") < max_depth).withColumnRenamed("url", page)
    carried = ["seed"] if "seed" in visited.columns else []
    return parents.select(*carried, page, "depth").join(records, page)


def edges_from_records(records: DataFrame, *, page: str = "page_url") -> DataFrame:
    """Followed links of link records: url, link, pos of the first mention."""
    http: Column = F.startswith("link", F.lit("http"))
    return (
        records.filter(http)
        .groupBy(F.col(page).alias("url"), "link")
        .agg(F.min("pos").alias("pos"))
    )


def deep_crawl(
    ready: DataFrame,
    records: DataFrame,
    *,
    max_pages: int = 1,
    max_depth: int = 1,
    page: str = "page_url",
    edges: DataFrame | None = None,
) -> DataFrame:
    """Crawl from every ready url and return the link records of each crawl."""
    graph = edges_from_records(records, page=page) if edges is None else edges
    visited = multi_seed_crawl(ready, graph, max_pages=max_pages, max_depth=max_depth)
    return crawl_results(visited, records, max_depth=max_depth, page=page)
