"""Near-duplicates by bottom-k sketches from one hash function, verified by exact Jaccard."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkloom.llm.bitmap import hash_bitmap, may_hold
from linkloom.llm.components import components
from linkloom.llm.copies import keyed, with_decisions, without
from linkloom.llm.words import mixed, word_hashes
from linkloom.session import discard, materialize

#: Values that a sketch retains.
K = 64
#: Of the K smallest values of a union, so many at least are common to two sets whose similarity
#: is 0.8: by the binomial law all but about one pair in a million at exactly 0.8 have 34 or more,
#: and practically all that are more alike.  Sets of up to K shingles are compared without any loss.
COMMON = 34
#: Percent of the union that two linked sets share at least.
SIMILAR = 80
#: Bits of a sketch value by which its frequency is counted, for the order of the inverted lists.
COUNTER_BITS = 16
#: Inverted lists that two similar sketches share at least, of those that they are put into.
SHARED = 4
#: Times that classes are compared with members drawn by lot, before what is left is compared in full.
DRAWS = 3
#: A draw that links fewer than one in so many open classes is the last one.
FEW = 1000
#: Members of an open list up to which they meet in it one with another; members of longer lists meet
#: under the rarest values of their whole sets.
SHORT = 128
#: Ratio of the sizes of whole sets that are listed together.
STEP = 1.05
#: Members at most that are drawn by lot from each list of whole sets.
LOTS = 64
#: Values of whole sets that a task gathers before it writes them.
GATHERED = 1 << 16


def shingle_sets(texts: pa.Array, width: int) -> Iterator[np.ndarray]:
    """Sorted distinct hashes of the shingles of each text of a column without nulls."""
    for _, hashes, counts in word_hashes(texts, lower=True):
        runs, begin = _shingles(hashes, width), 0
        for n in counts.tolist():
            if n >= width:
                yield np.unique(runs[begin : begin + n - width + 1])
            else:  # the whole sequence, if any
                yield _shingles(hashes[begin : begin + n], n)
            begin += n


def _shingles(hashes: np.ndarray, width: int) -> np.ndarray:
    """The hash of each run of ``width`` words."""
    n = hashes.size - width + 1
    if n < 1 or not width:
        return hashes[:0]
    whole = np.full(n, width, np.uint64)
    for i in range(width):
        whole = mixed(whole ^ hashes[i : i + n]) + np.uint64(0x9E3779B97F4A7C15)
    return mixed(whole)


def fingerprint(values: np.ndarray) -> tuple[int, int]:
    """128 bits that depend on the set alone."""
    sums = [int(mixed(values ^ np.uint64(salt)).sum(dtype=np.uint64)) for salt in (0x51, 0xA7)]
    return sums[0] - (1 << 63), sums[1] - (1 << 63)


def sketches(docs: DataFrame, width: int) -> DataFrame:
    """(doc_id, n, f1, f2, sketch): size and fingerprint of each row's set, its K smallest hashes."""
    names = ["doc_id", "n", "f1", "f2", "sketch"]

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, prints, least = [], [], []
            for found in shingle_sets(batch.column(1), width):
                sizes.append(found.size)
                prints.append(fingerprint(found))
                least.append(found[:K].view(np.int64).copy())
            offsets = np.cumsum([0, *map(len, least)], dtype=np.int32)
            values = np.concatenate([*least, np.empty(0, np.int64)])
            columns = [
                batch.column(0),
                pa.array(sizes, pa.int64()),
                pa.array([p[0] for p in prints], pa.int64()),
                pa.array([p[1] for p in prints], pa.int64()),
                pa.ListArray.from_arrays(pa.array(offsets), pa.array(values)),
            ]
            yield pa.RecordBatch.from_arrays(columns, names)

    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long"), text.alias("text")).mapInArrow(
        sketch, "doc_id long, n long, f1 long, f2 long, sketch array<long>"
    )


def indexed_values(values: np.ndarray, frequency: np.ndarray) -> np.ndarray:
    """The retained values to put into inverted lists: the rarest ones, by a fixed order of all.

    Of two sketches with c values in common, each of at most m values, the first m - c + s of each
    in the same order have s in common.
    """
    least = min(COMMON, -(-values.size * SIMILAR // 100))
    bucket = values.view(np.uint64) & np.uint64((1 << COUNTER_BITS) - 1)
    order = np.lexsort((values, frequency[bucket]))
    return values[order[: values.size - least + min(SHARED, least)]]


def postings(classes: DataFrame) -> DataFrame:
    """(value, cls, n) of the inverted lists.  The frequency table has 2**COUNTER_BITS counts."""
    place = F.col("value").bitwiseAND(F.lit((1 << COUNTER_BITS) - 1))
    counted = classes.select(F.explode("sketch").alias("value")).groupBy(place.alias("place")).count()
    table = np.zeros(1 << COUNTER_BITS, np.int64)
    got = counted.toPandas()  # at most 2**COUNTER_BITS rows
    table[got["place"].to_numpy(np.int64)] = got["count"]
    shared = classes.sparkSession.sparkContext.broadcast(table)
    names = ["value", "cls", "n"]

    def lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(2)
            flat = column.values.to_numpy(zero_copy_only=False).astype(np.int64, copy=False)
            offsets = column.offsets.to_numpy()
            chosen = [indexed_values(flat[a:b], shared.value) for a, b in zip(offsets, offsets[1:])]
            times = [c.size for c in chosen]
            rest = [np.repeat(batch.column(i).to_numpy(), times) for i in (0, 1)]
            values = np.concatenate([*chosen, np.empty(0, np.int64)])
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (values, *rest)], names)

    return classes.select("cls", "n", "sketch").mapInArrow(lists, "value long, cls long, n long")


def alike(a: np.ndarray, b: np.ndarray) -> int:
    """Common values among the K smallest of the union of two sketches, or -1 if they are too few."""
    both = np.concatenate([a, b]).view(np.uint64)
    both.sort(kind="stable")
    twice = both[1:] == both[:-1]
    distinct = np.r_[True, ~twice].cumsum()  # rank of each value in the union
    size = min(K, int(distinct[-1]))
    common = int((twice & (distinct[:-1] <= size)).sum())
    # With fewer than K values in the union the sketches are the sets.
    enough = common * 100 >= SIMILAR * size if size < K else common >= COMMON
    return common if enough else -1


def estimated(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """(u, v, common) of the pairs (u, v) whose union sketch allows the similarity."""
    for side in "uv":
        own = classes.select(F.col("cls").alias(side), F.col("sketch").alias(f"{side}_sketch"))
        pairs = pairs.join(own, side)

    def keep(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            common = [alike(a, b) for a, b in zip(batch["u_sketch"], batch["v_sketch"])]
            batch = batch[["u", "v"]].assign(common=common)
            yield batch[batch["common"] >= 0]

    return pairs.select("u", "v", "u_sketch", "v_sketch").mapInPandas(keep, "u long, v long, common int")


def texts_of(ids: DataFrame, docs: DataFrame) -> DataFrame:
    """(id, text) of the documents whose ids a table of distinct ids holds; null texts are empty.

    A bitmap of fixed size lets through those rows and few others before texts are shuffled.
    """
    ids = materialize(ids.select("id", F.xxhash64("id").alias("h")), "near-ids")
    table = hash_bitmap(ids, "h", 24)
    texts = materialize(
        docs.select(F.col("doc_id").cast("long").alias("id"), F.coalesce("text", F.lit("")).alias("text"))
        .filter(may_hold(table, F.xxhash64("id"), docs.sparkSession))
        .join(ids.select("id"), "id", "left_semi"),
        "near-texts",
    )
    discard(ids)
    return texts


def verified(pairs: DataFrame, docs: DataFrame, width: int) -> DataFrame:
    """The pairs (u, v) of doc_ids whose whole shingle sets are similar enough.

    Only texts of documents in a pair are read on.
    """
    pairs = materialize(pairs.select("u", "v"), "near-pairs")
    if pairs.isEmpty():
        return pairs
    texts = texts_of(pairs.select(F.explode(F.array("u", "v")).alias("id")).distinct(), docs)
    linked = confirmed(pairs, texts, width)
    discard(pairs, texts)
    return linked


def confirmed(pairs: DataFrame, texts: DataFrame, width: int) -> DataFrame:
    """The same with the texts (id, text) of the documents in the pairs."""

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text, linked = batch.column(3), []
            # Rows of one v stand together: equal neighbours are hashed once.
            fresh = [True, *pc.not_equal(text.slice(1), text.slice(0, max(0, len(text) - 1))).to_pylist()]
            fresh = pa.array(fresh[: len(text)], pa.bool_())
            others, b = shingle_sets(text.filter(fresh), width), None
            for a, new in zip(shingle_sets(batch.column(2), width), fresh.to_pylist()):
                b = next(others) if new else b
                common = np.intersect1d(a, b, assume_unique=True).size
                linked.append(common * 100 >= SIMILAR * (a.size + b.size - common) and a.size > 0)
            yield batch.select([0, 1]).filter(pa.array(linked, pa.bool_()))

    for side in "uv":
        own = texts.select(F.col("id").alias(side), F.col("text").alias(f"{side}_text"))
        pairs = pairs.join(own, side)
    linked = pairs.select("u", "v", "u_text", "v_text").mapInArrow(confirm, "u long, v long")
    return materialize(linked, "near-linked")


def sizes_allow(a: str, b: str) -> str:
    """Whether sets of these sizes can be similar enough."""
    return f"least({a}, {b}) * 100 >= greatest({a}, {b}) * {SIMILAR}"


def with_main(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows with main, the component that has most rows of their key, and members, the rows of the key."""
    main = rows.groupBy(*keys, "comp").count().groupBy(*keys)
    main = main.agg(F.max_by("comp", F.struct("count", "comp")).alias("main"), F.sum("count").alias("members"))
    return rows.join(main, keys)


def between(rows: DataFrame, keys: list[str], condition: str) -> DataFrame:
    """Pairs of rows alike in ``keys`` that stand in different components, once for each key.

    Rows need cls, n and comp; the second row's columns are called o_*.  Members of the component
    that has most rows of a key are not compared with each other.
    """
    rows = with_main(rows, keys).drop("members")
    outside = rows.filter("comp <> main").drop("main")
    outside = outside.select(*keys, *[F.col(c).alias(f"o_{c}") for c in outside.columns if c not in keys])
    return (
        outside.join(rows, keys)
        .filter("comp <> o_comp and (comp = main or cls < o_cls)")
        .filter(sizes_allow("n", "o_n"))
        .filter(condition)
    )


def by_lot(rows: DataFrame, keys: list[str], condition: str, lot: int) -> DataFrame:
    """Of the pairs of :func:`between` under keys of more than LOTS rows, those with a row drawn by lot.

    LOTS rows are drawn for each key, at most one from each of LOTS parts of its rows.  Only rows
    outside of the component that has most rows of the key meet them, so pairs grow with the rows.
    """
    rows = with_main(rows, keys).filter(f"members > {LOTS}")
    chance = F.xxhash64("cls", *keys, F.lit(lot))
    others = [c for c in rows.columns if c not in (*keys, "main", "members")]
    drawn = rows.groupBy(*keys, F.pmod(chance, F.lit(LOTS)).alias("part"))
    drawn = drawn.agg(F.min(F.struct(chance.alias("h"), *others)).alias("o"))
    drawn = drawn.select(*keys, *[F.col(f"o.{c}").alias(f"o_{c}") for c in others])
    met = rows.filter("comp <> main").join(drawn, keys).filter("comp <> o_comp")
    return met.filter(sizes_allow("n", "o_n")).filter(condition)


def set_values(texts: DataFrame, width: int) -> DataFrame:
    """(value, own, cls, comp, n) of the whole sets of (own, cls, comp, text): each value with its set's size."""
    names = ["value", "own", "cls", "comp", "n"]

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, owners, size = [], [], 0

        def gathered() -> pa.RecordBatch:
            sizes = [len(values) for values in held]
            values = np.concatenate([*held, np.empty(0, np.uint64)]).view(np.int64)
            of = np.array(owners, np.int64).reshape(-1, 3)
            columns = [values, *[np.repeat(c, sizes) for c in of.T], np.repeat(sizes, sizes).astype(np.int64)]
            return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)

        for batch in batches:
            of = zip(*[batch.column(i).to_pylist() for i in range(3)])
            for own, values in zip(of, shingle_sets(batch.column(3), width)):
                held.append(values)
                owners.append(own)
                size += values.size
                if size >= GATHERED:
                    yield gathered()
                    held, owners, size = [], [], 0
        yield gathered()

    schema = "value long, own long, cls long, comp long, n long"
    return texts.select("own", "cls", "comp", "text").mapInArrow(listed, schema)


def by_whole_sets(hot: DataFrame, docs: DataFrame, width: int, draws: int = 0) -> DataFrame:
    """(u, v) of classes (cls, comp) in different components whose whole sets may be similar enough.

    All values of these sets stand in one order, the rarest among them first.  The first value that
    two sets x and y of enough similarity share has at most |x| - o values before it in x, and
    |y| - o in y, where o is the least intersection, 4/9 of |x| + |y|: so they meet under it, and no
    pair is lost.  Values of one set alone are never shared but count as values before.  Sets meet
    only under sizes near to each other's, so what is listed depends on the partner's size as well.

    A class outside a large component may meet all of it, though a single link would do.  So members
    of the lists are drawn by lot first, ``draws`` times, and classes that are linked with one join
    its component; of the pairs inside the components of then only these links are returned.
    """
    if hot.isEmpty():
        return hot.select(F.col("cls").alias("u"), F.col("cls").alias("v"))
    found = texts_of(hot.select(F.col("cls").alias("id")).distinct(), docs)
    rows = found.withColumnRenamed("id", "cls").join(hot, "cls").withColumn("own", F.xxhash64("cls", "text"))
    values = materialize(set_values(rows.dropDuplicates(["own"]), width), "near-values")
    often = values.groupBy("value").agg(F.count(F.lit(1)).alias("often")).filter("often > 1")
    own = Window.partitionBy("own")
    place = F.row_number().over(own.orderBy("often", "value")) - 1
    before = F.col("n") - F.count(F.lit(1)).over(own) + place
    allowed = F.col("n") - F.ceil(F.col("n") * SIMILAR / 100)
    places = values.join(often, "value").withColumn("before", before).filter(F.col("before") <= allowed)

    def step(n: Column) -> Column:
        return F.floor(F.log(n) / math.log(STEP))

    mine, other = step(F.col("n")), F.col("other")
    smallest, largest = F.floor(F.col("n") * SIMILAR / 100), F.ceil(F.col("n") * 100 / SIMILAR)
    steps = F.sequence(step(F.greatest(smallest, F.lit(1))), step(largest))
    least = F.greatest(smallest, F.floor(F.pow(F.lit(STEP), other) * 0.999999))  # size of a partner there
    entries = (
        places.select("value", "cls", "comp", "n", "before", F.explode(steps).alias("other"))
        .filter(F.col("before") * 9 <= F.col("n") * 9 - (F.col("n") + least) * 4)
        .withColumns({"mine": mine, "low": F.least(mine, other), "high": F.greatest(mine, other)})
        .drop("other")
    )
    entries = listed = materialize(entries, "near-entries")
    keys = ["value", "low", "high"]
    several = entries.groupBy(*keys).agg(*[f(c).alias(f"{f.__name__}_{c}") for f in (F.min, F.max) for c in ("comp", "mine")])
    several = several.filter("min_comp < max_comp and min_mine = low and max_mine = high")
    entries = shared = materialize(entries.join(several.select(*keys), keys, "left_semi"), "near-shared")
    discard(values, listed)
    meet = "before * 9 <= n * 9 - (n + o_n) * 4 and o_before * 9 <= o_n * 9 - (n + o_n) * 4"
    meet += " and (mine <> o_mine or low = high)"

    def distinct_pairs(met: DataFrame, label: str) -> DataFrame:
        pairs = met.select(F.greatest("cls", "o_cls").alias("u"), F.least("cls", "o_cls").alias("v"))
        return materialize(pairs.distinct(), label)

    linked = []
    for lot in range(draws):
        drawn = distinct_pairs(by_lot(entries, keys, meet, lot), "near-drawn")
        more = drawn if drawn.isEmpty() else confirmed(drawn, found, width)
        if more.isEmpty():
            break
        linked.append(more)
        links = hot.select(F.col("cls").alias("u"), F.col("comp").alias("v"))
        for more in linked:
            links = links.unionByName(more)
        joined = components(links).withColumnRenamed("u", "cls")
        entries = shared.join(joined, "cls", "left").withColumn("comp", F.coalesce("m", "cls")).drop("m")
    pairs = distinct_pairs(between(entries, keys, meet), "near-met")
    discard(found, shared)
    for more in linked:
        pairs = pairs.unionByName(more)
    return pairs


def near_duplicates(docs: DataFrame, width: int = 5) -> DataFrame:
    """Each row's group of near-duplicates: doc_id, n_shingles, component_id, kept.

    Words are runs of other than ASCII blanks, A-Z lower-cased; a set holds the distinct shingles of
    ``width`` words, or the whole sequence if there are fewer.  Sets whose intersection is at least
    80 % of their union are linked; component_id is the smallest doc_id that links reach.

    Equal sets become one class first, so copies never meet in pairs.  Classes are listed under the
    rarest values of their sketches.  First each class is compared with the smallest class of each
    of its lists: the union sketch filters, and the most promising pair of each class is verified on
    the whole sets.  Lists whose members are then in one component are done.  In the others each
    class is compared with a member drawn by lot from each of its lists, which brings in the rest of
    a large group.  In the lists still open, no link between components is left out: classes that share
    SHARED lists, one of them with at most SHORT members, meet in that list and are compared.  Classes
    in SHARED longer lists meet by their whole sets, members drawn by lot first, so work does not grow
    with the square of a list.
    Pairs inside a component cannot change the result.

    Null and empty texts, and texts of blanks, have n_shingles 0 and are linked with nothing; so are
    rows with a null doc_id (component_id null, kept).  doc_id names a document: rows repeated with
    doc_id and text share one result.  Other columns are not read.  No rows in, no rows out.
    """
    found = materialize(sketches(docs, width), "near-sketches")
    classes = materialize(
        found.filter("n > 0 and doc_id is not null")
        .groupBy("n", "f1", "f2")
        .agg(F.min("doc_id").alias("cls"), F.first("sketch").alias("sketch")),
        "near-classes",
    )
    entries = materialize(postings(classes), "near-postings")
    heads = (
        entries.groupBy("value")
        .agg(F.min(F.struct("cls", "n")).alias("head"), F.count(F.lit(1)).alias("members"))
        .filter("members > 1")
        .select("value", "head")
    )
    lists = materialize(
        entries.join(heads, "value").select(
            "value", "cls", "n", F.col("head.cls").alias("head"), F.col("head.n").alias("head_n")
        ),
        "near-lists",
    )
    discard(entries)
    star = lists.filter("cls <> head").filter(sizes_allow("n", "head_n"))
    star = star.select(F.col("cls").alias("u"), F.col("head").alias("v")).distinct()
    star = materialize(estimated(star, classes), "near-star")
    best = star.groupBy("u").agg(F.max_by("v", F.struct("common", "v")).alias("v"))
    links = components(verified(best, docs, width))

    def in_component(rows: DataFrame, node: str, name: str) -> DataFrame:
        own = links.select(F.col("u").alias(node), F.col("m").alias(name))
        return rows.join(own, node, "left").withColumn(name, F.coalesce(name, node))

    def unresolved(rows: DataFrame) -> DataFrame:
        """Entries of the lists whose members are in several components."""
        rest = in_component(rows.select("value", "cls", "n"), "cls", "comp")
        split = rest.groupBy("value").agg(F.min("comp").alias("a"), F.max("comp").alias("b"))
        split = split.filter("a < b").select("value")
        return materialize(rest.join(split, "value", "left_semi"), "near-rest")

    rest = unresolved(lists.filter("cls <> head"))
    discard(lists)
    for lot in range(DRAWS):
        if rest.isEmpty():
            break
        chance = F.xxhash64("value", "cls", F.lit(lot)).alias("h")
        drawn = rest.groupBy("value").agg(F.min(F.struct(chance, "cls", "n", "comp")).alias("v"))
        tried = (
            rest.join(drawn, "value")
            .filter("comp <> v.comp")
            .filter(sizes_allow("n", "v.n"))
            .select(F.col("cls").alias("u"), F.col("v.cls").alias("v"))
            .distinct()
        )
        best = estimated(tried, classes).groupBy("u")
        best = best.agg(F.max_by("v", F.struct("common", "v")).alias("v"))
        more = verified(best, docs, width)
        links = components(links.select("u", F.col("m").alias("v")).unionByName(more))
        few = more.count() * FEW < rest.select("cls").distinct().count()
        open_before, rest = rest, unresolved(rest)
        discard(open_before)
        if few:
            break

    long = rest.groupBy("value").agg(F.count(F.lit(1)).alias("members")).filter(f"members > {SHORT}").select("value")
    # A pair shares as many lists as this, and sizes that allow it give both classes the same number.
    least = F.least(F.ceil(F.least("n", F.lit(K)) * SIMILAR / 100), F.lit(SHARED))
    many = rest.join(long, "value").groupBy("cls").agg(F.count(F.lit(1)).alias("many"))
    many = materialize(many, "near-many")
    short = rest.join(long, "value", "left_anti").join(many, "cls", "left")
    short = short.withColumn("many", F.coalesce("many", F.lit(0))).withColumn("hot", F.col("many") >= least)
    across = (
        between(short, ["value"], "not (hot and o_hot)")  # those two meet by their whole sets
        .groupBy(F.greatest("cls", "o_cls").alias("u"), F.least("cls", "o_cls").alias("v"))
        .agg(F.count(F.lit(1)).alias("lists"), F.min(F.least("many", "o_many")).alias("others"), F.min(least).alias("least"))
        .filter("lists + others >= least")
        .select("u", "v")
    )
    hot = rest.join(many, "cls").filter(F.col("many") >= least).select("cls", "comp").distinct()
    whole = by_whole_sets(materialize(hot, "near-hot"), docs, width, DRAWS)
    open_star = in_component(in_component(star, "u", "u_comp"), "v", "v_comp").filter("u_comp <> v_comp")
    more = estimated(across, classes).select("u", "v").unionByName(open_star.select("u", "v")).unionByName(whole)
    more = verified(more.distinct(), docs, width)
    links = components(links.select("u", F.col("m").alias("v")).unionByName(more))
    named = in_component(classes.select("n", "f1", "f2", "cls"), "cls", "component_id")
    return (
        found.select("doc_id", "n", "f1", "f2")
        .join(named.select("n", "f1", "f2", "component_id"), ["n", "f1", "f2"], "left")
        .select(
            "doc_id",
            F.col("n").alias("n_shingles"),
            F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"),
        )
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    )


def drop_near_duplicates(docs: DataFrame, width: int = 5) -> DataFrame:
    """``docs`` with one document of each group of near-duplicates, the one with the smallest doc_id.

    Rows with one doc_id and different texts are judged each by its own text: the text with the
    smallest hash goes by the doc_id, the others by ids of their own above all doc_ids, so they give
    way to any other document of their group.  Rows repeated with doc_id and text share one
    decision.  Null doc_ids and null, empty or blank texts stay.  No rows in, no rows out.
    """
    rows = keyed(docs)
    ids = materialize(rows.filter("_row.doc_id is not null").select("_k", "_h").distinct(), "near-ids")
    first = ids.groupBy("_k").agg(F.min("_h").alias("first"), F.max("_h").alias("last"))
    others = ids.join(first.filter("first < last"), "_k").filter("_h > first").select("_k", "_h")
    top = ids.agg(F.max("_k")).first()[0] or 0
    own = F.monotonically_increasing_id() + F.lit(top + 1)
    rows = with_decisions(rows, materialize(others.withColumn("_own", own), "near-own-ids"))
    rows = rows.select("_row", F.coalesce("_own", "_k").alias("_k"))
    named = F.when(F.col("_row.doc_id").isNotNull(), F.col("_k")).alias("doc_id")
    dropped = near_duplicates(rows.select(named, F.col("_row.text").alias("text")), width).filter("not kept")
    dropped = materialize(dropped.select(F.col("doc_id").alias("_k")).distinct(), "dropped")
    return without(rows, dropped).select("_row.*")
