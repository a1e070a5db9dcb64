"""Nearest neighbours by block matrix join: int8 product tiles with error bounds, exact scores for what survives."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from linkloom.session import materialize

#: Rows of a block; blocks of candidates and of queries that one task joins at most.
BLOCK_ROWS = 1024
BLOCKS_AT_ONCE = 16
#: Blocks that a task fills.
FULL_BLOCKS = 4
#: Dimensions whose int8 products add up exactly in float32: 127 * 127 * 1024 < 2**24.
EXACT_DIMS = 1024
#: Pairs scored exactly at once.
PAIRS = 1 << 16

_BLOCK = "block long, dim int, ids binary, uids binary, vectors binary"


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, uid, embedding as doubles) of rows that take part, written once so that uids hold."""
    values = F.col("embedding").cast("array<double>")
    fine = F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = vectors.select(F.col("vec_id").cast("long"), values.alias("embedding"), fine.alias("fine"))
    some = F.exists("embedding", lambda x: x != 0)
    rows = rows.filter(F.col("vec_id").isNotNull() & F.col("fine") & some).drop("fine")
    return materialize(rows.withColumn("uid", F.monotonically_increasing_id()), "vectors")


def blocks(rows: DataFrame, size: int) -> DataFrame:
    """Rows (vec_id, uid, embedding) as blocks of up to ``size`` of one length: block, dim, ids, uids, vectors.

    Blocks are numbered within their task.  Rows are dealt out so that each task fills a few blocks,
    however they lay before: the work of the join goes with the number of blocks.
    """
    rows = rows.repartition(-(-max(1, rows.count()) // (FULL_BLOCKS * size)))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, serial = TaskContext.get().partitionId() << 32, 0
        waiting: dict[int, list[tuple]] = {}

        def out(dim: int) -> pa.RecordBatch:
            ids, uids, values = (np.concatenate(x) for x in zip(*waiting.pop(dim)))
            columns = [[task | serial], [dim], [ids.tobytes()], [uids.tobytes()], [values.tobytes()]]
            kinds = [pa.int64(), pa.int32(), *[pa.binary()] * 3]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names)

        for batch in batches:
            ids, uids = (batch.column(i).to_numpy() for i in (0, 1))
            offsets, flat = batch.column(2).offsets.to_numpy(), batch.column(2).values.to_numpy()
            lengths = np.diff(offsets)
            for dim in np.unique(lengths).tolist():
                own = np.flatnonzero(lengths == dim)
                values = flat[offsets[own][:, None] + np.arange(dim)]
                while own.size:
                    room = size - sum(x[0].size for x in waiting.get(dim, []))
                    waiting.setdefault(dim, []).append((ids[own[:room]], uids[own[:room]], values[:room]))
                    if own.size >= room:
                        yield out(dim)
                        serial += 1
                    own, values = own[room:], values[room:]
        for dim in list(waiting):
            yield out(dim)
            serial += 1

    names = ["block", "dim", "ids", "uids", "vectors"]
    return rows.select("vec_id", "uid", "embedding").mapInArrow(cut, _BLOCK)


class Quantised:
    """A block of vectors as int8 with a scale each, and what that leaves out."""

    def __init__(self, ids: bytes, uids: bytes, vectors: bytes, dim: int) -> None:
        self.ids, self.uids = np.frombuffer(ids, np.int64), np.frombuffer(uids, np.int64)
        self.exact = np.frombuffer(vectors, np.float64).reshape(-1, dim)
        self.scale = np.abs(self.exact).max(1) / 127
        levels = np.rint(self.exact / np.maximum(self.scale, np.finfo(np.float64).tiny)[:, None]).clip(-127, 127)
        rest = self.exact - levels * self.scale[:, None]
        self.levels = levels.astype(np.int8)
        self.norm, self.rest = (np.sqrt((x * x).sum(1)) for x in (self.exact, rest))

    def products(self, other: Quantised) -> np.ndarray:
        """Sums of int8 products, exact: float32 holds them all, EXACT_DIMS dimensions at a time."""
        total = np.zeros((self.ids.size, other.ids.size))
        for d in range(0, self.levels.shape[1], EXACT_DIMS):
            total += self.levels[:, d : d + EXACT_DIMS].astype(np.float32) @ other.levels[:, d : d + EXACT_DIMS].T.astype(np.float32)
        return total


def tile_bounds(queries: Quantised, rows: Quantised) -> tuple[np.ndarray, np.ndarray]:
    """Inner products of a tile from int8 values, and how far off they can be.

    With x = a + e and y = b + g, where a and b are the int8 parts, x.y - a.b = e.y + a.g, so it is at most
    |e||y| + (|x| + |e|)|g|.  The last term covers the rounding of all of this.
    """
    guess = queries.products(rows) * queries.scale[:, None] * rows.scale
    off = queries.rest[:, None] * rows.norm + (queries.norm + queries.rest)[:, None] * rows.rest
    off += 1e-12 * rows.exact.shape[1] * queries.norm[:, None] * rows.norm
    return guess, off


def exact_scores(left: np.ndarray, right: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Inner products of rows i of ``left`` with rows j of ``right``, added up in order of dimension.

    The order is the same for each pair, so equal vectors have equal scores wherever they are computed.
    """
    found = np.empty(i.size)
    for lo in range(0, i.size, PAIRS):
        x, y = (m[k[lo : lo + PAIRS]].T for m, k in ((left, i), (right, j)))
        total = np.zeros(x.shape[1])
        for a, b in zip(x, y):
            total += a * b
        found[lo : lo + PAIRS] = total
    return found


class Nearest:
    """A heap for each query of a block: its ``k`` nearest rows so far, the worst on top."""

    def __init__(self, queries: Quantised, k: int) -> None:
        self.queries, self.k = queries, k
        self.heaps: list[list[tuple[float, int, int]]] = [[] for _ in queries.ids]
        self.bar = np.full(queries.ids.size, -np.inf)  # a row must reach it

    def meet(self, rows: Quantised) -> None:
        guess, off = tile_bounds(self.queries, rows)
        bar = self.bar
        if rows.ids.size >= self.k:
            sure = np.partition(guess - off, rows.ids.size - self.k, axis=1)[:, rows.ids.size - self.k]
            bar = np.fmax(bar, sure)
        i, j = np.nonzero(~(guess + off < bar[:, None]))
        score = exact_scores(self.queries.exact, rows.exact, i, j)
        order = np.lexsort((rows.uids[j], rows.ids[j], -score, i))  # each query's best first, so that few go through its heap
        i, j, score = i[order], j[order], score[order]
        first = np.flatnonzero(np.r_[True, i[1:] != i[:-1]]) if i.size else i
        place = np.arange(i.size) - np.repeat(first, np.diff(np.r_[first, i.size]))
        few = place < self.k
        for q, s, vec, uid in zip(i[few].tolist(), score[few].tolist(), rows.ids[j[few]].tolist(), rows.uids[j[few]].tolist()):
            heap, row = self.heaps[q], (s, -vec, -uid)
            if len(heap) < self.k:
                heapq.heappush(heap, row)
            elif row > heap[0]:
                heapq.heapreplace(heap, row)
            if len(heap) == self.k:
                self.bar[q] = heap[0][0]

    def rows(self) -> pa.RecordBatch:
        names = ["query", "score", "vec_id", "uid"]
        sizes = [len(h) for h in self.heaps]
        flat = [row for heap in self.heaps for row in heap]
        score, vec, uid = (np.array(x) for x in zip(*flat)) if flat else (np.empty(0), *[np.empty(0, np.int64)] * 2)
        columns = [np.repeat(self.queries.uids, sizes), score, -vec.astype(np.int64), -uid.astype(np.int64)]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)


def joined_blocks(asked: DataFrame, rows: DataFrame, k: int, at_once: int) -> DataFrame:
    """(query, score, vec_id, uid): the ``k`` nearest of each query in each group of ``at_once`` blocks of rows.

    Blocks fall into a grid of groups: a task meets the query blocks of one group with the row blocks of another,
    reading each once for each group of the other kind.
    """

    def side(table: DataFrame, groups: int) -> DataFrame:
        place = F.pmod(F.xxhash64("block"), F.lit(groups)).cast("int")
        return table.select(place.alias("own"), F.struct("block", "ids", "uids", "vectors").alias("b"), "dim")

    n_asked, n_rows = (max(1, -(-t.count() // at_once)) for t in (asked, rows))
    left = side(asked, n_asked).select("dim", F.col("own").alias("g"), F.explode(F.sequence(F.lit(0), F.lit(n_rows - 1))).alias("h"), F.col("b").alias("q"))
    right = side(rows, n_rows).select("dim", F.explode(F.sequence(F.lit(0), F.lit(n_asked - 1))).alias("g"), F.col("own").alias("h"), F.col("b").alias("r"))

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heaps: dict[tuple, Nearest] = {}  # of the query blocks met last; one met again later has rows twice, which is fine
        met = (None, None)
        for batch in batches:
            for dim, q, r in zip(*[batch.column(c).to_pylist() for c in range(3)]):
                name = (dim, q["block"])
                if name not in heaps:
                    if len(heaps) == at_once:
                        yield heaps.pop(next(iter(heaps))).rows()
                    heaps[name] = Nearest(Quantised(q["ids"], q["uids"], q["vectors"], dim), k)
                if met[0] != (dim, r["block"]):
                    met = (dim, r["block"]), Quantised(r["ids"], r["uids"], r["vectors"], dim)
                heaps[name].meet(met[1])
        for nearest in heaps.values():
            yield nearest.rows()

    pairs = left.join(right, ["dim", "g", "h"]).select("dim", "q", "r")
    return pairs.mapInArrow(join, "query long, score double, vec_id long, uid long")


def nearest_neighbours(
    vectors: DataFrame, *, every: int = 20, k: int = 20, block_rows: int = BLOCK_ROWS, at_once: int = BLOCKS_AT_ONCE
) -> DataFrame:
    """The ``k`` nearest rows of each query: query_id, rank (from 1), vec_id, score, nearest first.

    Queries are the rows whose vec_id is divisible by ``every``; candidates are all rows but the query's own.
    Nearness is the inner product in double precision, ties go to the smaller vec_id.  The result is exact: int8
    products bound each score from both sides, and every row that may be among the nearest is scored from the
    original vectors.

    Equal vectors are searched for once, and of equal rows only the k + 1 with the smallest vec_id can be found, so
    that many copies of one vector neither meet each other nor fill a heap.

    Rows without a vec_id, and vectors null, empty, zero or with null or non-finite components take no part.
    Vectors meet those of their own length only.  A row repeated with its vec_id is another row: it is found under
    that vec_id, also by its twin, and a repeated query gives its rows for each.  With fewer candidates all come out.
    No rows in, no rows out; other columns are not read.
    """
    rows = usable(vectors)
    best = Window.partitionBy("embedding").orderBy("vec_id", "uid")
    found = rows.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= k + 1).drop("place")
    queries = rows.filter(F.col("vec_id") % every == 0)
    classes = queries.groupBy("embedding").agg(F.min("uid").alias("uid")).withColumn("vec_id", F.lit(0).cast("long"))
    classes, found = materialize(classes, "vector-classes"), materialize(found, "vector-found")
    asked, searched = (materialize(blocks(t, block_rows), "vector-blocks") for t in (classes, found))
    near = materialize(joined_blocks(asked, searched, k + 1, at_once), "vector-near")
    order = [F.desc("score"), "vec_id", "uid"]
    first = F.row_number().over(Window.partitionBy("query").orderBy(*order))
    near = near.withColumn("place", first).filter(F.col("place") <= k + 1).drop("place")
    of_class = classes.select(F.col("uid").alias("query"), "embedding")
    members = queries.join(of_class, "embedding").select(F.col("vec_id").alias("query_id"), F.col("uid").alias("own"), "query")
    listed = near.groupBy("query").agg(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("s"), "vec_id", "uid"))).alias("near"))
    others = F.slice(F.filter("near", lambda x: x["uid"] != F.col("own")), 1, k)
    return (
        members.join(listed, "query")
        .select("query_id", F.posexplode(others).alias("pos", "x"))
        .select("query_id", (F.col("pos") + 1).alias("rank"), "x.vec_id", (-F.col("x.s")).alias("score"))
    )
