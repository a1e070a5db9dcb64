"""Best-fit packing of documents into bins, with conflicts of source and duplicate cluster."""

from __future__ import annotations

from collections.abc import Iterable
from heapq import heappop, heappush

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.session import materialize

#: Characters of a bin.
CAPACITY = 8192
#: Pieces that one task packs together, on average.
PIECES_PER_GROUP = 20_000


class Bins:
    """Open bins of one group in a tree over their residuals.

    A leaf stands for one residual and holds bins by their two bitmaps: sources and duplicate
    clusters in the bin.  An inner node has the bits that all bins below have in common, so a
    search leaves out subtrees in which every bin has the source, or every bin the cluster.
    """

    def __init__(self, capacity: int) -> None:
        self.capacity = capacity
        self.width = 1 << capacity.bit_length()
        self.leaves: dict[int, dict[tuple[int, int], list[int]]] = {}
        # -1 has all bits set: what the bins of an empty subtree have in common.
        self.sources = [-1] * (2 * self.width)
        self.clusters = [-1] * (2 * self.width)
        self.n = 0

    def _update(self, residual: int) -> None:
        node = self.width + residual
        sources = clusters = -1
        for source, cluster in self.leaves.get(residual, ()):
            sources &= source
            clusters &= cluster
        while node:
            if self.sources[node] == sources and self.clusters[node] == clusters:
                return
            self.sources[node], self.clusters[node] = sources, clusters
            node >>= 1
            if node:
                sources = self.sources[2 * node] & self.sources[2 * node + 1]
                clusters = self.clusters[2 * node] & self.clusters[2 * node + 1]

    def _put(self, residual: int, key: tuple[int, int], number: int) -> None:
        heappush(self.leaves.setdefault(residual, {}).setdefault(key, []), number)
        self._update(residual)

    def _successor(self, node: int, low: int, high: int, size: int, source: int, cluster: int) -> tuple | None:
        """The tightest compatible bin below a node: (residual, its bitmaps)."""
        common = self.sources[node]
        if high < size or common < 0 or common & source or self.clusters[node] & cluster:
            return None
        if node >= self.width:
            fit = [(b[0], k) for k, b in self.leaves[low].items() if not k[0] & source and not k[1] & cluster]
            return (low, min(fit)[1]) if fit else None
        middle = (low + high) // 2
        return self._successor(2 * node, low, middle, size, source, cluster) or self._successor(
            2 * node + 1, middle + 1, high, size, source, cluster
        )

    def place(self, size: int, source: int, cluster: int) -> tuple[int, int]:
        """Bin and place in it of a piece; source and cluster are single bits or 0."""
        found = self._successor(1, 0, self.width - 1, size, source, cluster)
        if found is None:
            residual, key, number = self.capacity, (0, 0), self.n
            self.n += 1
        else:
            residual, key = found
            leaf = self.leaves[residual]
            number = heappop(leaf[key])
            if not leaf[key]:
                del leaf[key]
            self._update(residual)
        self._put(residual - size, (key[0] | source, key[1] | cluster), number)
        return number, self.capacity - residual


def bits(values: Iterable) -> list[int]:
    """A bit for each value that occurs more than once, numbered by first sight; else 0."""
    values = list(values)
    counts: dict = {}
    for v in values:
        counts[v] = counts.get(v, 0) + 1
    numbers: dict = {}
    return [1 << numbers.setdefault(v, len(numbers)) if counts[v] > 1 else 0 for v in values]


def pack_group(pieces: pd.DataFrame, capacity: int) -> pd.DataFrame:
    """Bin and offset of each piece of one group, largest pieces first."""
    pieces = pieces.sort_values(
        ["length", "cluster", "source", "doc_id", "start", "uid"], ascending=[False, *[True] * 5], na_position="first"
    )
    bins = Bins(capacity)
    sources = bits(None if pd.isna(s) else s for s in pieces["source"])
    sources = [0 if pd.isna(s) else b for s, b in zip(pieces["source"], sources)]
    placed = [bins.place(*x) for x in zip(pieces["length"].tolist(), sources, bits(pieces["cluster"]))]
    return pieces.assign(bin=[b for b, _ in placed], bin_offset=[o for _, o in placed])


def best_fit(docs: DataFrame, capacity: int = CAPACITY, per_group: int = PIECES_PER_GROUP) -> DataFrame:
    """Pack all documents into bins: doc_id, piece, start, length, bin_group, bin, bin_offset, source, cluster.

    Sizes are characters.  A text longer than a bin is cut into pieces of ``capacity`` characters
    and a rest; [start, start + length) is a piece's span in the text.  Pieces are taken largest
    first; each goes into the open bin with the least room that still holds it (of equal ones the
    first opened), among bins that hold no document of the same source and none of the same
    duplicate cluster (equal texts, by a 64-bit hash); if there is none, a new bin opens.  No piece
    is dropped, and a bin never overflows.

    Groups of about ``per_group`` pieces, dealt by hash, are packed each by one task; their number
    grows with the input, hot sources and clusters spread evenly over them, and bins belong to one
    group, so conflicts hold for the whole result.  bin_group and bin together name a bin.

    Null and empty texts have nothing to pack: one row, length 0, bin_group, bin and bin_offset
    null.  A null source conflicts with nothing.  Repeated rows are packed each; being equal texts,
    they go to different bins.  Rows come out alike however the input is laid out.  Other columns are not read.  No rows in, no rows out.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    length = F.length(text).cast("long")
    last = F.greatest(F.col("whole") - 1, F.lit(0))
    starts = F.sequence(F.lit(0).cast("long"), last, F.lit(capacity).cast("long"))
    rows = docs.select(
        F.col("doc_id").cast("long"),
        F.col("source").cast("string"),
        F.xxhash64(text).alias("cluster"),
        length.alias("whole"),
    )
    # Rows alike are counted and numbered: uid, from 0.  The first level keeps arrays of many copies short.
    alike = rows.groupBy("doc_id", "source", "cluster", "whole").agg(F.count(F.lit(1)).alias("n"))
    alike = alike.withColumn("low", F.explode(F.expr("sequence(0L, n - 1, 65536L)")))
    alike = alike.withColumn("uid", F.explode(F.expr("sequence(low, least(low + 65535, n - 1))")))
    pieces = materialize(
        alike.select("doc_id", "source", "cluster", "uid", "whole", F.posexplode(starts).alias("piece", "start"))
        .withColumn("length", F.least(F.col("whole") - F.col("start"), F.lit(capacity)))
        .drop("whole"),
        "pack-pieces",
    )
    filled = pieces.filter("length > 0")
    groups = max(1, -(-filled.count() // per_group))
    columns = ["doc_id", "piece", "start", "length", "bin_group", "bin", "bin_offset", "source", "cluster"]
    schema = (
        "doc_id long, piece int, start long, length long, bin_group int, bin long, bin_offset long, "
        "source string, cluster long"
    )
    packed = (
        filled.withColumn("bin_group", F.pmod(F.xxhash64("doc_id", "source", "cluster", "piece", "uid"), F.lit(groups)).cast("int"))
        .groupBy("bin_group")
        .applyInPandas(lambda group: pack_group(group, capacity)[columns], schema)
    )
    nothing = F.lit(None)
    empty = pieces.filter("length = 0").select(
        *["doc_id", "piece", "start", "length"],
        nothing.cast("int").alias("bin_group"),
        nothing.cast("long").alias("bin"),
        nothing.cast("long").alias("bin_offset"),
        *["source", "cluster"],
    )
    return packed.unionByName(empty)
