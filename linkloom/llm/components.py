"""Connected components by alternating stars, as joins and aggregations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkloom.session import materialize

#: Links up to which they are read as one partition.  Spark then shuffles and broadcasts nothing in a
#: round; each shuffle and broadcast costs the driver a thread, which stays for a minute.
ONE_TASK = 1 << 17


def _smallest(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("m"))


def _pairs(rows: DataFrame, *pairs: tuple[str, str]) -> DataFrame:
    """(u, v) of each of the pairs of columns of each row."""

    def pair(u: str, v: str) -> Column:
        return F.struct(F.col(u).alias("u"), F.col(v).alias("v"))

    return rows.select(F.inline(F.array(*[pair(u, v) for u, v in pairs])))


def _done(edges: DataFrame) -> bool:
    """Whether each node that hangs on another hangs on that one only, and nothing hangs on it."""
    ends = _pairs(edges, ("u", "v"), ("v", "u")).withColumn("up", (F.col("u") > F.col("v")).cast("int"))
    ends = ends.groupBy("u").agg(F.sum("up").alias("up"), F.min("up").alias("all_up"))
    return ends.agg(F.count_if(F.expr("up > 1 or up = 1 and all_up = 0"))).first()[0] == 0


def components(edges: DataFrame) -> DataFrame:
    """(u, v) links of longs to (u, m): each linked node but the smallest of its component, with
    that smallest node m.

    Each round hangs every node's larger neighbours on its smallest neighbour, then its smaller
    ones.  Nodes of any degree are fine: minima are reduced in each task first, and no task or
    driver holds a node's neighbours or a component.  Rounds grow with the logarithm of the number
    of nodes; each is written to the shared folder.  They end when every node hangs on a smallest
    one: a round more would change nothing.  ONE_TASK links at most go without shuffles.
    """
    edges = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    edges = materialize(edges.filter("u <> v").distinct(), "links")
    few = edges.count() <= ONE_TASK

    def read(table: DataFrame) -> DataFrame:
        return table.coalesce(1) if few else table  # what a join gives does not count as one partition by itself

    while not _done(read(edges)):
        both = _pairs(read(edges), ("u", "v"), ("v", "u"))
        near = _smallest(both).select("u", F.least("u", "m").alias("m"))
        large = both.join(near.hint("merge"), "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = read(large).distinct()
        nearer = read(large.join(_smallest(large).hint("merge"), "u"))
        edges = _pairs(nearer, ("v", "m"), ("u", "m")).filter("u <> v").distinct()
        edges = materialize(edges, "links")
    return edges.select("u", F.col("v").alias("m"))
