"""The first rows of a large table in some order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.session import materialize


def first_rows(rows: DataFrame, order: str, k: int) -> DataFrame:
    """The ``k`` first rows by ``order`` (distinct values), without one task seeing all.

    Rows are range partitioned by the order; whole ranges are taken until ``k`` falls
    inside one, and only that range is cut by a sort.  The driver sees one count per
    range.
    """
    ranges = materialize(
        rows.repartitionByRange(order).withColumn("range_", F.spark_partition_id()), "first-rows"
    )
    taken, cut = 0, None
    for row in ranges.groupBy("range_").count().orderBy("range_").toLocalIterator():
        if taken + row["count"] > k:
            cut = row["range_"]
            break
        taken += row["count"]
    if cut is None:
        return ranges.drop("range_")
    whole = ranges.filter(F.col("range_") < cut)
    part = ranges.filter(F.col("range_") == cut).orderBy(order).limit(k - taken)
    return whole.unionByName(part).drop("range_")
