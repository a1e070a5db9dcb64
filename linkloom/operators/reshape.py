"""Nested crawl results as rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkloom.functions.binding import exploded


def flatten_maps(
    results: DataFrame, *, column: str = "results", keys: Sequence[str] = ()
) -> DataFrame:
    """Maps of page to link records as rows: keys, page_url, pos, record fields."""
    pages = results.select(*keys, F.explode(column).alias("page_url", "records"))
    return pages.select(*keys, "page_url", F.posexplode("records").alias("pos", "r")).select(
        *keys, "page_url", "pos", "r.*"
    )


def flatten_nested(
    rows: DataFrame, *, column: str, keys: Sequence[str] = (), output: str = "item"
) -> DataFrame:
    """A list, or a list of lists, as rows: keys, pos, item.

    The column's type decides how many levels there are.  A null inner list has no items
    and leaves the others as they are.
    """
    kind = rows.schema[column].dataType
    nested = isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.ArrayType)
    items = F.flatten(F.filter(column, lambda x: x.isNotNull())) if nested else F.col(column)
    return exploded(rows, keys, items, item=output)
