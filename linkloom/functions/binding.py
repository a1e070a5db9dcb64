"""Evaluate a sub-expression once and use it several times."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once.

    A costly expression repeated in the branches of a ``when`` is evaluated again at
    each mention; as a lambda variable it is a plain reference.
    """
    return F.transform(F.array(value), body)[0]


def exploded(
    rows: DataFrame,
    keys: Sequence[str | Column],
    array: Column,
    *,
    pos: str = "pos",
    item: str = "item",
) -> DataFrame:
    """One row per element of a computed array: keys, pos, item.

    The optimizer guards a plain explode with filters on the array's size, which would
    compute the array again for each of them.  The outer form has no such filters; the
    row it gives for an empty array is dropped here.
    """
    outer = rows.select(*keys, F.posexplode_outer(array).alias(pos, item))
    return outer.filter(F.col(pos).isNotNull())
