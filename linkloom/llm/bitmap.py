"""A bitmap of fixed size over 64-bit hashes, small enough to broadcast whatever the input.

It only prunes: a hash that was put in always tests true, and one that was not may test true
as well, more often the fuller the bitmap is.  What passes is decided exactly afterwards.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.session import discard, materialize

#: Bits of the bitmap; 2**27 bits are 16 MB, on the driver and on each executor.
BITMAP_BITS = 27
#: Bits that :func:`bits_for` goes up to: 32 MB.
MOST_BITS = 28
_BUCKET_BITS = 15  # bitmap_construct_agg makes bitmaps of 32,768 bits


def bits_for(n: int) -> int:
    """Bits of a bitmap of which n hashes set about an eighth at most, while MOST_BITS allow it."""
    return min(MOST_BITS, max(BITMAP_BITS, (8 * n - 1).bit_length()))


def bitmap_parts(hashes: DataFrame, column: str, bits: int) -> DataFrame:
    """The bitmap of a long column as a table of its own: (bucket, bits), 4 KB for each bucket that has any."""
    place = F.shiftrightunsigned(column, 64 - bits)  # the first bits of the hash
    parts = (
        hashes.select(place.alias("place"))
        .groupBy(F.shiftright("place", _BUCKET_BITS).alias("bucket"))
        .agg(F.expr(f"bitmap_construct_agg(place & {(1 << _BUCKET_BITS) - 1})").alias("bits"))
    )
    return materialize(parts, "bitmap")  # shuffle files of what was hashed go


def part_holds(hashed: Column, bits: int) -> tuple[Column, Column]:
    """Which row of :func:`bitmap_parts` a hash goes with, and whether that row has it."""
    place = F.shiftrightunsigned(hashed, 64 - bits)
    inside = place.bitwiseAND(F.lit((1 << _BUCKET_BITS) - 1))
    at = (F.shiftright(inside, 3) + 1).cast("int")
    byte = F.conv(F.hex(F.substring("bits", at, F.lit(1))), 16, 10).cast("int")
    mask = F.element_at(F.array(*[F.lit(1 << i) for i in range(8)]), (inside.bitwiseAND(F.lit(7)) + 1).cast("int"))
    return F.shiftright(place, _BUCKET_BITS) == F.col("bucket"), byte.bitwiseAND(mask) != 0


def hash_bitmap(hashes: DataFrame, column: str, bits: int = BITMAP_BITS) -> np.ndarray:
    """The bitmap of a long column as 2**bits / 8 bytes.

    The driver gets at most 2**(bits - 15) rows of 4 KB, whatever the number of hashes.
    """
    parts = bitmap_parts(hashes, column, bits)
    size = 1 << (_BUCKET_BITS - 3)
    table = np.zeros(1 << (bits - 3), dtype=np.uint8)
    for row in parts.toLocalIterator():
        table[row.bucket * size : (row.bucket + 1) * size] = np.frombuffer(row.bits, np.uint8)
    discard(parts)
    return table


def in_bitmap(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether each 64-bit hash may be in the bitmap."""
    place = hashes.astype(np.uint64, copy=False) >> np.uint64(64 - (table.size * 8 - 1).bit_length())
    return (table[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1


def may_hold(table: np.ndarray, column: Column, spark: SparkSession) -> Column:
    """Column form of :func:`in_bitmap`; only the hash column goes through Python."""
    shared = spark.sparkContext.broadcast(table)

    @F.pandas_udf("boolean")
    def test(hashes: pd.Series) -> pd.Series:
        return pd.Series(in_bitmap(shared.value, hashes.to_numpy(np.int64).view(np.uint64)))

    return test(column)
