"""Counting quotient filters built per partition and merged without loss.

A fingerprint is cut into block, quotient and remainder.  A filter holds, for each block, the
run length of each quotient, the sorted remainders of all runs one after another, and the counts
above one.  Filters of one block merge by their sorted remainders; counts add up, and nothing is
lost, because a remainder holds every bit that block and quotient leave.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame

QUOTIENT_BITS = 8
#: Fingerprints that a task gathers before it writes a filter.
CHUNK = 1 << 19
#: Fingerprints aimed at for a block, which one task merges in memory.
PER_BLOCK = 1 << 17
SCHEMA = "block long, runs binary, remainders binary, places binary, counts binary"


def block_bits_for(n: int) -> int:
    """Bits of the block number, so that n fingerprints come to about PER_BLOCK a block."""
    return min(24, max(5, (max(1, n) // PER_BLOCK).bit_length()))


def _narrow(lengths: np.ndarray) -> bytes:
    """In as few bytes each as the largest needs: the more blocks, the shorter the runs."""
    return lengths.astype(np.min_scalar_type(int(lengths.max())).newbyteorder("<")).tobytes()


def build(prints: np.ndarray, block_bits: int, remainder_bytes: int) -> Iterator[dict]:
    """The blocks of the filter of some 64-bit fingerprints.

    Only the first block_bits + QUOTIENT_BITS + 8 * remainder_bytes bits count.
    """
    used = block_bits + QUOTIENT_BITS + 8 * remainder_bytes
    if used < 64:
        prints = prints >> np.uint64(64 - used)
    else:
        used, remainder_bytes = 64, -(-(64 - block_bits - QUOTIENT_BITS) // 8)
    values, counts = np.unique(prints, return_counts=True)
    below = used - block_bits
    blocks = (values >> np.uint64(below)).astype(np.int64)
    starts = np.flatnonzero(np.r_[True, blocks[1:] != blocks[:-1]]) if blocks.size else []
    rest = values & np.uint64((1 << below) - 1)
    quotients = (rest >> np.uint64(below - QUOTIENT_BITS)).astype(np.int64)
    remainders = rest & np.uint64((1 << (below - QUOTIENT_BITS)) - 1)
    packed = remainders.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :remainder_bytes]
    for start, end in zip(starts, [*starts[1:], blocks.size]):
        own = counts[start:end]
        places = np.flatnonzero(own > 1)
        yield {
            "block": int(blocks[start]),
            "runs": _narrow(np.bincount(quotients[start:end], minlength=1 << QUOTIENT_BITS)),
            "remainders": packed[start:end].tobytes(),
            "places": places.astype("<u4").tobytes(),
            "counts": own[places].astype("<i8").tobytes(),
        }


def merge(filters: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Quotient and remainder joined again, ascending, and their counts, over filters of one block."""
    values, counts = [], []
    for row in filters.itertuples(index=False):
        runs = np.frombuffer(row.runs, f"<u{len(row.runs) >> QUOTIENT_BITS}").astype(np.int64)
        n = int(runs.sum())
        packed = np.frombuffer(row.remainders, np.uint8).reshape(n, -1)
        wide = np.zeros((n, 8), np.uint8)
        wide[:, : packed.shape[1]] = packed
        quotients = np.repeat(np.arange(runs.size, dtype=np.uint64), runs)
        width = np.uint64(packed.shape[1])
        values.append((quotients, wide.view("<u8").ravel(), width))
        own = np.ones(n, np.int64)
        own[np.frombuffer(row.places, "<u4")] = np.frombuffer(row.counts, "<i8")
        counts.append(own)
    quotients = np.concatenate([q for q, _, _ in values])
    remainders = np.concatenate([r for _, r, _ in values])
    counts = np.concatenate(counts)
    order = np.lexsort((remainders, quotients))
    quotients, remainders, counts = quotients[order], remainders[order], counts[order]
    first = np.r_[True, (quotients[1:] != quotients[:-1]) | (remainders[1:] != remainders[:-1])]
    at = np.flatnonzero(first)
    return np.stack([quotients[at], remainders[at]]), np.add.reduceat(counts, at)


def own_values(column: pa.Array) -> Iterator[np.ndarray]:
    """The fingerprints that a column of longs holds."""
    yield column.to_numpy().view(np.uint64)


def repeated(
    rows: DataFrame,
    column: str,
    n: int,
    remainder_bytes: int = 7,
    prints: Callable[[pa.Array], Iterator[np.ndarray]] = own_values,
) -> DataFrame:
    """(print, count) of the 64-bit fingerprints that occur more than once.

    ``prints`` gives the fingerprints of a batch of ``column``, and n is about how many there are in
    all.  With fewer than 64 bits in use, print is the fingerprint with its last bits zero.  A task
    holds CHUNK fingerprints and those of one more row at most, and a block about PER_BLOCK
    different ones, each at most once per chunk, however many rows share one fingerprint.
    """
    bits = block_bits_for(n)
    used = min(64, bits + QUOTIENT_BITS + 8 * remainder_bytes)
    schema = pa.schema(
        [("block", pa.int64()), *[(c, pa.binary()) for c in ("runs", "remainders", "places", "counts")]]
    )

    def filters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for new in prints(batch.column(0)):
                held.append(new)
                size += new.size
                if size >= CHUNK:
                    blocks = build(np.concatenate(held), bits, remainder_bytes)
                    yield pa.RecordBatch.from_pylist(list(blocks), schema)
                    held, size = [], 0
        if size:
            blocks = build(np.concatenate(held), bits, remainder_bytes)
            yield pa.RecordBatch.from_pylist(list(blocks), schema)

    def merged(block: pd.DataFrame) -> pd.DataFrame:
        (quotients, remainders), counts = merge(block)
        more = counts > 1
        below = used - bits
        value = (
            (np.uint64(block["block"].iloc[0]) << np.uint64(below))
            | (quotients[more] << np.uint64(below - QUOTIENT_BITS))
            | remainders[more]
        ) << np.uint64(64 - used)
        return pd.DataFrame({"print": value.view(np.int64), "count": counts[more]})

    return (
        rows.select(column)
        .mapInArrow(filters, SCHEMA)
        .groupBy("block")
        .applyInPandas(merged, "print long, count long")
    )
