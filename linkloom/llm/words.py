"""Hashes of the words of many texts at once, in numpy over their bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

#: Bytes of text looked at in one go; a longer text is looked at alone.
AT_ONCE = 1 << 20
#: Words longer than this many bytes are hashed one by one.
LONG = 64

_BLANK = np.isin(np.arange(256), [*b" \t\n\v\f\r"])
_LOWER = np.array([c + 32 if 65 <= c <= 90 else c for c in range(256)], np.uint8)
_FIRST = np.array([(1 << 8 * i) - 1 for i in range(9)], np.uint64)  # masks of the first i bytes
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _hashed(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word, eight bytes of all words at a time."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray((data.size + 1,), "<u8", padded, strides=(1,))  # the eight bytes from each place on
    sizes = ends - starts
    found = mixed(sizes.astype(np.uint64) * _GOLDEN)
    found = mixed(found ^ (eight[starts] & _FIRST[np.minimum(sizes, 8)]))
    done, more = 8, np.flatnonzero(sizes > 8)
    while more.size and done < LONG:
        part = eight[starts[more] + done] & _FIRST[np.minimum(sizes[more] - done, 8)]
        found[more] = mixed(found[more] * _GOLDEN ^ part)
        done += 8
        more = more[sizes[more] > done]
    for i in more:
        found[i] = xxhash.xxh3_64_intdigest(padded[starts[i] : ends[i]])
    return found


def word_hashes(texts: pa.Array, lower: bool = False) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, hashes, counts) of slices of a column of texts without nulls.

    Words are runs of other than ASCII blanks; ``lower`` lower-cases A-Z.  hashes are those of all
    words of the slice one after the other, counts the number of words of each of its rows.
    """
    texts = texts.cast(pa.large_binary())
    if not len(texts):
        return
    _, places, content = texts.buffers()
    offsets = np.frombuffer(places, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    everything = np.frombuffer(content, np.uint8) if content else np.empty(0, np.uint8)
    first = 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + AT_ONCE, "right")) - 1)
        own = offsets[first : last + 1] - offsets[first]
        data = everything[offsets[first] : offsets[last]]
        if data.size:
            blank = _BLANK[data]
            begins, stops = np.empty((2, data.size), bool)
            begins[1:], stops[:-1] = blank[:-1], blank[1:]
            begins[own[:-1][own[:-1] < data.size]] = True
            stops[own[1:] - 1] = True  # for an empty text in front this is the last byte of all, which stops too
            starts = np.flatnonzero(begins & ~blank)
            ends = np.flatnonzero(stops & ~blank) + 1
            hashes = _hashed(_LOWER[data] if lower else data, starts, ends)
            counts = np.diff(np.searchsorted(starts, own))
        else:
            hashes, counts = np.empty(0, np.uint64), np.zeros(last - first, np.int64)
        yield first, hashes, counts
        first = last
