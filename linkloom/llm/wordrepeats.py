"""Substring deduplication on words: suffix trees over prefix-partitioned suffixes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkloom.llm.bitmap import hash_bitmap, in_bitmap
from linkloom.llm.copies import copies, keyed, texts, with_decisions, without
from linkloom.llm.quotient import repeated
from linkloom.llm.words import mixed, word_hashes
from linkloom.session import discard, materialize

#: Words of a window; suffixes are compared to this depth, in blocks of BLOCK words.
WINDOW = 20
BLOCK = 4
LEVELS = WINDOW // BLOCK
#: Words of an anchor, two blocks: each window has the anchor with the smallest hash in it.
ANCHOR = 2 * BLOCK
#: Suffixes of one range, which one task sorts.
PER_RANGE = 400_000

PATH = [f"s{i}" for i in range(LEVELS)]
PLACE = ["k", "h", "pos"]


def runs(hashes: np.ndarray, size: int) -> np.ndarray:
    """The hash of each run of ``size`` words, a power of two."""
    step = 1
    while step < size:
        hashes = mixed(hashes[:-step] * np.uint64(0x9E3779B97F4A7C15) + hashes[step:])
        step *= 2
    return hashes


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The place of the least of each ``width`` neighbours, the leftmost of equal ones."""
    at, step = np.arange(values.size), 1
    while step < width:
        more = min(step, width - step)
        left, right = at[:-more], at[more:]
        at = np.where(values[left] <= values[right], left, right)
        step += more
    return at


def anchors(hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of texts with ``counts`` words, one after the other: (blocks, windows, least, at).

    blocks has the hash of each run of BLOCK words.  windows are the places of the runs of WINDOW
    words that lie in one text, least the smallest hash of an anchor in each (the leftmost of equal
    ones), and at those hashes, once for each place.
    """
    if hashes.size < WINDOW:
        return hashes[:0], np.empty(0, np.int64), hashes[:0], hashes[:0]
    blocks = runs(hashes, BLOCK)
    found = mixed(blocks[:-BLOCK] * np.uint64(0x9E3779B97F4A7C15) + blocks[BLOCK:])
    places = _least(found, WINDOW - ANCHOR + 1)
    left = np.repeat(np.cumsum(counts), counts) - np.arange(hashes.size)
    windows = np.flatnonzero(left[: places.size] >= WINDOW)
    places = places[windows]
    # Anchors move to the right only, so equal places stand together.
    return blocks, windows, found[places], found[places[np.r_[True, places[1:] != places[:-1]][: places.size]]]


def anchor_hashes(column: pa.Array) -> Iterator[np.ndarray]:
    """The hashes of the anchors that the texts' windows have."""
    for _, hashes, counts in word_hashes(column):
        yield anchors(hashes, counts)[3]


def suffixes(rows: DataFrame, table: np.ndarray) -> DataFrame:
    """The suffixes whose window has an anchor that may repeat: s0.., k, h, pos.

    The path s0.. is the suffix's first WINDOW words, as a hash of each block of BLOCK words: 160
    bits in all.
    """
    shared = rows.sparkSession.sparkContext.broadcast(table)
    names = [*PATH, *PLACE]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [batch.column(i).to_numpy() for i in (0, 1)]
            parts = [[np.empty(0, np.int32)] * LEVELS + [k[:0] for k in keys] + [np.empty(0, np.int32)]]
            for row, hashes, counts in word_hashes(batch.column(2)):
                blocks, windows, least, _ = anchors(hashes, counts)
                own = windows[in_bitmap(shared.value, least)]
                text = np.repeat(np.arange(counts.size), counts)[own]
                pos = (own - (np.cumsum(counts) - counts)[text]).astype(np.int32)
                path = (blocks >> np.uint64(32)).astype(np.uint32).view(np.int32)
                parts.append([path[own + BLOCK * i] for i in range(LEVELS)] + [k[row + text] for k in keys] + [pos])
            # One batch for each that came in: many small ones leave the executor's memory in pieces.
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*parts)], names)

    schema = ", ".join(f"{s} int" for s in PATH) + ", k long, h long, pos int"
    return rows.select("_k", "_h", "_text").mapInArrow(cut, schema)


def subtrees(sorted_rows: DataFrame) -> DataFrame:
    """Leaves below the deep internal nodes of each range's suffix tree.

    A range holds sorted suffixes; the depth that neighbours have in common makes the tree.  A run
    of neighbours alike to depth WINDOW is an internal node at that depth: a repeat, whose first
    leaf stays.  The others come out with edge false.  A node may go on from one range to the next,
    so the first leaf of each range's first and last node comes out too, with edge true and its path.
    """
    names = [*PATH, *PLACE, "edge"]

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path = place = None  # path and first leaf of the node that is open
        edges: list[np.ndarray] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = np.stack([batch.column(i).to_numpy().astype(np.int64) for i in range(LEVELS + 3)], 1)
            paths, places = rows[:, :LEVELS], rows[:, LEVELS:]
            common = np.r_[path is not None and bool((paths[0] == path).all()), (paths[1:] == paths[:-1]).all(1)]
            if path is None:
                edges.append(rows[0])
            # The first leaf of each row's node: its own first row, or the one carried over.
            starts = np.flatnonzero(~common)
            first = np.empty_like(places)
            begin = starts[0] if starts.size else len(rows)
            if begin:
                first[:begin] = place
            if starts.size:
                first[begin:] = np.repeat(places[starts], np.diff(np.r_[starts, len(rows)]), axis=0)
            later = (places != first).any(1)
            path, place = paths[-1], first[-1]
            out = rows[later]
            arrays = [pa.array(out[:, i], pa.int64()) for i in range(LEVELS + 3)]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(np.zeros(len(out), bool))], names)
        if path is not None:
            edges.append(np.r_[path, place])
            out = np.stack(edges)
            arrays = [pa.array(out[:, i], pa.int64()) for i in range(LEVELS + 3)]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(np.ones(len(out), bool))], names)

    schema = ", ".join(f"{s} long" for s in names[:-1]) + ", edge boolean"
    return sorted_rows.select(*PATH, *PLACE).mapInArrow(walk, schema)


def repeated_windows(rows: DataFrame) -> DataFrame:
    """(_k, _h, starts, copy): windows of each row that also start earlier; copy: the whole text does.

    Order is by _k, then _h, then place.  Rows that are whole copies take no part: each of their
    windows starts earlier in the first row with that text.  Suffixes are cut into ranges of about
    PER_RANGE by the shortest prefixes that tell neighbouring ranges apart, with the place as last
    resort, so that even one window found in a third of all rows is spread over many tasks.
    """
    whole = copies(rows)
    distinct = without(rows, whole)
    n = distinct.select(F.sum(F.octet_length("_text"))).first()[0] or 0
    prints = repeated(distinct, "_text", n // 40, 4, anchor_hashes)
    table = hash_bitmap(prints.select("print"), "print")
    found = materialize(suffixes(distinct, table), "suffixes")
    order = [*PATH, *PLACE]
    ranges = max(1, -(-found.count() // PER_RANGE))
    leaves = materialize(
        subtrees(found.repartitionByRange(ranges, *order).sortWithinPartitions(*order)), "repeats"
    )
    discard(found)
    edges = leaves.filter("edge")  # two rows for each range
    first = edges.groupBy(*PATH).agg(F.min(F.struct(*PLACE)).alias("first"))
    carried = edges.join(first, PATH).filter(F.struct(*PLACE) > F.col("first"))
    starts = (
        leaves.filter("not edge")
        .select(*PLACE)
        .unionByName(carried.select(*PLACE))
        .groupBy(F.col("k").alias("_k"), F.col("h").alias("_h"))
        .agg(F.collect_set(F.col("pos").cast("int")).alias("starts"), F.lit(False).alias("copy"))
    )
    copied = whole.select("_k", "_h", F.lit(None).cast("array<int>").alias("starts"), F.lit(True).alias("copy"))
    starts = materialize(starts.unionByName(copied), "repeat-starts")
    discard(whole, leaves)
    return starts


KEPT = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("n_removed", T.LongType()),
        T.StructField("kept", T.StringType()),
    ]
)


@F.pandas_udf(KEPT)
def _kept(texts: pd.Series, starts: pd.Series, copy: pd.Series) -> pd.DataFrame:
    rows = []
    for text, own, whole in zip(texts, starts, copy):
        words = text.encode().split()
        n = len(words)
        if whole is True and n >= WINDOW:
            rows.append((n, n, ""))
        elif own is not None and len(own):
            change = np.zeros(n + 1, np.int32)
            own = np.asarray(own, np.int64)
            np.add.at(change, own, 1)
            np.add.at(change, own + WINDOW, -1)
            left = np.flatnonzero(np.cumsum(change[:-1]) == 0)
            rows.append((n, n - left.size, b" ".join([words[i] for i in left]).decode()))
        else:
            rows.append((n, 0, b" ".join(words).decode()))
    return pd.DataFrame(rows, columns=["n_words", "n_removed", "kept"])


def remove_repeated_words(docs: DataFrame) -> DataFrame:
    """``docs`` with n_words, n_removed and kept, the words left joined by one blank; columns of
    these names give way.

    Words are runs of other than ASCII blanks, unchanged.  A window is WINDOW consecutive words of
    one document.  Each word covered by a window whose words also start earlier (smaller doc_id, or
    the same document at an earlier place) goes; windows are judged on the texts as given.

    A suffix takes part only if the anchor of its window, the eight-word run with the smallest hash
    in it, occurs more than once; equal windows have equal anchors, so this loses nothing.

    Null text counts as empty: no words.  A null doc_id is smaller than any other.  doc_id names a
    document: of rows repeated with doc_id and text none is earlier, and rows with one doc_id and
    different texts are ordered by a hash of the text.  Other columns come out as they are.  No rows
    in, no rows out.
    """
    rows = keyed(docs)
    decided = with_decisions(rows, repeated_windows(texts(rows)))
    text = F.coalesce(F.col("_row.text"), F.lit(""))
    result = decided.withColumn("_kept", _kept(text, "starts", "copy"))
    others = [F.col("_row").getField(c).alias(c) for c in docs.columns if c not in KEPT.names]
    return result.select(*others, "_kept.*")


def drop_repeated_words(docs: DataFrame) -> DataFrame:
    """``docs`` with the repeated words taken out of text, and n_chars to match.

    Texts without repeats stay as they are to the byte; rows left without any words stay, with an
    empty text.
    """
    clean = remove_repeated_words(docs.select("doc_id", "text", F.struct(*docs.columns).alias("_all")))
    cut = F.col("n_removed") > 0
    changed = {"text": F.col("kept"), "n_chars": F.length("kept").cast("long")}
    return clean.select(
        *[
            (F.when(cut, changed[c]).otherwise(old) if c in changed else old).alias(c)
            for c in docs.columns
            for old in [F.col("_all").getField(c)]
        ]
    )
