"""Phrase collocation mining: pairs of frequency-ranked ids counted in tiles, level by level."""

from __future__ import annotations

import itertools
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkloom.session import materialize

#: Words of the longest phrase.
LONGEST = 5
#: A tile holds pairs of 2**TILE_BITS first and as many second ids: at most 2**20 cells.
TILE_BITS = 10
#: A tile is counted in a dense array if it has at least one pair for so many cells, else by sorting.
SPARSE = 16
#: Bytes of text of one part (a single larger text is a part of its own), and of text split at once.
PART_BYTES = 8 << 20
SLICE_BYTES = 1 << 20
#: Parts whose blocks of one tile are merged at once; more are merged in rounds.
FAN = 256

_END = b"\xff"  # stands in no UTF-8 text
_TABLE = bytes(
    c + 32 if 65 <= c <= 90 else 32 if c == 9 else 255 if c in b".,;:!?\n\x0b\x0c\r" else c for c in range(256)
)
_GAP = re.compile(rb"[ \xff]")
_NAMES = ["part", "lang", "bucket", "ids", "places", "words", "counts"]
_PARTS = "part long, lang string, bucket long, ids binary, places binary, words binary, counts binary"
#: How hard ids are compressed: they are most of what is stored and sent.
IDS_LEVEL = 9
#: Bytes of text for each bucket of words.
BUCKET_BYTES = 64 << 20
_PAIRS = "part long, lang string, ids binary, ti long, tj long, start int, cells binary, counts binary"


def packed(values: np.ndarray, level: int = 3) -> bytes:
    """An array of integers with equal bytes of all values side by side, compressed."""
    planes = values.view(np.uint8).reshape(values.size, values.itemsize).T
    return zstandard.ZstdCompressor(level=level).compress(planes.tobytes())


def unpacked(data: bytes, kind: type) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.ascontiguousarray(planes.reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


def packed_cells(cells: np.ndarray) -> bytes:
    return packed(np.diff(cells, prepend=np.int32(0)))


def unpacked_cells(data: bytes) -> np.ndarray:
    return np.cumsum(unpacked(data, np.int32), dtype=np.int32)


_COMPRESS, _EXPAND = zstandard.compress, zstandard.decompress


class _Ids(dict):
    """Numbers words in the order they are met."""

    def __missing__(self, word: bytes) -> int:
        self[word] = found = len(self)
        return found


def numbered(texts: list[bytes], at_once: int = SLICE_BYTES) -> tuple[np.ndarray, list[bytes]]:
    """Local word ids of the texts in order, -1 where a piece ends, and the words by id."""
    data = _END.join(texts).translate(_TABLE)
    ids = _Ids({_END: 0})
    found, start = [], 0
    while start < len(data):
        gap = _GAP.search(data, start + at_once)
        end = gap.start() if gap else len(data)
        words = data[start:end].replace(_END, b" \xff ").split(b" ")
        words = [w for w in words if w]
        found.append(np.fromiter(map(ids.__getitem__, words), np.int32, len(words)))
        start = end
    return np.concatenate([np.empty(0, np.int32), *found]) - 1, list(ids)[1:]


def word_parts(docs: DataFrame, buckets: int, part_bytes: int = PART_BYTES) -> DataFrame:
    """Texts as parts of one lang each: a row with all local ids, and a row for each bucket of local words.

    A part has the texts of one task up to ``part_bytes``, so neither the ids nor the words of a part grow
    with the corpus.  A word's bucket is its CRC-32 modulo ``buckets``.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, serial = TaskContext.get().partitionId(), itertools.count()
        waiting: dict[str, list[bytes]] = {}
        sizes: dict[str, int] = {}

        def rows(lang: str) -> Iterator[pa.RecordBatch]:
            part = task << 32 | next(serial)
            sizes.pop(lang)
            ids, words = numbered(waiting.pop(lang))
            if not words:
                return
            counts = np.bincount(ids[ids >= 0], minlength=len(words))
            bucket = np.fromiter(map(zlib.crc32, words), np.int64, len(words)) % buckets
            order = np.argsort(bucket, kind="stable").astype(np.int32)
            columns: list[list] = [[None], [packed(ids, IDS_LEVEL)], [None], [None], [None]]
            for own in np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1):
                joined = _COMPRESS(_END.join([words[k] for k in own]))
                values = (int(bucket[own[0]]), None, packed_cells(own), joined, packed(counts[own]))
                for column, value in zip(columns, values):
                    column.append(value)
            kinds = [pa.int64(), *[pa.binary()] * 4]
            n = len(columns[0])
            keys = [pa.array([part] * n), pa.array([lang] * n, pa.string())]
            yield pa.RecordBatch.from_arrays([*keys, *map(pa.array, columns, kinds)], _NAMES)

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
                waiting.setdefault(lang, []).append(text)
                sizes[lang] = sizes.get(lang, 0) + len(text)
                if sizes[lang] >= part_bytes:
                    yield from rows(lang)
                elif sum(sizes.values()) >= 4 * part_bytes:
                    yield from rows(max(sizes, key=sizes.get))
        for lang in list(waiting):
            yield from rows(lang)

    lang, text = F.coalesce("lang", F.lit("und")), F.coalesce("text", F.lit(""))
    return materialize(docs.select(lang.alias("lang"), text.alias("text")).mapInArrow(cut, _PARTS), "phrase-words")


def merged_words(blocks: DataFrame, fan: int = FAN) -> DataFrame:
    """(lang, word, f) over all parts; blocks of a bucket meet in rounds as those of a tile do."""

    def merge(last: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            opened, held = None, Counter()

            def out() -> pa.RecordBatch:
                lang, bucket, group = opened
                words, counts = list(held), np.fromiter(held.values(), np.int64, len(held))
                if not last:
                    values = [[lang], [bucket], [group], [_COMPRESS(_END.join(words))], [packed(counts)]]
                    kinds = [pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
                    return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, kinds)], [*key, "words", "counts"])
                columns = [pa.array([lang] * len(words), pa.string()), pa.array(words, pa.binary()).cast(pa.string())]
                return pa.RecordBatch.from_arrays([*columns, pa.array(counts)], ["lang", "word", "f"])

            for batch in batches:
                for *k, words, counts in zip(*[batch.column(c).to_pylist() for c in range(5)]):
                    if k != opened:
                        if opened:
                            yield out()
                        opened, held = k, Counter()
                    held.update(dict(zip(_EXPAND(words).split(_END), unpacked(counts, np.int64).tolist())))
            if opened:
                yield out()

        return run

    key = ["lang", "bucket", "group"]
    schemas = ["lang string, bucket long, `group` long, words binary, counts binary", "lang string, word string, f long"]
    return _in_rounds(blocks, key, ["words", "counts"], merge, schemas, fan, "phrase-words")


def word_ranks(blocks: DataFrame, ranked: DataFrame, buckets: int) -> DataFrame:
    """(part, places, ranks): what the words of each part's buckets are ranked, -1 for rare ones."""

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for words, known in zip(batch.column(2).to_pylist(), batch.column(3)):
                pairs = known.values
                table = dict(zip(pairs.field(0).cast(pa.binary()).to_pylist(), pairs.field(1).to_pylist()))
                ranks = [table.get(w, -1) for w in _EXPAND(words).split(_END)]
                found.append(packed(np.array(ranks, np.int64)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(found, pa.binary())], ["part", "places", "ranks"])

    bucket = F.pmod(F.crc32(F.col("word").cast("binary")), F.lit(buckets)).alias("bucket")
    known = ranked.select("lang", bucket, F.struct("word", "rank").alias("pair"))
    known = known.groupBy("lang", "bucket").agg(F.collect_list("pair").alias("known"))
    joined = blocks.join(known, ["lang", "bucket"]).select("part", "places", "words", "known")
    return joined.mapInArrow(look, "part long, places binary, ranks binary")


def tile_blocks(first: np.ndarray, second: np.ndarray, bits: int = TILE_BITS) -> tuple[np.ndarray, list[tuple]]:
    """Number of each pair among the distinct pairs, and (ti, tj, start, cells, counts) by tile.

    The pairs of a tile are the numbers from ``start`` on, in the order of their cells.
    """
    mask, n_cells = (1 << bits) - 1, 1 << 2 * bits
    tile = (first >> bits) << 32 | second >> bits
    cell = ((first & mask) << bits | second & mask).astype(np.int32)
    order = np.argsort(tile, kind="stable")
    tile, cell = tile[order], cell[order]
    cuts = np.r_[0, np.flatnonzero(tile[1:] != tile[:-1]) + 1, tile.size]
    numbers, blocks, start = np.empty(tile.size, np.int32), [], 0
    for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        own = cell[lo:hi]
        if own.size * SPARSE >= n_cells:
            dense = np.bincount(own, minlength=n_cells)
            found = np.flatnonzero(dense).astype(np.int32)
            counts, place = dense[found], np.empty(n_cells, np.int32)
            place[found] = np.arange(found.size)
            inverse = place[own]
        else:
            found, inverse, counts = np.unique(own, return_inverse=True, return_counts=True)
        numbers[order[lo:hi]] = start + inverse
        blocks.append((int(tile[lo] >> 32), int(tile[lo] & 0xFFFFFFFF), start, found, counts.astype(np.int64)))
        start += found.size
    return numbers, blocks


def part_pairs(parts: DataFrame, ranks: DataFrame, bits: int = TILE_BITS) -> DataFrame:
    """Adjacent pairs of ranked ids in each part: its ids one level up, and the counts of its tiles.

    ``parts`` are (part, lang, ids); ``ranks`` (part, places, ranks) are what came back for the part's
    local ids.  A part and its ranks meet in one task; both are bounded by the size of a part.
    """

    def pair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        answers: list[tuple[bytes, bytes]] = []
        for batch in batches:
            for part, lang, ids, places, ranked in zip(*[batch.column(c).to_pylist() for c in range(5)]):
                if ids is None:
                    answers.append((places, ranked))
                else:
                    yield from paired(part, lang, unpacked(ids, np.int32), answers)
                    answers = []

    def paired(part: int, lang: str, seq: np.ndarray, answers: list) -> Iterator[pa.RecordBatch]:
        known = [(unpacked_cells(places), unpacked(found, np.int64)) for places, found in answers]
        top = max([int(seq.max(initial=-1)), *[int(places[-1]) for places, _ in known]])
        table = np.full(top + 2, -1, np.int64)  # its last place answers for -1
        for places, found in known:
            table[places] = found
        ranked = table[seq]
        at = np.flatnonzero((ranked[:-1] >= 0) & (ranked[1:] >= 0))
        if not at.size:
            return
        numbers, tiles = tile_blocks(ranked[at], ranked[at + 1], bits)
        above = np.full(seq.size - 1, -1, np.int32)
        above[at] = numbers
        edged = np.r_[-1, above, -1]
        above[(edged[:-2] < 0) & (edged[2:] < 0)] = -1  # alone: in no longer phrase
        above = above[np.r_[True, (above[1:] >= 0) | (above[:-1] >= 0)]]  # one -1 is enough between runs
        names = ["part", "lang", "ids", "ti", "tj", "start", "cells", "counts"]
        n = len(tiles)
        nulls = [pa.nulls(1, t) for t in (pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary())]
        yield pa.RecordBatch.from_arrays(
            [pa.array([part]), pa.array([lang], pa.string()), pa.array([packed(above, IDS_LEVEL)], pa.binary()), *nulls], names
        )
        ti, tj, start, cells, counts = zip(*tiles)
        yield pa.RecordBatch.from_arrays(
            [
                *[pa.array([part] * n), pa.array([lang] * n, pa.string()), pa.nulls(n, pa.binary())],
                *[pa.array(ti, pa.int64()), pa.array(tj, pa.int64()), pa.array(start, pa.int32())],
                *[pa.array(list(map(pack, c)), pa.binary()) for pack, c in ((packed_cells, cells), (packed, counts))],
            ],
            names,
        )

    none = F.lit(None)
    seqs = parts.select("part", "lang", "ids", *[none.cast("binary").alias(c) for c in ("places", "ranks")])
    back = ranks.select("part", none.cast("string").alias("lang"), none.cast("binary").alias("ids"), "places", "ranks")
    feed = seqs.unionByName(back).repartition("part").sortWithinPartitions("part", F.col("ids").isNotNull())
    return materialize(feed.mapInArrow(pair, _PAIRS), "phrase-pairs")


def _summed(blocks: list[tuple[np.ndarray, np.ndarray]], n_cells: int) -> tuple[np.ndarray, np.ndarray]:
    """Cells and counts of blocks of one tile together."""
    if sum(c.size for c, _ in blocks) * SPARSE >= n_cells:
        dense = np.zeros(n_cells, np.int64)
        for cells, counts in blocks:
            dense[cells] += counts
        found = np.flatnonzero(dense).astype(np.int32)
        return found, dense[found]
    cells, counts = (np.concatenate(x) for x in zip(*blocks))
    order = np.argsort(cells, kind="stable")
    cells, counts = cells[order], counts[order]
    first = np.flatnonzero(np.r_[True, cells[1:] != cells[:-1]])
    return cells[first], np.add.reduceat(counts, first)


def merged_tiles(blocks: DataFrame, least: int, bits: int = TILE_BITS, fan: int = FAN) -> DataFrame:
    """(lang, i, j, f) of the pairs counted ``least`` times or more over all parts.

    Blocks of a tile meet in groups of ``fan`` parts or so, and merged blocks again, so that no task reads
    more than about ``fan`` blocks of a tile, each of 4**bits cells at most.
    """
    key, n_cells = ["lang", "ti", "tj", "group"], 1 << 2 * bits

    def merge(last: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            opened, held, entries = None, [], 0

            def out() -> pa.RecordBatch:
                lang, ti, tj, group = opened
                cells, counts = _summed(held, n_cells)
                if not last:
                    values = [[lang], [ti], [tj], [group], [packed_cells(cells)], [packed(counts)]]
                    kinds = [pa.string(), *[pa.int64()] * 3, pa.binary(), pa.binary()]
                    return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, kinds)], [*key, "cells", "counts"])
                often = counts >= least
                cells = cells[often].astype(np.int64)
                i, j = (ti << bits) + (cells >> bits), (tj << bits) + (cells & ((1 << bits) - 1))
                columns = [pa.array([lang] * cells.size, pa.string()), pa.array(i), pa.array(j), pa.array(counts[often])]
                return pa.RecordBatch.from_arrays(columns, ["lang", "i", "j", "f"])

            for batch in batches:
                for *k, cells, counts in zip(*[batch.column(c).to_pylist() for c in range(6)]):
                    if k != opened:
                        if opened:
                            yield out()
                        opened, held, entries = k, [], 0
                    held.append((unpacked_cells(cells), unpacked(counts, np.int64)))
                    entries += held[-1][0].size
                    if entries > 2 * n_cells:
                        held = [_summed(held, n_cells)]
                        entries = held[0][0].size
            if opened:
                yield out()

        return run

    schemas = ["lang string, ti long, tj long, `group` long, cells binary, counts binary", "lang string, i long, j long, f long"]
    return _in_rounds(blocks, key, ["cells", "counts"], merge, schemas, fan, "phrase-counts")


def _in_rounds(blocks: DataFrame, key: list[str], values: list[str], merge, schemas: list[str], fan: int, label: str) -> DataFrame:
    """Blocks alike in ``key`` (the last of which is their group) merged, then groups with others, until one is left."""
    groups = -(-max(1, blocks.select("part").distinct().count()) // fan)
    blocks = blocks.withColumn("group", F.pmod(F.xxhash64("part"), F.lit(groups)))
    while True:
        sent = blocks.select(*key, *values).repartition(*key).sortWithinPartitions(*key)
        if groups == 1:
            return materialize(sent.mapInArrow(merge(True), schemas[1]), label)
        blocks = sent.mapInArrow(merge(False), schemas[0]).withColumn("group", F.expr(f"`group` div {fan}"))
        groups = -(-groups // fan)


def frequency_ranks(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows (lang, keys, f) with ``rank``: 0 for the most frequent of each lang.

    Ranks come from ranges and the counts of the ranges before, so no task needs a whole lang.
    """
    order = [F.desc("f"), *keys]
    ranges = rows.repartitionByRange("lang", *order).withColumn("range", F.spark_partition_id())
    ranges = materialize(ranges, "phrase-ranges")
    sizes = ranges.groupBy("lang", "range").agg(F.count(F.lit(1)).alias("rows"))
    until = F.sum("rows").over(Window.partitionBy("lang").orderBy("range"))
    before = sizes.select("lang", "range", (until - F.col("rows")).alias("before"))
    inside = F.row_number().over(Window.partitionBy("lang", "range").orderBy(*order))
    placed = ranges.withColumn("inside", inside).join(before, ["lang", "range"])
    rank = F.col("before") + F.col("inside") - 1
    return materialize(placed.select("lang", *keys, "f", rank.alias("rank")), "phrase-ranks")


def block_ranks(blocks: DataFrame, ranked: DataFrame, bits: int = TILE_BITS) -> DataFrame:
    """(part, places, ranks): what the pairs of each part's tiles are ranked, -1 for rare ones."""

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known, found, places = batch.column(3), [], []
            values = [known.values.field(i).to_numpy(zero_copy_only=False) for i in (0, 1)]
            offsets = known.offsets.to_numpy()
            for k in range(batch.num_rows):
                cells, ranks = (v[offsets[k] : offsets[k + 1]] for v in values)
                own = unpacked_cells(batch.column(2)[k].as_py())
                start = batch.column(1)[k].as_py()
                places.append(packed_cells(np.arange(start, start + own.size, dtype=np.int32)))
                place = np.minimum(np.searchsorted(cells, own), cells.size - 1)
                found.append(packed(np.where(cells[place] == own, ranks[place], -1).astype(np.int64)))
            columns = [batch.column(0), pa.array(places, pa.binary()), pa.array(found, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["part", "places", "ranks"])

    mask = (1 << bits) - 1
    cell = F.shiftleft(F.col("i").bitwiseAND(F.lit(mask)), bits).bitwiseOR(F.col("j").bitwiseAND(F.lit(mask)))
    tile = [F.shiftright(c, bits).alias(t) for c, t in (("i", "ti"), ("j", "tj"))]
    known = ranked.select("lang", *tile, F.struct(cell.cast("int").alias("cell"), "rank").alias("pair"))
    known = known.groupBy("lang", "ti", "tj").agg(F.array_sort(F.collect_list("pair")).alias("known"))
    joined = blocks.join(known, ["lang", "ti", "tj"]).select("part", "start", "cells", "known")
    return joined.mapInArrow(look, "part long, places binary, ranks binary")


def frequent_phrases(
    docs: DataFrame, least: int, part_bytes: int = PART_BYTES, bits: int = TILE_BITS, fan: int = FAN
) -> tuple[DataFrame, list[DataFrame]]:
    """(lang, n), and for each length the phrases found ``least`` times: (lang, rank, f) with word or i, j.

    A phrase is a pair of ranks one level below, its words without the last and without the first.
    """
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = 1 + size // BUCKET_BYTES
    table = word_parts(docs, buckets, part_bytes)
    parts = table.filter("ids is not null").select("part", "lang", "ids")
    blocks = table.filter("ids is null").select("part", "lang", "bucket", "places", "words", "counts")
    counted = merged_words(blocks, fan)
    totals = materialize(counted.groupBy("lang").agg(F.sum("f").alias("n")), "phrase-totals")
    levels = [frequency_ranks(counted.filter(F.col("f") >= least), ["word"])]
    ranks = word_ranks(blocks, levels[0], buckets)
    while len(levels) < LONGEST and not levels[-1].isEmpty():
        table = part_pairs(parts, ranks, bits)
        parts = table.filter("ids is not null").select("part", "lang", "ids")
        blocks = table.filter("ids is null").select("part", "lang", "ti", "tj", "start", "cells", "counts")
        levels.append(frequency_ranks(merged_tiles(blocks, least, bits, fan), ["i", "j"]))
        ranks = block_ranks(blocks, levels[-1], bits)
    if levels[1:] and levels[-1].isEmpty():
        levels.pop()
    return totals, levels


def _cut_scores(size: int) -> Column:
    """The lowest-scoring cut of a phrase of ``size`` words: score, k, l, r."""
    whole = F.lit(1000).cast("decimal(4,0)") * (F.col("a").cast("decimal(19,0)") * F.col("n").cast("decimal(19,0)"))
    cuts = []
    for k in range(1, size):
        left, right = F.col("heads")[k - 1], F.col("tails")[size - k - 1]
        product = left.cast("decimal(19,0)") * right.cast("decimal(19,0)")
        score = F.call_function("div", whole, product).cast("long")
        cuts.append(F.struct(score.alias("score"), F.lit(k).alias("k"), left.alias("l"), right.alias("r")))
    return F.array_min(F.array(*cuts))


def collocations(docs: DataFrame, *, least: int = 100, top: int = 2000, **tiling: int) -> DataFrame:
    """The ``top`` phrases of each lang by score: lang, rank, phrase, a, l, r, n, score.

    Texts are lower-cased (A-Z), cut into pieces at ``.,;:!?`` and line ends and those into words at blanks
    and tabs.  Phrases are 2 to LONGEST words of a piece, found ``a`` >= ``least`` times.  Each cut into a first
    and a second part, found l and r times, scores floor(1000 * a * n / (l * r)), n being all words of the
    lang; the lowest-scoring cut counts.  Phrases inside a longer one as frequent go: as counts only fall with
    each word more, it is enough to look one word further.

    Words get ids by frequency.  Pairs of ids fall into tiles, counted per part in dense arrays or, where
    sparse, by sorting; frequent pairs are ranked anew and are the ids of the next level, where two that
    overlap are a phrase of one word more.  Parts get back the ranks of their own pairs only.  ``tiling``
    may change sizes (part_bytes, bits, fan); the result is the same.

    A null text is empty, a null lang is ``und``; empty texts and tables give no rows.  Repeated rows all count.
    Other columns are not read.  Arithmetic is exact while 1000 * a * n is below 10**38 and ids below 2**32.
    """
    totals, levels = frequent_phrases(docs, least, **tiling)
    counts = F.array("f")
    below = levels[0].select("lang", "rank", "f", F.array("word").alias("words"), counts.alias("heads"), counts.alias("tails"))
    found, inside = [], None
    for size, level in enumerate([*levels[1:], None], 2):
        if level is not None:
            x, y, p = below.alias("x"), below.alias("y"), level.alias("p")
            joined = p.join(x, (F.col("p.lang") == F.col("x.lang")) & (F.col("p.i") == F.col("x.rank"))).join(
                y, (F.col("p.lang") == F.col("y.lang")) & (F.col("p.j") == F.col("y.rank"))
            )
            f = F.array("p.f")
            here = materialize(
                joined.select(
                    *["p.lang", "p.rank", "p.f", "p.i", "p.j", F.col("x.f").alias("fi"), F.col("y.f").alias("fj")],
                    F.concat("x.words", F.slice("y.words", -1, 1)).alias("words"),
                    F.concat("x.heads", f).alias("heads"),
                    F.concat("y.tails", f).alias("tails"),
                ),
                "phrases",
            )
            sides = [here.filter(f"f >= f{s}").select("lang", F.col(s).alias("rank")) for s in "ij"]
            inside = sides[0].unionByName(sides[1]).distinct()
        if size > 2:
            kept = below if level is None else below.join(inside, ["lang", "rank"], "left_anti")
            kept = kept.withColumnRenamed("f", "a").join(totals, "lang").withColumn("cut", _cut_scores(size - 1))
            found.append(kept.select("lang", F.array_join("words", " ").alias("phrase"), "a", "cut.l", "cut.r", "n", "cut.score"))
        if level is not None:
            below = here
    if not found:
        kinds = "lang string, rank long, phrase string, a long, l long, r long, n long, score long"
        return docs.sparkSession.createDataFrame([], kinds)
    rows = reduce(DataFrame.unionByName, found)
    best = [F.desc("score"), F.desc("a"), "phrase"]
    rows = rows.withColumn("share", F.pmod(F.xxhash64("phrase"), F.lit(64)))  # so that no task ranks a whole lang
    first = F.row_number().over(Window.partitionBy("lang", "share").orderBy(*best))
    rows = rows.withColumn("rank", first).filter(F.col("rank") <= top)
    rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best)).cast("long"))
    return rows.filter(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
