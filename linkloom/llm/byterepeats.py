"""Substring deduplication on bytes: prefix-free parsing and suffix arrays of its dictionary."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkloom.llm.bitmap import bits_for, hash_bitmap, in_bitmap, may_hold
from linkloom.llm.copies import apart, copies, keyed, texts
from linkloom.llm.quotient import repeated
from linkloom.llm.words import mixed
from linkloom.session import discard, materialize

#: Bytes of a string that counts as a repeat.
WINDOW = 50
#: Bytes that the rolling hash covers.
GRAM = 16
#: Bytes of texts that are hashed at once; a longer text is hashed alone.
TOGETHER = 1 << 17
#: Windows of a phrase at most; longer runs become several phrases.
LONGEST = 256
#: Windows that a task sorts at once; a trigger that has so many alone is split by its windows.
SORTED = 400_000
#: Places of phrases that a task of the parse gathers before it writes them.
PARSED = 1 << 15


def _least(hashes: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each run of ``width`` values, by doubling."""
    size, least = 1, hashes
    while 2 * size <= width:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    n = hashes.size - width + 1
    return np.minimum(least[:n], least[width - size :][:n])


def gram_hashes(data: bytes) -> np.ndarray:
    """The rolling hash of each GRAM bytes; none for a text shorter than a window."""
    if len(data) < WINDOW:
        return np.empty(0, np.uint64)
    n = len(data) - GRAM + 1
    eight = np.ndarray(len(data) - 7, "<u8", data, strides=(1,))
    return mixed(mixed(eight[:n] + np.uint64(0x9E3779B97F4A7C15)) ^ eight[8 : n + 8])


def window_triggers(grams: np.ndarray) -> np.ndarray:
    """For each window the smallest rolling hash in it: the hash of its trigger.

    A text is parsed where this value changes, so the parse depends on content alone: equal windows
    have equal triggers wherever they stand, and each window lies in exactly one phrase.
    """
    return _least(grams, WINDOW - GRAM + 1) if grams.size else grams


def window_contexts(grams: np.ndarray) -> np.ndarray:
    """The same with the hash of 2 * GRAM bytes, which strings seldom share by chance."""
    if not grams.size:
        return grams
    long = mixed(grams[:-GRAM] * np.uint64(0x9E3779B97F4A7C15) + grams[GRAM:])
    return _least(long, WINDOW - 2 * GRAM + 1)


def together(column: pa.Array) -> Iterator[tuple[int, bytes, np.ndarray]]:
    """Texts in runs of about TOGETHER bytes: the first one's row, their bytes, and the length of each."""
    row, held, size = 0, [], 0
    for i, text in enumerate(column.cast(pa.binary()).to_pylist()):
        held.append(text)
        size += len(text)
        if size >= TOGETHER:
            yield row, b"".join(held), np.array([*map(len, held)])
            row, held, size = i + 1, [], 0
    if held:
        yield row, b"".join(held), np.array([*map(len, held)])


def _windows(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each place with WINDOW bytes after it: whether they lie in one text, and its text."""
    ends = np.cumsum(lengths)
    n = max(0, int(ends[-1]) - WINDOW + 1)
    text = np.repeat(np.arange(lengths.size), lengths)[:n]
    return ends[text] - np.arange(n) >= WINDOW, text


def _runs(*columns: np.ndarray) -> np.ndarray:
    """Where a run of places alike in all columns begins."""
    new = np.zeros(columns[0].size, bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def _held(table: np.ndarray, values: np.ndarray) -> np.ndarray:
    """:func:`in_bitmap` of the values' prints, looked up once for each run of equal values."""
    heads = _runs(values)
    return np.repeat(in_bitmap(table, mixed(values[heads])), np.diff(np.r_[heads, values.size]))


def _once(values: np.ndarray, text: np.ndarray) -> np.ndarray:
    """The prints of the values, each once for each text that has it.

    Values are least hashes, which crowd at the low end: by their first bits they would share few
    places of a bitmap and few blocks of a filter.  Mixed again they spread over all, one to one.
    """
    order = np.lexsort((text, values))
    values, text = values[order], text[order]
    return mixed(values[_runs(values, text)])


def trigger_hashes(column: pa.Array) -> Iterator[np.ndarray]:
    """The prints of the trigger hashes of each text's windows, each once a text."""
    for _, data, lengths in together(column):
        found = window_triggers(gram_hashes(data))
        whole, text = _windows(lengths)
        heads = _runs(found, whole)
        heads = heads[whole[heads]]
        yield _once(found[heads], text[heads])


def context_hashes(table: Broadcast) -> Callable[[pa.Array], Iterator[np.ndarray]]:
    """The prints of the context hashes of each text's windows whose trigger may repeat, each once a text."""

    def find(column: pa.Array) -> Iterator[np.ndarray]:
        for _, data, lengths in together(column):
            grams = gram_hashes(data)
            found = window_contexts(grams)
            whole, text = _windows(lengths)
            may = whole & _held(table.value, window_triggers(grams))
            heads = _runs(found, may)
            heads = heads[may[heads]]
            yield _once(found[heads], text[heads])

    return find


def parse(rows: DataFrame, triggers: Broadcast, contexts: Broadcast) -> DataFrame:
    """Phrases of each row that may stand in several, in rows of two kinds: where a phrase stands
    (trigger, p, k, h, start), and what it is (trigger, p, phrase, first, last).

    A phrase is the bytes of a run of windows with one trigger; neighbours overlap by WINDOW - 1
    bytes.  The trigger and p, a hash of its bytes, are its name in the parse: 128 bits.  Its bytes
    are written once for each PARSED places of a task, with the smallest and largest document there.
    """
    places, words = ["k", "h", "start"], ["phrase", "first", "last"]
    kinds = [pa.int64()] * 4 + [pa.int32(), pa.binary(), pa.int64(), pa.int64()]
    layout = pa.schema(list(zip(["trigger", "p", *places, *words], kinds)))

    def rows_of(columns: dict[str, pa.Array]) -> pa.RecordBatch:
        n = len(columns["p"])
        return pa.RecordBatch.from_arrays([columns.get(f.name, pa.nulls(n, f.type)) for f in layout], schema=layout)

    def both(held: list[tuple[np.ndarray, ...]], phrases: list[bytes]) -> Iterator[pa.RecordBatch]:
        trigger, k, h, start = (np.concatenate(c) for c in zip(*held))
        p = np.fromiter(map(xxhash.xxh3_64_intdigest, phrases), np.uint64, len(phrases)).view(np.int64)
        yield rows_of({c: pa.array(v) for c, v in zip(["trigger", "p", *places], (trigger, p, k, h, start))})
        order = np.lexsort((p, trigger))
        new = (trigger[order[1:]] != trigger[order[:-1]]) | (p[order[1:]] != p[order[:-1]])
        heads = np.flatnonzero(np.r_[True, new])
        one = order[heads]
        found = {"trigger": pa.array(trigger[one]), "p": pa.array(p[one])}
        found["phrase"] = pa.array([phrases[i] for i in one.tolist()], pa.binary())
        found["first"] = pa.array(np.minimum.reduceat(k[order], heads))
        found["last"] = pa.array(np.maximum.reduceat(k[order], heads))
        yield rows_of(found)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, phrases = [], []
        for batch in batches:
            keys = [batch.column(i).to_numpy() for i in (0, 1)]
            for row, data, lengths in together(batch.column(2)):
                grams = gram_hashes(data)
                found = window_triggers(grams)
                whole, text = _windows(lengths)
                may = whole & _held(triggers.value, found) & _held(contexts.value, window_contexts(grams))
                heads = _runs(found, may)
                ends = np.r_[heads[1:], found.size].astype(np.int64)
                heads, ends = heads[may[heads]], ends[may[heads]]
                times = -(-(ends - heads) // LONGEST)
                ends = np.repeat(ends, times)
                step = np.arange(ends.size) - np.repeat(np.cumsum(times) - times, times)
                heads = np.repeat(heads, times) + LONGEST * step
                ends = np.minimum(heads + LONGEST, ends) - 1 + WINDOW
                own = text[heads]
                start = (heads - (np.cumsum(lengths) - lengths)[own]).astype(np.int32)
                phrases += [data[a:b] for a, b in zip(heads.tolist(), ends.tolist())]
                held.append((found[heads].view(np.int64), *[k[row + own] for k in keys], start))
                if len(phrases) >= PARSED:
                    yield from both(held, phrases)
                    held, phrases = [], []
        if phrases:
            yield from both(held, phrases)

    schema = "trigger long, p long, k long, h long, start int, phrase binary, first long, last long"
    return rows.select("_k", "_h", "_text").mapInArrow(cut, schema)


def first_documents(phrases: list[bytes], firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each window of each phrase, in order, the smallest first document of equal windows.

    The windows are the suffixes of a dictionary of phrases, to the depth that counts.  They are
    sorted by their bytes, seven words of eight, into a suffix array; equal neighbours share one
    minimum.  Also returns the number of windows of each phrase.
    """
    sizes = np.array([len(p) - WINDOW + 1 for p in phrases])
    data = b"".join(phrases)
    begin = np.cumsum([0, *map(len, phrases)])[:-1]
    at = np.repeat(begin - np.cumsum(np.r_[0, sizes[:-1]]), sizes) + np.arange(sizes.sum())
    eight = np.ndarray(len(data) - 7, ">u8", data, strides=(1,))
    words = [eight[at + i].astype(np.uint64) for i in (*range(0, WINDOW - 8, 8), WINDOW - 8)]
    order = np.lexsort(words[::-1])
    new = np.zeros(order.size, bool)
    new[0] = True
    for w in words:
        new[1:] |= w[order[1:]] != w[order[:-1]]
    heads = np.flatnonzero(new)
    least = np.minimum.reduceat(np.repeat(firsts, sizes)[order], heads)
    found = np.empty(order.size, np.int64)
    found[order] = np.repeat(least, np.diff(np.r_[heads, order.size]))
    return found, sizes


def dictionary_order(dictionary: DataFrame) -> DataFrame:
    """(trigger, p, begins, ends, firsts) of phrases that hold a repeat: the runs of windows that
    also stand in a document before the last one that has the phrase, and the smallest such document.

    ``dictionary`` has distinct phrases (trigger, p, phrase, first, last), sorted by trigger
    in each partition; equal windows have equal triggers, so they meet in one task.  No trigger
    may have SORTED windows or more.
    """
    names = ["trigger", "p", "begins", "ends", "firsts"]

    def arrays(batch: pd.DataFrame) -> pa.RecordBatch:
        phrases = batch["phrase"].tolist()
        found, sizes = first_documents(phrases, batch["first"].to_numpy(np.int64))
        of = np.repeat(np.arange(sizes.size), sizes)
        heads = _runs(found, of)
        ends = np.r_[heads[1:], found.size]
        repeat = found[heads] < batch["last"].to_numpy(np.int64)[of[heads]]
        heads, ends = heads[repeat], ends[repeat]
        own = of[heads]
        before = (np.cumsum(sizes) - sizes)[own]
        kept = _runs(own)
        offsets = pa.array(np.r_[kept, own.size], pa.int32())
        lists = [(heads - before).astype(np.int32), (ends - before).astype(np.int32), found[heads]]
        return pa.RecordBatch.from_arrays(
            [
                *[pa.array(batch[c].to_numpy(np.int64)[own[kept]]) for c in names[:2]],
                *[pa.ListArray.from_arrays(offsets, pa.array(x)) for x in lists],
            ],
            names,
        )

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pd.DataFrame] = []
        size = 0
        for batch in batches:
            rows = batch.to_pandas()
            held.append(rows)
            size += int(rows["phrase"].map(len).sum()) - (WINDOW - 1) * len(rows)
            if size >= SORTED:
                whole = pd.concat(held)
                open_ = whole["trigger"] == whole["trigger"].iloc[-1]
                if not open_.all():
                    yield arrays(whole[~open_])
                    held = [whole[open_]]
                    size = int(held[0]["phrase"].map(len).sum()) - (WINDOW - 1) * len(held[0])
                else:
                    held = [whole]
        if held and size:
            yield arrays(pd.concat(held))

    schema = "trigger long, p long, begins array<int>, ends array<int>, firsts array<long>"
    return dictionary.mapInArrow(sort, schema)


def hot_triggers(found: DataFrame) -> DataFrame:
    """Triggers whose phrases have SORTED windows or more in all, each phrase as often as it was written."""
    windows = F.sum(F.octet_length("phrase") - F.lit(WINDOW - 1))
    return found.groupBy("trigger").agg(windows.alias("n")).filter(F.col("n") >= SORTED).select("trigger")


def windows_order(dictionary: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The same as :func:`dictionary_order` with nothing gathered by trigger: windows are grouped by
    their bytes, and only the windows of one phrase, LONGEST at most, come together again.  Also
    returns the table of windows that it reads."""
    name = ["trigger", "p"]
    places = F.sequence(F.lit(1), F.octet_length("phrase") - F.lit(WINDOW - 1))
    each = dictionary.withColumn("at", F.explode(places)).select(
        *name, "first", "last", "at", F.expr(f"substring(phrase, at, {WINDOW})").alias("window")
    )
    least = each.groupBy("window").agg(F.min("first").alias("least"), F.max("last").alias("most"))
    # Written, so that the join deals windows anew and a window in very many phrases can be split.
    # Windows of one document are no repeats; a bitmap keeps most of them from moving again.
    least = materialize(least.filter("least < most").select("window", "least"), "windows")
    table = hash_bitmap(least.select(F.xxhash64("window").alias("h")), "h", 25)
    maybe = each.filter(may_hold(table, F.xxhash64("window"), dictionary.sparkSession))
    found = maybe.join(least, "window").filter(F.col("least") < F.col("last")).groupBy(*name)
    found = found.agg(F.array_sort(F.collect_list(F.struct("at", "least"))).alias("w"))

    def breaks(w: Column, i: Column) -> Column:
        """Whether no run goes on from the place before i to i."""
        a, b = F.get(w, i - 1), F.get(w, i)
        apart = (b["at"] != a["at"] + 1) | (b["least"] != a["least"])
        return F.coalesce(apart, F.lit(True))  # before the first and after the last

    index = F.sequence(F.lit(0), F.size("w") - 1)
    heads = F.filter(index, lambda i: breaks(F.col("w"), i))
    tails = F.filter(index, lambda i: breaks(F.col("w"), i + 1))
    found = found.withColumns({"heads": heads, "tails": tails})
    runs = found.select(
        *name,
        F.transform("heads", lambda i: F.get("w", i)["at"] - 1).alias("begins"),
        F.transform("tails", lambda i: F.get("w", i)["at"]).alias("ends"),
        F.transform("heads", lambda i: F.get("w", i)["least"]).alias("firsts"),
    )
    return runs, least


def repeated_spans(rows: DataFrame) -> DataFrame:
    """(_k, _h, spans, copy): byte spans of each row whose windows stand in a smaller _k.

    Rows that are whole copies of a smaller _k take no part.  A trigger matters only if it stands in
    two rows or more: a quotient filter counts them.  Of the windows left, another counts the longer
    contexts.  Distinct phrases make the dictionary, with the
    smallest and largest document of each, reduced in each task first: a phrase in a third of all
    rows is one entry.  Its suffix array gives each window's smallest document (windows of triggers
    with very many are grouped by their bytes instead), and the parse, joined with that by the
    phrases' names, gives the spans.
    """
    whole = copies(rows)
    maybe, rest, marks = apart(rows, whole)
    distinct = rest.unionByName(maybe.join(whole, ["_k", "_h"], "left_anti"))
    n = distinct.select(F.sum(F.octet_length("_text"))).first()[0] or 0
    send = rows.sparkSession.sparkContext.broadcast

    def repeating(prints: Callable[[pa.Array], Iterator[np.ndarray]]) -> Broadcast:
        found = materialize(repeated(distinct, "_text", n // 18, 4, prints).select("print"), "prints")
        table = send(hash_bitmap(found, "print", bits_for(found.count())))
        discard(found)
        return table

    triggers = repeating(trigger_hashes)
    contexts = repeating(context_hashes(triggers))
    parsed = materialize(parse(distinct, triggers, contexts), "parse")
    name = ["trigger", "p"]
    found = parsed.filter("phrase is not null").select(*name, "phrase", "first", "last")
    # The bitmap may hold a trigger that is not hot: either way gives the same.
    hot = may_hold(hash_bitmap(hot_triggers(found), "trigger", 25), F.col("trigger"), rows.sparkSession)

    def distinct_phrases(some: DataFrame) -> DataFrame:
        return some.groupBy(*name, "phrase").agg(F.min("first").alias("first"), F.max("last").alias("last"))

    # Phrases move once: dealt by trigger, they are made distinct and sorted where they are.
    ordered = distinct_phrases(found.filter(~hot).repartition("trigger")).sortWithinPartitions("trigger")
    by_window, least = windows_order(distinct_phrases(found.filter(hot)))
    repeats = materialize(dictionary_order(ordered).unionByName(by_window), "repeats")
    discard(least)
    spans = (
        parsed.filter("k is not null")
        .select(*name, "k", "h", "start")
        .join(repeats, name)
        .select(
            *["k", "h", "start"],
            F.filter(F.arrays_zip("begins", "ends", "firsts"), lambda r: r["firsts"] < F.col("k")).alias("runs"),
        )
        .filter(F.size("runs") > 0)
        .select("k", "h", "start", F.explode("runs").alias("r"))
        .groupBy(F.col("k").alias("_k"), F.col("h").alias("_h"))
        .agg(
            F.collect_list(
                F.struct(
                    (F.col("start") + F.col("r.begins")).alias("a"),
                    (F.col("start") + F.col("r.ends") + F.lit(WINDOW - 1)).alias("b"),
                )
            ).alias("spans"),
            F.lit(False).alias("copy"),
        )
    )
    kind = spans.schema["spans"].dataType
    copied = whole.select("_k", "_h", F.lit(None).cast(kind).alias("spans"), F.lit(True).alias("copy"))
    spans = materialize(spans.unionByName(copied), "repeat-spans")
    discard(whole, marks, parsed, repeats)
    for table in (triggers, contexts):
        table.destroy()
    return spans


KEPT = T.StructType(
    [
        T.StructField("n_bytes", T.LongType()),
        T.StructField("n_removed", T.LongType()),
        T.StructField("n_spans", T.LongType()),
        T.StructField("kept", T.BinaryType()),
    ]
)


@F.pandas_udf(KEPT)
def _kept(texts: pd.Series, begins: pd.Series, ends: pd.Series, copy: pd.Series) -> pd.DataFrame:
    rows = []
    for text, a, b, whole in zip(texts, begins, ends, copy):
        data = text.encode()
        n = len(data)
        if whole is True and n >= WINDOW:
            rows.append((n, n, 1, b""))
        elif a is not None and len(a):
            change = np.zeros(n + 1, np.int32)
            np.add.at(change, np.asarray(a, np.int64), 1)
            np.add.at(change, np.asarray(b, np.int64), -1)
            left = np.cumsum(change[:-1]) == 0
            gone = np.r_[True, left][:-1] & ~left
            kept = np.frombuffer(data, np.uint8)[left].tobytes()
            rows.append((n, n - len(kept), int(gone.sum()), kept))
        else:
            rows.append((n, 0, 0, data))
    return pd.DataFrame(rows, columns=["n_bytes", "n_removed", "n_spans", "kept"])


def remove_repeated_bytes(docs: DataFrame) -> DataFrame:
    """``docs`` with n_bytes, n_removed, n_spans (maximal removed runs) and kept, the bytes left;
    columns of these names give way.

    Texts are UTF-8 bytes; matches never cross documents.  Each byte covered by a WINDOW-byte string
    that also starts in a document with a smaller doc_id goes, judged on the texts as given.  kept is
    binary, for a cut may fall inside a character.

    Null text counts as empty.  A null doc_id is smaller than any other.  Rows with one doc_id never
    remove anything from each other.  Other columns come out as they are.  No rows in, no rows out.
    """
    rows = keyed(docs)
    spans = repeated_spans(texts(rows))
    maybe, plain, _ = apart(rows, spans)
    decided = maybe.join(spans, ["_k", "_h"], "left")
    text = F.coalesce(F.col("_row.text"), F.lit(""))
    kept = _kept(text, F.col("spans.a"), F.col("spans.b"), "copy")
    # Texts that lose nothing do not go through Python.
    none = F.lit(0).cast("long")
    whole = [F.octet_length(text).cast("long"), none, none, text.cast("binary")]
    whole = F.struct(*[c.alias(n) for c, n in zip(whole, KEPT.names)])
    result = decided.select("_row", kept.alias("_kept")).unionByName(plain.select("_row", whole.alias("_kept")))
    others = [F.col("_row").getField(c).alias(c) for c in docs.columns if c not in KEPT.names]
    return result.select(*others, "_kept.*")
