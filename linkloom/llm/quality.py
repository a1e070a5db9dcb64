"""Quality classifier: a factorisation machine over hashed words, structure and length."""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WORD_BITS = 14
FACTORS = 8
#: Labelled rows that the model is fitted on at most, chosen by the smallest hash of doc_id.
MAX_LABELLED = 8000
#: A text is kept if its score is this high.
THRESHOLD = 0.7
EPOCHS = 12
BATCH = 128
#: Texts scored at once, and hashed words remembered in a task.
SCORED = 256
KNOWN_WORDS = 100_000

_UPPER = bytes(range(65, 91))
_DIGITS = bytes(range(48, 58))
_LETTERS = bytes([*range(65, 91), *range(97, 123), *range(128, 256)])
_BLANKS = b" \t\n\r\x0b\x0c"
_STOPS = b".,;:?'\""
N_STATS = 18


def _left_out(data: bytes, chars: bytes) -> int:
    return len(data) - len(data.translate(None, chars))


def statistics(text: str, words: list[str], counts: Counter) -> list[float]:
    """Structure and length of a text, each of moderate size; zeros for an empty one."""
    if not words:
        return [0.0] * N_STATS
    data = text.encode()
    n, size = len(words), len(data)
    lines = [x for x in text.split("\n") if x.strip()]
    letters = _left_out(data, _LETTERS)
    blanks = _left_out(data, _BLANKS)
    digits = _left_out(data, _DIGITS)
    stops = _left_out(data, _STOPS)
    symbols = size - letters - blanks - digits - stops
    top = counts.most_common(3)
    return [
        math.log1p(n),
        math.log1p(size),
        letters / n,
        len(counts) / n,
        math.log1p(len(counts)) / math.log1p(n),
        top[0][1] / n,
        sum(c for _, c in top) / n,
        sum(map(str.__eq__, words, words[1:])) / n,
        _left_out(data, _UPPER) / size,
        digits / size,
        symbols / size,
        math.log1p(symbols),
        stops / n,
        data.count(b".") / n,
        len(lines) / n,
        1 - len(set(lines)) / len(lines),
        max(map(len, words)) / 100,
        sum(len(w) == 1 for w in words) / n,
    ]


class Hasher:
    """Turns texts into sparse rows: hashed words of unit length together, then statistics."""

    def __init__(self) -> None:
        self.known: dict[str, int] = {}

    def place(self, word: str) -> int:
        found = self.known.get(word)
        if found is None:
            if len(self.known) >= KNOWN_WORDS:
                self.known.clear()
            found = self.known[word] = zlib.crc32(word.encode()) >> (32 - WORD_BITS)
        return found

    def row(self, text: str) -> tuple[np.ndarray, np.ndarray, list[float]]:
        words = text.split()
        counts = Counter(map(str.lower, words))
        places = np.fromiter(map(self.place, counts), np.int64, len(counts))
        weights = 1 + np.log(np.fromiter(counts.values(), np.float64, len(counts)))
        if weights.size:
            weights /= math.sqrt(float(weights @ weights))
        return places, weights, statistics(text, words, counts)


@dataclass
class Rows:
    """Sparse rows: places and values one after another, and where each row starts."""

    places: np.ndarray
    values: np.ndarray
    starts: np.ndarray


@dataclass
class Model:
    """Bias, weights and factors; mean and spread of the statistics."""

    bias: float
    weights: np.ndarray
    factors: np.ndarray
    mean: np.ndarray
    spread: np.ndarray

    def rows(self, found: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> Rows:
        places, values, starts, at = [], [], [], 0
        own = np.arange(N_STATS) + (1 << WORD_BITS)
        for words, weights, stats in found:
            starts.append(at)
            at += words.size + N_STATS
            places += [words, own]
            values += [weights, np.clip((np.asarray(stats) - self.mean) / self.spread, -4, 4) / 4]
        return Rows(np.concatenate(places), np.concatenate(values), np.array(starts))

    def margins(self, rows: Rows) -> tuple[np.ndarray, np.ndarray]:
        """Log odds, and the sums of factors.  Pairs cost no more than a pass over the row:
        the sum over pairs of <v_i, v_j> x_i x_j is half of (sum v_i x_i)^2 - sum (v_i x_i)^2."""
        scaled = self.factors[rows.places] * rows.values[:, None]
        sums = np.add.reduceat(scaled, rows.starts)
        squares = np.add.reduceat((scaled * scaled).sum(1), rows.starts)
        linear = np.add.reduceat(self.weights[rows.places] * rows.values, rows.starts)
        return self.bias + linear + 0.5 * ((sums * sums).sum(1) - squares), sums

    def scores(self, found: list) -> np.ndarray:
        margin, _ = self.margins(self.rows(found))
        return 1 / (1 + np.exp(-np.clip(margin, -30, 30)))


def fit(found: list[tuple[np.ndarray, np.ndarray, np.ndarray]], labels: np.ndarray) -> Model:
    """Fit by stochastic gradients with per-weight steps.  No rows: a model that scores 0.5."""
    size = (1 << WORD_BITS) + N_STATS
    random = np.random.default_rng(7)
    stats = np.array([s for _, _, s in found]).reshape(-1, N_STATS)
    some = len(found) > 0
    model = Model(
        0.0,
        np.zeros(size),
        random.normal(0, 0.05, (size, FACTORS)) if some else np.zeros((size, FACTORS)),
        stats.mean(0) if some else np.zeros(N_STATS),
        stats.std(0) + 1e-6 if some else np.ones(N_STATS),
    )
    seen_w, seen_f, seen_b = np.full(size, 1e-2), np.full((size, FACTORS), 1e-2), 1e-2
    for _ in range(EPOCHS if some else 0):
        for chosen in np.array_split(random.permutation(len(found)), -(-len(found) // BATCH)):
            rows = model.rows([found[i] for i in chosen])
            margin, sums = model.margins(rows)
            lengths = np.diff(np.r_[rows.starts, rows.places.size])
            error = 1 / (1 + np.exp(-np.clip(margin, -30, 30))) - labels[chosen]
            of = np.repeat(np.arange(len(chosen)), lengths)
            pull = error[of] * rows.values / len(chosen)
            used, where = np.unique(rows.places, return_inverse=True)
            step_w = np.bincount(where, pull, used.size) + 1e-6 * model.weights[used]
            apart = sums[of] - model.factors[rows.places] * rows.values[:, None]
            pulled = pull[:, None] * apart
            step_f = np.stack([np.bincount(where, pulled[:, f], used.size) for f in range(FACTORS)], 1)
            step_f += 1e-6 * model.factors[used]
            step_b = float(error.mean())
            seen_w[used] += step_w**2
            seen_f[used] += step_f**2
            seen_b += step_b**2
            model.weights[used] -= 0.5 * step_w / np.sqrt(seen_w[used])
            model.factors[used] -= 0.1 * step_f / np.sqrt(seen_f[used])
            model.bias -= 0.2 * step_b / math.sqrt(seen_b)
    return model


def held_out(doc_id: Column) -> Column:
    """Rows whose labels the model never sees: crc32 of the id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> Model:
    """Fit on at most ``max_labelled`` labelled rows that are not held out.

    Rows are taken by the smallest hash of doc_id, so the sample is the same on each run.  Several
    labels of one document count as their largest; null labels and ids are left out.  Only the
    rows' features reach the driver, about 3 KB each.
    """
    chosen = (
        labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
        .filter(~held_out(F.col("doc_id")))
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.max("quality").cast("int").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(max_labelled)
    )
    text = F.coalesce(F.col("text"), F.lit("")).alias("text")

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hasher = Hasher()
        for batch in batches:
            rows = [hasher.row(t) for t in batch["text"]]
            yield pd.DataFrame(
                {
                    "doc_id": batch["doc_id"],
                    "label": batch["label"],
                    "places": [p.astype("<i4").tobytes() for p, _, _ in rows],
                    "weights": [w.astype("<f4").tobytes() for _, w, _ in rows],
                    "stats": [np.array(s, "<f8").tobytes() for _, _, s in rows],
                }
            )

    # The sample is bounded by max_labelled rows of two numbers.
    got = (
        docs.select(F.col("doc_id").cast("long"), text)
        .join(F.broadcast(chosen), "doc_id")
        .mapInPandas(features, "doc_id long, label int, places binary, weights binary, stats binary")
        .toPandas()
        .sort_values(["doc_id", "stats"])
        .drop_duplicates("doc_id")
    )
    found = [  # as they came; a batch of the fit is widened when its turn comes
        (np.frombuffer(p, "<i4"), np.frombuffer(w, "<f4"), np.frombuffer(s, "<f8"))
        for p, w, s in zip(got["places"], got["weights"], got["stats"])
    ]
    return fit(found, got["label"].to_numpy(float))


def score_column(model: Model, text: Column, spark: SparkSession) -> Column:
    """The score of each text by a fitted model, which has a fixed size of about 1.2 MB."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        hasher = Hasher()
        for batch in batches:
            texts = batch.tolist()
            parts = [
                shared.value.scores([hasher.row(t) for t in texts[i : i + SCORED]])
                for i in range(0, len(texts), SCORED)
            ]
            yield pd.Series(np.concatenate(parts) if parts else np.empty(0))

    return score(F.coalesce(text, F.lit("")))


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Each row's quality: doc_id, held_out, score, predicted.

    Scores depend on the text alone: hashed words, 18 statistics of structure and length, and the
    pairwise interactions of all of them.  Null and empty texts get the score of a text without
    words.  A null doc_id is not held out.  Without any labels every score is 0.5.  Rows come out as
    they come in; other columns are not read.  No rows in, no rows out.
    """
    model = train(docs, labels)
    return docs.select(
        F.col("doc_id").cast("long"),
        held_out(F.col("doc_id").cast("long")).alias("held_out"),
        score_column(model, F.col("text"), docs.sparkSession).alias("score"),
    ).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the rows whose score is under the threshold; columns as they are."""
    model = train(docs, labels)
    return docs.filter(score_column(model, docs["text"], docs.sparkSession) >= THRESHOLD)
