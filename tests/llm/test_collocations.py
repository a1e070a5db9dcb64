"""Phrase mining against a plain form."""

from __future__ import annotations

import random

import brute
import numpy as np
import pytest

from linkloom.llm import collocations as C

SCHEMA = "text string, lang string, n long, rank int, part string, f double, `group` int"


def _rows() -> list[tuple]:
    rng = random.Random(3)
    words = [f"w{i}" for i in range(30)]
    rows = [(" ".join(rng.choices(words, weights=range(30, 0, -1), k=rng.randint(0, 60))), "en") for _ in range(60)]
    rows += [("New York CITY, new york city! new\tyork  city\x0bnew\nyork", None)] * 7 + [("new york", "und")] * 3
    rows += [("a a a a a a a", "zz"), (None, "en"), ("", "en"), (" .,; \n", "fr"), ("é\xa0É \x1cx É", "fr")] * 4
    rows += [("one two three four five six seven " * 500, "long"), ("x" * 300_000, "long"), ("y z " * 5_000, "long")]
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(t, lang, 1, 2, "p", 0.5, 3) for t, lang in _rows()], SCHEMA).repartition(5).cache()


@pytest.mark.parametrize("tiling", [{}, {"part_bytes": 900, "fan": 3, "bits": 2}])
def test_phrases(docs, tiling):
    """One part per task and lang, or many small parts merged in rounds, and tiles of 4 x 4 pairs."""
    got = sorted(tuple(r) for r in C.collocations(docs, least=4, top=50, **tiling).collect())
    want = sorted(brute.phrases([(lang, t) for t, lang in _rows()], 4, 50))
    assert got == want
    assert {"en", "long", "und", "zz"} <= {r[0] for r in got}


def test_no_rows(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert C.collocations(none).collect() == []
    assert C.collocations(spark.createDataFrame([("once only", "en", 1, 1, "", 0.0, 0)], SCHEMA)).collect() == []


def test_large_numbers(spark):
    rows = [(10**13, [10**13 + 1, 10**12], [3 * 10**12 + 1, 10**12], 2 * 10**13)]
    frame = spark.createDataFrame(rows, "a long, heads array<long>, tails array<long>, n long")
    a, (left, _), (right, _), n = rows[0]
    assert frame.select(C._cut_scores(2)["score"]).first()[0] == 1000 * a * n // (left * right)


def test_dense_and_sparse_tiles_agree(monkeypatch):
    rng = np.random.default_rng(1)
    first, second = rng.integers(0, 3000, 20_000), rng.integers(0, 1500, 20_000)
    plain = C.tile_blocks(first, second)
    monkeypatch.setattr(C, "SPARSE", 1 << 20)
    dense = C.tile_blocks(first, second)
    assert (plain[0] == dense[0]).all()
    assert all((a[3] == b[3]).all() and (a[4] == b[4]).all() for a, b in zip(plain[1], dense[1]))
    assert len({*zip(first, second, plain[0])}) == plain[0].max() + 1 == len({*zip(first, second)})
