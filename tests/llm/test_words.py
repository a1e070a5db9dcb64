"""Hashes of words and shingles over whole columns against plain forms."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest

from linkloom.llm import minhash, words


def _texts() -> list[str]:
    rng = random.Random(9)
    some = ["".join(rng.choices("abé漢Z", k=rng.randint(1, 90))) for _ in range(300)] + ["\0", "\0\0", "a\0"]
    blanks = [" ", "\t", "\n", "\v", "\f", "\r", "  "]
    texts = ["".join(rng.choice(some) + rng.choice(blanks) for _ in range(rng.randint(0, 40))) for _ in range(200)]
    return ["", "", " ", "x", *texts, "", "tail", "y" * 5000 + " " + "y" * 5001, "\x85\xa0", ""]


@pytest.mark.parametrize("at_once", [1, 700, 1 << 20])
def test_word_hashes(monkeypatch, at_once):
    monkeypatch.setattr(words, "AT_ONCE", at_once)
    texts = _texts()
    known: dict[bytes, int] = {}
    for column in (pa.array(texts), pa.array(texts, pa.large_string()), pa.array(["q", *texts]).slice(1)):
        row = 0
        for first, hashes, counts in words.word_hashes(column):
            plain = [t.encode().split() for t in texts[first : first + counts.size]]
            assert first == row and counts.tolist() == [len(p) for p in plain]
            for word, found in zip([w for p in plain for w in p], hashes.tolist(), strict=True):
                assert known.setdefault(word, found) == found
            row += counts.size
        assert row == len(texts)
    assert len(set(known.values())) == len(known)
    assert not list(words.word_hashes(pa.array([], pa.string())))


def test_shingle_sets_are_of_single_texts():
    texts = ["A b c", "a B c d", "b c d", "", "a", "c d a b c", "a b c"]
    sets = [set(s.tolist()) for s in minhash.shingle_sets(pa.array(texts), 2)]
    assert [len(s) for s in sets] == [2, 3, 2, 0, 1, 4, 2]
    assert sets[0] == sets[6] and sets[0] < sets[1] and sets[2] < sets[1] and sets[1] < sets[5] | sets[1]
    assert len(sets[5] & sets[1]) == 3


def test_similar_sketches_share_lists():
    rng = np.random.default_rng(3)
    frequency = rng.integers(0, 50, 1 << minhash.COUNTER_BITS)
    for _ in range(300):
        n = int(rng.integers(1, 65))
        u = np.unique(rng.integers(0, 1 << 62, n))
        v = np.r_[u[int(rng.integers(0, n // 5 + 1)) :], rng.integers(0, 1 << 62, 1)]
        common = np.intersect1d(u, v).size
        if common * 100 < minhash.SIMILAR * (u.size + v.size - common):
            continue
        least = min(minhash.SHARED, -(-min(u.size, v.size) * minhash.SIMILAR // 100))
        lists = [minhash.indexed_values(np.sort(x), frequency) for x in (u, v)]
        assert np.intersect1d(*lists).size >= least
