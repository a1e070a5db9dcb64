"""Nearest neighbours against all pairs."""

from __future__ import annotations

import numpy as np
import pytest

import brute
from linkloom.llm import neighbours as N

SCHEMA = "vec_id long, embedding array<float>, label int, uid string, score int, rank int"


def _rows() -> list[tuple]:
    rng = np.random.default_rng(4)
    centre = rng.normal(size=(6, 24))
    rows = [(i, (centre[i % 6] + rng.normal(size=24) * [0.001, 0.3][i % 2]).tolist()) for i in range(400)]
    rows += [(1000 + i, rows[3][1]) for i in range(90)]  # many copies of one vector, queries among them
    rows += [(60, rows[60][1]), (60, rows[61][1]), (2000, None), (2020, []), (2040, [0.0] * 24), (None, rows[5][1])]
    rows += [(2060, [None, *rows[5][1][1:]]), (2080, [float("nan")] * 24), (2100, [float("inf")] * 24)]
    rows += [(-20, [1e30] * 24), (3000, [1.0, 2.0]), (3001, [2.0, 1.0]), (3002, [-1.0, -1.0]), (4000, [5.0])]
    rows += [(5000 + 20 * i, [float(i)] * 1500) for i in range(1, 4)]
    return [(i, v if v is None else [x if x is None else float(np.float32(x)) for x in v]) for i, v in rows]


@pytest.mark.parametrize("sizes", [{}, {"block_rows": 37, "at_once": 2}])
def test_nearest(spark, sizes):
    frame = spark.createDataFrame([(i, v, 1, "u", 2, 3) for i, v in _rows()], SCHEMA).repartition(4)
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in N.nearest_neighbours(frame, k=7, **sizes).collect())
    assert got == sorted(brute.nearest(_rows(), 20, 7))


def test_no_rows(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert N.nearest_neighbours(none).collect() == []
    one = spark.createDataFrame([(20, [1.0], 1, "", 1, 1)], SCHEMA)
    assert N.nearest_neighbours(one).collect() == []


def test_bounds_hold_and_prune():
    rng = np.random.default_rng(2)
    values = rng.normal(size=(300, 64)) * rng.lognormal(0, 3, (300, 1))
    ids = np.arange(300).tobytes()
    block = N.Quantised(ids, ids, values.tobytes(), 64)
    guess, off = N.tile_bounds(block, block)
    assert (np.abs(values @ values.T - guess) <= off).all()
    unit = values / np.sqrt((values**2).sum(1))[:, None]
    block = N.Quantised(ids, ids, unit.tobytes(), 64)
    assert N.tile_bounds(block, block)[1].max() < 0.02
