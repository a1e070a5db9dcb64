"""Conversation repair against plain forms."""

from __future__ import annotations

import random

import pytest

import brute
from linkloom.llm import repair as R

SCHEMA = "conv_id long, turn long, role string, text string, part int, conv string, fault int, uid string"
COLUMNS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def _rows() -> list[tuple]:
    rng = random.Random(8)
    texts = ["Yes.", "No!", "cut off", "", " \t\n", "Why? ", "é. ", "Sure.\r\n", None, "x" * 200_000]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None]
    rows = []
    for conv in range(150):
        for turn in range(rng.randint(1, 9)):
            rows.append((conv, rng.choice([turn, turn, turn * 2, None]), rng.choice(roles), rng.choice(texts[:9])))
    rows += [(None, t, "user", f"{t}.") for t in range(6)] + [(500, None, "user", "a.")] * 3 + [(501, 3, "user", texts[9])]
    rows += [(900, t, ["user", "assistant"][t % 2], f"turn {t % 40}.") for t in range(600)]
    rows += [(-7, 5, "user", "same.")] * 40
    return rows


def test_cheapest_is_the_least_of_all_edits():
    rng = random.Random(1)
    for _ in range(60):
        turns = [(rng.choice("suaut "), rng.choice([0, 0, 1, 2, 3])) for _ in range(rng.randint(0, 3))]
        assert R.cheapest(turns, R.NOTHING, R.ENDS) == brute.repairs(turns), turns


@pytest.mark.parametrize(("segment", "split"), [(R.SEGMENT, None), (7, None), (7, "2k")])
def test_repaired(spark, segment, split):
    """With short segments; and with ranges read back in splits, so that conversations go on in other tasks."""
    if split:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        _compare(spark, segment)
    finally:
        for key in ("maxPartitionBytes", "openCostInBytes"):
            spark.conf.unset(f"spark.sql.files.{key}")


def _compare(spark, segment):
    rows = _rows()
    frame = spark.createDataFrame([(*r, 1, "c", 2, "u") for r in rows], SCHEMA).repartition(4)
    got = {r.conv_id: tuple(r[c] for c in COLUMNS) for r in R.repaired_conversations(frame, segment=segment).collect()}
    want = brute.repaired(rows)
    assert got.keys() == want.keys()
    assert {k: (got[k], v) for k, v in want.items() if got[k] != v} == {}
    assert any(len(v[6]) > 400 for v in want.values())


def test_no_rows(spark):
    assert R.repaired_conversations(spark.createDataFrame([], SCHEMA)).collect() == []
