"""Tables merged on read."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkloom.sources.keyed import KeyedTable

SCHEMA = T.StructType().add("url", "string").add("title", "string").add("n", "long")


@pytest.fixture
def table(spark, tmp_path):
    return KeyedTable(spark, str(tmp_path / "table"), SCHEMA, buckets=8)


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def size(path):
    return sum(os.path.getsize(f"{d}/{f}") for d, _, files in os.walk(path) for f in files if f.endswith(".parquet"))


def change(spark, table, plain, keys, new, version):
    """The same change on the table and on plain rows."""
    table.apply(spark.createDataFrame([(k,) for k in keys], "url string"), frame(spark, new), version)
    return [r for r in plain if r[0] not in keys] + new


def test_changes_compaction_and_versions(spark, table):
    plain = [(f"u{i % 40}", f"t{i}", i) for i in range(60)] + [(None, "none", 1)]
    assert rows(table.read()) == []
    table.create(frame(spark, plain))
    seen = {0: plain}
    for version in range(1, 7):
        keys = [f"u{(version * 7 + i) % 45}" for i in range(9)]
        new = [(k, f"v{version}", version) for k in keys[:6]] + [(keys[0], "twice", 0)]
        plain = change(spark, table, plain, keys, new, version)
        seen[version] = plain
    for version, want in seen.items():
        assert rows(table.read(version)) == sorted(want, key=str)
    gone = [f"u{i}" for i in range(45)]
    plain = change(spark, table, plain, gone, [(None, "late", 7)], 7)
    assert rows(table.read()) == sorted(plain, key=str) == [(None, "late", 7), (None, "none", 1)]
    due = table.compact(7, least=3)
    assert due
    assert rows(table.read()) == sorted(plain, key=str)  # emptied buckets stay empty
    assert rows(table.read(6)) == sorted(seen[6], key=str)
    plain = change(spark, table, plain, ["u1"], [("u1", "back", 8)], 8)
    assert table.vacuum(7) > 0
    assert table.vacuum(7) == 0
    assert rows(table.read()) == sorted(plain, key=str)


def test_unfinished_and_repeated_versions(spark, table, tmp_path):
    plain = [("a", "x", 1), ("b", "y", 2)]
    table.create(frame(spark, plain))
    table.apply(frame(spark, [("a", "", 0)]), frame(spark, [("a", "wrong", 0)]), 1)
    os.remove(tmp_path / "table/kind=delta/version=1/_SUCCESS")
    assert rows(table.read()) == plain
    for _ in range(2):  # a batch that runs again overwrites what it had written
        after = change(spark, table, plain, ["a"], [("a", "right", 0)], 1)
    assert rows(table.read()) == sorted(after)


def test_bytes_go_with_the_change(spark, table, tmp_path):
    n = 20_000
    text = F.sha2(F.concat(F.lit("x"), F.col("id")), 256)
    wide = spark.range(n).select(F.concat(F.lit("u"), "id").alias("url"), text.alias("title"), F.col("id").alias("n"))
    table.create(wide)
    base = size(tmp_path / "table")
    few = wide.filter(F.col("n") % 100 == 0).withColumn("title", F.reverse("title"))
    table.apply(few, few, 1)
    delta = size(tmp_path / "table/kind=delta")
    assert delta < 0.05 * base  # 1 % of the rows, a marker for each, and eight files' footers
    assert table.read().count() == n
    assert table.read().join(few, ["url", "title"], "left_semi").count() == n // 100
    one = wide.filter("url = 'u7'")
    table.apply(one, one, 2)
    before = {f for d, _, files in os.walk(tmp_path / "table") for f in files}
    assert len(table.compact(2, least=2)) == 1  # the bucket of u7 has two deltas, the others one
    added = [f"{d}/{f}" for d, _, files in os.walk(tmp_path / "table") for f in files if f not in before]
    assert 0 < sum(os.path.getsize(f) for f in added) < base / 4
    assert table.read().count() == n
