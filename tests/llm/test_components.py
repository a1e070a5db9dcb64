from __future__ import annotations

import random

import pytest

from linkloom.llm import components, minhash


def smallest(links):
    """Of each node that is not the smallest of its component, that smallest node."""
    found = {x: x for link in links for x in link}
    while any(found[u] != found[v] for u, v in links):
        for u, v in links:
            found[u] = found[v] = min(found[u], found[v])
    return {x: m for x, m in found.items() if x != m}


@pytest.mark.parametrize("one_task", [components.ONE_TASK, 0])
def test_many_shapes(spark, monkeypatch, one_task):
    monkeypatch.setattr(components, "ONE_TASK", one_task)
    random.seed(3)
    links = [(random.randrange(-60, 60), random.randrange(-60, 60)) for _ in range(70)]
    links += [(200, x) for x in range(100, 130)] + [(x, 99) for x in range(130, 160)] + [(140, 200)]
    got = components.components(spark.createDataFrame(links, "u long, v long")).collect()
    assert len(got) == len({r.u for r in got}) and {r.u: r.m for r in got} == smallest(links)


def test_few_links_are_not_shuffled(spark, monkeypatch):
    plans, write = [], components.materialize

    def written(df, label):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return write(df, label)

    monkeypatch.setattr(components, "materialize", written)
    links = spark.createDataFrame([(x, x + 1) for x in range(20)], "u long, v long")
    assert {r.u: r.m for r in components.components(links).collect()} == {x: 0 for x in range(1, 21)}
    assert len(plans) > 2 and not any("Exchange" in plan for plan in plans[1:])


def test_stars_take_no_round(spark, monkeypatch):
    written, write = [], components.materialize
    monkeypatch.setattr(components, "materialize", lambda df, label: written.append(label) or write(df, label))
    links = spark.createDataFrame([(3, 1), (2, 1), (9, 5)], "u long, v long")
    assert {r.u: r.m for r in components.components(links).collect()} == {2: 1, 3: 1, 9: 5}
    assert written == ["links"]


def test_no_pairs_read_no_texts(spark, monkeypatch):
    monkeypatch.setattr(minhash, "texts_of", None)
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    pairs = spark.createDataFrame([], "u long, v long")
    assert minhash.verified(pairs, docs, 2).collect() == []
    hot = spark.createDataFrame([], "cls long, comp long")
    got = minhash.by_whole_sets(hot, docs, 2)
    assert got.columns == ["u", "v"] and got.collect() == []
