"""Strong components and tours of forests against plain versions."""

import random

import pytest

from runnel.operators import graph, reach


def plain_components(edges):
    nodes = {v for e in edges for v in e}
    ahead = {v: {b for a, b in edges if a == v} for v in nodes}

    def seen_from(v):
        seen, todo = set(), [v]
        while todo:
            for w in ahead[todo.pop()]:
                if w not in seen:
                    seen.add(w)
                    todo.append(w)
        return seen

    after = {v: seen_from(v) for v in nodes}
    out = {}
    for v in nodes:
        own = {v} | {w for w in after[v] if v in after[w]}
        out[v] = (min(own), len(own), v in after[v])
    return out


@pytest.mark.parametrize("shape", ["random", "dense", "ring_on_chain", "star"])
def test_strong_components(spark, shape):
    rnd = random.Random(9)
    edges = {
        "random": [(rnd.randrange(60), rnd.randrange(60)) for _ in range(75)],
        "dense": [(rnd.randrange(15), rnd.randrange(15)) for _ in range(60)] + [(20, 21), (21, 22), (22, 20), (3, 20)],
        "ring_on_chain": [(i, i + 1) for i in range(40)] + [(40, 30), (50, 50), (51, 52), (52, 51), (60, 0)],
        "star": [(0, i) for i in range(1, 20)] + [(i, 0) for i in range(15, 25)],
    }[shape]
    got = {r.id: (r.component, r.size, r.cyclic) for r in reach.strong_components(spark.createDataFrame([*edges, edges[0], (None, 1)], "src long, dst long")).collect()}
    assert got == plain_components(edges)


def test_rounds_on_a_long_chain_grow_with_its_logarithm(spark, monkeypatch):
    rounds = []
    monkeypatch.setattr(reach, "_coin", lambda node, turn, f=reach._coin: rounds.append(turn) or f(node, turn))
    n = 20_000
    edges = spark.range(n).selectExpr("id as src", "id + 1 as dst").union(spark.createDataFrame([(n, 0)], "src long, dst long"))
    got = reach.strong_components(edges)
    assert got.filter(f"component = 0 and size = {n + 1} and cyclic").count() == n + 1
    assert max(rounds) < 80


def test_nothing_to_connect(spark):
    assert reach.strong_components(spark.createDataFrame([], "src long, dst long")).count() == 0
    got = reach.strong_components(spark.createDataFrame([("a", "b")], "src string, dst string")).collect()
    assert sorted(tuple(r) for r in got) == [("a", "a", 1, False), ("b", "b", 1, False)]


@pytest.mark.parametrize("shape", ["chain", "random", "star"])
def test_tours(spark, monkeypatch, shape):
    monkeypatch.setattr(reach, "BAND", 7)
    rnd = random.Random(3)
    down = {
        "chain": {i: i - 1 for i in range(1, 70)} | {0: None},
        "random": {i: rnd.randrange(i) if rnd.random() < 0.9 else None for i in range(1, 80)} | {0: None},
        "star": {i: 0 for i in range(1, 60)} | {0: None, 99: None},
    }[shape]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        intervals = reach.tree_intervals(spark.createDataFrame(list(down.items()), "id long, down long"))
        rows = {r.id: r for r in intervals.collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    through = {v: set() for v in down}
    for v in down:
        w = v
        while w is not None:
            through[w].add(v)
            last, w = w, down[w]
        assert rows[v].root == last
    for v, r in rows.items():
        assert {w for w, q in rows.items() if q.root == r.root and r.enter <= q.enter <= r.leave} == through[v]
        assert (r.leave - r.enter + 1) // 2 == len(through[v])
    asked = spark.createDataFrame([(v,) for v in list(down)[::9]], "id long")
    got = {tuple(r) for r in reach.drains_through(intervals, asked).collect()}
    assert got == {(v, w) for v in list(down)[::9] for w in through[v]}


def test_tours_of_what_is_no_forest(spark):
    with pytest.raises(graph.CycleError):
        reach.tree_intervals(spark.createDataFrame([(1, 2), (2, 1), (3, None)], "id long, down long"))
    with pytest.raises(ValueError, match="not there"):
        reach.tree_intervals(spark.createDataFrame([(1, 2)], "id long, down long"))
    assert reach.tree_intervals(spark.createDataFrame([], "id long, down long")).count() == 0
