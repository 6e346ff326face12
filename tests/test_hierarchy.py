"""Routes over the hierarchy against a plain search."""

import heapq
import random

import pytest

from runnel.operators import hierarchy


def plain(edges, source):
    near = {}
    for a, b, w in edges:
        near.setdefault(a, []).append((b, w))
        near.setdefault(b, []).append((a, w))
    best, queue = {}, [(0.0, source)] if source in near else []
    while queue:
        d, v = heapq.heappop(queue)
        if v not in best:
            best[v] = d
            for u, w in near[v]:
                heapq.heappush(queue, (d + w, u))
    return best


def cases(shape):
    rnd = random.Random(6)
    w = lambda: rnd.random() * 9 + 0.1
    if shape == "grid":
        return [(r * 8 + c, r * 8 + c + s, w()) for r in range(8) for c in range(8) for s in (1, 8) if (s == 8 or c < 7) and r * 8 + c + s < 64], 0, 63
    if shape == "chain":
        return [(i, i + 1, w()) for i in range(120)] + [(120, 300, 1.0)], 3, 119
    if shape == "random":
        return [(rnd.randrange(50), rnd.randrange(50), w()) for _ in range(140)] + [(60, 61, 1.0)], 5, 44
    return [(0, i, w()) for i in range(1, 30)] + [(i, i + 1, 0.0) for i in range(1, 12)] + [(7, 7, 1.0), (1, 2, 4.0)], 29, 12


@pytest.mark.parametrize("shape", ["grid", "chain", "random", "star"])
def test_distances_and_routes(spark, shape):
    edges, source, target = cases(shape)
    found = hierarchy.contract(spark.createDataFrame(edges, "src long, dst long, weight double"))
    want = plain(edges, source)
    got = {r.id: r.distance for r in hierarchy.search(found, source).collect()}
    assert got.keys() == want.keys() and all(got[v] == pytest.approx(want[v]) for v in want)
    way = hierarchy.route(found, source, target).orderBy("step").collect()
    assert [r.step for r in way] == list(range(len(way))) and way[0].id == source and way[-1].id == target
    for a, b in zip(way, way[1:], strict=False):  # edges of the graph, each as long as the distances say
        step = min(w for x, y, w in edges if {x, y} == {a.id, b.id})
        assert a.distance == pytest.approx(want[a.id]) and b.distance - a.distance == pytest.approx(step)


def test_rounds_do_not_grow_with_the_way(spark):
    n = 3000
    found = hierarchy.contract(spark.range(n).selectExpr("id as src", "id + 1 as dst", "1.0 as weight"))
    assert len(found.levels) < 30 and found.core.isEmpty()
    way = hierarchy.route(found, 0, n).orderBy("step").collect()
    assert [r.id for r in way] == list(range(n + 1))


def test_no_way_and_bad_weights(spark):
    found = hierarchy.contract(spark.createDataFrame([(1, 2, 1.0), (3, 4, 1.0), (5, 5, 1.0)], "src int, dst int, weight double"))
    assert hierarchy.route(found, 1, 4).count() == hierarchy.route(found, 1, 99).count() == hierarchy.search(found, 99).count() == 0
    assert [tuple(r) for r in hierarchy.route(found, 5, 5).collect()] == [(0, 5, 0.0)]
    with pytest.raises(ValueError, match="weights"):
        hierarchy.contract(spark.createDataFrame([(1, 2, -1.0)], "src int, dst int, weight double"))
