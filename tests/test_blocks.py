"""Shortest ways over blocks against a plain search."""

import pytest
from test_hierarchy import cases, plain

from runnel.operators import blocks
from runnel.plans import catalog


@pytest.mark.parametrize("shape,size", [("grid", 40), ("chain", 50), ("random", 1000), ("star", 10)])
def test_distances_and_routes(spark, shape, size):
    edges, source, target = cases(shape)
    parted = blocks.blocks_of(spark.createDataFrame(edges, "src long, dst long, weight double"), size)
    want = plain(edges, source)
    found = blocks.distances(parted, source)
    got = {r.id: r.distance for r in found.collect()}
    assert got.keys() == want.keys() and all(got[v] == pytest.approx(want[v]) for v in want)
    way = blocks.route(found, target).orderBy("step").collect()
    assert [r.step for r in way] == list(range(len(way))) and way[0].id == source and way[-1].id == target
    for a, b in zip(way, way[1:], strict=False):
        step = min(w for x, y, w in edges if {x, y} == {a.id, b.id})
        assert b.distance == pytest.approx(want[b.id]) and b.distance - a.distance == pytest.approx(step)


def test_no_way_and_bad_weights(spark):
    parted = blocks.blocks_of(spark.createDataFrame([(1, 2, 1.0), (3, 4, 1.0), (5, 5, 1.0)], "src int, dst int, weight double"), 2)
    found = blocks.distances(parted, 1)
    assert sorted(r.id for r in found.collect()) == [1, 2] and blocks.route(found, 4).count() == blocks.distances(parted, 99).count() == 0
    assert [tuple(r) for r in blocks.route(blocks.distances(parted, 5), 5).collect()] == [(0, 5, 0.0)]
    with pytest.raises(ValueError, match="weights"):
        blocks.blocks_of(spark.createDataFrame([(1, 2, -1.0)], "src int, dst int, weight double"))


def test_rounds_are_those_of_blocks(spark, monkeypatch):
    """A way of 1200 edges over three blocks takes a round for each."""
    rounds = []
    monkeypatch.setattr(blocks, "materialize", lambda df, name, *a, keep=blocks.materialize: rounds.append(name) or keep(df, name, *a))
    parted = blocks.blocks_of(spark.range(1200).selectExpr("id as src", "id + 1 as dst", "1.0 as weight"), 800)
    assert blocks.distances(parted, 0).filter("distance = id").count() == 1201
    assert rounds.count("round") <= 4


@pytest.fixture
def apart(spark):
    """Shuffles of seven partitions that are not put together, as those of large tables are not."""
    settings = {"spark.sql.shuffle.partitions": "7", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def test_arcs_and_offers_of_a_block_meet_in_any_partition(spark, apart):
    edges, source, _ = cases("grid")
    parted = blocks.blocks_of(spark.createDataFrame(edges, "src long, dst long, weight double"), 40)
    assert parted.select("block").distinct().count() > 3
    got = {r.id: r.distance for r in blocks.distances(parted, source).collect()}
    assert got == pytest.approx(plain(edges, source))


def test_a_route_over_many_blocks_equals_its_sql(matches, apart, monkeypatch):
    monkeypatch.setattr(blocks, "BLOCK_ARCS", 150)
    matches(catalog.QUERIES["street_route"], catalog.ORACLES["street_route"])
