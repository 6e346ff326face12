import random

import pytest
from pyspark.sql import functions as F

from runnel.operators import graph, grid, relational


def chain(spark, codes, volumes):
    cells = spark.createDataFrame([(0, c, k, float(v)) for c, (k, v) in enumerate(zip(codes, volumes, strict=True))], "row int, col int, direction int, volume double")
    moved = grid.downstream_by_code(cells)
    return moved.select(F.col("col").alias("cell"), F.col("down_col").alias("down"), "volume")


def test_row_accumulates_to_the_east(spark):
    got = graph.accumulate(chain(spark, [8, 8, 8, 8], [1, 2, 3, 4]), ["volume"])
    assert {r.cell: r.volume for r in got.collect()} == {0: 1.0, 1: 3.0, 2: 6.0, 3: 10.0}


@pytest.mark.parametrize("inlet,captured,exported", [(1, 3.0, 7.0), (3, 10.0, 0.0)])
def test_first_inlet_captures_before_export(spark, inlet, captured, exported):
    cells = chain(spark, [8, 8, 8, 8], [1, 2, 3, 4])
    got = graph.capture_at(cells, cells.filter(F.col("cell") == inlet), ["volume"]).collect()
    assert sum(r.volume for r in got if r.captured) == captured
    assert sum(r.volume for r in got if r.outlet) == exported


@pytest.mark.parametrize("codes", [[8, 4], [8, 8, 4]])
def test_cycles_are_counted(spark, codes):
    with pytest.raises(graph.CycleError) as e:
        graph.accumulate(chain(spark, codes, [1] * len(codes)), ["volume"])
    assert e.value.unresolved == 2


def test_bad_codes_fail_or_are_marked(spark):
    cells = spark.createDataFrame([(0, 0, 9), (0, 1, 4)], "row int, col int, direction int")
    with pytest.raises(Exception, match="bad direction code"):
        grid.downstream_by_code(cells).collect()
    assert {r.col: r.bad_code for r in grid.downstream_by_code(cells, strict=False).collect()} == {0: True, 1: False}


def test_random_forest_matches_a_walk(spark):
    rnd = random.Random(4)
    n = 120
    down = {i: (rnd.randrange(i) if i and rnd.random() < 0.95 else None) for i in range(n)}
    value = {i: float(rnd.randrange(1, 9)) for i in range(n)}
    cells = spark.createDataFrame([(i, down[i], value[i]) for i in range(n)], "cell long, down long, v double")
    want, depth, root = dict(value), {}, {}
    for i in range(n):
        j, k = i, 0
        while down[j] is not None:
            j, k = down[j], k + 1
            want[j] += value[i]
        root[i], depth[i] = j, k
    assert {r.cell: r.v for r in graph.accumulate(cells.repartition(3), ["v"]).collect()} == want
    assert {r.cell: (r.root, r.depth) for r in graph.roots(cells).collect()} == {i: (root[i], depth[i]) for i in range(n)}
    edges = cells.filter("down is not null").select(F.col("cell").alias("src"), F.col("down").alias("dst"))
    ids = cells.select(F.col("cell").alias("id"))
    low = {}
    for i in range(n):
        low[root[i]] = min(low.get(root[i], i), i)
    assert {r.id: r.component for r in graph.components(ids, edges).collect()} == {i: low[root[i]] for i in range(n)}
    assert graph.topological_levels(edges)["unresolved"] == 0


def test_strahler_and_routing(spark):
    edges = spark.createDataFrame([("a", "c"), ("b", "c"), ("c", "d"), ("s", "d"), ("d", "e"), ("p", "q"), ("r", "q"), ("q", "e")], "src string, dst string")
    roots = edges.select(F.col("src").alias("id")).union(edges.select("dst")).distinct().withColumn("root", F.lit("e"))
    got = {r.id: r.order for r in graph.strahler(edges, roots).collect()}
    assert (got["c"], got["d"], got["q"], got["e"], got["s"]) == (2, 2, 2, 3, 1)
    nodes = spark.createDataFrame([("A", "B", 2.0, 5.0), ("B", "S", 3.0, 2.0), ("S", None, None, None)], "id string, down string, capacity double, local double").withColumn("root", F.lit("S"))
    r = {x.id: x for x in graph.capacity_route(nodes).collect()}
    assert (r["A"].conveyed, r["A"].overflow, r["B"].total, r["B"].conveyed, r["B"].overflow, r["S"].export) == (2, 3, 4, 3, 1, 3)


def test_shortest_paths(spark):
    edges = spark.createDataFrame([(1, 2, 1.0), (2, 3, 1.0), (1, 3, 5.0), (1, 3, 2.5), (4, 5, 1.0), (3, 3, 1.0)], "src int, dst int, weight double")
    got = {r.id: (r.distance, r.previous) for r in graph.shortest_paths(edges, 1).collect()}
    assert got == {1: (0.0, None), 2: (1.0, 1), 3: (2.0, 2)}
    assert graph.farthest(graph.shortest_paths(edges, 1)).first()["id"] == 3
    assert {r.id for r in graph.descendants(edges, [1]).collect()} == {2, 3}


def test_strict_lookup(spark):
    rows = spark.createDataFrame([(1,), (2,)], "k int")
    good = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k int, v string")
    assert [r.v for r in relational.strict_lookup(rows, good, "k").orderBy("k").collect()] == ["a", "b"]
    for bad in (good.filter("k <> 2"), good.union(good)):
        with pytest.raises(Exception, match="no k 2|k is not unique"):
            relational.strict_lookup(rows, bad, "k").collect()
        for narrow in (lambda df: df.select("k").collect(), lambda df: df.count()):
            with pytest.raises(Exception, match="no k 2|k is not unique"):
                narrow(relational.strict_lookup(rows, bad, "k"))


def test_spreading(spark):
    cells = spark.createDataFrame([(r, c, 0.0) for r in range(11) for c in range(11)], "row int, col int, z double")
    source = spark.createDataFrame([(5, 5, 100.0)], "row int, col int, volume double")
    got = {(r.row, r.col): r.volume for r in grid.spread(source, cells).collect()}
    assert len(got) == 81 and abs(sum(got.values()) - 100) < 1e-9 and abs(got[5, 5] - 3.502052) < 1e-6


def test_hottest_takes_the_first_of_equals(spark):
    df = spark.createDataFrame([(2, 5, 9.0), (2, 4, 9.0), (3, 0, 1.0)], "row int, col int, v double")
    assert tuple(grid.hottest(df, "v").first()) == (2, 4, 9.0)


def test_overlay_later_layers_win(spark):
    cells = spark.createDataFrame([(0, 0), (0, 1)], "row int, col int")
    one = cells.filter("col = 0")
    got = {r.col: r.coefficient for r in grid.overlay(cells, [(one, 0.3), (one, 0.85), (one, 0.9)], 0.75).collect()}
    assert got == {0: 0.9, 1: 0.75}


def test_network_names_by_place(spark):
    lines = spark.createDataFrame([("L1", [[(0.0, 0.0), (1.0, 0.0)], [(1.0, 0.0), (2.0, 0.0)]]), ("L2", [[(0.0, 0.0), (1.0001, 0.0)]])], "id string, parts array<array<struct<x:double,y:double>>>")
    nodes, edges = graph.network(lines, "N")
    assert [r.node_id for r in nodes.orderBy("x").collect()] == ["N_00001", "N_00002", "N_00003"]
    assert sorted((r.edge_id, r.src, r.dst, r.key) for r in edges.collect()) == [("L1_1", "N_00001", "N_00002", 0), ("L1_2", "N_00002", "N_00003", 0), ("L2", "N_00001", "N_00002", 1)]


def test_longest_way_by_length_and_its_path(spark):
    """Few long steps beat many short ones; of parallel edges the shorter counts; names break ties."""
    edges = [("a", "b", 1.0), ("b", "c", 1.0), ("c", "z", 1.0), ("p", "q", 50.0), ("q", "z", 5.0), ("q", "z", 9.0), ("m", "n", 55.0), ("s", "s2", None)]
    df = spark.createDataFrame(edges, "src string, dst string, length double")
    assert tuple(graph.longest_flow_path(df).first()) == ("m", "n", 55.0)
    assert graph.longest_flow_path(df.limit(0)).count() == 0
    rnd = random.Random(4)
    down = {i: rnd.randrange(max(0, i - 3), i) for i in range(1, 400)} | {0: None}
    tree = spark.createDataFrame([(i, d, rnd.random()) for i, d in down.items()], "id long, down long, length double")
    want, at = [], 399
    while at is not None:
        want.append(at)
        at = down[at]
    assert [r.id for r in graph.flow_path(tree, 399).orderBy("step").collect()] == want
    length = {r.id: r.length for r in tree.collect()}
    got = {r.id: (r.root, r.depth, r.length) for r in graph.roots(tree, "id", "down", "length").collect()}
    assert got[399][:2] == (0, len(want) - 1) and abs(got[399][2] - sum(length[i] for i in want[:-1])) < 1e-9 and got[0] == (0, 0, 0.0)
    assert graph.flow_path(tree, None).count() <= 1


@pytest.mark.parametrize("logs", [1, 16])
def test_shortest_paths_of_random_roads(spark, monkeypatch, logs):
    """Against relaxation of all edges, with parallel edges, a part out of reach, and late improvements."""
    monkeypatch.setattr(graph, "LOGS", logs)
    rnd = random.Random(6)
    edges = [(i, i + 1, 10.0) for i in range(30)] + [(rnd.randrange(60), rnd.randrange(60), float(rnd.randrange(1, 200))) for _ in range(90)] + [(100, 101, 1.0)]
    want = {0: 0.0}
    for _ in range(100):
        for a, b, w in edges:
            for x, y in ((a, b), (b, a)):
                if x in want and want[x] + w < want.get(y, float("inf")):
                    want[y] = want[x] + w
    rows = graph.shortest_paths(spark.createDataFrame(edges, "src long, dst long, weight double"), 0).collect()
    got = {r.id: r.distance for r in rows}
    assert got == want and len(rows) == len(want) and 100 not in got
    light = {}
    for a, b, w in edges:
        for k in ((a, b), (b, a)):
            light[k] = min(w, light.get(k, w))
    assert all(r.previous is None and r.id == 0 or got[r.previous] + light[r.previous, r.id] == r.distance for r in rows)


@pytest.mark.parametrize("shape", ["chain", "random", "star", "comb"])
def test_large_trees_are_contracted(spark, monkeypatch, shape):
    """Orders and flows of contracted trees equal those of the walk, which is told to take no tree."""
    rnd = random.Random(11)
    down = {
        "chain": {i: i - 1 for i in range(1, 24)} | {0: None},
        "random": {i: rnd.randrange(max(0, i - 6), i) for i in range(1, 60)} | {0: None},
        "star": {i: 0 for i in range(1, 30)} | {0: None, 100: 101, 101: None},
        "comb": {i: i - 2 if i % 2 == 0 else i - 1 for i in range(1, 40)} | {0: None},
    }[shape]
    edges = spark.createDataFrame([(i, d) for i, d in down.items() if d is not None], "src long, dst long")
    tree = spark.createDataFrame(list(down.items()), "id long, down long")
    roots = graph.roots(tree, "id", "down")
    rows = [(s, i, d, rnd.uniform(1, 15) if d is not None else None, rnd.choice((None, 0.0, rnd.random() * 5))) for i, d in down.items() for s in (0, 30)]
    nodes = spark.createDataFrame(rows, "step int, id long, down long, capacity double, local double").join(roots.select("id", "root"), "id")
    want_orders = {r.id: r.order for r in graph.strahler(edges, roots).collect()}
    want = {(r.step, r.id): r for r in graph.capacity_route(nodes, ["step"]).collect()}
    monkeypatch.setattr(graph, "WALK_ROWS", 0)
    assert {r.id: r.order for r in graph.strahler(edges, roots).collect()} == want_orders
    got = {(r.step, r.id): r for r in graph.capacity_route(nodes, ["step"]).collect()}
    assert set(got) == set(want)
    for k, r in got.items():
        assert all(abs(a - b) < 1e-9 for a, b in zip(r[2:], want[k][2:], strict=True)), (k, r, want[k])


@pytest.mark.parametrize("n", [1, 2, 4, 9, 64])
def test_a_chain_of_any_length_has_one_root(spark, n):
    """The chain is the whole table, so no other rows lend it rounds."""
    tree = spark.createDataFrame([(i, i - 1 if i else None) for i in range(n)], "cell long, down long")
    assert {r.cell: (r.root, r.depth) for r in graph.roots(tree).collect()} == {i: (0, i) for i in range(n)}
    assert {r.id: r.component for r in graph.connected(tree.filter("down is not null").toDF("a", "b")).collect()} == {i: 0 for i in range(n) if n > 1}


@pytest.mark.parametrize("walk_rows", [500_000, 0])
@pytest.mark.parametrize("fault", ["none", "capacity", "dangling", "circle", "elsewhere"])
def test_routing_answers_alike_whichever_way_it_takes(spark, monkeypatch, walk_rows, fault):
    """Capacities that differ by interval count, and what cannot be routed is refused on both ways."""
    monkeypatch.setattr(graph, "WALK_ROWS", walk_rows)
    rows = {(s, i): [s, i, d, c, 2.5, "S"] for s in (0, 30) for i, d, c in (("A", "B", 2.0 + s), ("B", "S", 30.0), ("C", "B", 0.5), ("S", None, None))}
    if fault == "capacity":
        rows[30, "C"][3] = None
    if fault == "dangling":
        rows[30, "C"][2] = "lost"
        rows[0, "C"][2] = "lost"
    if fault == "circle":
        for s in (0, 30):
            rows[s, "B"][2] = "A"
    if fault == "elsewhere":
        rows[30, "C"][2] = "S"
    nodes = spark.createDataFrame([tuple(r) for r in rows.values()], "step int, id string, down string, capacity double, local double, root string")
    if fault != "none":
        with pytest.raises(graph.CycleError if fault == "circle" else ValueError, match={"capacity": "capacity", "dangling": "not there", "circle": "cycle", "elsewhere": "different"}[fault]):
            graph.capacity_route(nodes, ["step"]).collect()
        return
    got = {(r.step, r.id): (r.conveyed, r.overflow, r.export) for r in graph.capacity_route(nodes, ["step"]).collect()}
    assert got[0, "A"] == (2.0, 0.5, 0.0) and got[30, "A"] == (2.5, 0.0, 0.0) and got[0, "C"] == (0.5, 2.0, 0.0)
    assert got[0, "S"] == (0.0, 0.0, 7.5) and got[30, "S"] == (0.0, 0.0, 8.0)


def test_a_value_that_would_be_lost_is_an_error(spark):
    from runnel.operators.contraction import fold, sums_under_limits

    way = F.struct(F.lit(0.0).alias("plus"), F.lit(1.0).alias("limit"))
    nodes = spark.createDataFrame([(1, 7), (2, None)], "k int, p int").withColumn("state", F.lit(1.0)).withColumn("way", way)
    with pytest.raises(ValueError, match="not there"):
        fold(nodes, sums_under_limits())


def broadcasts(spark, run):
    """Broadcast joins that a step's tables are written by, as its plans show them."""
    plans, real = [], graph.materialize

    def watched(df, *rest):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return real(df, *rest)

    graph.materialize = watched
    try:
        got = run()
    finally:
        graph.materialize = real
    return sum("BroadcastHashJoin" in p for p in plans), len(plans), got


def test_loops_send_no_table_a_round_through_the_driver(spark):
    tree = spark.range(500).selectExpr("id as cell", "case when id > 0 then int(id / 2) end as down", "1.0 as n").cache()
    ring = spark.range(500).selectExpr("id as cell", "case when id < 40 then (id + 1) % 40 else id - 7 end as down").cache()
    for run in (lambda: graph.accumulate(tree, ["n"]), lambda: graph.roots(tree), lambda: graph.flow_path(tree, 499, "cell"), lambda: graph.cycle_cells(ring)):
        sent, tables, got = broadcasts(spark, run)
        assert sent == 0 and tables > 2 and got.count() > 0
    assert sorted(r.cell for r in graph.cycle_cells(ring).collect()) == list(range(40))
    assert broadcasts(spark, lambda: graph.cycle_cells(tree))[1] < 12  # it ends once all have drained


def test_cycles_of_random_pointers(spark):
    for seed in range(3):
        rnd = random.Random(seed)
        down = {i: rnd.choice([None, 10_000, *[rnd.randrange(300)] * 30]) for i in range(300)}
        want = set()
        for i in down:
            seen, at = set(), i
            while at in down and at not in seen:
                seen.add(at)
                at = down[at]
            want |= {i} if at == i else set()
        assert {r.cell for r in graph.cycle_cells(spark.createDataFrame(list(down.items()), "cell long, down long")).collect()} == want


@pytest.mark.parametrize("walk_rows", [500_000, 3])
def test_steps_are_routed_as_rows_of_nodes_and_steps_are(spark, monkeypatch, walk_rows):
    rnd = random.Random(2)
    down = {i: None if i % 20 == 0 else rnd.randrange(i - i % 20, i) for i in range(100)}
    rows = [(i, d, None if d is None else rnd.random() * 4, i - i % 20, rnd.choice((None, 0.0, rnd.random() * 3))) for i, d in down.items()]
    tree = spark.createDataFrame(rows, "id long, down long, capacity double, root long, share double")
    steps = spark.createDataFrame([(s, s / 7) for s in range(30)], "step int, depth double")
    dealt = tree.crossJoin(steps).withColumn("local", F.col("depth") * F.col("share"))
    want = {(r.step, r.id): r for r in graph.capacity_route(dealt.drop("share", "depth"), ["step"]).collect()}
    monkeypatch.setattr(graph, "WALK_ROWS", walk_rows)
    monkeypatch.setattr(graph, "GROVE_ROWS", 40)
    got = {(r.step, r.id): r for r in graph.capacity_route_steps(tree, steps, ["step"]).collect()}
    assert set(got) == set(want) and len(got) == 3000
    assert all(abs(a - b) < 1e-9 for k, r in got.items() for a, b in zip(r[2:], want[k][2:], strict=True))
    with pytest.raises(graph.CycleError):
        graph.capacity_route_steps(tree.withColumn("down", F.expr("case when id = 0 then 1 else down end")).withColumn("capacity", F.lit(1.0)), steps, ["step"])
