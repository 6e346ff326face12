"""Terrain steps over many small tiles against plain versions on one machine."""

import heapq
import math
from collections import deque

import numpy as np
import pytest
from pyspark.sql import functions as F

from runnel.functions import geo as G
from runnel.operators import terrain, warp
from runnel.operators.grid import DIRECTIONS

CELLS = "row int, col int, z double"


def around(p):
    return [(p[0] + DIRECTIONS[k][0], p[1] + DIRECTIONS[k][1]) for k in sorted(DIRECTIONS)]


def rough(seed, n, levels, gaps=0.01):
    """Nested pits, with rows and columns below zero and some nodata."""
    rng = np.random.default_rng(seed)
    return {(r - 5, c - 3): float(rng.integers(0, levels)) for r in range(n) for c in range(n) if rng.random() >= gaps}


def frame(spark, z):
    return spark.createDataFrame([(r, c, v) for (r, c), v in z.items()], CELLS)


def plain_fill(z):
    out = {p: v for p, v in z.items() if any(q not in z for q in around(p))}
    queue = [(v, p) for p, v in out.items()]
    heapq.heapify(queue)
    while queue:
        level, p = heapq.heappop(queue)
        for q in around(p):
            if q in z and q not in out:
                out[q] = max(z[q], level)
                heapq.heappush(queue, (out[q], q))
    return out


def plain_directions(z):
    code = {}
    for p, v in z.items():
        falls = [((v - z[q]) / math.hypot(*DIRECTIONS[k]), -k) for k, q in zip(sorted(DIRECTIONS), around(p), strict=True) if q in z and z[q] < v]
        gone = [k for k, q in zip(sorted(DIRECTIONS), around(p), strict=True) if q not in z]
        code[p] = -max(falls)[1] if falls else gone[0] if gone else None
    flat = {p for p, k in code.items() if k is None}
    drains = {p for p in z if p not in flat and any(q in flat and z[q] == z[p] for q in around(p))}

    def steps(start, first):
        d, queue = dict.fromkeys(start, first), deque(start)
        while queue:
            p = queue.popleft()
            for q in around(p):
                if q in flat and q not in d and z[q] == z[p]:
                    d[q] = d[p] + 1
                    queue.append(q)
        return d

    low = steps(drains, 0)
    high = steps([p for p in flat if any(q in z and z[q] > z[p] for q in around(p))], 1)
    for p in flat & set(low):
        ways = [(-math.inf if q in drains else 2 * low[q] - high.get(q, 0), k) for k, q in zip(sorted(DIRECTIONS), around(p), strict=True) if q in low and z[q] == z[p]]
        code[p] = min(ways)[1]
    return code


@pytest.mark.parametrize("seed,n,levels,tile", [(1, 20, 30, 6), (2, 31, 8, 4), (3, 12, 50, 64)])
def test_filling_and_directions(spark, seed, n, levels, tile):
    z = rough(seed, n, levels)
    got = {(r.row, r.col): r.filled for r in terrain.fill_sinks(frame(spark, z), tile=tile).collect()}
    want = plain_fill(z)
    assert got == want and any(want[p] > z[p] for p in z)
    code = {(r.row, r.col): r.direction for r in terrain.flow_directions(frame(spark, want), tile=tile).collect()}
    assert code == plain_directions(want) and None not in code.values()
    for p in z:  # every cell drains off the grid
        for _ in range(len(z)):
            p = (p[0] + DIRECTIONS[code[p]][0], p[1] + DIRECTIONS[code[p]][1])
            if p not in z:
                break
        assert p not in z


def test_nested_pits_across_tiles(spark):
    """A pit within a pit whose inner wall is lower than the outer one, and a spiral that leaves one way out."""
    z = {(r, c): 9.0 for r in range(21) for c in range(21)}
    z |= {(r, c): 1.0 for r in range(2, 19) for c in range(2, 19)}
    z |= {p: 5.0 for r in range(6, 15) for p in ((r, 6), (r, 14), (6, r), (14, r))}
    z |= {(10, 10): 0.0, (10, 20): 4.0, (10, 19): 3.0}
    got = {(r.row, r.col): r.filled for r in terrain.fill_sinks(frame(spark, z), tile=5).collect()}
    assert got == plain_fill(z) and got[10, 10] == got[10, 6] == 5.0 and got[3, 3] == 4.0


def test_sinks_that_are_not_filled_and_odd_cells(spark):
    z = {(r, c): 2.0 for r in range(5) for c in range(5)} | {(2, 2): 1.0}
    code = {(r.row, r.col): r.direction for r in terrain.flow_directions(frame(spark, z), tile=3).collect()}
    assert code[2, 2] is None and code == plain_directions(z)
    odd = spark.createDataFrame([(0, 0, 1.0, 5), (0, 1, None, 6), (1, 0, math.nan, 7), (9, 9, 3.0, 8)], "row long, col long, z double, filled int")
    assert sorted(tuple(r) for r in terrain.fill_sinks(odd).collect()) == [(0, 0, 1.0), (9, 9, 3.0)]
    assert sorted(tuple(r) for r in terrain.flow_directions(odd).collect()) == [(0, 0, 1), (9, 9, 1)]
    assert [r.slope for r in terrain.slope(odd, 1, 1).collect()] == [None, None]
    empty = odd.filter("false")
    assert terrain.fill_sinks(empty).count() == terrain.flow_directions(empty).count() == terrain.slope(empty, 1, 1).count() == 0


def test_spill_levels_of_vertices_that_never_drain(spark):
    edges = [(1, 2, 5.0), (2, 1, 7.0), (2, terrain.OUTSIDE, 1.0), (3, 1, 2.0), (8, 9, 1.0), (4, 4, 0.0), (3, 5, 2.0), (5, 2, 5.0)]
    got = {r.v: r.spill for r in terrain.spill_levels(spark.createDataFrame(edges, "a long, b long, w double")).collect() if r.v != terrain.OUTSIDE}
    assert got == {1: 5.0, 2: 1.0, 3: 5.0, 5: 5.0, 8: None, 9: None}


def test_slope(spark):
    z = rough(4, 17, 40, 0.02)
    got = {(r.row, r.col): r.slope for r in terrain.slope(frame(spark, z), 30, 20, tile=5).collect()}
    for (r, c), s in got.items():
        w = [[z.get((r + a, c + b)) for b in (-1, 0, 1)] for a in (-1, 0, 1)]
        if any(v is None for row in w for v in row):
            assert s is None
            continue
        x = (w[0][2] + 2 * w[1][2] + w[2][2] - w[0][0] - 2 * w[1][0] - w[2][0]) / 240
        y = (w[2][0] + 2 * w[2][1] + w[2][2] - w[0][0] - 2 * w[0][1] - w[0][2]) / 160
        assert s == pytest.approx(math.degrees(math.atan(math.hypot(x, y))))
    assert len(got) == len(z)


def test_projection_there_and_back(spark):
    """Below a millimetre over the zone and beyond."""
    at = spark.createDataFrame([(lon, lat) for lon in (70.5, 72.0, 73.85, 75.0, 78.0, 79.5) for lat in (-60.0, -1.0, 0.0, 18.52, 45.0, 80.0)], "lon double, lat double")
    x, y = G.tm_forward(F.col("lon"), F.col("lat"))
    lon, lat = G.tm_inverse(x, y)
    back = at.select("lon", "lat", x.alias("x"), y.alias("y"), lon.alias("lon2"), lat.alias("lat2"))
    x2, y2 = G.tm_forward(F.col("lon2"), F.col("lat2"))
    for r in back.withColumn("off", F.hypot(x2 - F.col("x"), y2 - F.col("y"))).collect():
        assert r.off < 1e-3 and abs(r.lon - r.lon2) < 1e-8 and abs(r.lat - r.lat2) < 1e-8


def test_warping_onto_a_shifted_grid(spark):
    source = {"x0": 0.0, "y0": 4.0, "dx": 1.0, "dy": 1.0}
    z = {(r, c): float(10 * r + c) for r in range(4) for c in range(4)}
    del z[1, 2]
    target = spark.createDataFrame([(r, c) for r in range(4) for c in range(4)], "row int, col int")
    shifted = source | {"x0": 0.25, "y0": 3.75}

    def run(method):
        return {(r.row, r.col): r.z for r in warp.warp(target, frame(spark, z), "z", shifted, source, lambda x, y: (x, y), method).collect()}

    assert run("nearest") == {(r, c): z.get((r, c)) for r in range(4) for c in range(4)}
    got = run("bilinear")
    assert got[0, 0] == pytest.approx(2.75) and got[2, 1] == pytest.approx(23.75)
    assert got[1, 2] is None  # the missing cell has 9/16 of the weight
    assert got[0, 1] == pytest.approx((z[0, 1] * 9 + z[0, 2] * 3 + z[1, 1] * 3) / 15)
    assert got[3, 3] == pytest.approx(33.0)
    with pytest.raises(ValueError):
        run("cubic")
