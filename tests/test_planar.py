"""Validity, clipping, dissolving and buffers against hand cases and plain versions."""

import math
import random

import pytest
from pyspark.sql import functions as F

from runnel.operators import planar

SHAPES = "id int, geometry struct<type:string,parts:array<array<struct<x:double,y:double>>>>"


def frame(spark, shapes):
    """shapes: id -> (type, parts) or None."""
    rows = [(i, None if g is None else (g[0], [[(float(x), float(y)) for x, y in part] for part in g[1]])) for i, g in shapes.items()]
    return spark.createDataFrame(rows, SHAPES)


def box(x0, y0, x1, y1):
    return [(x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0)]


def test_polygon_faults(spark):
    shell = box(0, 0, 10, 10)
    cases = {
        1: (("Polygon", [shell]), set()),
        2: (("Polygon", [[(0, 0), (4, 4), (4, 0), (0, 4), (0, 0)]]), {"self"}),  # a bow tie
        3: (("Polygon", [[(0, 0), (1, 1), (0, 0)]]), {"points"}),
        4: (("Polygon", [[(0, 0), (1, 0), (1, 1), (0, 1)]]), {"open"}),
        5: (("Polygon", [shell, box(2, 2, 4, 4)]), set()),
        6: (("Polygon", [shell, box(8, 8, 12, 12)]), {"crossing", "hole"}),
        7: (("Polygon", [shell, box(20, 2, 24, 4)]), {"hole"}),
        8: (("Polygon", [shell, box(2, 2, 8, 8), box(3, 3, 4, 4)]), {"nested"}),
        9: (("Polygon", [shell, [(0, 5), (4, 3), (4, 7), (0, 5)]]), set()),  # a hole that touches the shell in a point
        10: (("Polygon", [shell, box(0, 2, 4, 4)]), {"crossing"}),  # a hole along the shell
        11: (("Polygon", [[(0, 0), (10, 0), (10, 10), (5, 0), (0, 10), (0, 0)]]), {"self"}),  # a ring that touches itself
        12: (("Polygon", [[(0, 0), (10, 0), (10, 10), (10, -5), (0, -5), (0, 0)]]), {"self"}),  # folds back
        13: (("Polygon", [[(0, 0), (0, 0), (10, 0), (10, 0), (5, 5), (0, 0)]]), set()),  # points that repeat
        14: (("Polygon", [[(0, 0), (math.nan, 0), (1, 1), (0, 0)]]), {"coordinate"}),
        15: (("MultiPolygon", [shell, box(20, 0, 30, 10)]), set()),
        16: (("MultiPolygon", [shell, box(5, 5, 30, 30)]), {"crossing"}),
        17: (("Polygon", [shell, [(5, 10), (12, 12), (12, 8), (5, 6), (5, 10)]]), {"crossing", "hole"}),  # through a touching point
        18: (("LineString", [[(0, 0), (4, 4), (4, 0), (0, 4), (0, 0)]]), set()),
        19: (None, set()),
        20: (("Polygon", []), set()),
        21: (("Polygon", [shell, [(0, 5), (-4, 3), (-4, 7), (0, 5)]]), {"hole"}),  # outside, touching in a point
        22: (("Polygon", [shell, [(2, 2), (8, 2), (5, 8), (2, 2)], [(5, 2), (5.5, 3), (4.5, 3), (5, 2)]]), {"nested"}),
        23: (("Polygon", [[(0, 0), (100, 0), (100, 1e-3), (0, 1e-3), (0, 0)], [(1, 1e-4), (99, 1e-4), (50, 5e-4), (1, 1e-4)]]), set()),
    }
    got = {}
    for r in planar.polygon_faults(frame(spark, {i: g for i, (g, _) in cases.items()})).collect():
        got.setdefault(r.id, set()).add(r.fault)
    assert {i: got.get(i, set()) for i in cases} == {i: want for i, (_, want) in cases.items()}
    assert planar.polygon_faults(frame(spark, {})).count() == 0


def parts(g):
    return [[(p.x, p.y) for p in part] for part in g.parts]


def test_clipping_to_a_concave_area_with_a_hole(spark):
    """All edges of the area are part of it, whichever side they are on."""
    area = [(0, 0), (10, 0), (10, 10), (5, 4), (0, 10), (0, 0)]
    polygons = {1: ("Polygon", [area, box(2, 1, 4, 2)]), 2: ("Polygon", [box(20, 0, 22, 2)]), 3: ("Polygon", [box(21, 0, 24, 2)])}
    lines = {
        1: ("LineString", [[(-5, 8), (15, 8)]]),
        2: ("LineString", [[(-1, 1.5), (6, 1.5), (6, 2)]]),
        3: ("LineString", [[(0, -3), (0, 12)]]),
        4: ("LineString", [[(10, -3), (10, 12)]]),
        5: ("LineString", [[(-3, 0), (13, 0)]]),
        6: ("LineString", [[(2, 1), (4, 1)]]),  # along the hole
        7: ("LineString", [[(2.5, 1.5), (3.5, 1.5)]]),  # in the hole
        8: ("LineString", [[(19, 1), (25, 1)]]),  # through two that overlap
        9: ("LineString", [[(1, 3), (1, 3), (3, 3), (3, 3.5)]]),
        10: ("LineString", [[(-1, 11), (1, 9)]]),  # touches a corner and ends in the area
        11: ("LineString", [[(-2, 2), (2, -2)]]),  # only a corner
        12: ("MultiLineString", [[(-1, 0.5), (1, 0.5)], [(30, 30), (31, 31)]]),
        13: None,
    }
    got = {r.id: r.geometry for r in planar.clip_lines(frame(spark, lines), frame(spark, polygons)).collect()}
    near = lambda want: [[(pytest.approx(x), pytest.approx(y)) for x, y in part] for part in want]
    assert set(got) == {1, 2, 3, 4, 5, 6, 8, 9, 12}
    assert parts(got[1]) == near([[(0, 8), (5 / 3, 8)], [(25 / 3, 8), (10, 8)]]) and got[1].type == "MultiLineString"
    assert parts(got[2]) == near([[(0, 1.5), (2, 1.5)], [(4, 1.5), (6, 1.5), (6, 2)]])
    assert parts(got[3]) == near([[(0, 0), (0, 10)]]) and parts(got[4]) == near([[(10, 0), (10, 10)]])
    assert parts(got[5]) == near([[(0, 0), (10, 0)]]) and parts(got[6]) == near([[(2, 1), (4, 1)]])
    ends = parts(got[8])
    assert len(ends) == 1 and ends[0][0] == (20, 1) and ends[0][-1] == (24, 1)
    assert parts(got[9]) == near([[(1, 3), (3, 3), (3, 3.5)]]) and parts(got[12]) == near([[(0, 0.5), (1, 0.5)]])


def union_area(boxes):
    """Of rectangles, by the cells between all their edges."""
    xs, ys = (sorted({b[k] for b in boxes} | {b[k + 2] for b in boxes}) for k in (0, 1))
    total = 0
    for x0, x1 in zip(xs, xs[1:], strict=False):
        for y0, y1 in zip(ys, ys[1:], strict=False):
            if any(b[0] <= x0 and b[2] >= x1 and b[1] <= y0 and b[3] >= y1 for b in boxes):
                total += (x1 - x0) * (y1 - y0)
    return total


def test_dissolving_rectangles(spark):
    """Groups of rectangles that overlap, repeat, touch and share edges, in two groups of equal places."""
    rnd = random.Random(4)
    groups = {"a": [], "b": []}
    for boxes in groups.values():
        for _ in range(25):
            x, y = rnd.randrange(12), rnd.randrange(12)
            boxes.append((x, y, x + rnd.randint(1, 4), y + rnd.randint(1, 4)))
        boxes.append(boxes[0])
    groups["c"] = [(0, 0, 3, 1), (0, 2, 3, 3), (0, 0, 1, 3), (2, 0, 3, 3)]  # a frame around a hole
    groups["d"] = [(0, 0, 1, 1), (5, 5, 6, 7)]
    rows = [(g, i, ("Polygon", [[(float(x), float(y)) for x, y in (box(*b) if i % 2 else box(*b)[::-1])]])) for g, bs in groups.items() for i, b in enumerate(bs)]
    features = spark.createDataFrame(rows, "group string, " + SHAPES)
    found = planar.dissolve(features).collect()
    for g, boxes in groups.items():
        mine = [r for r in found if r.group == g]
        assert sum(r.area for r in mine) == pytest.approx(union_area(boxes))
        assert all(r.part[0] == r.part[-1] for r in mine)
    assert sorted(r.area for r in found if r.group == "c") == [-1.0, 9.0]
    assert sorted(r.area for r in found if r.group == "d") == [1.0, 2.0]


def test_dissolving_polygons_with_holes(spark):
    """A hole stays where nothing covers it; slanted edges that cross; an island in a hole of a multipolygon."""
    shapes = {
        1: ("Polygon", [box(0, 0, 10, 10), box(2, 2, 8, 8)]), 2: ("Polygon", [[(1, 5), (5, 1), (9, 5), (5, 9), (1, 5)]]),
        3: ("MultiPolygon", [box(20, 0, 30, 10), box(22, 2, 28, 8)[::-1], box(24, 4, 26, 6)]), 4: None,
    }
    features = frame(spark, shapes).withColumn("group", F.lit("all"))
    areas = sorted(r.area for r in planar.dissolve(features).collect())
    corners = [-2.0] * 4  # what is left of the hole beside the lozenge: (8 - 2)^2 less the lozenge's part of it
    assert areas == pytest.approx(sorted([100.0, *corners, 100.0, -36.0, 4.0]))


def distance_to(p, a, b):
    dx, dy = b[0] - a[0], b[1] - a[1]
    t = 0 if dx == dy == 0 else max(0, min(1, ((p[0] - a[0]) * dx + (p[1] - a[1]) * dy) / (dx * dx + dy * dy)))
    return math.hypot(a[0] + t * dx - p[0], a[1] + t * dy - p[1])


def test_buffers(spark):
    shapes = {
        1: ("LineString", [[(0, 0), (10, 0), (10, 8), (2, 8), (2, 2)]]),
        2: ("Point", [[(50, 50)]]),
        3: ("Polygon", [box(100, 100, 120, 120), box(105, 105, 115, 115)]),
    }
    quarter, d = 8, 1.5
    found = planar.buffer(frame(spark, shapes), d, quarter).collect()
    least = d * math.cos(math.pi / 4 / quarter) - 1e-6
    for i, (_, ps) in shapes.items():
        segments = [(a, b) for part in ps for a, b in (zip(part, part[1:], strict=False) if len(part) > 1 else [(part[0], part[0])])]
        for r in (r for r in found if r.group == i):
            for p, q in zip(r.part, r.part[1:], strict=False):
                for at in ((p.x, p.y), ((p.x + q.x) / 2, (p.y + q.y) / 2)):
                    assert least <= min(distance_to(at, a, b) for a, b in segments) <= d + 1e-6
    circle = 2 * quarter * d * d * math.sin(math.pi / 2 / quarter)
    assert sum(r.area for r in found if r.group == 2) == pytest.approx(circle)
    assert sorted(r.area for r in found if r.group == 3) == pytest.approx([-49.0, 400 + 80 * d + circle], abs=1e-4)
    assert sorted(r.area > 0 for r in found if r.group == 1) == [False, True]  # the way comes back near its start


@pytest.mark.parametrize("block", [100_000, 7])
def test_rings_are_followed_in_and_across_shares(spark, monkeypatch, block):
    """Rings of 3 to 60 edges in two groups; few of them are left to the graph operators, none if one task holds all."""
    monkeypatch.setattr(planar, "BLOCK_EDGES", block)
    joined = []
    monkeypatch.setattr(planar, "connected", lambda edges, real=planar.connected: joined.append(edges.count()) or real(edges))
    rnd, ids, rows, want = random.Random(3), iter(random.Random(4).sample(range(1000), 300)), [], {}
    for n in (3, 60, 4, 25, 9, 30):
        ring, x, y = [next(ids) for _ in range(n)], rnd.random() * 50, rnd.random() * 50
        at = {e: (x + 5 * math.cos(2 * math.pi * i / n), y + 5 * math.sin(2 * math.pi * i / n)) for i, e in enumerate(ring)}
        rows += [(n % 2, e, ring[(i + 1) % n], *at[e]) for i, e in enumerate(ring)]
        first = ring.index(min(ring))
        want |= {e: (min(ring), i, n % 2) for i, e in enumerate(ring[first:] + ring[:first])}
    rnd.shuffle(rows)
    got = planar.rings_in_order(spark.createDataFrame(rows, "group int, eid long, next long, ax double, ay double"), ["group"])
    assert {r.eid: (r.ring, r.place, r.group) for r in got.collect()} == want and got.count() == len(want)
    assert joined == [] if block > 1000 else len(joined) == 1
