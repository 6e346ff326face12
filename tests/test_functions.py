import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from runnel.functions import exprs as E
from runnel.functions import geo as G


def one(spark, **cols):
    return spark.range(1).select(*[c.alias(n) for n, c in cols.items()]).first()


def test_finite_excludes_nan_infinities_and_nodata(spark):
    df = spark.createDataFrame([(float("nan"),), (float("inf"),), (-float("inf"),), (-9999.0,), (None,), (1.5,)], "v double")
    assert [r.v for r in df.filter(E.valid(F.col("v"))).collect()] == [1.5]


@pytest.mark.parametrize("value,label", [(0.3, "green_open"), (0.75, "default_urban"), (0.85, "road"), (0.9, "building"), (0.5, "unknown")])
def test_surface_class_of_floats(spark, value, label):
    assert one(spark, c=E.surface_class(F.lit(value).cast("float"))).c == label


def test_distance_classes_before_and_after_rounding(spark):
    rows = spark.createDataFrame([(0.5,), (0.5004,), (10.0,), (20.0,), (20.001,)], "d double").select(
        "d", E.candidate_method(F.col("d")).alias("m"), E.distance_class(E.rint_n(F.col("d"), 3)).alias("c")
    )
    got = {r.d: (r.m, r.c) for r in rows.collect()}
    assert got[0.5] == ("road_intersection", "intersection")
    assert got[0.5004] == ("road_proximity", "intersection")
    assert (got[10.0][1], got[20.0][1], got[20.001][1]) == ("near", "moderate", "distant_candidate")


@pytest.mark.parametrize("slope,want", [(0.001, (0.026378, 0.096317, 0.227983, 0.524664)), (0.01, (0.083413, 0.304581, 0.720945, 1.659133)), (0.0, (0.026378, 0.096317, 0.227983, 0.524664))])
def test_manning(spark, slope, want):
    df = spark.range(1, 5).select("id", E.manning_m3s(*E.section(F.col("id")), F.lit(slope)).alias("q"))
    assert tuple(round(r.q, 6) for r in df.orderBy("id").collect()) == want


def test_section_is_held_to_four(spark):
    w, d = E.section(F.lit(9))
    assert tuple(one(spark, w=w, d=d)) == (1.4, 0.8)


def test_safe_casts(spark):
    r = one(spark, a=E.safe_double(F.lit("x"), 2.0), b=E.safe_double(F.lit("1e3")), c=E.safe_int(F.lit("2.5")), d=E.safe_int(F.lit("inf"), 7), e=E.safe_string(F.lit(None)), f=E.yes_no(F.lit(None)))
    assert tuple(r) == (2.0, 1000.0, 2, 7, "", False)


def test_rint_is_half_even(spark):
    assert one(spark, a=E.rint_n(F.lit(0.0005), 3), b=E.rint_n(F.lit(2.5), 0)).asDict() == {"a": 0.0, "b": 2.0}


def test_ids_and_intervals(spark):
    s, e = E.interval_from_name(F.lit("runoff_volume_030_060.tif"))
    r = one(spark, a=E.cell_id(F.lit(7), F.lit(12)), b=E.interval_id(F.lit(0), F.lit(30)), s=s, e=e, n=E.interval_from_name(F.lit("x.tif"))[0])
    assert tuple(r) == ("R007_C012", "000_030", 30, 60, None)


def test_utm_of_known_points(spark):
    east, north = G.tm_forward(F.lit(75.0), F.lit(0.0))
    a = one(spark, e=east, n=north)
    assert abs(a.e - 500000) < 1e-6 and abs(a.n) < 1e-6
    # A degree of latitude on the meridian at the equator: 110574.39 m of arc, times 0.9996.
    b = one(spark, n=G.tm_forward(F.lit(75.0), F.lit(1.0))[1])
    assert abs(b.n - 110574.3886 * 0.9996) < 0.01
    c = one(spark, e=G.tm_forward(F.lit(73.8), F.lit(18.45))[0], f=G.tm_forward(F.lit(76.2), F.lit(18.45))[0])
    assert abs((c.e - 500000) + (c.f - 500000)) < 1e-6 and 372000 < c.e < 374500


def line(*points, kind="LineString"):
    return F.struct(F.lit(kind).alias("type"), F.array(F.array(*[G.point(F.lit(float(x)), F.lit(float(y))) for x, y in points])).alias("parts"))


def test_lines(spark):
    g = line((0, 0), (3, 4), (3, 10))
    r = one(spark, g=g).g
    df = spark.createDataFrame([(r,)], "g struct<type:string,parts:array<array<struct<x:double,y:double>>>>")
    got = df.select(
        G.length(F.col("g")).alias("n"), G.first_point(F.col("g")).alias("a"), G.last_point(F.col("g")).alias("b"), G.midpoint(F.col("g.parts")[0]).alias("m"),
        G.wkt_line(F.col("g.parts")[0]).alias("w"), G.is_usable(F.col("g")).alias("u"),
        G.touched_cells(F.col("g.parts")[0], 0.0, 10.0, 1.0, 1.0).alias("t"),
    ).first()
    assert got.n == 11.0 and tuple(got.a) == (0, 0) and tuple(got.b) == (3, 10) and got.u
    assert abs(got.m.x - 3) < 1e-9 and abs(got.m.y - 4.5) < 1e-9
    assert got.w == "LINESTRING (0.0 0.0, 3.0 4.0, 3.0 10.0)"
    assert {(c.row, c.col) for c in got.t} >= {(9, 0), (5, 3), (0, 3)}


def test_polygon_with_hole(spark):
    ring = lambda a, b: F.array(*[G.point(F.lit(float(x)), F.lit(float(y))) for x, y in ((a, a), (b, a), (b, b), (a, b), (a, a))])
    g = F.struct(F.lit("Polygon").alias("type"), F.array(ring(0, 10), ring(4, 6)).alias("parts"))
    r = one(spark, a=G.in_polygon(F.lit(1.0), F.lit(1.0), g), b=G.in_polygon(F.lit(5.0), F.lit(5.0), g), c=G.in_polygon(F.lit(11.0), F.lit(1.0), g), s=G.ring_area(g["parts"][0]))
    assert tuple(r) == (True, False, False, 100.0)


def test_midpoints_and_cells_of_odd_lines(spark):
    rnd = random.Random(9)
    rows = [(i, [(rnd.uniform(-50, 50), rnd.uniform(-50, 50)) for _ in range(rnd.randrange(1, 6))]) for i in range(60)]
    rows += [(100, [(3.0, 4.0), (3.0, 4.0)]), (101, []), (102, None), (103, [(0.0, 0.0), (10.0, 0.0), (10.0, 10.0)]), (104, [(-5.0, 5.0), (5.0, 5.0)])]
    df = spark.createDataFrame(rows, "id long, part array<struct<x:double,y:double>>")
    got = {r.id: r for r in df.select("id", G.midpoint(F.col("part")).alias("mid"), G.touched_cells(F.col("part"), -60.0, 60.0, 7.0, 5.0).alias("cells")).collect()}
    for i, points in rows:
        if not points:
            assert got[i].mid is None and got[i].cells == []
            continue
        p = np.array(points, float)
        step = np.r_[0.0, np.cumsum(np.hypot(*np.diff(p, axis=0).T))] if len(p) > 1 else np.zeros(1)
        want = [np.interp(step[-1] / 2, step, p[:, k]) for k in (0, 1)] if step[-1] else p[0]
        assert np.allclose([got[i].mid.x, got[i].mid.y], want), i
        cells = {(c.row, c.col) for c in got[i].cells}
        for t in np.linspace(0.0005, 0.9995, 800):
            x, y = (np.interp(t * step[-1], step, p[:, k]) if step[-1] else p[0, k] for k in (0, 1))
            assert (int(np.floor((60 - y) / 5)), int(np.floor((x + 60) / 7))) in cells
        assert len(cells) <= 4 * (abs(np.diff(p, axis=0)).sum() / 5 + len(p))


def test_a_line_from_a_corner_does_not_touch_the_cell_behind_it(spark):
    cells = G.touched_cells(F.array(G.point(F.lit(0.0), F.lit(-0.0)), G.point(F.lit(6.0), F.lit(8.0))), 0.0, 0.0, 2.0, 2.0)
    got = one(spark, cells=cells).cells
    assert {(c.row, c.col) for c in got} == {(-1, 0), (-2, 0), (-2, 1), (-3, 1), (-3, 2), (-4, 2)}


def test_lines_that_leave_a_concave_area(spark):
    """All vertices lie in the U, but one line crosses its notch; another strays by less than the tolerance."""
    ring = [(0, 0), (30, 0), (30, 30), (20, 30), (20, 10), (10, 10), (10, 30), (0, 30), (0, 0)]
    lines = {"in": [(5, 5), (25, 5)], "notch": [(5, 25), (25, 25)], "rim": [(5, -0.04), (25, -0.04)], "out": [(5, 5), (5, 40)], "round": [(5, 25), (5, 5), (25, 5), (25, 25)]}
    df = spark.createDataFrame([(k, [(float(x), float(y)) for x, y in v]) for k, v in lines.items()], "id string, part array<struct<x:double,y:double>>")
    got = {r.id: r.gone for r in df.select("id", G.leaves_area(F.col("part"), [[ring]], 0.05).alias("gone")).collect()}
    assert got == {"in": False, "notch": True, "rim": False, "out": True, "round": False}
    # A second polygon fills the notch but for its own hole and a gap of 0.08, which the tolerance of both sides bridges.
    plug = [[(10.08, 9), (21, 9), (21, 31), (10.08, 31), (10.08, 9)], [(14, 20), (16, 20), (16, 22), (14, 22), (14, 20)]]
    more = {"notch": False, "hole": True}
    df = df.union(spark.createDataFrame([("hole", [(5.0, 21.0), (25.0, 21.0)])], df.schema))
    got = {r.id: r.gone for r in df.select("id", G.leaves_area(F.col("part"), [[ring], plug], 0.05).alias("gone")).collect()}
    assert got == {"in": False, "rim": False, "out": True, "round": False} | more


def test_polygons_that_meet(spark):
    box = lambda x, y, w, h: [(x, y), (x + w, y), (x + w, y + h), (x, y + h), (x, y)]
    area = [box(0, 0, 30, 30), box(10, 10, 10, 10)]  # the second ring is a hole
    cases = {"inside": (box(2, 2, 3, 3), True), "in the hole": (box(12, 12, 3, 3), False), "across the hole": (box(8, 12, 4, 2), True), "around": (box(-5, -5, 50, 50), True), "beside": (box(31, 0, 5, 5), False), "touches": (box(30, 5, 5, 5), True)}
    corner = [(40, -20), (60, 5), (29, 40), (60, 60), (40, -20)]  # its bounds meet the area's, it does not
    cases["bounds only"] = ([(28, 45), (45, 28), (45, 45), (28, 45)], False)
    cases["crosses by edges"] = (corner, False)
    schema = "id string, a array<array<struct<x:double,y:double>>>, b array<array<struct<x:double,y:double>>>"
    real = lambda rings: [[(float(x), float(y)) for x, y in r] for r in rings]
    df = spark.createDataFrame([(k, real([r]), real(area)) for k, (r, _) in cases.items()], schema)
    got = {r.id: (r.m, r.n) for r in df.select("id", G.parts_meet(F.col("a"), F.col("b")).alias("m"), G.parts_meet(F.col("b"), F.col("a")).alias("n")).collect()}
    assert got == {k: (want, want) for k, (_, want) in cases.items()}
