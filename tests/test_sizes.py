"""Steps whose work must grow with what they give, not with pairs."""

import random
import time

from pyspark.sql import functions as F

from runnel.functions import geo as G
from runnel.operators import grid, spatial

META = {"x0": -3.0, "y0": 5.0, "dx": 2.0, "dy": -2.0}


def shapes(spark, polygons):
    ring = "array<struct<x:double,y:double>>"
    rows = [(i, ("Polygon", [[tuple(map(float, p)) for p in r] for r in rings])) for i, rings in enumerate(polygons)]
    return spark.createDataFrame(rows, f"id int, geometry struct<type:string,parts:array<{ring}>>")


def test_cells_in_polygons_are_those_with_their_centre_inside(spark):
    rnd = random.Random(5)
    polygons = [[[(-8, -3), (90, -3), (90, -70), (30, -20), (-8, -70), (-8, -3)], [(2, -6), (14, -6), (14, -13), (2, -13), (2, -6)]]]
    for _ in range(40):
        ring = [(rnd.randrange(-10, 60), rnd.randrange(-60, 10)) for _ in range(rnd.choice([3, 4, 7]))]
        polygons.append([[*ring, ring[0]]])
    cells = spark.range(900).filter("id % 7 > 0").selectExpr("int(id / 30) as row", "int(id % 30) as col")
    x, y = grid.centre_of(F.col("row"), F.col("col"), META)
    for some in (polygons[:1], polygons[1:]):
        areas = shapes(spark, some)
        want = cells.crossJoin(areas).filter(G.in_polygon(x, y, F.col("geometry"))).select("row", "col").distinct()
        assert sorted(grid.cells_in_polygons(cells, areas, META).collect()) == sorted(want.collect()) != []


def test_cells_in_many_small_polygons(spark):
    corners = [(0, 0), (3, 0), (3, -3), (0, -3), (0, 0)]
    at = (F.col("id") % 64 * 2 - 3).cast("double"), (5 - F.col("id") % 4096 / 64).cast("double")
    ring = F.array(*[G.point(at[0] + x, at[1] + y) for x, y in corners])
    areas = spark.range(60_000).select(F.struct(F.lit("Polygon").alias("type"), F.array(ring).alias("parts")).alias("geometry"))
    cells = spark.range(4096).selectExpr("int(id / 64) as row", "int(id % 64) as col")
    began = time.monotonic()
    assert grid.cells_in_polygons(cells, areas, META).count() > 0
    assert time.monotonic() - began < 60  # 60,000 polygons on a tile of 4096 cells: 245 million pairs


def test_cells_on_lines_are_dealt_out_before_they_are_put_together(spark):
    line = F.array(G.point(F.lit(0.0), F.lit(0.0)), G.point(F.col("id").cast("double"), F.lit(-7.0)))
    lines = spark.range(50).select(F.struct(F.lit("LineString").alias("type"), F.array(line).alias("parts")).alias("geometry"))
    cells = grid.cells_on_lines(lines, META)
    below = cells._jdf.queryExecution().executedPlan().toString().split("Exchange")[-1]
    assert cells.count() == cells.distinct().count() and "Generate" in below and "Aggregate" not in below


def cloud(spark, n, size, copies=1):
    """n segments in a square, each from one of the n points, some of them alike."""
    k = F.expr(f"int(id / {copies})")
    x, y, dx, dy = ((F.xxhash64(k, F.lit(s)) % 100_003) / 100_003 for s in range(4))
    at = spark.range(n).select("id", (x * size).alias("x"), (y * size).alias("y"), (dx * 9).alias("dx"), (dy * 9).alias("dy"))
    return at.select("id", "x", "y"), at.select(F.col("id").alias("sid"), F.col("x").alias("ax"), F.col("y").alias("ay"), (F.col("x") + F.col("dx")).alias("bx"), (F.col("y") + F.col("dy")).alias("by"))


def test_nearest_segments_are_those_of_all_pairs(spark):
    for n, size, reach, copies, apart in ((400, 20, 30.0, 1, True), (400, 60, 30.0, 3, True), (300, 900, 30.0, 2, True), (300, 40, 7.0, 2, False), (300, 4000, 30.0, 1, True)):
        points, segments = cloud(spark, n, size, copies)
        d = G.segment_distance(*[F.col(c) for c in ("x", "y", "ax", "ay", "bx", "by")])
        near = points.crossJoin(segments).withColumn("distance", d).filter(F.col("distance") <= reach)
        near = near.filter("id <> sid") if apart else near
        want = near.groupBy("id").agg(F.min(F.struct("distance", "sid")).alias("m")).select("id", "m.sid", "m.distance")
        got = spatial.nearest_segment(points, segments, reach, apart=apart)
        assert sorted(got.collect()) == sorted(want.collect()) != []


def test_a_crowded_point_does_not_meet_all_segments_in_reach(spark):
    points, segments = cloud(spark, 30_000, 40)
    began = time.monotonic()
    assert spatial.nearest_segment(points, segments, 30.0, apart=True).count() == 30_000
    assert time.monotonic() - began < 60  # hundreds of millions of pairs are in reach
