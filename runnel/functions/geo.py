"""Geometry as nested columns: struct(type, parts), a part being an array of points (x, y)."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

POINT = "struct<x:double,y:double>"

# WGS 84 ellipsoid and the transverse Mercator of UTM zone 43 north.
MAJOR, FLATTENING = 6378137.0, 1 / 298.257223563
MERIDIAN, SCALE_FACTOR, FALSE_EAST = 75.0, 0.9996, 500000.0


def point(x: Column, y: Column) -> Column:
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))


def tm_forward(lon: Column, lat: Column, meridian: float = MERIDIAN) -> tuple[Column, Column]:
    """Easting and northing by the Krüger series to the third order of n (well under a millimetre in a zone)."""
    n = FLATTENING / (2 - FLATTENING)
    a = MAJOR / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    alpha = (n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16, 13 * n**2 / 48 - 3 * n**3 / 5, 61 * n**3 / 240)
    e = 2 * math.sqrt(n) / (1 + n)
    phi, lam = F.radians(lat), F.radians(lon - meridian)
    sin = F.sin(phi)
    t = F.sinh(F.atanh(sin) - e * F.atanh(e * sin))
    xi, eta = F.atan2(t, F.cos(lam)), F.atanh(F.sin(lam) / F.sqrt(1 + t * t))
    east, north = eta, xi
    for j, c in enumerate(alpha, 1):
        east = east + c * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
        north = north + c * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
    return FALSE_EAST + SCALE_FACTOR * a * east, SCALE_FACTOR * a * north


def tm_inverse(east: Column, north: Column, meridian: float = MERIDIAN) -> tuple[Column, Column]:
    """Longitude and latitude of an easting and northing, by the inverse series to the fourth order of n."""
    n = FLATTENING / (2 - FLATTENING)
    a = MAJOR / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    # Coefficients of the inverse series, and of the latitude by the conformal latitude.
    beta = (
        n / 2 - 2 * n**2 / 3 + 37 * n**3 / 96 - n**4 / 360, n**2 / 48 + n**3 / 15 - 437 * n**4 / 1440,
        17 * n**3 / 480 - 37 * n**4 / 840, 4397 * n**4 / 161280,
    )
    delta = (
        2 * n - 2 * n**2 / 3 - 2 * n**3 + 116 * n**4 / 45, 7 * n**2 / 3 - 8 * n**3 / 5 - 227 * n**4 / 45,
        56 * n**3 / 15 - 136 * n**4 / 35, 4279 * n**4 / 630,
    )
    xi, eta = north / (SCALE_FACTOR * a), (east - FALSE_EAST) / (SCALE_FACTOR * a)
    x, y = xi, eta
    for j, c in enumerate(beta, 1):
        x = x - c * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
        y = y - c * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
    conformal = F.asin(F.sin(x) / F.cosh(y))
    lat = conformal
    for j, c in enumerate(delta, 1):
        lat = lat + c * F.sin(2 * j * conformal)
    return meridian + F.degrees(F.atan2(F.sinh(y), F.cos(x))), F.degrees(lat)


def project(geometry: Column) -> Column:
    """Longitudes and latitudes of a geometry to UTM 43 north."""

    def move(p: Column) -> Column:
        x, y = tm_forward(p["x"], p["y"])
        return F.struct(x.alias("x"), y.alias("y"))

    parts = F.transform(geometry["parts"], lambda part: F.transform(part, move))
    return F.struct(geometry["type"].alias("type"), parts.alias("parts"))


def part_length(part: Column) -> Column:
    steps = F.zip_with(
        F.slice(part, F.lit(1), F.greatest(F.size(part) - 1, F.lit(0))),
        F.slice(part, F.lit(2), F.greatest(F.size(part) - 1, F.lit(0))),
        lambda a, b: F.sqrt((b["x"] - a["x"]) * (b["x"] - a["x"]) + (b["y"] - a["y"]) * (b["y"] - a["y"])),
    )
    return F.aggregate(steps, F.lit(0.0), lambda s, d: s + d)


def length(geometry: Column) -> Column:
    return F.aggregate(F.transform(geometry["parts"], part_length), F.lit(0.0), lambda s, d: s + d)


def ring_area(ring: Column) -> Column:
    """Shoelace area of a closed ring."""
    n = F.greatest(F.size(ring) - 1, F.lit(0))
    cross = F.zip_with(F.slice(ring, F.lit(1), n), F.slice(ring, F.lit(2), n), lambda a, b: a["x"] * b["y"] - b["x"] * a["y"])
    return F.abs(F.aggregate(cross, F.lit(0.0), lambda s, d: s + d)) / 2


def area_of(geometry: Column) -> Column:
    """A Polygon's first ring less the others; of a MultiPolygon the sum of its rings, holes turning the other way than shells."""

    def turning(ring: Column) -> Column:
        return F.aggregate(F.transform(segments(ring), lambda e: e["ax"] * e["by"] - e["bx"] * e["ay"]), F.lit(0.0), lambda s, d: s + d) / 2

    parts = geometry["parts"]
    every = F.aggregate(F.transform(parts, ring_area), F.lit(0.0), lambda s, d: s + d)
    turned = F.abs(F.aggregate(F.transform(parts, turning), F.lit(0.0), lambda s, d: s + d))
    return F.when(geometry["type"] == "Polygon", 2 * F.coalesce(ring_area(F.try_element_at(parts, F.lit(1))), F.lit(0.0)) - every).otherwise(turned)


def in_ring(x: Column, y: Column, ring: Column) -> Column:
    """Even-odd rule over the edges of a closed ring."""
    n = F.greatest(F.size(ring) - 1, F.lit(0))
    hits = F.zip_with(
        F.slice(ring, F.lit(1), n),
        F.slice(ring, F.lit(2), n),
        lambda a, b: ((a["y"] > y) != (b["y"] > y)) & (x < F.try_divide((b["x"] - a["x"]) * (y - a["y"]), b["y"] - a["y"]) + a["x"]),
    )
    return F.size(F.filter(hits, lambda h: h)) % 2 == 1


def in_polygon(x: Column, y: Column, geometry: Column) -> Column:
    """Inside an odd number of rings: the outer one without its holes, for each polygon of a multipolygon."""
    inside = F.filter(geometry["parts"], lambda ring: in_ring(x, y, ring))
    return F.size(inside) % 2 == 1


def crossings(y: Column, geometry: Column) -> Column:
    """Where the edges of all rings cross a height, by the rule of in_ring."""
    edges = F.filter(F.flatten(F.transform(geometry["parts"], segments)), lambda e: (e["ay"] > y) != (e["by"] > y))
    return F.transform(edges, lambda e: F.try_divide((e["bx"] - e["ax"]) * (y - e["ay"]), e["by"] - e["ay"]) + e["ax"])


def first_point(geometry: Column) -> Column:
    return F.element_at(F.element_at(geometry["parts"], 1), 1)


def last_point(geometry: Column) -> Column:
    return F.element_at(F.element_at(geometry["parts"], -1), -1)


def is_usable(geometry: Column) -> Column:
    """Not null, not empty, and every part has two distinct points (one for points). Whether a polygon is valid is told by planar.polygon_faults."""
    enough = F.forall(geometry["parts"], lambda part: F.size(F.array_distinct(part)) >= F.when(geometry["type"].contains("Point"), 1).otherwise(2))
    return F.coalesce(geometry.isNotNull() & (F.size(geometry["parts"]) > 0) & enough, F.lit(False))


def wkt_line(part: Column) -> Column:
    return F.concat(F.lit("LINESTRING ("), F.array_join(F.transform(part, lambda p: F.concat_ws(" ", p["x"], p["y"])), ", "), F.lit(")"))


def parse_wkt_line(text: Column) -> Column:
    inner = F.regexp_extract(text, r"\(([^)]*)\)", 1)
    return F.transform(
        F.split(inner, r",\s*"),
        lambda p: F.struct(F.split(p, " ")[0].cast("double").alias("x"), F.split(p, " ")[1].cast("double").alias("y")),
    )


def bounds(geometry: Column) -> Column:
    points = F.flatten(geometry["parts"])
    xs, ys = F.transform(points, lambda p: p["x"]), F.transform(points, lambda p: p["y"])
    return F.struct(
        F.array_min(xs).alias("min_x"), F.array_min(ys).alias("min_y"), F.array_max(xs).alias("max_x"), F.array_max(ys).alias("max_y")
    )


def segment_distance(px: Column, py: Column, ax: Column, ay: Column, bx: Column, by: Column) -> Column:
    dx, dy = bx - ax, by - ay
    along = F.coalesce(F.try_divide((px - ax) * dx + (py - ay) * dy, dx * dx + dy * dy), F.lit(0.0))
    t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), along))
    ex, ey = ax + t * dx - px, ay + t * dy - py
    return F.sqrt(ex * ex + ey * ey)


def segments(part: Column) -> Column:
    """array<struct<ax,ay,bx,by>> of a line or a closed ring."""
    n = F.greatest(F.size(part) - 1, F.lit(0))
    return F.zip_with(
        F.slice(part, F.lit(1), n), F.slice(part, F.lit(2), n),
        lambda a, b: F.struct(a["x"].alias("ax"), a["y"].alias("ay"), b["x"].alias("bx"), b["y"].alias("by")),
    )


def midpoint(part: Column) -> Column:
    """The point half way along a line; null for a line without points."""

    def step(s: Column, e: Column) -> Column:
        d = F.sqrt((e["bx"] - e["ax"]) * (e["bx"] - e["ax"]) + (e["by"] - e["ay"]) * (e["by"] - e["ay"]))
        done, here = s["rest"] < 0, s["rest"] <= d
        t = F.coalesce(F.try_divide(s["rest"], d), F.lit(0.0))
        rest = F.when(done, s["rest"]).when(here, -1.0).otherwise(s["rest"] - d)
        at = [F.when(done, s[k]).when(here, e["a" + k] + (e["b" + k] - e["a" + k]) * t).otherwise(e["b" + k]).alias(k) for k in ("x", "y")]
        return F.struct(rest.alias("rest"), *at)

    first = F.try_element_at(part, F.lit(1))
    start = F.struct((part_length(part) / 2).alias("rest"), first["x"].alias("x"), first["y"].alias("y"))
    return F.when(F.size(part) > 0, F.aggregate(segments(part), start, step, lambda s: F.struct(s["x"].alias("x"), s["y"].alias("y"))))


def segments_meet(p: Column, q: Column) -> Column:
    """Whether two segments have a point in common, ends included."""

    def side(a: Column, x: Column, y: Column) -> Column:
        return (a["bx"] - a["ax"]) * (y - a["ay"]) - (a["by"] - a["ay"]) * (x - a["ax"])

    def apart(k: str) -> Column:
        a, b = (F.struct(F.least(s["a" + k], s["b" + k]).alias("low"), F.greatest(s["a" + k], s["b" + k]).alias("high")) for s in (p, q))
        return (a["high"] < b["low"]) | (b["high"] < a["low"])

    across = (side(p, q["ax"], q["ay"]) * side(p, q["bx"], q["by"]) <= 0) & (side(q, p["ax"], p["ay"]) * side(q, p["bx"], p["by"]) <= 0)
    return ~apart("x") & ~apart("y") & across


def in_parts(x: Column, y: Column, parts: Column) -> Column:
    """Inside an odd number of rings."""
    return F.size(F.filter(parts, lambda ring: in_ring(x, y, ring))) % 2 == 1


def parts_meet(a: Column, b: Column) -> Column:
    """Whether two polygons, each an array of rings, have a point in common: edges meet, or one lies in the other."""
    edges_a, edges_b = (F.flatten(F.transform(parts, segments)) for parts in (a, b))
    crossing = F.exists(edges_a, lambda p: F.exists(edges_b, lambda q: segments_meet(p, q)))

    def inner(inside: Column, outside: Column) -> Column:
        return F.exists(inside, lambda ring: F.coalesce(in_parts(ring[0]["x"], ring[0]["y"], outside), F.lit(False)))

    return crossing | inner(a, b) | inner(b, a)


def leaves_area(part: Column, area: list[list[list[tuple[float, float]]]], tolerance: float) -> Column:
    """Whether any piece of a line lies outside the union of polygons, grown by ``tolerance``.

    area: polygons, each a list of rings, holes among them. A segment is cut where it crosses an edge; a piece between
    two cuts is wholly inside or wholly outside, so its ends and its middle tell.
    """
    literal = F.array(*[F.array(*[F.array(*[point(F.lit(x), F.lit(y)) for x, y in ring]) for ring in polygon]) for polygon in area])
    edges = F.flatten(F.transform(F.flatten(literal), segments))

    def outside(x: Column, y: Column) -> Column:
        inside = F.exists(literal, lambda rings: F.coalesce(in_parts(x, y, rings), F.lit(False)))
        return ~inside & F.forall(edges, lambda e: segment_distance(x, y, e["ax"], e["ay"], e["bx"], e["by"]) > tolerance)

    def strays(s: Column) -> Column:
        dx, dy = s["bx"] - s["ax"], s["by"] - s["ay"]

        def cut(e: Column) -> Column:
            ex, ey = e["bx"] - e["ax"], e["by"] - e["ay"]
            return F.try_divide((e["ax"] - s["ax"]) * ey - (e["ay"] - s["ay"]) * ex, dx * ey - dy * ex)

        cuts = F.filter(F.transform(edges, cut), lambda t: (t > 0) & (t < 1))
        ts = F.array_sort(F.concat(F.array(F.lit(0.0), F.lit(1.0)), cuts))
        mids = F.zip_with(F.slice(ts, F.lit(1), F.size(ts) - 1), F.slice(ts, F.lit(2), F.size(ts) - 1), lambda a, b: (a + b) / 2)
        return F.exists(F.concat(ts, mids), lambda t: outside(s["ax"] + dx * t, s["ay"] + dy * t))

    return F.exists(segments(part), strays)


def touched_cells(part: Column, x0: float, y0: float, dx: float, dy: float) -> Column:
    """array<struct<row,col>> of all cells a line touches: each segment is cut at the cell borders it crosses."""

    def borders(u: Column, v: Column) -> Column:
        low, high = F.ceil(F.least(u, v)), F.floor(F.greatest(u, v))
        some = (u != v) & (low <= high)
        between = F.sequence(F.when(some, low).otherwise(0), F.when(some, high).otherwise(0))
        return F.when(some, F.transform(between, lambda k: (k - u) / (v - u))).otherwise(F.array().cast("array<double>"))

    def cells(s: Column) -> Column:
        ax, ay, bx, by = (s["ax"] - x0) / dx, (y0 - s["ay"]) / dy, (s["bx"] - x0) / dx, (y0 - s["by"]) / dy
        cuts = F.filter(F.concat(borders(ax, bx), borders(ay, by)), lambda t: (t > 0) & (t < 1))
        ts = F.array_sort(F.array_distinct(F.concat(F.array(F.lit(0.0), F.lit(1.0)), cuts)))
        mids = F.zip_with(F.slice(ts, F.lit(1), F.size(ts) - 1), F.slice(ts, F.lit(2), F.size(ts) - 1), lambda a, b: (a + b) / 2)
        return F.transform(mids, lambda t: F.struct(F.floor(ay + (by - ay) * t).cast("int").alias("row"), F.floor(ax + (bx - ax) * t).cast("int").alias("col")))

    line = F.when(F.size(part) == 1, F.concat(part, part)).otherwise(part)
    return F.coalesce(F.array_distinct(F.flatten(F.transform(segments(line), cells))), F.array().cast("array<struct<row:int,col:int>>"))
