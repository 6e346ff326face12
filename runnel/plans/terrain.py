"""Terrain queries over a rough surface: parts in a square, each as high as its size; every sixty-first is nodata."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runnel.functions import geo as G
from runnel.operators import terrain, warp
from runnel.plans.relational import query, table
from runnel.staging import materialize

#: Cells on a side of a tile in these queries, so that small tables have several tiles; nodata cells; the cell size in metres.
TILE, GAP, CELL = 32, 61, 30.0
#: The rough surface in longitude and latitude, and a grid of 30 m in UTM zone 43 that lies over it.
LONLAT = {"x0": 73.8, "y0": 18.55, "dx": 1 / 3600, "dy": 1 / 3600}
UTM = {"x0": 373400.0, "y0": 2051400.0, "dx": 30.0, "dy": 30.0}

SURFACE_SQL = f"""surface AS (SELECT p_partkey AS cell, (p_partkey // w)::INT AS row, (p_partkey % w)::INT AS col, p_size::DOUBLE AS z
  FROM part, (SELECT ceil(sqrt(count(*)))::BIGINT AS w FROM part) WHERE p_partkey % {GAP} <> {GAP - 1})"""
NEAR_SQL = """step(code, dr, dc) AS (VALUES (1, -1, 1), (2, -1, 0), (3, -1, -1), (4, 0, -1), (5, 1, -1), (6, 1, 0), (7, 1, 1), (8, 0, 1)),
near AS (SELECT a.cell, b.cell AS other, b.z, code, dr, dc FROM surface a CROSS JOIN step JOIN surface b ON b.row = a.row + dr AND b.col = a.col + dc)"""
FLOOD_SQL = f"""{SURFACE_SQL}, {NEAR_SQL},
flood(cell, level) USING KEY (cell) AS (
  SELECT cell, z FROM surface WHERE cell NOT IN (SELECT cell FROM near GROUP BY cell HAVING count(*) = 8)
  UNION
  SELECT n.other, min(greatest(n.z, f.level)) FROM flood f JOIN near n ON n.cell = f.cell LEFT JOIN recurring.flood old ON old.cell = n.other
  WHERE old.cell IS NULL OR greatest(n.z, f.level) < old.level GROUP BY n.other)"""


def surface(spark, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").select("p_partkey", "p_size")
    width = part.agg(F.ceil(F.sqrt(F.count(F.lit(1)))).cast("long").alias("w"))  # one row
    at = part.crossJoin(F.broadcast(width)).filter(F.col("p_partkey") % GAP != GAP - 1)
    row, col = F.floor(F.col("p_partkey") / F.col("w")), F.col("p_partkey") % F.col("w")
    return at.select(row.cast("int").alias("row"), col.cast("int").alias("col"), F.col("p_size").cast("double").alias("z"))


def filled(spark, sf_dir: str) -> DataFrame:
    return materialize(terrain.fill_sinks(surface(spark, sf_dir), tile=TILE), "filled")


@query(f"""WITH RECURSIVE {FLOOD_SQL} SELECT row, col, z, level AS filled, level - z AS depth FROM surface JOIN flood USING (cell)""")
def sink_filling(spark, sf_dir):
    joined = surface(spark, sf_dir).join(terrain.fill_sinks(surface(spark, sf_dir), tile=TILE), ["row", "col"])
    return joined.withColumn("depth", F.col("filled") - F.col("z"))


@query(f"""WITH RECURSIVE {FLOOD_SQL},
pair AS (SELECT n.cell, n.other, code, f.level AS z, g.level AS oz, (f.level - g.level) / CASE WHEN dr * dc = 0 THEN 1 ELSE sqrt(2) END AS fall
  FROM near n JOIN flood f ON f.cell = n.cell JOIN flood g ON g.cell = n.other),
steep AS (SELECT cell, code FROM pair WHERE fall > 0 QUALIFY row_number() OVER (PARTITION BY cell ORDER BY fall DESC, code) = 1),
off AS (SELECT s.cell, min(step.code) AS code FROM surface s CROSS JOIN step LEFT JOIN surface o ON o.row = s.row + dr AND o.col = s.col + dc
  WHERE o.cell IS NULL AND s.cell NOT IN (SELECT cell FROM steep) GROUP BY s.cell),
flat AS (SELECT cell FROM surface WHERE cell NOT IN (SELECT cell FROM steep UNION ALL SELECT cell FROM off)),
same AS (SELECT cell, other, code FROM pair WHERE z = oz AND cell IN (FROM flat)),
low(cell, d) USING KEY (cell) AS (
  SELECT other, 0 FROM same WHERE other NOT IN (FROM flat) GROUP BY other
  UNION
  SELECT s.cell, min(l.d + 1) FROM low l JOIN same s ON s.other = l.cell LEFT JOIN recurring.low o ON o.cell = s.cell WHERE o.cell IS NULL GROUP BY s.cell),
high(cell, d) USING KEY (cell) AS (
  SELECT cell, 1 FROM pair WHERE oz > z AND cell IN (FROM flat) GROUP BY cell
  UNION
  SELECT s.cell, min(l.d + 1) FROM high l JOIN same s ON s.other = l.cell LEFT JOIN recurring.high o ON o.cell = s.cell WHERE o.cell IS NULL GROUP BY s.cell),
over AS (SELECT s.cell, code FROM same s JOIN low l ON l.cell = s.other LEFT JOIN high h ON h.cell = s.other
  QUALIFY row_number() OVER (PARTITION BY s.cell ORDER BY CASE WHEN l.d = 0 THEN -1e9 ELSE 2 * l.d - coalesce(h.d, 0) END, code) = 1)
SELECT row, col, code::INTEGER AS direction FROM surface LEFT JOIN (FROM steep UNION ALL FROM off UNION ALL FROM over) USING (cell)""")
def flat_directions(spark, sf_dir):
    return terrain.flow_directions(filled(spark, sf_dir), "filled", tile=TILE)


def _at(dr: int, dc: int) -> str:
    return f"max(CASE WHEN dr = {dr} AND dc = {dc} THEN n.z END)"


@query(f"""WITH {SURFACE_SQL}, {NEAR_SQL}, around AS (SELECT cell,
  ({_at(-1, 1)} + 2 * {_at(0, 1)} + {_at(1, 1)}) - ({_at(-1, -1)} + 2 * {_at(0, -1)} + {_at(1, -1)}) AS across,
  ({_at(1, -1)} + 2 * {_at(1, 0)} + {_at(1, 1)}) - ({_at(-1, -1)} + 2 * {_at(-1, 0)} + {_at(-1, 1)}) AS along FROM near n GROUP BY cell)
SELECT row, col, round(degrees(atan(sqrt(across * across + along * along) / (8 * {CELL}))), 6) AS slope FROM surface LEFT JOIN around USING (cell)""")
def terrain_slope(spark, sf_dir):
    return terrain.slope(surface(spark, sf_dir), CELL, CELL, tile=TILE).withColumn("slope", F.round("slope", 6))


def _inverse_sql() -> str:
    """Longitude and latitude of (x, y), as geo.tm_inverse has them."""
    n = G.FLATTENING / (2 - G.FLATTENING)
    a = G.SCALE_FACTOR * G.MAJOR / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    # The coefficients of both series.
    beta = (n / 2 - 2 * n**2 / 3 + 37 * n**3 / 96 - n**4 / 360, n**2 / 48 + n**3 / 15 - 437 * n**4 / 1440, 17 * n**3 / 480 - 37 * n**4 / 840, 4397 * n**4 / 161280)
    delta = (2 * n - 2 * n**2 / 3 - 2 * n**3 + 116 * n**4 / 45, 7 * n**2 / 3 - 8 * n**3 / 5 - 227 * n**4 / 45, 56 * n**3 / 15 - 136 * n**4 / 35, 4279 * n**4 / 630)
    xi = "".join(f" - {c!r}::DOUBLE * sin({2 * j} * xi) * cosh({2 * j} * eta)" for j, c in enumerate(beta, 1))
    eta = "".join(f" - {c!r}::DOUBLE * cos({2 * j} * xi) * sinh({2 * j} * eta)" for j, c in enumerate(beta, 1))
    lat = "".join(f" + {c!r}::DOUBLE * sin({2 * j} * chi)" for j, c in enumerate(delta, 1))
    return f"""tm AS (SELECT row, col, y / {a!r}::DOUBLE AS xi, (x - {G.FALSE_EAST!r}::DOUBLE) / {a!r}::DOUBLE AS eta FROM centre),
turned AS (SELECT row, col, xi{xi} AS u, eta{eta} AS v FROM tm),
sphere AS (SELECT row, col, {G.MERIDIAN!r}::DOUBLE + degrees(atan2(sinh(v), cos(u))) AS lon, asin(sin(u) / cosh(v)) AS chi FROM turned),
lonlat AS (SELECT row, col, lon, degrees(chi{lat}) AS lat FROM sphere)"""


WARP_SQL = f"""{SURFACE_SQL},
cells AS (SELECT (p_partkey // w)::INT AS row, (p_partkey % w)::INT AS col FROM part, (SELECT ceil(sqrt(count(*)))::BIGINT AS w FROM part)),
centre AS (SELECT row, col, {UTM["x0"]} + (col + 0.5) * 30 AS x, {UTM["y0"]} - (row + 0.5) * 30 AS y FROM cells), {_inverse_sql()},
place AS (SELECT row, col, (lon - {LONLAT["x0"]}::DOUBLE) / {LONLAT["dx"]!r}::DOUBLE AS c, ({LONLAT["y0"]}::DOUBLE - lat) / {LONLAT["dy"]!r}::DOUBLE AS r FROM lonlat)"""


def target_cells(spark, sf_dir: str) -> DataFrame:
    """The cells of a square of as many cells as there are parts."""
    part = table(spark, sf_dir, "part").select("p_partkey")
    width = part.agg(F.ceil(F.sqrt(F.count(F.lit(1)))).cast("long").alias("w"))
    return part.crossJoin(F.broadcast(width)).select(F.floor(F.col("p_partkey") / F.col("w")).cast("int").alias("row"), (F.col("p_partkey") % F.col("w")).cast("int").alias("col"))


@query(f"""WITH {WARP_SQL} SELECT p.row, p.col, s.z FROM place p LEFT JOIN surface s ON s.row = floor(p.r)::INT AND s.col = floor(p.c)::INT""")
def warp_nearest(spark, sf_dir):
    return warp.warp(target_cells(spark, sf_dir), surface(spark, sf_dir), "z", UTM, LONLAT, G.tm_inverse)


@query(f"""WITH {WARP_SQL}, corner(dr, dc) AS (VALUES (0, 0), (0, 1), (1, 0), (1, 1)),
weighed AS (SELECT p.row, p.col, s.z, CASE WHEN dr = 1 THEN (r - 0.5) - floor(r - 0.5) ELSE 1 - ((r - 0.5) - floor(r - 0.5)) END
    * CASE WHEN dc = 1 THEN (c - 0.5) - floor(c - 0.5) ELSE 1 - ((c - 0.5) - floor(c - 0.5)) END AS weight
  FROM place p CROSS JOIN corner LEFT JOIN surface s ON s.row = floor(r - 0.5)::INT + dr AND s.col = floor(c - 0.5)::INT + dc)
SELECT row, col, CASE WHEN sum(weight) FILTER (z IS NOT NULL) >= 0.5 THEN round(sum(weight * z) / sum(weight) FILTER (z IS NOT NULL), 5) END AS z
FROM weighed GROUP BY row, col""")
def warp_bilinear(spark, sf_dir):
    got = warp.warp(target_cells(spark, sf_dir), surface(spark, sf_dir), "z", UTM, LONLAT, G.tm_inverse, "bilinear")
    return got.withColumn("z", F.round("z", 5))
