"""The validations as registered queries: each check over a surrogate of its artefact made from the star-schema tables.

The surrogates break rules on purpose, by their data, so that counts of violations are not all zero. Values are rounded
to six digits. The SQL states every metric anew; it shares nothing with ``checks``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runnel.functions import exprs as E
from runnel.functions import geo as G
from runnel.operators import graph, grid, planar
from runnel.plans import checks
from runnel.plans.gridded import CHANNEL_SQL, DOWN_SQL, GRID_SQL, ROADS_SQL, SPREAD_SQL, channel_edges, channel_nodes, roads, spill_sources, spilled
from runnel.plans.relational import PART_COEF_SQL, part_coefficient, query, table
from runnel.schema import PROVENANCE
from runnel.staging import materialize


def metrics_sql(with_: str, source: str, metrics: list[tuple[str, str, str]]) -> str:
    """metrics: (name, aggregate, condition on v); one row for each."""
    rows = ", ".join(f"{{'metric': '{n}', 'value': v_{n}::DOUBLE, 'ok': {f'coalesce(v_{n} {rule}, FALSE)' if rule else 'TRUE'}}}" for n, _, rule in metrics)
    aggregates = ", ".join(f"{a} AS v_{n}" for n, a, _ in metrics)
    return f"{with_} SELECT r.metric AS metric, round(r.value, 6) AS value, r.ok AS ok FROM (SELECT unnest([{rows}]) AS r FROM (SELECT {aggregates} FROM {source}))"


def shown(report: DataFrame) -> DataFrame:
    return report.select("metric", F.round("value", 6).alias("value"), "ok")


def flag(condition: Column) -> Column:
    return F.when(condition, 1).otherwise(0)


NONE = "= 0"
SOME = "> 0"

# --- V1: a scenario for each kind of event, its points by the hour ---

SCENARIO_SQL = """WITH points AS (SELECT event_type, (epoch(date_trunc('hour', ts)) / 60)::BIGINT AS minutes, sum(value::DECIMAL(18,2))::DOUBLE AS intensity FROM events GROUP BY 1, 2),
edge AS (SELECT min(minutes) AS m0, max(minutes) - min(minutes) AS horizon FROM points),
scenario AS (SELECT event_type, list(minutes - m0 ORDER BY minutes) AS m, list(intensity ORDER BY minutes) AS r, any_value(horizon) AS horizon FROM points, edge GROUP BY 1)"""


@query(metrics_sql(SCENARIO_SQL, "scenario", [
    ("missing_fields", "count(*) FILTER (event_type IS NULL)", NONE), ("empty_forecast", "count(*) FILTER (len(m) < 1)", NONE),
    ("not_increasing", "count(*) FILTER (list_sort(list_distinct(m)) <> m)", NONE), ("negative", "count(*) FILTER (list_min(r) < 0 OR list_min(m) < 0)", NONE),
    ("wrong_horizon", "count(*) FILTER (m[-1] <> horizon)", NONE), ("wrong_count", "count(*) FILTER (len(m) <> horizon // 60 + 1)", NONE),
]))
def v01_rainfall(spark, sf_dir):
    ts = F.col("ts")
    minutes = F.unix_date(F.to_date(ts)).cast("long") * 1440 + F.hour(ts) * 60
    points = table(spark, sf_dir, "events").groupBy("event_type", minutes.alias("minutes")).agg(F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("intensity"))
    edge = points.agg(F.min("minutes").alias("m0"), (F.max("minutes") - F.min("minutes")).alias("forecast_horizon_minutes"))
    point = F.struct((F.col("minutes") - F.col("m0")).alias("minutes"), F.col("intensity").alias("rainfall_mm_hr"))
    scenario = points.crossJoin(F.broadcast(edge)).groupBy(F.col("event_type").alias("scenario_id"), "forecast_horizon_minutes").agg(F.sort_array(F.collect_list(point)).alias("forecast"))
    return shown(checks.rainfall(scenario.withColumn("location", F.lit("x")).withColumn("source", F.lit("synthetic")).withColumn("interval_minutes", F.lit(60))))


# --- V2, V5: a lot for each part, some without geometry, some of one point, some bow ties, some with a hole across the edge ---

LOTS_SQL = f"""WITH {GRID_SQL}, lots AS (SELECT cell, p_size, 30.0 * col AS x0, -30.0 * row AS y0, 30.0 * col + 2 + p_size / 2.0 AS x1, -30.0 * row + 4.5 AS y1, p_size <> 17 AS has, p_size <> 13 AS wide, p_size NOT IN (19, 23) AS simple FROM grid),
ok AS (SELECT *, CASE WHEN has THEN x0 END AS gx0, CASE WHEN has THEN y0 END AS gy0, CASE WHEN has THEN CASE WHEN wide THEN x1 ELSE x0 END END AS gx1, CASE WHEN has THEN CASE WHEN wide THEN y1 ELSE y0 END END AS gy1 FROM lots)"""


AREAS_SQL = "SELECT 30.0 * col - 10 AS a, 30.0 * col + 65 AS c, -30.0 * row - 10 AS b, -30.0 * row + 40 AS d FROM grid WHERE p_size = 50"


def lots(spark, sf_dir) -> DataFrame:
    cells = grid.grid_from_parts(spark, sf_dir).join(table(spark, sf_dir, "part").select(F.col("p_partkey").alias("cell"), "p_size"), "cell")
    x0, y0 = F.col("col") * 30.0, F.col("row") * -30.0
    x1, y1 = F.when(F.col("p_size") != 13, x0 + 2 + F.col("p_size") / 2.0).otherwise(x0), F.when(F.col("p_size") != 13, y0 + 4.5).otherwise(y0)
    corners = [G.point(x0, y0), G.point(x1, y0), G.point(x1, y1), G.point(x0, y1), G.point(x0, y0)]
    ring = F.array(*corners)
    tie = F.array(*[corners[i] for i in (0, 2, 1, 3, 0)])
    hole = F.array(*[G.point(x1 + dx, y0 + dy) for dx, dy in ((-1, 1), (-1, 2), (1, 2), (1, 1), (-1, 1))])
    parts = F.when(F.col("p_size") == 19, F.array(tie)).when(F.col("p_size") == 23, F.array(ring, hole)).otherwise(F.array(ring))
    shape = F.struct(F.lit("Polygon").alias("type"), parts.alias("parts"))
    return cells.select("cell", "p_size", F.when(F.col("p_size") != 17, shape).alias("geometry"))


@query(metrics_sql(LOTS_SQL, "ok", [
    ("features", "count(*)", SOME), ("unusable_geometry", "count(*) FILTER (NOT has OR NOT wide OR NOT simple)", NONE),
    ("min_x", "min(gx0)", ""), ("min_y", "min(gy0)", ""), ("max_x", "max(CASE WHEN p_size = 23 THEN gx1 + 1 ELSE gx1 END)", ""), ("max_y", "max(gy1)", ""),
]))
def v02_area(spark, sf_dir):
    return shown(checks.area(lots(spark, sf_dir)))


@query(metrics_sql(LOTS_SQL + f", areas AS ({AREAS_SQL})", "ok", [
    ("features", "count(*)", SOME), ("unusable_geometry", "count(*) FILTER (NOT has OR NOT wide OR NOT simple)", NONE),
    ("outside", "count(*) FILTER (has AND NOT EXISTS (SELECT 1 FROM areas WHERE gx0 <= c AND gx1 >= a AND gy0 <= d AND gy1 >= b))", NONE), ("area", "sum(CASE p_size WHEN 19 THEN 0 WHEN 23 THEN (gx1 - gx0) * (gy1 - gy0) - 2 ELSE (gx1 - gx0) * (gy1 - gy0) END)", ""),
]))
def v05_surface_features(spark, sf_dir):
    """Against a block of three by two cells for each of the largest parts."""
    x0, y0 = F.col("col") * 30.0 - 10, F.col("row") * -30.0 - 10
    ring = F.array(G.point(x0, y0), G.point(x0 + 75, y0), G.point(x0 + 75, y0 + 50), G.point(x0, y0 + 50), G.point(x0, y0))
    cells = grid.grid_from_parts(spark, sf_dir).join(table(spark, sf_dir, "part").filter("p_size = 50").select(F.col("p_partkey").alias("cell")), "cell")
    areas = cells.select(F.struct(F.lit("Polygon").alias("type"), F.array(ring).alias("parts")).alias("geometry"))
    return shown(checks.surface_features(lots(spark, sf_dir), areas))


# --- V3, V4: rasters ---


@query(metrics_sql(f"WITH {GRID_SQL}", "grid", [("cells", "count(z)", ""), ("min", "min(z)", ""), ("max", "max(z)", ""), ("mean", "avg(z)", "")]))
def v03_raster_statistics(spark, sf_dir):
    return shown(checks.raster_statistics(grid.grid_from_parts(spark, sf_dir), "z"))


@query(metrics_sql("", "(SELECT 32643 + (n_regionkey = 4)::INT AS srid, 205 AS width, 184 + n_nationkey // 20 AS height, 1000 + n_regionkey * 5e-7::DOUBLE AS x0, 2000.0::DOUBLE AS y0, 30.0::DOUBLE AS dx, -30 + n_nationkey * 1e-8::DOUBLE AS dy FROM nation)", [
    ("distinct_srid", "count(DISTINCT srid)", "= 1"), ("distinct_width", "count(DISTINCT width)", "= 1"), ("distinct_height", "count(DISTINCT height)", "= 1"),
    *[(f"spread_{c}", f"max({c}) - min({c})", "<= 1e-6") for c in ("x0", "y0", "dx", "dy")],
]))
def v04_alignment(spark, sf_dir):
    n, r = F.col("n_nationkey"), F.col("n_regionkey")
    meta = table(spark, sf_dir, "nation").select(
        F.col("n_name").alias("grid_id"), (flag(r == 4) + 32643).alias("srid"), F.lit(205).alias("width"), (F.floor(n / 20) + 184).alias("height"),
        (r * F.lit(5e-7) + 1000).alias("x0"), F.lit(2000.0).alias("y0"), F.lit(30.0).alias("dx"), (n * F.lit(1e-8) - 30).alias("dy"),
    )
    return shown(checks.alignment(meta))


# --- V6, V7, V8, V10: coefficients, volumes, series ---

_CLASS = {"green_open": 0.3, "default_urban": 0.75, "road": 0.85, "building": 0.9}


@query(metrics_sql(f"WITH c AS (SELECT ({PART_COEF_SQL})::DOUBLE AS c FROM part)", "c", [
    *[(f"cells_{k}", f"count(*) FILTER (abs(c - {v}) <= 1e-8 + 1e-5 * {v})", SOME) for k, v in _CLASS.items()],
    ("unknown", "count(*) FILTER (c = 0.5)", NONE), ("out_of_range", "count(*) FILTER (NOT c BETWEEN 0 AND 1)", NONE), ("cells", "count(*)", SOME),
]))
def v06_runoff_coefficient(spark, sf_dir):
    return shown(checks.runoff_coefficient(table(spark, sf_dir, "part").select(part_coefficient().alias("coefficient"))))


VOLUMES_SQL = """WITH rows AS (SELECT l_linenumber AS step, l_partkey AS cell, CASE WHEN l_partkey % 97 = 0 THEN 'NaN'::DOUBLE ELSE sum(l_quantity) - 10 END AS v FROM lineitem GROUP BY 1, 2),
per AS (SELECT step, count(*) AS n, count(*) FILTER (isnan(v)) AS bad, count(*) FILTER (v < 0) AS neg FROM rows GROUP BY 1)"""


def volumes(spark, sf_dir) -> DataFrame:
    """What each part was sold in each line number: a volume for a cell and an interval, not finite for some parts."""
    rows = table(spark, sf_dir, "lineitem").groupBy(F.col("l_linenumber").alias("interval_id"), F.col("l_partkey").alias("cell")).agg(F.sum("l_quantity").alias("q"))
    return rows.withColumn("volume", F.when(F.col("cell") % 97 == 0, F.lit(float("nan"))).otherwise(F.col("q") - 10))


@query(metrics_sql(VOLUMES_SQL, "per", [
    ("intervals", "count(*)", SOME), ("wrong_cell_count", "count(*) FILTER (n <> (SELECT count(*) FROM part))", NONE), ("not_finite", "sum(bad)", NONE), ("negative", "sum(neg)", NONE),
]))
def v07_v10_volumes(spark, sf_dir):
    return shown(checks.volumes(volumes(spark, sf_dir), table(spark, sf_dir, "part")))


@query(metrics_sql("""WITH keys AS (SELECT l_partkey AS cell, l_linenumber * 30 AS t, count(*) AS n, min(l_quantity - 2) AS least, count(*) FILTER (l_quantity = 50) AS bad FROM lineitem GROUP BY 1, 2),
per AS (SELECT cell, sum(n - 1) AS dup, count(*) AS steps, min(least) AS least, sum(bad) AS bad FROM keys GROUP BY 1),
j AS (SELECT per.*, p_partkey FROM per FULL JOIN (SELECT p_partkey FROM part WHERE p_size > 3) ON p_partkey = cell)""", "j", [
    ("cells", "count(*)", SOME), ("duplicates", "sum(dup)", NONE), ("unknown_cells", "count(*) FILTER (p_partkey IS NULL)", NONE),
    ("wrong_steps", "count(*) FILTER (coalesce(steps, 0) <> 6)", NONE), ("negative", "count(*) FILTER (least < 0)", NONE), ("not_finite", "sum(bad)", NONE),
]))
def v08_timeseries(spark, sf_dir):
    """Cells are the parts above size 3; lines of other parts refer to unknown cells."""
    q = F.col("l_quantity")
    series = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("cell_id"), (F.col("l_linenumber") * 30).alias("start_min"), F.when(q == 50, float("inf")).otherwise(q - 2).alias("runoff_m3"))
    return shown(checks.timeseries(series, table(spark, sf_dir, "part").filter("p_size > 3").select(F.col("p_partkey").alias("cell_id"))))


# --- V9: directions ---


@query(metrics_sql(f"""WITH {DOWN_SQL}, d AS (SELECT a.*, p_size % 10 AS code FROM grid a),
j AS (SELECT d.code, s.code IS NULL AS bad, d.z - b.z AS fall FROM d LEFT JOIN steps8 s ON s.code = d.code LEFT JOIN grid b ON b.row = d.row + dr AND b.col = d.col + dc)""", "j", [
    *[(f"code_{k}", f"count(*) FILTER (code = {k})", "") for k in range(1, 9)], ("bad_code", "count(*) FILTER (bad)", NONE),
    ("exits", "count(*) FILTER (fall IS NULL AND NOT bad)", SOME), ("downhill", "count(*) FILTER (fall > 0.01)", ""),
    ("level", "count(*) FILTER (abs(fall) <= 0.01)", ""), ("uphill", "count(*) FILTER (fall < -0.01)", ""),
]))
def v09_flow_direction(spark, sf_dir):
    """Directions from the parts' sizes: codes 0 and 9 are none, many point uphill."""
    size = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("cell"), (F.col("p_size") % 10).alias("direction"))
    return shown(checks.flow_direction(grid.grid_from_parts(spark, sf_dir).join(size, "cell").select("row", "col", "direction", "z")))


# --- V11, V13, V14: lines ---

PATHS_SQL = f"""WITH {GRID_SQL}, paths AS (SELECT cell, p_size, 30.0 * col AS x0, -30.0 * row AS y0, 30.0 * col + 3 * (p_size % 11) AS x1, -30.0 * row + 4 * (p_size % 11) AS y1, 30.0 * col + 3 * (p_size % 11) + 12 AS x2 FROM grid),
measured AS (SELECT *, 5.0 * (p_size % 11) + 12 AS len FROM paths),
said AS (SELECT *, CASE WHEN p_size = 7 THEN 0 ELSE len + (p_size % 3) * 0.75 END AS length_m FROM measured), ends AS (SELECT *, (SELECT w FROM w) * 15 + 0.5 AS half FROM said)"""


def paths(spark, sf_dir) -> DataFrame:
    """A line of three points for each part: 5 metres for each unit of size modulo 11, then 12 to the east."""
    cells = grid.grid_from_parts(spark, sf_dir).join(table(spark, sf_dir, "part").select(F.col("p_partkey").alias("cell"), "p_size"), "cell")
    x, y, k = F.col("col") * 30.0, F.col("row") * -30.0, F.col("p_size") % 11
    line = F.array(G.point(x, y), G.point(x + 3 * k, y + 4 * k), G.point(x + 3 * k + 12, y + 4 * k))
    length = F.when(F.col("p_size") == 7, 0.0).otherwise(5.0 * k + 12 + (F.col("p_size") % 3) * 0.75)
    return cells.select("cell", "row", "col", "p_size", length.alias("length_m"), F.struct(F.lit("LineString").alias("type"), F.array(line).alias("parts")).alias("geometry"))


@query(metrics_sql(PATHS_SQL, "ends", [
    ("rows", "count(*)", SOME), ("duplicate_ids", "count(*) FILTER (p_size = 31)", NONE), ("null_ids", "count(*) FILTER (cell = 0)", NONE),
    ("unusable_geometry", "count(*) FILTER (p_size = 41)", NONE), ("no_length", "count(*) FILTER (length_m <= 0)", NONE),
    ("length_differs", "count(*) FILTER (abs(CASE WHEN p_size = 41 THEN 0 ELSE len END - length_m) > 1)", NONE),
    ("outside_area", "count(*) FILTER (y0 < -half OR x0 < -0.5 OR CASE WHEN p_size = 41 THEN x0 > half OR y0 > 0.5 ELSE x2 > half OR y1 > 0.5 END)", NONE),
]))
def v11_v13_lines(spark, sf_dir):
    """Against the quarter of the grid that holds the first cells, half a metre wider; some lines twice, one without id, some points."""
    width = int(table(spark, sf_dir, "part").agg(F.ceil(F.sqrt(F.count(F.lit(1)))).cast("int")).first()[0])
    half = width * 15 + 0.5
    cut = half // 2 + 0.25  # two polygons that overlap make up the area
    west, east = ([(a, 0.5), (b, 0.5), (b, -half), (a, -half), (a, 0.5)] for a, b in ((-0.5, cut + 3), (cut, half)))
    start = G.first_point(F.col("geometry"))
    dot = F.struct(F.lit("LineString").alias("type"), F.array(F.array(start, start)).alias("parts"))
    rows = paths(spark, sf_dir).withColumn("geometry", F.when(F.col("p_size") == 41, dot).otherwise(F.col("geometry"))).withColumn("cell", F.nullif("cell", F.lit(0)))
    rows = rows.unionByName(rows.filter("p_size = 31"))
    return shown(checks.lines(rows, "cell", ["geometry", "length_m"], [[west], [east]], 0.05))


@query(f"""{PATHS_SQL},
seg AS (SELECT cell, x0 AS ax, y0 AS ay, x1 AS bx, y1 AS by_ FROM paths UNION ALL SELECT cell, x1, y1, x2, y1 FROM paths),
t AS (SELECT cell, ax, ay, bx, by_, greatest(0, CASE WHEN bx > ax THEN (4.25 - ax) / (bx - ax) WHEN ax >= 4.25 THEN 0 ELSE 2 END, CASE WHEN by_ > ay THEN (-100.5 - ay) / (by_ - ay) WHEN ay >= -100.5 THEN 0 ELSE 2 END) AS t0,
  least(1, CASE WHEN bx > ax THEN (70.75 - ax) / (bx - ax) WHEN ax <= 70.75 THEN 1 ELSE -1 END, CASE WHEN by_ > ay THEN (1.25 - ay) / (by_ - ay) WHEN ay <= 1.25 THEN 1 ELSE -1 END) AS t1 FROM seg)
SELECT cell, round(sum((t1 - t0) * sqrt((bx - ax) * (bx - ax) + (by_ - ay) * (by_ - ay))), 6) AS length_m FROM t WHERE t1 > t0 AND (bx <> ax OR by_ <> ay) GROUP BY 1""")
def clip_lines(spark, sf_dir):
    """What lies of each line in a rectangle."""
    ring = F.array(*[G.point(F.lit(x), F.lit(y)) for x, y in ((4.25, -100.5), (70.75, -100.5), (70.75, 1.25), (4.25, 1.25), (4.25, -100.5))])
    area = spark.range(1).select("id", F.struct(F.lit("Polygon").alias("type"), F.array(ring).alias("parts")).alias("geometry"))
    inside = planar.clip_lines(paths(spark, sf_dir).select(F.col("cell").alias("id"), "geometry"), area)
    return inside.select(F.col("id").alias("cell"), F.round(G.length(F.col("geometry")), 6).alias("length_m")).filter("length_m > 0")


# --- Layers of polygons ---

PLOTS_SQL = f"""WITH {GRID_SQL}, plots AS (SELECT cell, p_size % 3 AS class, 30.0 * col AS x0, -30.0 * row AS y0, 30.0 * col + 10 + p_size AS x1, -30.0 * row + 5 + (p_size * 7) % 40 AS y1 FROM grid)"""


def plots(spark, sf_dir) -> DataFrame:
    """A rectangle for each part, most of which overlap their neighbours, in three classes."""
    cells = grid.grid_from_parts(spark, sf_dir).join(table(spark, sf_dir, "part").select(F.col("p_partkey").alias("cell"), "p_size"), "cell")
    x0, y0 = F.col("col") * 30.0, F.col("row") * -30.0
    x1, y1 = x0 + 10 + F.col("p_size"), y0 + 5 + (F.col("p_size") * 7) % 40
    ring = F.array(G.point(x0, y0), G.point(x1, y0), G.point(x1, y1), G.point(x0, y1), G.point(x0, y0))
    return cells.select((F.col("p_size") % 3).alias("group"), F.col("cell").alias("id"), F.struct(F.lit("Polygon").alias("type"), F.array(ring).alias("parts")).alias("geometry"))


@query(f"""{PLOTS_SQL},
edge AS (SELECT DISTINCT class, unnest([x0, x1]) AS x FROM plots), slab AS (SELECT class, x AS a, lead(x) OVER (PARTITION BY class ORDER BY x) AS b FROM edge),
strip AS (SELECT s.class, a, b, y0, y1, max(y1) OVER (PARTITION BY s.class, a ORDER BY y0, y1 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reached
  FROM slab s JOIN plots p ON p.class = s.class AND p.x0 <= a AND p.x1 >= b)
SELECT class, round(sum((b - a) * greatest(0, y1 - greatest(y0, coalesce(reached, y0))))::DOUBLE, 4) AS area FROM strip GROUP BY class""")
def dissolve_plots(spark, sf_dir):
    """The area that the plots of a class cover, those that overlap once."""
    rings = planar.dissolve(plots(spark, sf_dir))
    return rings.groupBy(F.col("group").alias("class")).agg(F.round(F.sum("area"), 4).alias("area"))


QUARTER, REACH = 8, 6.5


@query(f"""SELECT s_suppkey, round(2 * {REACH} * 10 * (1 + s_suppkey % 7) + 2 * {QUARTER} * {REACH} * {REACH} * sin(pi() / 2 / {QUARTER}), 4) AS area FROM supplier""")
def buffer_lines(spark, sf_dir):
    """All within 6.5 m of a straight line of three points for each supplier."""
    k = F.col("s_suppkey")
    x, y, n = (k * 37 % 1000).cast("double"), (k * 91 % 1000).cast("double"), k % 7 + 1
    line = F.array(G.point(x, y), G.point(x + 3 * n, y + 4 * n), G.point(x + 6 * n, y + 8 * n))
    lines = table(spark, sf_dir, "supplier").select(k.alias("id"), F.struct(F.lit("LineString").alias("type"), F.array(line).alias("parts")).alias("geometry"))
    rings = planar.buffer(lines, REACH, QUARTER)
    return rings.groupBy(F.col("group").alias("s_suppkey")).agg(F.round(F.sum("area"), 4).alias("area"))


#: A hook with a hole, from a cell's corner; no line of ``paths`` runs along it.
HOOK = ([(-10.37, -35.41), (52.63, -35.41), (52.63, -5.19), (21.17, -5.19), (21.17, 3.77), (52.63, 3.77), (52.63, 31.43), (-10.37, 31.43), (-10.37, -35.41)],
        [(-4.21, 8.83), (15.91, 8.83), (15.91, 22.57), (-4.21, 22.57), (-4.21, 8.83)])
_HOOK_EDGES = ", ".join(f"({a[0]}, {a[1]}, {b[0]}, {b[1]})" for ring in HOOK for a, b in zip(ring, ring[1:], strict=False))


@query(f"""{PATHS_SQL},
hook(hax, hay, hbx, hby) AS (VALUES {_HOOK_EDGES}),
border AS (SELECT cell AS area, 30.0 * col + hax AS ax, -30.0 * row + hay AS ay, 30.0 * col + hbx AS bx, -30.0 * row + hby AS by_ FROM grid, hook WHERE p_size = 50),
seg AS (SELECT cell, 1 AS i, x0 AS ax, y0 AS ay, x1 AS bx, y1 AS by_ FROM paths WHERE x1 > x0 UNION ALL SELECT cell, 2, x1, y1, x2, y1 FROM paths),
cut AS (SELECT s.cell, s.i, CASE WHEN b.ax = b.bx THEN (b.ax - s.ax) / (s.bx - s.ax) ELSE (b.ay - s.ay) / nullif(s.by_ - s.ay, 0) END AS t FROM seg s JOIN border b
  ON least(b.ax, b.bx) <= s.bx AND greatest(b.ax, b.bx) >= s.ax AND least(b.ay, b.by_) <= s.by_ AND greatest(b.ay, b.by_) >= s.ay),
place AS (SELECT cell, i, t FROM cut WHERE t > 0 AND t < 1 UNION SELECT cell, i, unnest([0::DOUBLE, 1::DOUBLE]) FROM seg),
piece AS (SELECT cell, i, t AS t0, lead(t) OVER (PARTITION BY cell, i ORDER BY t) AS t1 FROM place),
middle AS (SELECT p.cell, p.i, t0, t1, ax + (bx - ax) * (t0 + t1) / 2 AS x, ay + (by_ - ay) * (t0 + t1) / 2 AS y, sqrt((bx - ax) * (bx - ax) + (by_ - ay) * (by_ - ay)) * (t1 - t0) AS len
  FROM piece p JOIN seg s ON s.cell = p.cell AND s.i = p.i WHERE t1 IS NOT NULL),
held AS (SELECT m.cell, m.i, t0, any_value(len) AS len FROM middle m JOIN border b ON (b.ay > m.y) <> (b.by_ > m.y) AND m.x < b.ax GROUP BY m.cell, m.i, t0, area HAVING count(*) % 2 = 1),
once AS (SELECT cell, i, t0, any_value(len) AS len FROM held GROUP BY ALL)
SELECT cell, round(sum(len), 5) AS length_m FROM once GROUP BY cell""")
def clip_layers(spark, sf_dir):
    """What lies of each line in hooks with holes, one for each of the largest parts; hooks overlap."""
    corner = F.col("col") * 30.0, F.col("row") * -30.0
    rings = F.array(*[F.array(*[G.point(corner[0] + x, corner[1] + y) for x, y in ring]) for ring in HOOK])
    large = grid.grid_from_parts(spark, sf_dir).join(table(spark, sf_dir, "part").filter("p_size = 50").select(F.col("p_partkey").alias("cell")), "cell")
    hooks = large.select(F.col("cell").alias("id"), F.struct(F.lit("Polygon").alias("type"), rings.alias("parts")).alias("geometry"))
    inside = planar.clip_lines(paths(spark, sf_dir).select(F.col("cell").alias("id"), "geometry"), hooks)
    return inside.select(F.col("id").alias("cell"), F.round(G.length(F.col("geometry")), 5).alias("length_m"))


_BURN = {"x0": 0.0, "y0": 0.0, "dx": 2.0, "dy": -2.0}


@query(f"""{PATHS_SQL}, seg AS (SELECT x0 / 2 AS ax, -y0 / 2 AS ay, x1 / 2 AS bx, -y1 / 2 AS by_ FROM paths UNION ALL SELECT x1 / 2, -y1 / 2, x2 / 2, -y1 / 2 FROM paths),
cuts AS (SELECT ax, ay, bx, by_, list_sort(list_distinct(list_filter(list_concat([0::DOUBLE, 1::DOUBLE], list_concat(
  CASE WHEN ax <> bx THEN list_transform(range(ceil(least(ax, bx))::BIGINT, floor(greatest(ax, bx))::BIGINT + 1), lambda k: (k - ax) / (bx - ax)) ELSE [] END,
  CASE WHEN ay <> by_ THEN list_transform(range(ceil(least(ay, by_))::BIGINT, floor(greatest(ay, by_))::BIGINT + 1), lambda k: (k - ay) / (by_ - ay)) ELSE [] END)), lambda t: t >= 0 AND t <= 1))) AS ts FROM seg),
mids AS (SELECT *, unnest(list_transform(range(1, len(ts)), lambda i: (ts[i] + ts[i + 1]) / 2)) AS m FROM cuts)
SELECT DISTINCT floor(ay + (by_ - ay) * m)::INT AS row, floor(ax + (bx - ax) * m)::INT AS col FROM mids""")
def burn_lines(spark, sf_dir):
    """Cells of two metres that the lines touch."""
    return grid.cells_on_lines(paths(spark, sf_dir), _BURN)


@query(f"""{LOTS_SQL}, fine AS (SELECT a.r AS row, b.c AS col, 10.0 * b.c + 5 AS x, -10.0 * a.r + 2 AS y FROM range(0, (SELECT 3 * w FROM w)) a(r), range(0, (SELECT 3 * w FROM w)) b(c))
SELECT DISTINCT row::INT AS row, col::INT AS col FROM fine JOIN ok ON x > gx0 AND x < gx1 AND y > gy0 AND y < gy1 WHERE wide""")
def burn_polygons(spark, sf_dir):
    """Cells of ten metres whose centre lies in a lot."""
    meta = {"x0": 0.0, "y0": 7.0, "dx": 10.0, "dy": -10.0}
    cells = grid.grid_from_parts(spark, sf_dir).select("row", "col")
    step = F.explode(F.array(*[F.lit(i) for i in range(3)]))
    fine = cells.select((F.col("row") * 3).alias("row"), (F.col("col") * 3).alias("col")).withColumn("i", step).withColumn("j", step)
    fine = fine.select((F.col("row") + F.col("i")).cast("int").alias("row"), (F.col("col") + F.col("j")).cast("int").alias("col"))
    return grid.cells_in_polygons(fine, lots(spark, sf_dir).filter("geometry is not null"), meta)


@query("""WITH p AS (SELECT s_suppkey, 72 + s_acctbal / 2000 AS lon, 8 + s_nationkey * 0.75 AS lat FROM supplier), c AS (SELECT 1 / 298.257223563::DOUBLE AS f),
k AS (SELECT f / (2 - f) AS n FROM c), s AS (SELECT n, 6378137.0 / (1 + n) * (1 + n * n / 4 + n * n * n * n / 64) AS a, 2 * sqrt(n) / (1 + n) AS e,
  n / 2 - 2 * n * n / 3 + 5 * n * n * n / 16 AS a1, 13 * n * n / 48 - 3 * n * n * n / 5 AS a2, 61 * n * n * n / 240 AS a3 FROM k),
t AS (SELECT *, sinh(atanh(sin(radians(lat))) - e * atanh(e * sin(radians(lat)))) AS t, radians(lon - 75) AS l FROM p, s),
x AS (SELECT *, atan2(t, cos(l)) AS xi, atanh(sin(l) / sqrt(1 + t * t)) AS eta FROM t)
SELECT s_suppkey, round(500000 + 0.9996 * a * (eta + a1 * cos(2 * xi) * sinh(2 * eta) + a2 * cos(4 * xi) * sinh(4 * eta) + a3 * cos(6 * xi) * sinh(6 * eta)), 4) AS east,
  round(0.9996 * a * (xi + a1 * sin(2 * xi) * cosh(2 * eta) + a2 * sin(4 * xi) * cosh(4 * eta) + a3 * sin(6 * xi) * cosh(6 * eta)), 4) AS north FROM x""")
def utm_forward(spark, sf_dir):
    lon, lat = F.col("s_acctbal") / 2000 + 72, F.col("s_nationkey") * 0.75 + 8
    east, north = G.tm_forward(lon, lat)
    return table(spark, sf_dir, "supplier").select("s_suppkey", F.round(east, 4).alias("east"), F.round(north, 4).alias("north"))


@query("""WITH {grid}, lots AS (SELECT p_size % 11 AS k, 30.0 * col AS x, -30.0 * row AS y FROM grid) SELECT count(*) AS lines, sum(5.0 * k + 12) AS length_m,
  min(x) AS min_x, max(y + 4 * k) AS max_y, sum(x + 3 * k + 12)::DOUBLE AS last_x, sum(y)::DOUBLE AS first_y, round(sum(CASE WHEN 5 * k >= 12 THEN x + 3.0 * (5 * k + 12) / 10 ELSE x + 3 * k + (12 - 5 * k) / 2.0 END)::DOUBLE, 6) AS mid_x FROM lots""".replace("{grid}", GRID_SQL))
def line_measures(spark, sf_dir):
    """Lengths, bounds, ends and points half way along the lines."""
    g = F.col("geometry")
    b = G.bounds(g)
    at = paths(spark, sf_dir).select(G.length(g).alias("len"), b["min_x"].alias("min_x"), b["max_y"].alias("max_y"), G.last_point(g)["x"].alias("last_x"), G.first_point(g)["y"].alias("first_y"), G.midpoint(F.element_at("geometry.parts", 1))["x"].alias("mid_x"))
    return at.agg(
        F.count(F.lit(1)).alias("lines"), F.round(F.sum("len"), 6).alias("length_m"), F.min("min_x").alias("min_x"), F.max("max_y").alias("max_y"),
        F.sum("last_x").alias("last_x"), F.sum("first_y").alias("first_y"), F.round(F.sum("mid_x"), 6).alias("mid_x"),
    )


@query(metrics_sql("WITH d AS (SELECT CASE WHEN p_size % 9 = 0 THEN 'observed' ELSE 'dem_inferred_surface_flow' END AS s, p_size % 8 <> 0 AS i, p_size - 3 AS acc, p_retailprice - 1000 AS a FROM part)", "d", [
    ("wrong_source", "count(*) FILTER (s <> 'dem_inferred_surface_flow')", NONE), ("not_inferred", "count(*) FILTER (NOT i)", NONE),
    ("no_accumulation", "count(*) FILTER (acc <= 0)", NONE), ("no_area", "count(*) FILTER (a <= 0)", NONE),
]))
def v13_drainage_provenance(spark, sf_dir):
    s = F.col("p_size")
    rows = table(spark, sf_dir, "part").select(
        F.when(s % 9 == 0, "observed").otherwise(PROVENANCE["drainage"]).alias("source_type"), (s % 8 != 0).alias("is_inferred"), (s - 3).alias("acc_cells"),
        (F.col("p_retailprice") - 1000).alias("upstream_area_m2"),
    )
    return shown(checks.drainage_provenance(rows))


@query(metrics_sql("""WITH d AS (SELECT CASE WHEN p_size = 50 THEN 'inf'::DOUBLE ELSE p_size::DOUBLE END AS a, (p_partkey % 37)::DOUBLE AS b, p_size, p_partkey FROM part),
e AS (SELECT *, a - b + (p_size % 4) * 0.004 AS d, 10.0 + p_partkey % 7 AS len FROM d), f AS (SELECT *, d / len + (p_partkey % 5) * 0.00004 AS s FROM e)""", "f", [
    ("not_finite", "count(*) FILTER (NOT isfinite(a) OR NOT isfinite(b))", NONE), ("uphill", "count(*) FILTER (a - b < -0.05)", NONE),
    ("drop_differs", "count(*) FILTER (p_size = 50 OR p_size % 4 = 3)", NONE),
    ("slope_differs", "count(*) FILTER (p_size = 50 OR p_partkey % 5 >= 3)", NONE), ("percent_differs", "count(*) FILTER (p_size = 50 OR p_partkey % 3 = 0)", NONE),
]))
def v14_drainage_attributes(spark, sf_dir):
    """Drops, slopes and percentages that are off by little or by too much; what is not finite differs."""
    p, s = F.col("p_partkey"), F.col("p_size")
    rows = table(spark, sf_dir, "part").select(p, s, F.when(s == 50, float("inf")).otherwise(s.cast("double")).alias("start_elevation_m"), (p % 37).cast("double").alias("end_elevation_m"))
    rows = rows.withColumn("elevation_drop_m", F.col("start_elevation_m") - F.col("end_elevation_m") + (s % 4) * 0.004).withColumn("length_m", p % 7 + 10.0)
    rows = rows.withColumn("slope_m_per_m", F.col("elevation_drop_m") / F.col("length_m") + (p % 5) * 0.00004)
    return shown(checks.drainage_attributes(rows.withColumn("slope_percent", F.col("slope_m_per_m") * 100 + flag(p % 3 == 0) * 0.5)))


# --- V12, V15, V16: networks ---

NETWORK_SQL = """ids AS (SELECT id FROM nodes), both_ways AS (SELECT src, dst FROM edges WHERE src <> dst UNION SELECT dst, src FROM edges WHERE src <> dst),
reached(id, c) AS (SELECT id, id FROM ids UNION SELECT b.dst, r.c FROM reached r JOIN both_ways b ON b.src = r.id),
deg AS (SELECT id, (SELECT count(*) FROM edges WHERE dst = id) AS i, (SELECT count(*) FROM edges WHERE src = id) AS o FROM ids),
net AS (SELECT (SELECT count(*) FROM ids) AS nodes, (SELECT count(*) FROM edges) AS edges, (SELECT count(DISTINCT c) FROM (SELECT id, min(c) AS c FROM reached GROUP BY 1)) AS components,
  (SELECT count(*) FROM (SELECT src AS e FROM edges UNION ALL SELECT dst FROM edges) WHERE e NOT IN (SELECT id FROM ids)) AS dangling,
  (SELECT count(*) FROM deg WHERE i = 0 AND o = 0) AS isolates, (SELECT count(*) FROM edges WHERE src = dst) AS loops, (SELECT count(*) FROM deg WHERE o > 1) AS branching)"""
_NETWORK = [("nodes", "max(nodes)", SOME), ("edges", "max(edges)", SOME), ("components", "max(components)", ""), ("dangling", "max(dangling)", NONE), ("isolates", "max(isolates)", NONE)]


@query(metrics_sql(f"WITH RECURSIVE {ROADS_SQL}, edges AS (SELECT a AS src, b AS dst FROM roads), nodes AS (SELECT n_nationkey AS id FROM nation), {NETWORK_SQL}", "net", _NETWORK))
def v12_road_network(spark, sf_dir):
    edges = materialize(roads(spark, sf_dir), "roads")
    return shown(checks.network(table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("node_id")), edges, forest=False))


@query(metrics_sql("WITH r AS (SELECT CASE WHEN l_tax = 0 THEN 0.2 ELSE -1 END AS d, CASE WHEN l_discount = 0 THEN 'low' ELSE 'unknown' END AS k, (l_quantity <> 3)::INT AS p, l_quantity AS len, l_quantity + (l_quantity = 9)::INT AS c FROM lineitem)", "r", [
    ("depth", "count(*) FILTER (d <> -1)", NONE), ("risk", "count(*) FILTER (k <> 'unknown')", NONE), ("passable", "count(*) FILTER (p <> 1)", NONE), ("cost", "count(*) FILTER (c <> len)", NONE),
]))
def v12_road_placeholders(spark, sf_dir):
    q = F.col("l_quantity")
    rows = table(spark, sf_dir, "lineitem").select(
        F.when(F.col("l_tax") == 0, 0.2).otherwise(-1.0).alias("flood_depth_m"), F.when(F.col("l_discount") == 0, "low").otherwise("unknown").alias("flood_risk"),
        flag(q != 3).alias("is_passable"), q.alias("length_m"), (q + flag(q == 9)).alias("routing_cost"),
    )
    return shown(checks.road_placeholders(rows))


@query(metrics_sql(f"WITH RECURSIVE {CHANNEL_SQL}, nodes AS (SELECT src AS id FROM edges UNION SELECT dst FROM edges), {NETWORK_SQL}", "net", [
    *_NETWORK, ("loops", "max(loops)", NONE), ("branching", "max(branching)", NONE), ("forest_relation", "max(edges - nodes + components)", NONE),
]))
def v15_drainage_network(spark, sf_dir):
    edges = materialize(channel_edges(spark, sf_dir), "edges")
    return shown(checks.network(channel_nodes(edges).withColumnRenamed("id", "node_id"), edges))


@query(metrics_sql("""WITH e AS (SELECT p_partkey AS k, p_size % 6 AS o, CASE WHEN p_partkey % 10 = 0 THEN 'low' WHEN p_size % 6 <= 1 THEN 'low' WHEN p_size % 6 = 2 THEN 'medium' WHEN p_size % 6 = 3 THEN 'high' ELSE 'very_high' END AS class,
  CASE WHEN p_size % 6 <= 1 THEN 'low' WHEN p_size % 6 = 2 THEN 'medium' WHEN p_size % 6 = 3 THEN 'high' ELSE 'very_high' END AS right_class FROM part)""", "e", [
    ("order", "count(*) FILTER (o < 1)", NONE), ("class", "count(*) FILTER (class <> right_class)", NONE), ("section", "count(*) FILTER (k % 12 = 0)", NONE), ("slope", "count(*) FILTER (k % 13 = 0)", NONE),
    ("discharge", "count(*) FILTER (k % 14 = 0)", NONE), ("provenance", "count(*) FILTER (k % 15 = 0 OR k % 16 = 0)", NONE),
]))
def v16_capacity(spark, sf_dir):
    """Classes, sections, slopes, discharges and labels that are wrong for every tenth to sixteenth edge."""
    k, o = F.col("p_partkey"), F.col("p_size") % 6
    width, depth = E.section(o)
    rows = table(spark, sf_dir, "part").select(
        k, o.alias("strahler_order"), F.when(k % 10 == 0, "low").otherwise(E.capacity_class(o)).alias("capacity_class"), (width + flag(k % 12 == 0)).alias("scenario_width_m"), depth.alias("scenario_depth_m"),
        F.when(k % 13 == 0, 0.0005).otherwise(E.SLOPE_FLOOR + F.col("p_size") / 1000).alias("capacity_effective_slope"),
        F.when(k % 15 == 0, "measured").otherwise(PROVENANCE["capacity_source"]).alias("capacity_source"), flag(k % 16 == 0).alias("capacity_is_observed"),
    )
    again = E.manning_m3s(F.col("scenario_width_m"), F.col("scenario_depth_m"), F.col("capacity_effective_slope"))
    return shown(checks.capacity(rows.withColumn("capacity_m3s", again + flag(k % 14 == 0) * 0.001)))


@query(metrics_sql("""WITH layer AS (SELECT o_orderkey % 220 AS id, o_orderkey % 4 + 1 AS o, o_totalprice / 1000 AS c FROM orders),
j AS (SELECT o, c, p_partkey, p_size % 4 + 1 AS po, p_retailprice AS pc FROM layer LEFT JOIN part ON p_partkey = id)""", "j", [
    ("lines", "count(*)", SOME), ("missing_in_graph", "count(*) FILTER (p_partkey IS NULL)", NONE),
    ("graph_differs", "count(*) FILTER (p_partkey IS NOT NULL AND (o <> po OR abs(c - pc) > 1e-6))", NONE),
]))
def v16_capacity_matches(spark, sf_dir):
    """Orders as lines of the layer, parts as edges of the graph."""
    k = F.col("o_orderkey")
    layer = table(spark, sf_dir, "orders").select((k % 220).alias("drain_id"), (k % 4 + 1).alias("strahler_order"), (F.col("o_totalprice") / 1000).alias("capacity_m3s"))
    edges = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("drain_id"), (F.col("p_size") % 4 + 1).alias("strahler_order"), F.col("p_retailprice").alias("capacity_m3s"))
    return shown(checks.capacity_matches(layer, edges))


@query(metrics_sql(f"""WITH RECURSIVE {CHANNEL_SQL}, ids AS (SELECT src AS id FROM edges UNION SELECT dst FROM edges),
i AS (SELECT id, (SELECT count(*) FROM edges WHERE dst = id) AS ins, (SELECT count(*) FROM edges WHERE src = id) AS outs, src, acc, id % 7 = 0 AS w7, id % 5 = 0 AS w5, id % 3 = 0 AS w3 FROM ids LEFT JOIN edges ON src = id)""", "i", [
    ("sinks_used", "count(*) FILTER (outs = 0)", NONE), ("degrees", "count(*) FILTER (w7)", NONE), ("drain", "count(*) FILTER (outs > 0 AND w5)", NONE),
    ("accumulation", "count(*) FILTER (outs > 0 AND w3)", NONE), ("area", "count(*) FILTER (outs > 0 AND w7)", NONE),
]))
def v17_inlet_graph(spark, sf_dir):
    """An inlet at every channel node, with degrees, drains, accumulations and areas that are wrong for some."""
    edges = materialize(channel_edges(spark, sf_dir), "edges").select("src", "dst", F.col("src").alias("drain_id"), F.col("acc").alias("acc_cells"), (F.col("acc") * 900.0).alias("upstream_area_m2"))
    nodes = channel_nodes(edges).withColumnRenamed("id", "node_id")
    known = nodes.select(F.col("node_id").alias("id"))
    degree = graph.degrees(known, edges).join(edges.select(F.col("src").alias("id"), F.col("acc_cells").alias("acc")), "id", "left")
    i = F.col("id")
    rows = degree.select(
        i.alias("drain_node_id"), (F.col("in_degree") + flag(i % 7 == 0)).alias("graph_in_degree"), F.col("out_degree").alias("graph_out_degree"), (i + flag(i % 5 == 0)).alias("drain_id"),
        (F.col("acc") + flag(i % 3 == 0)).alias("acc_cells"), (F.col("acc") * 900.0 + flag(i % 7 == 0) * 0.5).alias("upstream_area_m2"),
    )
    return shown(checks.inlet_graph(rows, nodes, edges))


# --- V17, V18: inlets ---

INLET_ROWS_SQL = """WITH i AS (SELECT o_orderkey // 2 * 2 + (o_orderkey % 50 <> 1)::INT * (o_orderkey % 2) AS inlet_id, o_custkey AS node, o_orderkey % 30 AS drain, o_orderkey % 130 AS road, o_totalprice / 10000 AS d, o_orderkey FROM orders),
j AS (SELECT i.*, c_custkey, n_nationkey, s_suppkey, CASE WHEN d <= 12 THEN 'road_intersection' ELSE 'road_proximity' END AS method FROM i LEFT JOIN customer ON c_custkey = node
  LEFT JOIN nation ON n_nationkey = drain LEFT JOIN supplier ON s_suppkey = road)"""


@query(metrics_sql(INLET_ROWS_SQL, "j", [
    ("rows", "count(*)", SOME), ("duplicate_ids", "count(*) - count(DISTINCT inlet_id)", NONE), ("distance", "count(*) FILTER (NOT d BETWEEN 0 AND 30)", NONE),
    ("method", "count(*) FILTER (d > 0.501 AND method = 'road_intersection')", NONE), ("provenance", "count(*) FILTER (o_orderkey % 19 = 0)", NONE),
    ("unknown_node", "count(*) FILTER (c_custkey IS NULL)", NONE), ("unknown_edge", "count(*) FILTER (n_nationkey IS NULL)", NONE), ("unknown_road", "count(*) FILTER (s_suppkey IS NULL)", NONE),
    ("moved", "count(*) FILTER (o_orderkey % 23 = 0 AND c_custkey IS NOT NULL)", NONE), ("median_distance", "median(d)", ""),
]))
def v17_inlets(spark, sf_dir):
    """An inlet for each order: at its customer's place, moved for some; drains and roads that exist only in part."""
    k, d = F.col("o_orderkey"), F.col("o_totalprice") / 10000
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("node_id"), F.col("c_acctbal").alias("x"), F.col("c_nationkey").cast("double").alias("y"))
    rows = table(spark, sf_dir, "orders").join(c.withColumnRenamed("node_id", "o_custkey"), "o_custkey", "left").select(
        (F.floor(k / 2) * 2 + F.when(k % 50 != 1, k % 2).otherwise(0)).alias("inlet_id"), F.col("o_custkey").alias("drain_node_id"), (k % 30).alias("drain_id"), (k % 130).alias("road_id"),
        d.alias("distance_to_road_m"), F.when(d <= 12, "road_intersection").otherwise("road_proximity").alias("candidate_method"),
        F.when(k % 19 == 0, "observed").otherwise(PROVENANCE["inlets"]).alias("source_type"), F.lit(0).alias("is_observed"), (F.col("x") + flag(k % 23 == 0) * 0.5).alias("x"), "y",
    )
    edges = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("long").alias("drain_id"))
    return shown(checks.inlets(rows, c, edges, table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("road_id"))))


@query(metrics_sql("WITH i AS (SELECT l_quantity AS d, (l_quantity <= 22)::INT AS e, CASE WHEN l_quantity <= 0.5 THEN 'intersection' WHEN l_quantity <= 9 THEN 'near' WHEN l_quantity <= 20 THEN 'moderate' ELSE 'distant_candidate' END AS class, l_tax AS t FROM lineitem)", "i", [
    ("eligibility", "count(*) FILTER (e <> (d <= 20)::INT)", NONE), ("class", "count(*) FILTER (d > 9 AND d <= 10)", NONE),
    ("thresholds", "count(*) FILTER (t = 0.08)", NONE), ("horizon", "count(*) FILTER (d > 30)", NONE),
]))
def v18_inlet_flags(spark, sf_dir):
    d = F.col("l_quantity")
    kind = F.when(d <= 0.5, "intersection").when(d <= 9, "near").when(d <= 20, "moderate").otherwise("distant_candidate")
    rows = table(spark, sf_dir, "lineitem").select(
        d.alias("distance_to_road_m"), flag(d <= 22).alias("coupling_eligible"), kind.alias("spatial_class"), F.when(F.col("l_tax") == 0.08, 31.0).otherwise(E.SEARCH_M).alias("mapping_tolerance_m"),
        F.lit(E.COUPLING_M).alias("coupling_threshold_m"),
    )
    return shown(checks.inlet_flags(rows))


# --- V19: balances ---

BALANCE_SQL = """WITH b AS (SELECT l_linenumber AS k, sum(l_quantity) AS g, sum(l_quantity) FILTER (l_returnflag = 'R') AS c, sum(l_quantity) FILTER (l_returnflag <> 'R') AS e,
  sum(l_quantity) FILTER (l_returnflag = 'R' AND l_linestatus = 'F') AS x, sum(l_quantity) FILTER (l_returnflag = 'R' AND l_linestatus <> 'F') + (l_linenumber = 3)::INT AS o FROM lineitem GROUP BY 1)"""


@query(metrics_sql(BALANCE_SQL, "b", [
    ("intervals", "count(*)", SOME), ("surface_balance", "count(*) FILTER (abs(g - c - e) > greatest(0.05, g * 1e-8))", NONE),
    ("drainage_balance", "count(*) FILTER (abs(c + 2 * (k = 5)::INT - x - o) > greatest(0.05, c * 1e-8))", NONE), ("captured_is_input", "count(*) FILTER (k = 5)", NONE),
]))
def v19_balance(spark, sf_dir):
    """Lines as water: returned ones are captured, finished ones of these leave; the third interval gains a cubic metre, the fifth takes in two more."""
    q, back, done = F.col("l_quantity"), F.col("l_returnflag") == "R", F.col("l_linestatus") == "F"
    part = table(spark, sf_dir, "lineitem").groupBy(F.col("l_linenumber").alias("interval_id")).agg(
        F.sum(q).alias("generated_surface_volume_m3"), F.sum(F.when(back, q)).alias("captured_to_drain_volume_m3"), F.sum(F.when(~back, q)).alias("surface_export_volume_m3"),
        F.sum(F.when(back & done, q)).alias("drainage_export_volume_m3"), F.sum(F.when(back & ~done, q)).alias("o"),
    )
    over, taken = F.col("o") + flag(F.col("interval_id") == 3), F.col("captured_to_drain_volume_m3") + 2 * flag(F.col("interval_id") == 5)
    return shown(checks.balance(part.withColumn("drainage_overflow_volume_m3", over).withColumn("drainage_input_volume_m3", taken)))


# --- V20, V21: flood depths ---


@query(metrics_sql(f"WITH {SPREAD_SQL}, m AS (SELECT abs((SELECT sum(volume) FROM depth) - (SELECT sum(volume) FROM sources)) <= greatest(0.01, (SELECT sum(volume) FROM sources) * 1e-6) AS closed)", "depth, m", [
    ("negative", "count(*) FILTER (volume < 0)", NONE), ("not_finite", "count(*) FILTER (NOT isfinite(volume))", NONE), ("max", "max(volume / 900)", ""),
    *[(f"p{n}", f"quantile_cont(volume / 900, {n / 100})", "") for n in (50, 90, 95, 99)], ("volume_lost", "(NOT any_value(closed))::INT", NONE),
]))
def v20_flood_depth(spark, sf_dir):
    depth = materialize(spilled(spark, sf_dir).select(F.lit("all").alias("interval_id"), "row", "col", (F.col("volume") / 900).alias("depth_m")), "depth")
    over = spill_sources(grid.grid_from_parts(spark, sf_dir)).select(F.lit("all").alias("interval_id"), "volume")
    return shown(checks.flood_depth(depth, over, 900.0))


@query(metrics_sql(f"""WITH {SPREAD_SQL}, hot AS (SELECT row, col FROM depth ORDER BY volume DESC, row, col LIMIT 1),
near_hot AS (SELECT hot.row AS r, hot.col AS c, g.z, d.volume / 900 AS d, s.volume AS v FROM hot CROSS JOIN disc JOIN grid g ON g.row = hot.row + dr AND g.col = hot.col + dc
  LEFT JOIN depth d ON d.row = g.row AND d.col = g.col LEFT JOIN sources s ON s.cell = g.cell)""", "near_hot", [
    ("row", "max(r)", ""), ("col", "max(c)", ""), ("cells", "count(*)", ""), ("z_min", "min(z)", ""), ("z_median", "median(z)", ""), ("z_max", "max(z)", ""),
    ("depth_max", "max(d)", ""), ("depth_median", "median(d)", ""), ("overflow", "sum(v)", ""), ("sources", "count(*) FILTER (v > 0)", ""),
]))
def v21_hotspot(spark, sf_dir):
    cells = grid.grid_from_parts(spark, sf_dir)
    depth = materialize(spilled(spark, sf_dir).select("row", "col", (F.col("volume") / 900).alias("depth_m")), "depth")
    return shown(checks.hotspot(depth, cells, spill_sources(cells).select("row", "col", "volume")))

