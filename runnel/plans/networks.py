"""Network queries whose rounds do not grow with the network's edges in a row: strong components, what drains through a node, routes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runnel.operators import blocks, reach
from runnel.plans.gridded import DOWN_SQL, INLET_SIZE, REACH_SQL, cells_with_down
from runnel.plans.relational import query, table
from runnel.plans.terrain import SURFACE_SQL, surface
from runnel.staging import materialize


@query("""WITH RECURSIVE e AS (SELECT DISTINCT a.l_partkey AS src, b.l_partkey AS dst FROM lineitem a JOIN lineitem b ON b.l_orderkey = a.l_orderkey AND b.l_linenumber = a.l_linenumber + 1
  JOIN part p ON p.p_partkey = a.l_partkey JOIN part q ON q.p_partkey = b.l_partkey WHERE abs(p.p_size - q.p_size) <= 1),
reaches(a, b) AS (SELECT src, dst FROM e UNION SELECT r.a, e.dst FROM reaches r JOIN e ON e.src = r.b),
mutual AS (SELECT r.a AS id, r.b AS other FROM reaches r JOIN reaches s ON s.a = r.b AND s.b = r.a UNION SELECT src, src FROM e UNION SELECT dst, dst FROM e)
SELECT id, min(other) AS component, count(*) AS size, count(*) > 1 OR EXISTS (SELECT 1 FROM e WHERE src = id AND dst = id) AS cyclic FROM mutual GROUP BY id""")
def strong_components(spark, sf_dir):
    """Of parts of about one size, each pointing to the part of the order's next line."""
    line = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    after = line.select("l_orderkey", (F.col("l_linenumber") - 1).alias("l_linenumber"), F.col("l_partkey").alias("dst"))
    size = table(spark, sf_dir, "part").select("p_partkey", "p_size")
    pairs = line.join(after, ["l_orderkey", "l_linenumber"]).select(F.col("l_partkey").alias("src"), "dst")
    for end in ("src", "dst"):
        pairs = pairs.join(size.select(F.col("p_partkey").alias(end), F.col("p_size").alias(f"size_{end}")), end)
    return reach.strong_components(pairs.filter(F.abs(F.col("size_src") - F.col("size_dst")) <= 1).select("src", "dst"))


@query(f"""WITH RECURSIVE {DOWN_SQL}, {REACH_SQL} SELECT r.cell, count(*) AS cells, sum(g.volume)::DOUBLE AS volume
FROM reach r JOIN grid g ON g.cell = r.up JOIN grid i ON i.cell = r.cell WHERE i.p_size <= {INLET_SIZE} GROUP BY r.cell""")
def drains_to_inlets(spark, sf_dir):
    """How many cells drain through each inlet, and their volume, by intervals of a tour of the forest."""
    cells = cells_with_down(spark, sf_dir)
    intervals = materialize(reach.tree_intervals(cells.select(F.col("cell").alias("id"), "down")), "intervals")
    inlets = cells.filter(F.col("z") - 30 * F.col("row") <= INLET_SIZE).select(F.col("cell").alias("id"))
    through = reach.drains_through(intervals, inlets).join(cells.select(F.col("cell").alias("id"), "volume"), "id")
    return through.groupBy(F.col("of").alias("cell")).agg(F.count(F.lit(1)).alias("cells"), F.sum("volume").cast("double").alias("volume"))


STREETS_SQL = f"""{SURFACE_SQL},
street AS (SELECT a.cell AS a, b.cell AS b, sqrt(1 + (a.cell * 7919 + b.cell * 104729) % 1000) AS w FROM surface a JOIN surface b ON (b.row = a.row AND b.col = a.col + 1) OR (b.row = a.row + 1 AND b.col = a.col)),
hop AS (SELECT a, b, w FROM street UNION ALL SELECT b, a, w FROM street),
best(cell, d) USING KEY (cell) AS (
  SELECT min(cell), 0::DOUBLE FROM surface
  UNION
  SELECT h.b, min(f.d + h.w) FROM best f JOIN hop h ON h.a = f.cell LEFT JOIN recurring.best old ON old.cell = h.b WHERE old.cell IS NULL OR f.d + h.w < old.d GROUP BY h.b)"""


def streets(spark, sf_dir) -> DataFrame:
    """A street between each two cells beside each other, of lengths that hardly ever tie."""
    cells = surface(spark, sf_dir).join(table(spark, sf_dir, "part").agg(F.ceil(F.sqrt(F.count(F.lit(1)))).cast("long").alias("w")), how="cross")  # one row
    cells = cells.select("row", "col", (F.col("row") * F.col("w") + F.col("col")).alias("cell"))
    steps = F.array(*[F.struct(F.lit(r).alias("r"), F.lit(c).alias("c")) for r, c in ((0, 1), (1, 0))])
    moved = cells.select(F.col("cell").alias("src"), "row", "col", F.explode(steps).alias("s")).select("src", (F.col("row") + F.col("s.r")).alias("row"), (F.col("col") + F.col("s.c")).alias("col"))
    pairs = moved.join(cells.withColumnRenamed("cell", "dst"), ["row", "col"])
    return pairs.select("src", "dst", F.sqrt((1 + (F.col("src") * 7919 + F.col("dst") * 104729) % 1000).cast("double")).alias("weight"))


@query(f"""WITH RECURSIVE {STREETS_SQL} SELECT cell AS id, round(d, 6) AS distance FROM best""")
def street_distances(spark, sf_dir):
    """From the first cell to all others."""
    parted = blocks.blocks_of(streets(spark, sf_dir))
    return blocks.distances(parted, parted.agg(F.min("a")).first()[0]).select("id", F.round("distance", 6).alias("distance"))


@query(f"""WITH RECURSIVE {STREETS_SQL},
way(cell, d, k) AS (
  SELECT max_by(cell, d), max(d), 0 FROM best
  UNION ALL
  SELECT arg_min(h.b, f.d + h.w), arg_min(f.d, f.d + h.w), any_value(k) + 1 FROM way y JOIN hop h ON h.a = y.cell JOIN best f ON f.cell = h.b WHERE y.d > 0 GROUP BY y.cell)
SELECT (max(k) OVER () - k)::BIGINT AS step, cell AS id, round(d, 6) AS distance FROM way""")
def street_route(spark, sf_dir):
    """Node by node from the first cell to the one that is farthest from it."""
    parted = blocks.blocks_of(streets(spark, sf_dir))
    found = blocks.distances(parted, parted.agg(F.min("a")).first()[0])
    last = found.agg(F.max_by("id", "distance")).first()[0]
    return blocks.route(found, last).select("step", "id", F.round("distance", 6).alias("distance"))
