"""Grid operators. A grid is a frame of valid cells (row, col, ...); what a raster calls nodata has no row."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from runnel.functions import exprs as E
from runnel.functions import geo as G

# Direction codes and their steps (row, col).
DIRECTIONS = {1: (-1, 1), 2: (-1, 0), 3: (-1, -1), 4: (0, -1), 5: (1, -1), 6: (1, 0), 7: (1, 1), 8: (0, 1)}


def cell_of(x: Column, y: Column, meta: dict) -> tuple[Column, Column]:
    """Row and column of the cell that holds a point; meta has x0, y0 (top left), dx, dy."""
    row = F.floor((F.lit(meta["y0"]) - y) / abs(meta["dy"]))
    col = F.floor((x - F.lit(meta["x0"])) / meta["dx"])
    return row.cast("int"), col.cast("int")


def centre_of(row: Column, col: Column, meta: dict) -> tuple[Column, Column]:
    return F.lit(meta["x0"]) + (col + 0.5) * meta["dx"], F.lit(meta["y0"]) - (row + 0.5) * abs(meta["dy"])


def in_bounds(row: Column, col: Column, width: int, height: int) -> Column:
    return (row >= 0) & (row < height) & (col >= 0) & (col < width)


def assert_aligned(a: dict, b: dict, tolerance: float = 1e-5) -> None:
    """Same reference system and size, near-equal transform; else ValueError."""
    for key in ("srid", "width", "height"):
        if a[key] != b[key]:
            raise ValueError(f"grids differ in {key}: {a[key]} and {b[key]}")
    for key in ("x0", "y0", "dx", "dy"):
        if abs(a[key] - b[key]) > tolerance:
            raise ValueError(f"grids differ in {key}: {a[key]} and {b[key]}")


def valid_cells(cells: DataFrame, value: str, nodata: float = E.NODATA) -> DataFrame:
    return cells.filter(E.valid(F.col(value), nodata))


def mask_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Cells that only one of the grids has; no rows where the masks are equal."""
    key = ["row", "col"]
    only_a = a.select(key).join(b.select(key), key, "left_anti").withColumn("only_in", F.lit("a"))
    return only_a.unionByName(b.select(key).join(a.select(key), key, "left_anti").withColumn("only_in", F.lit("b")))


def steps(offsets: list[tuple]) -> Column:
    """A literal array of (dr, dc) structs; its size is fixed by the neighbourhood, not by data."""
    return F.array(*[F.struct(F.lit(r).alias("dr"), F.lit(c).alias("dc")) for r, c in offsets])


def disc(radius: int) -> list[tuple[int, int]]:
    """Offsets of the cells whose centres lie within ``radius`` cells."""
    span = range(-radius, radius + 1)
    return [(r, c) for r in span for c in span if r * r + c * c <= radius * radius]


def neighbourhood(sources: DataFrame, cells: DataFrame, offsets: list[tuple[int, int]]) -> DataFrame:
    """Source rows once for each offset, with the cell found there (inner equi-join on row and col).

    Cell columns get the prefix ``n_``; ``dr`` and ``dc`` are kept. A band join by distance becomes an equi-join, so
    it shuffles on (row, col) like any other.
    """
    moved = sources.withColumn("_o", F.explode(steps(offsets)))
    moved = moved.withColumn("dr", F.col("_o.dr")).withColumn("dc", F.col("_o.dc")).drop("_o")
    moved = moved.withColumn("n_row", F.col("row") + F.col("dr")).withColumn("n_col", F.col("col") + F.col("dc"))
    near = cells.select(*[F.col(c).alias(f"n_{c}") for c in cells.columns])
    return moved.join(near, ["n_row", "n_col"])


def downstream_by_code(cells: DataFrame, code: str = "direction", strict: bool = True) -> DataFrame:
    """down_row, down_col from direction codes, null where the step leaves the grid.

    Bad codes fail the job if ``strict``, else the cell gets ``bad_code`` and no downstream cell.
    """
    c = F.col(code)
    dr = reduce(lambda out, k: out.when(c == k, DIRECTIONS[k][0]), list(DIRECTIONS)[1:], F.when(c == 1, DIRECTIONS[1][0]))
    dc = reduce(lambda out, k: out.when(c == k, DIRECTIONS[k][1]), list(DIRECTIONS)[1:], F.when(c == 1, DIRECTIONS[1][1]))
    if strict:
        dr = F.when(dr.isNull(), F.raise_error(F.concat(F.lit("bad direction code "), F.coalesce(c.cast("string"), F.lit("null"))))).otherwise(dr)
    moved = cells.withColumn("_r", F.col("row") + dr).withColumn("_c", F.col("col") + dc)
    there = cells.select(F.col("row").alias("down_row"), F.col("col").alias("down_col"))
    out = moved.join(there, (F.col("_r") == F.col("down_row")) & (F.col("_c") == F.col("down_col")), "left")
    if not strict:
        out = out.withColumn("bad_code", F.col("_r").isNull())
    return out.drop("_r", "_c")


def steepest_neighbour(cells: DataFrame, key: str = "cell", z: str = "z") -> DataFrame:
    """Each cell with the neighbour that is lowest by (z, key), if that is lower than itself, as ``down``; else null."""
    around = [o for o in DIRECTIONS.values()]
    pairs = neighbourhood(cells.select("row", "col", key, z), cells.select("row", "col", key, z), around)
    lowest = pairs.groupBy(key, z).agg(F.min(F.struct(f"n_{z}", f"n_{key}", "dr", "dc")).alias("low"))
    falls = F.struct(F.col(f"low.n_{z}").alias("a"), F.col(f"low.n_{key}").alias("b")) < F.struct(F.col(z).alias("a"), F.col(key).alias("b"))
    down = lowest.filter(falls).select(key, F.col(f"low.n_{key}").alias("down"), F.col("low.dr").alias("dr"), F.col("low.dc").alias("dc"))
    return cells.join(down, key, "left")


def direction_code(dr: Column, dc: Column) -> Column:
    out = F.lit(None).cast("int")
    for code, (r, c) in DIRECTIONS.items():
        out = F.when((dr == r) & (dc == c), code).otherwise(out)
    return out


def sample_points(points: DataFrame, cells: DataFrame, meta: dict, value: str) -> DataFrame:
    """Points with the value of the cell they lie in; null outside the grid and on invalid cells."""
    row, col = cell_of(F.col("x"), F.col("y"), meta)
    at = points.withColumn("row", row).withColumn("col", col)
    return at.join(cells.select("row", "col", value), ["row", "col"], "left")


def points_to_cells(points: DataFrame, meta: dict, value: str) -> DataFrame:
    """Point values added up per cell."""
    row, col = cell_of(F.col("x"), F.col("y"), meta)
    return points.groupBy(row.alias("row"), col.alias("col")).agg(F.sum(value).alias(value))


def overlay(cells: DataFrame, layers: list[tuple[DataFrame, float]], default: float, name: str = "coefficient") -> DataFrame:
    """Each cell's value by priority: of the layers (cells with row, col) that cover it, the last one wins.

    Layers are put together and brought to one row per cell before the join.
    """
    parts = [layer.select("row", "col", F.lit(i).alias("p"), F.lit(v).alias("v")) for i, (layer, v) in enumerate(layers)]
    covered = reduce(DataFrame.unionByName, parts).groupBy("row", "col").agg(F.max(F.struct("p", "v")).alias("top"))
    out = cells.join(covered, ["row", "col"], "left")
    return out.withColumn(name, F.coalesce("top.v", F.lit(default))).drop("top")


def cells_in_polygons(cells: DataFrame, polygons: DataFrame, meta: dict) -> DataFrame:
    """Cells whose centre is inside one of the polygons (column geometry), each once.

    A polygon is cut at the centres of the rows that it spans within the bounds of ``cells``; in a row, the centres between
    its first and last crossing are inside where the edges east of them are odd in number. Work grows with the cells that
    polygons cover, and their edges by rows, not with pairs of cells and polygons.
    """
    extent = cells.agg(*[f(c).alias(f"{k}_{c}") for k, f in (("low", F.min), ("high", F.max)) for c in ("row", "col")])  # one row
    box = G.bounds(F.col("geometry"))
    r1, c0 = cell_of(box["min_x"], box["min_y"], meta)
    r0, c1 = cell_of(box["max_x"], box["max_y"], meta)
    dealt = polygons.select("geometry", r0.alias("r0"), r1.alias("r1"), c0.alias("c0"), c1.alias("c1")).crossJoin(F.broadcast(extent))
    dealt = dealt.select("geometry", *[F.greatest(f"{k}0", f"low_{c}").alias(f"{k}0") for k, c in (("r", "row"), ("c", "col"))], *[F.least(f"{k}1", f"high_{c}").alias(f"{k}1") for k, c in (("r", "row"), ("c", "col"))])
    dealt = dealt.filter("r0 <= r1 and c0 <= c1").select("geometry", "c0", "c1", F.explode(F.sequence("r0", "r1")).alias("row"))
    _, y = centre_of(F.col("row"), F.col("c0"), meta)
    at = dealt.select("row", "c0", "c1", G.crossings(y, F.col("geometry")).alias("xs"))

    def column(x: Column) -> Column:
        return cell_of(x, F.lit(meta["y0"]), meta)[1]

    west, east = (column(F.array_min("xs")), column(F.array_max("xs"))) if meta["dx"] > 0 else (column(F.array_max("xs")), column(F.array_min("xs")))
    at = at.select("row", "xs", F.greatest("c0", west - 1).alias("c0"), F.least("c1", east + 1).alias("c1")).filter("size(xs) > 0 and c0 <= c1")
    at = at.select("row", "xs", F.explode(F.sequence("c0", "c1")).alias("col"))
    x, _ = centre_of(F.col("row"), F.col("col"), meta)
    inside = at.withColumn("x", x).filter(F.size(F.filter("xs", lambda c: c > F.col("x"))) % 2 == 1)
    return cells.select("row", "col").join(inside.select("row", "col"), ["row", "col"], "left_semi").distinct()


def cells_on_lines(lines: DataFrame, meta: dict) -> DataFrame:
    """All cells that lines (column geometry) touch, each once.

    Cells are dealt out before equal ones are put together: a task would else hold all cells of its lines, which are many in a small file.
    """
    part = lines.select(F.explode("geometry.parts").alias("part"))
    touched = G.touched_cells(F.col("part"), meta["x0"], meta["y0"], meta["dx"], abs(meta["dy"]))
    return part.select(F.explode(touched).alias("cell")).select("cell.row", "cell.col").repartition("row", "col").distinct()


def spread(sources: DataFrame, cells: DataFrame, radius: int = 5, z: str = "z", volume: str = "volume") -> DataFrame:
    """Volume of each source dealt over the valid cells of its disc, by terrain and distance; summed per cell.

    weight = exp(-(z - zmin) / 2) * exp(-d / 3) with zmin the lowest cell of the disc, normed to 1 for each source.
    """
    near = neighbourhood(sources.select("row", "col", volume), cells.select("row", "col", z), disc(radius))
    source = W.partitionBy("row", "col")
    d = F.sqrt((F.col("dr") * F.col("dr") + F.col("dc") * F.col("dc")).cast("double"))
    w = near.withColumn("zmin", F.min(f"n_{z}").over(source)).withColumn("w", E.decay_weight(F.col(f"n_{z}"), F.col("zmin"), d))
    part = w.withColumn("part", F.col(volume) * F.col("w") / F.sum("w").over(source))
    return part.groupBy(F.col("n_row").alias("row"), F.col("n_col").alias("col")).agg(F.sum("part").alias(volume))


def hottest(cells: DataFrame, value: str) -> DataFrame:
    """The cell of the largest value, the first in row-major order among equals: one row."""
    return cells.agg(F.max_by(F.struct("row", "col", value), F.struct(F.col(value), -F.col("row"), -F.col("col"))).alias("m")).select("m.*")


def grid_from_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The surrogate grid: cell, row, col, z and volume of every part, laid out in a square."""
    part = spark.read.parquet(f"{sf_dir}/part.parquet").select("p_partkey", "p_size")
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.sum("l_quantity").alias("volume"))
    width = part.agg(F.ceil(F.sqrt(F.count(F.lit(1)))).cast("long").alias("w"))
    at = part.crossJoin(F.broadcast(width)).join(lines, "p_partkey", "left")
    row, col = (F.col("p_partkey") / F.col("w")), F.col("p_partkey") % F.col("w")
    return at.select(
        F.col("p_partkey").alias("cell"),
        F.floor(row).cast("int").alias("row"),
        col.cast("int").alias("col"),
        (30 * F.floor(row) + F.col("p_size")).cast("double").alias("z"),
        F.coalesce("volume", F.lit(0.0)).alias("volume"),
    )
