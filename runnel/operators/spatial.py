"""Spatial joins as equi-joins on tiles, and the mapping of inlets to cells."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from runnel.functions import geo as G
from runnel.operators import grid
from runnel.staging import discard, materialize, new_path


#: Segments that the tile of a typical point should meet in the first round, and tiles that a segment of mean extent spans at most there.
MATES, MOST_SPAN = 32, 16


def nearest_segment(points: DataFrame, segments: DataFrame, reach: float, point: str = "id", segment: str = "sid", apart: bool = False) -> DataFrame:
    """(point, segment, distance): each point's nearest segment up to ``reach`` away, the smaller id among equals.

    points: id, x, y; segments: sid, ax, ay, bx, by. Rounds look farther and farther, the last one up
    to ``reach``: segments are dealt to the tiles within the round's distance of them, a point has one tile, and what is
    found there within that distance is the nearest; only points without such a segment go on. The first distance follows
    from how densely segments lie, so a point does not meet all that are in reach. The least distance and the least id
    at it are aggregates of numbers, which are not sorted. Points without a segment in reach have no row. With
    ``apart`` a segment of the point's own id does not count; of equal segments the two smallest ids can count.
    """
    ends = ["ax", "ay", "bx", "by"]
    finite = [F.abs(F.col(c)) < float("inf") for c in ends]  # not null, not NaN
    usable = segments.select(segment, *[(F.col(c).cast("double") + 0.0).alias(c) for c in ends]).filter(reduce(Column.__and__, finite))
    copies = W.partitionBy(*ends).orderBy(segment)
    usable = usable.withColumn("_copy", F.dense_rank().over(copies)).filter(F.col("_copy") <= (2 if apart else 1)).drop("_copy")
    usable = materialize(usable, "segments")
    left_path, found = new_path(points.sparkSession, "points"), []
    left = materialize(points.select(point, "x", "y").filter("abs(x) < double('inf') and abs(y) < double('inf')"), "points", left_path)
    for side in _distances(left, usable, reach):
        dealt = within_tiles(usable, side)
        least = _met(left, dealt, side, point, segment, apart).groupBy(point).agg(F.min("distance").alias("_least"))
        least = materialize(left.join(least, point), "least")
        best = _met(least, dealt, side, point, segment, apart).filter(F.col("distance") == F.col("_least"))
        found.append(materialize(best.groupBy(point).agg(F.min(segment).alias(segment), F.min("distance").alias("distance")), "nearest"))
        if side < reach:
            old, left_path = left_path, new_path(points.sparkSession, "points")
            left = materialize(left.join(found[-1].select(point), point, "left_anti"), "points", left_path)
            discard(points.sparkSession, old)
            if left.isEmpty():
                break
    return reduce(DataFrame.union, found)


def _met(points: DataFrame, dealt: DataFrame, side: float, point: str, segment: str, apart: bool) -> DataFrame:
    """Pairs of points and segments up to ``side`` away from each other, with their distance."""
    at = points.withColumn("tx", F.floor(F.col("x") / side)).withColumn("ty", F.floor(F.col("y") / side))
    pairs = at.join(dealt.hint("merge"), ["tx", "ty"])  # both are large where a broadcast would still take one
    pairs = pairs.filter(F.col(point) != F.col(segment)) if apart else pairs
    d = G.segment_distance(*[F.col(c) for c in ("x", "y", "ax", "ay", "bx", "by")])
    return pairs.withColumn("distance", d).filter(F.col("distance") <= side)


def within_tiles(segments: DataFrame, side: float) -> DataFrame:
    """Each segment once for every tile (tx, ty) of that side which may hold a point up to ``side`` away from it.

    In a column of tiles these are the tiles beside the piece that is near the column, so a slanted segment does not fill its box.
    """
    wide = side * 1.001  # rounding loses no tile
    low, high = F.least("ax", "bx"), F.greatest("ax", "bx")
    columns = segments.withColumn("tx", F.explode(F.sequence(F.floor((low - wide) / side), F.floor((high + wide) / side))))
    dx, dy = F.col("bx") - F.col("ax"), F.col("by") - F.col("ay")

    def y_at(x: Column, end: str) -> Column:
        t = F.least(F.greatest(F.try_divide(x - F.col("ax"), dx), F.lit(0.0)), F.lit(1.0))
        return F.when(dx == 0, F.col(end)).otherwise(F.col("ay") + dy * t)

    y0, y1 = y_at(F.col("tx") * side - wide, "ay"), y_at((F.col("tx") + 1) * side + wide, "by")
    rows = F.sequence(F.floor((F.least(y0, y1) - wide) / side), F.floor((F.greatest(y0, y1) + wide) / side))
    return columns.withColumn("ty", F.explode(rows))


def _distances(points: DataFrame, segments: DataFrame, reach: float) -> list[float]:
    """Distances of the rounds, each a quarter of the next one, ``reach`` last.

    The first is about the one at which the tile of a typical point meets MATES segments: they are counted by their first ends
    in squares of ``reach``, and a segment counts for as many tiles as it is dealt to.
    """
    squares = [F.floor(F.col(c) / reach) for c in ("x", "y")]
    near = points.groupBy(squares[0].alias("tx"), squares[1].alias("ty")).agg(F.count(F.lit(1)).alias("p"))
    squares = [F.floor(F.col(c) / reach) for c in ("ax", "ay")]
    starts = segments.groupBy(squares[0].alias("tx"), squares[1].alias("ty")).agg(F.count(F.lit(1)).alias("s"))
    typical = near.join(starts, ["tx", "ty"]).agg((F.sum(F.col("p") * F.col("s").cast("double")) / F.sum("p")).alias("s"))
    extent = segments.agg(F.avg(F.abs(F.col("bx") - F.col("ax")) + F.abs(F.col("by") - F.col("ay"))).alias("l"))
    dense, long = typical.crossJoin(extent).first()
    sides = [reach]
    while dense:
        side = sides[0] / 4
        if side * MOST_SPAN < (long or 0.0) or dense * (side / reach) ** 2 * 3 * (3 + (long or 0.0) / side) < MATES:
            break
        sides.insert(0, side)
    return sides


# What can become of an inlet.
MAPPING_STATUS = ("mapped", "excluded_outside_runoff_aoi", "excluded_outside_grid", "excluded_invalid_geometry", "excluded_same_30m_cell")


def map_inlets(inlets: DataFrame, cells: DataFrame, meta: dict, width: Column, height: Column, ties: list[str]) -> DataFrame:
    """Inlets (x, y, ...) with surface_row, surface_col, surface_mapping_selected and surface_mapping_status.

    A cell takes one inlet: the one nearest to its centre, then the first by ``ties``. All inlets stay in the audit.
    """
    row, col = grid.cell_of(F.col("x"), F.col("y"), meta)
    at = inlets.withColumn("_r", row).withColumn("_c", col).withColumn("_in", grid.in_bounds(F.col("_r"), F.col("_c"), width, height))
    known = cells.select(F.col("row").alias("_r"), F.col("col").alias("_c"), F.lit(True).alias("_cell"))
    at = at.join(known, ["_r", "_c"], "left")
    cx, cy = grid.centre_of(F.col("_r"), F.col("_c"), meta)
    status = (
        F.when(F.col("x").isNull() | F.col("y").isNull(), "excluded_invalid_geometry")
        .when(~F.col("_in"), "excluded_outside_grid")
        .when(F.col("_cell").isNull(), "excluded_outside_runoff_aoi")
        .otherwise("candidate")
    )
    d = F.sqrt((F.col("x") - cx) * (F.col("x") - cx) + (F.col("y") - cy) * (F.col("y") - cy))
    at = at.withColumn("_s", status).withColumn("_k", F.struct(d.alias("d"), *ties))
    winners = at.filter("_s = 'candidate'").groupBy("_r", "_c").agg(F.min("_k").alias("_w"))
    out = at.join(winners, ["_r", "_c"], "left")
    won = F.col("_k") == F.col("_w")
    final = F.when(F.col("_s") != "candidate", F.col("_s")).when(won, "mapped").otherwise("excluded_same_30m_cell")
    placed = F.coalesce(F.col("_in"), F.lit(False))
    return out.select(
        *inlets.columns, F.when(placed, F.col("_r")).otherwise(-1).alias("surface_row"), F.when(placed, F.col("_c")).otherwise(-1).alias("surface_col"),
        (final == "mapped").cast("int").alias("surface_mapping_selected"), final.alias("surface_mapping_status"),
    )
