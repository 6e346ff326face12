"""Resampling of a grid to another reference system: target cells gather source cells by equi-joins on (row, col)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runnel.operators.grid import cell_of, centre_of

#: Least share of the weights that must lie on cells that have a value.
LEAST_WEIGHT = 0.5


def warp(
    target: DataFrame, source: DataFrame, value: str, target_meta: dict, source_meta: dict, to_source: Callable[[Column, Column], tuple[Column, Column]],
    method: str = "nearest",
) -> DataFrame:
    """row, col and ``value`` of each target cell (row, col), taken where its centre lies in the source grid.

    ``to_source`` gives the source coordinates of a point of the target system; metas have x0, y0 (top left), dx, dy.
    ``nearest`` takes the cell that holds the point. ``bilinear`` weighs the four cells around it; of those without a value the
    others bear the weight, if they have LEAST_WEIGHT of it. Without a value, or outside the source, the
    result is null. Every target row comes once; a target cell has one row.
    """
    x, y = to_source(*centre_of(F.col("row"), F.col("col"), target_meta))
    at = target.select("row", "col", x.alias("_x"), y.alias("_y"))
    known = source.filter(F.col(value).isNotNull()).select(F.col("row").alias("_r"), F.col("col").alias("_c"), F.col(value).alias(value))
    if method == "nearest":
        r, c = cell_of(F.col("_x"), F.col("_y"), source_meta)
        return at.withColumn("_r", r).withColumn("_c", c).join(known, ["_r", "_c"], "left").select("row", "col", value)
    if method != "bilinear":
        raise ValueError(f"unknown method {method}")
    u = (F.col("_x") - F.lit(source_meta["x0"])) / source_meta["dx"] - 0.5
    v = (F.lit(source_meta["y0"]) - F.col("_y")) / abs(source_meta["dy"]) - 0.5
    at = at.select("row", "col", F.floor(u).cast("int").alias("_c"), F.floor(v).cast("int").alias("_r"), (u - F.floor(u)).alias("_u"), (v - F.floor(v)).alias("_v"))
    corners = F.array(*[
        F.struct(
            (F.col("_r") + dr).alias("r"), (F.col("_c") + dc).alias("c"),
            ((F.col("_v") if dr else 1 - F.col("_v")) * (F.col("_u") if dc else 1 - F.col("_u"))).alias("w"),
        )
        for dr in (0, 1) for dc in (0, 1)
    ])
    near = at.select("row", "col", F.explode(corners).alias("k")).select("row", "col", F.col("k.r").alias("_r"), F.col("k.c").alias("_c"), F.col("k.w").alias("_w"))
    got = near.join(known, ["_r", "_c"], "left")
    weight = F.when(F.col(value).isNotNull(), F.col("_w"))
    sums = got.groupBy("row", "col").agg(F.sum(weight).alias("_w"), F.sum(weight * F.col(value)).alias("_s"))
    return sums.select("row", "col", F.when(F.col("_w") >= LEAST_WEIGHT, F.col("_s") / F.col("_w")).alias(value))

