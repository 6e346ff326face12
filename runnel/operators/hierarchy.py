"""Shortest routes over a contraction hierarchy, in rounds that do not grow with the edges of a route.

Nodes of few neighbours are contracted, in rounds: of those with at most MOST_DEGREE neighbours the ones that come before all such
neighbours of theirs (by degree, then by a digest) leave together, and each pair of a node's neighbours gets a shortcut over it
unless a shorter edge is there. Chains go first, in log2 of their length rounds, then what is left of them. What has more
neighbours is the core. A search goes up from the source round by round, over the core by relaxing, and down again
round by round; every round is one join with that round's edges. A route is unpacked by replacing shortcuts by
the two edges they stand for, all at once, as often as shortcuts are nested.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runnel.operators.graph import flow_path
from runnel.staging import materialize

#: Neighbours of a node that is contracted; it adds half the square of them at most.
MOST_DEGREE = 4


@dataclass(frozen=True)
class Hierarchy:
    levels: list[DataFrame]  # of each round v, h, w, via: the edges from a contracted node to nodes that stay
    core: DataFrame  # a, b, w, via in both directions
    nodes: DataFrame  # id


def _lightest(arcs: DataFrame) -> DataFrame:
    best = arcs.groupBy("a", "b").agg(F.min(F.struct("w", "via")).alias("m"))
    return best.select("a", "b", "m.w", "m.via")


def contract(edges: DataFrame) -> Hierarchy:
    """The hierarchy of an undirected graph: src, dst, weight, which is not negative; of parallel edges the lightest counts."""
    rows = edges.filter("src is not null and dst is not null").select("src", "dst", F.col("weight").cast("double").alias("w"))
    rows = materialize(rows, "weighted")
    if not rows.filter("w is null or isnan(w) or w < 0").isEmpty():
        raise ValueError("weights must be numbers from 0 on")
    nodes = materialize(rows.select(F.explode(F.array("src", "dst")).alias("id")).distinct(), "nodes")
    kind = dict(rows.dtypes)["src"]
    one = rows.filter("src <> dst").select(F.col("src").alias("a"), F.col("dst").alias("b"), "w", F.lit(None).cast(kind).alias("via"))
    arcs = materialize(_lightest(one.unionByName(one.select(F.col("b").alias("a"), F.col("a").alias("b"), "w", "via"))), "arcs")
    levels: list[DataFrame] = []
    while True:
        degree = arcs.groupBy(F.col("a").alias("v")).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") <= MOST_DEGREE)
        rank = materialize(degree.select("v", F.struct("n", F.xxhash64("v", F.lit(len(levels))).alias("x"), "v").alias("rank")), "ranks")
        if rank.isEmpty():
            return Hierarchy(levels, arcs, nodes)
        near = arcs.select("a", "b").join(rank.select(F.col("v").alias("b"), F.col("rank").alias("_r")), "b").groupBy(F.col("a").alias("v")).agg(F.min("_r").alias("_r"))
        goes = materialize(rank.join(near, "v", "left").filter("_r is null or rank < _r").select("v"), "contracted")
        level = materialize(arcs.withColumnRenamed("a", "v").join(goes, "v").select("v", F.col("b").alias("h"), "w", "via"), "level")
        levels.append(level)
        other = level.select("v", F.col("h").alias("b"), F.col("w").alias("_w"))
        over = level.select("v", F.col("h").alias("a"), "w").join(other, "v").filter("a <> b")
        over = over.select("a", "b", (F.col("w") + F.col("_w")).alias("w"), F.col("v").alias("via"))
        stay = arcs.join(goes.withColumnRenamed("v", "a"), "a", "left_anti").join(goes.withColumnRenamed("v", "b"), "b", "left_anti")
        arcs = materialize(_lightest(stay.select("a", "b", "w", "via").unionByName(over)), "arcs")


def _nearest(rows: DataFrame) -> DataFrame:
    best = rows.groupBy("id").agg(F.min(F.struct("distance", "previous", "via")).alias("m"))
    return best.select("id", "m.distance", "m.previous", "m.via")


def search(hierarchy: Hierarchy, source) -> DataFrame:
    """(id, distance, previous, via): from one node to all it reaches, previous being the node before it in the hierarchy.

    ``via`` is the node that a shortcut from previous stands for, null for an edge of the graph. No rows if source is no node.
    """
    kind = dict(hierarchy.nodes.dtypes)["id"]
    nothing = F.lit(None).cast(kind)
    known = hierarchy.nodes.filter(F.col("id") == F.lit(source).cast(kind)).select("id", F.lit(0.0).alias("distance"), nothing.alias("previous"), nothing.alias("via"))
    known = materialize(known, "known")
    for level in hierarchy.levels:
        up = level.join(known.select(F.col("id").alias("v"), "distance"), "v")
        offer = up.select(F.col("h").alias("id"), (F.col("distance") + F.col("w")).alias("distance"), F.col("v").alias("previous"), "via")
        known = materialize(_nearest(known.unionByName(offer)), "known")
    front = known
    while not front.isEmpty():
        over = hierarchy.core.join(front.select(F.col("id").alias("a"), "distance"), "a")
        offer = _nearest(over.select(F.col("b").alias("id"), (F.col("distance") + F.col("w")).alias("distance"), F.col("a").alias("previous"), "via"))
        old = known.select("id", F.col("distance").alias("_d"))
        front = materialize(offer.join(old, "id", "left").filter("_d is null or distance < _d").drop("_d"), "front")
        known = materialize(_nearest(known.unionByName(front)), "known")
    for level in reversed(hierarchy.levels):
        down = level.join(known.select(F.col("id").alias("h"), "distance"), "h")
        offer = down.select(F.col("v").alias("id"), (F.col("distance") + F.col("w")).alias("distance"), F.col("h").alias("previous"), "via")
        mine = known.join(level.select(F.col("v").alias("id")).distinct(), "id", "left_semi")
        rest = known.join(level.select(F.col("v").alias("id")).distinct(), "id", "left_anti")
        known = materialize(rest.unionByName(_nearest(mine.unionByName(offer))), "known")
    return known


def route(hierarchy: Hierarchy, source, target, found: DataFrame | None = None) -> DataFrame:
    """(step, id, distance) of the nodes of a shortest way from source to target, both included; no rows if there is none.

    found: the rows of ``search`` from source, if they are there already.
    """
    found = search(hierarchy, source) if found is None else found
    spark, kind = found.sparkSession, dict(found.dtypes)["id"]
    at_end = found.filter(F.col("id") == F.lit(target).cast(kind))
    if at_end.isEmpty():
        return spark.createDataFrame([], f"step long, id {kind}, distance double")
    back = flow_path(found, target, "id", "previous")
    last = back.agg(F.max("step")).first()[0]
    hops = found.filter("previous is not null").join(back, "id")
    # Places are texts: halves of a shortcut have their shortcut's place before their own.
    place = F.format_string("%019d", F.lit(last) - F.col("step"))
    edges = materialize(hops.select(place.alias("at"), F.col("previous").alias("a"), F.col("id").alias("b"), "via"), "hops")
    levels = [x.select("v", "h", F.col("via").alias("_via"), F.col("w").alias("_w")) for x in hierarchy.levels]
    while not edges.filter("via is not null").isEmpty():
        halves = F.array(F.struct(F.lit("0").alias("k"), F.col("a").alias("end")), F.struct(F.lit("1").alias("k"), F.col("b").alias("end")))
        open_ones = edges.filter("via is not null").select("at", "via", F.explode(halves).alias("half"))
        open_ones = open_ones.select(F.concat("at", "half.k").alias("at"), F.col("half.k").alias("k"), F.col("via").alias("v"), F.col("half.end").alias("h"))
        looked = reduce(DataFrame.unionByName, levels).join(open_ones, ["v", "h"])
        a, b = F.when(F.col("k") == "0", F.col("h")).otherwise(F.col("v")), F.when(F.col("k") == "0", F.col("v")).otherwise(F.col("h"))
        edges = materialize(edges.filter("via is null").unionByName(looked.select("at", a.alias("a"), b.alias("b"), F.col("_via").alias("via"))), "hops")
    # A node on the way has its place by the edge that ends in it; its distance is that of the search.
    steps = edges.select(F.col("b").alias("id"), "at").join(found.select("id", "distance"), "id")
    first = spark.range(1).select(F.lit(source).cast(kind).alias("id"), F.lit("").alias("at"), F.lit(0.0).alias("distance"))
    whole = materialize(first.unionByName(steps), "route")
    return _numbered(whole).select("step", "id", "distance")


def _numbered(rows: DataFrame) -> DataFrame:
    """``step`` from 0 in the order of ``at``: ranges are ordered each by itself."""
    bits = 33
    ranges = materialize(rows.repartitionByRange("at").sortWithinPartitions("at").withColumn("_row", F.monotonically_increasing_id()), "steps")
    part = F.shiftright("_row", bits)
    sizes = sorted(tuple(r) for r in ranges.groupBy(part.alias("p")).count().collect())  # a row for each range
    before, starts = 0, []
    for p, n in sizes:
        starts.append((p, before))
        before += n
    offsets = F.broadcast(rows.sparkSession.createDataFrame(starts, "_part long, _before long"))
    joined = ranges.withColumn("_part", part).join(offsets, "_part")
    return joined.withColumn("step", F.col("_before") + F.col("_row").bitwiseAND((1 << bits) - 1))
