"""Polygons and lines in the plane as tables of edges: validity, dissolving, buffers, clipping.

A feature is a row (id, geometry), the geometry a struct(type, parts); parts of a polygon are closed rings, and a point is inside
when it is inside an odd number of them. Edges that may meet are found by equi-joins on square tiles, and points are
told inside from outside by the edges in their band of y: no geometry is compared with all others, and no feature is
looped over in Python. Coordinates are doubles; predicates are evaluated in double arithmetic without a tolerance.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from runnel.functions import geo as G
from runnel.operators.graph import connected, roots
from runnel.staging import materialize

#: Tiles on a side of the whole extent at most, which bounds the number of tiles of one long edge.
MOST_TILES = 1 << 20
#: Edges of rings that one task follows.
BLOCK_EDGES = 100_000
EDGE = ("ax", "ay", "bx", "by")


def without_repeats(part: Column) -> Column:
    """A part without points that repeat the one before."""
    return F.filter(part, lambda p, i: (i == 0) | (p != F.element_at(part, F.greatest(i, F.lit(1)))))


def rings_of(features: DataFrame) -> DataFrame:
    """id, type, ring, part of every part of every geometry."""
    parts = features.filter("geometry is not null").select("id", F.col("geometry.type").alias("type"), F.posexplode("geometry.parts").alias("ring", "part"))
    return parts.withColumn("part", without_repeats(F.col("part")))


def edges_of(rings: DataFrame) -> DataFrame:
    """The edges of parts, numbered by i from 0 to n - 1, with all other columns."""
    rest = [c for c in rings.columns if c != "part"]
    cut = rings.select(*rest, F.posexplode(G.segments(F.col("part"))).alias("i", "_e"), F.greatest(F.size("part") - 1, F.lit(0)).alias("n"))
    return cut.select(*rest, "i", "n", *[F.col(f"_e.{c}").alias(c) for c in EDGE])


def tile_side(edges: DataFrame) -> float:
    """Twice the mean extent of an edge, bounded by the extent of all."""
    extent = F.greatest(F.abs(F.col("bx") - F.col("ax")), F.abs(F.col("by") - F.col("ay")))
    mean, span = edges.agg(F.avg(extent), F.max(F.greatest(*[F.abs(F.col(c)) for c in EDGE]))).first()
    return max(2 * (mean or 0), 2 * (span or 0) / MOST_TILES, 1e-9)


def _span(low: Column, high: Column, side: float) -> Column:
    return F.sequence(F.floor(low / side), F.floor(high / side))


def on_tiles(edges: DataFrame, side: float) -> DataFrame:
    """Each edge once for every tile (tx, ty) that it touches; a long one is cut at the columns of tiles, so its whole box is not filled."""
    wide = side * 1e-6  # rounding loses no tile
    low, high = F.least("ax", "bx"), F.greatest("ax", "bx")
    columns = edges.withColumn("tx", F.explode(_span(low - wide, high + wide, side)))
    dx, dy = F.col("bx") - F.col("ax"), F.col("by") - F.col("ay")

    def y_at(x: Column, end: str) -> Column:
        t = F.least(F.greatest(F.try_divide(x - F.col("ax"), dx), F.lit(0.0)), F.lit(1.0))
        return F.when(F.abs(dx) <= wide, F.col(end)).otherwise(F.col("ay") + dy * t)

    y0, y1 = y_at(F.col("tx") * side - wide, "ay"), y_at((F.col("tx") + 1) * side + wide, "by")
    return columns.withColumn("ty", F.explode(_span(F.least(y0, y1) - wide, F.greatest(y0, y1) + wide, side)))


def spread_out(rows: DataFrame, *keys: str) -> DataFrame:
    """The rows dealt to all cores: those of a small file, or few shuffled ones, would be blown up to edges in one task."""
    return rows.repartition(3 * rows.sparkSession.sparkContext.defaultParallelism, *keys)


def _edge(prefix: str = "") -> Column:
    return F.struct(*[F.col(prefix + c).alias(c) for c in EDGE])


def meetings(edges: DataFrame, others: DataFrame, side: float, keys: list[str] | None = None, apart: Column | None = None) -> DataFrame:
    """Pairs of edges that have a point in common, each once; the columns of ``others`` have the prefix o_.

    keys: columns in which both must be equal. apart: a condition on the pair, ``o_`` columns among them, before the geometry. Both
    sides have a column ``eid`` that tells their edges apart.
    """
    keys = keys or []
    far = on_tiles(others, side)
    far = far.select(*[F.col(c).alias(c if c in (*keys, "tx", "ty") else f"o_{c}") for c in far.columns])
    pairs = on_tiles(edges, side).join(far, [*keys, "tx", "ty"])
    pairs = pairs if apart is None else pairs.filter(apart)
    return pairs.filter(G.segments_meet(_edge(), _edge("o_"))).drop("tx", "ty").dropDuplicates(["eid", "o_eid"])


def inside(points: DataFrame, edges: DataFrame, side: float, keys: list[str], of: list[str], by: list[str]) -> DataFrame:
    """(of, by) for each point (of, x, y) that is inside an odd number of turns of the rings ``by`` of edges with equal ``keys``.

    A point only meets the edges in its band of y. On a ring's own edge the answer is open.
    """
    bands = edges.select(*dict.fromkeys([*keys, *by]), *EDGE, F.explode(_span(F.least("ay", "by"), F.greatest("ay", "by"), side)).alias("_band"))
    at = points.withColumn("_band", F.floor(F.col("y") / side))
    over = (F.col("ay") > F.col("y")) != (F.col("by") > F.col("y"))
    cross = F.col("ax") + F.try_divide((F.col("bx") - F.col("ax")) * (F.col("y") - F.col("ay")), F.col("by") - F.col("ay"))
    hits = at.join(bands, [*keys, "_band"]).filter(over & (F.col("x") < cross))
    names = list(dict.fromkeys([*of, *by]))
    return hits.groupBy(*names).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") % 2 == 1).select(*names)


# --- Crossing points and pieces ---------------------------------------------------------------------------------------


def _parameters(p: str, q: str) -> Column:
    """Where, from 0 to 1 along edge p, edge q meets it: one place, or two where they lie on one line."""
    px, py = F.col(f"{p}ax"), F.col(f"{p}ay")
    dx, dy = F.col(f"{p}bx") - px, F.col(f"{p}by") - py
    ex, ey = F.col(f"{q}bx") - F.col(f"{q}ax"), F.col(f"{q}by") - F.col(f"{q}ay")
    cross = dx * ey - dy * ex
    t = F.try_divide((F.col(f"{q}ax") - px) * ey - (F.col(f"{q}ay") - py) * ex, cross)
    along = [F.try_divide((F.col(f"{q}{e}x") - px) * dx + (F.col(f"{q}{e}y") - py) * dy, dx * dx + dy * dy) for e in "ab"]
    return F.when(cross != 0, F.array(t)).otherwise(F.array(*along))


def split(edges: DataFrame, met: DataFrame, digits: int | None) -> DataFrame:
    """The pieces of ``edges`` (eid, ...) between the points at which they meet others: number k, ends, and the middle's place ``at``.

    met: rows of ``meetings``. Points are rounded to ``digits`` decimals, if given, so that edges that cross in one point have it in common.
    """
    cuts = met.select("eid", F.explode(_parameters("", "o_")).alias("t")).filter("t > 0 and t < 1").groupBy("eid").agg(F.array_sort(F.collect_set("t")).alias("_cuts"))
    whole = edges.join(cuts, "eid", "left").withColumn("_t", F.concat(F.array(F.lit(0.0)), F.coalesce("_cuts", F.array().cast("array<double>")), F.array(F.lit(1.0))))

    def place(t: Column, c: str) -> Column:
        here = F.col("a" + c) + (F.col("b" + c) - F.col("a" + c)) * t
        here = here if digits is None else F.round(here, digits) + 0.0  # no negative zero
        return F.when(t == 0, F.col("a" + c)).when(t == 1, F.col("b" + c)).otherwise(here)

    n = F.size("_t") - 1
    ends = F.zip_with(
        F.slice("_t", F.lit(1), n), F.slice("_t", F.lit(2), n),
        lambda s, e: F.struct(*[place(u, c).alias(f"{k}{c}") for u, k in ((s, "a"), (e, "b")) for c in "xy"], ((s + e) / 2).alias("at")),
    )
    rest = [c for c in edges.columns if c not in EDGE]
    pieces = whole.select(*rest, F.posexplode(ends).alias("k", "_p")).select(*rest, "k", *[F.col(f"_p.{c}").alias(c) for c in (*EDGE, "at")])
    return pieces.filter((F.col("ax") != F.col("bx")) | (F.col("ay") != F.col("by")))


def _middle(rows: DataFrame) -> DataFrame:
    return rows.withColumn("x", (F.col("ax") + F.col("bx")) / 2).withColumn("y", (F.col("ay") + F.col("by")) / 2)


# --- Validity ---------------------------------------------------------------------------------------------------------


def polygon_faults(features: DataFrame) -> DataFrame:
    """id, fault: the faults of polygons (Polygon, MultiPolygon), each once; a valid one has no row.

    - ``coordinate``: null, NaN or infinite. ``open``: a ring whose last point is not its first. ``points``: a ring of fewer than
      three different points.
    - ``self``: edges of one ring meet elsewhere than in the point that consecutive edges share.
    - ``crossing``: two rings of a feature cross, or share a piece of an edge; they may touch in points.
    - ``hole``: a Polygon's second or later ring is not inside the first; ``nested``: it is inside another of them.

    Null geometries and empty ones have no faults here; ids must be unique. That holes which touch part the interior is not checked.
    """
    rings = rings_of(spread_out(features.filter(F.col("geometry.type").contains("Polygon")), "id"))
    finite = F.forall("part", lambda p: p.isNotNull() & p["x"].between(-1.7e308, 1.7e308) & p["y"].between(-1.7e308, 1.7e308))
    finite = F.coalesce(finite, F.lit(False))
    closed = F.coalesce(F.element_at("part", 1) == F.element_at("part", -1), F.lit(False))
    fault = F.when(~finite, "coordinate").when(F.size(F.array_distinct("part")) < 3, "points").when(~closed, "open")
    rings = materialize(rings.withColumn("fault", fault), "rings")
    simple = rings.filter("fault is not null").select("id", "fault")
    numbered = edges_of(rings.filter("fault is null").drop("fault")).withColumn("eid", F.struct("id", "ring", "i"))
    edges = materialize(numbered, "edges")
    side = tile_side(edges)
    met = materialize(meetings(edges, edges, side, ["id"], F.struct("ring", "i") < F.struct("o_ring", "o_i")), "meetings")

    own = F.col("ring") == F.col("o_ring")
    dx, dy, ox, oy = (F.col(f"{p}b{c}") - F.col(f"{p}a{c}") for p in ("", "o_") for c in "xy")
    one_line = dx * oy - dy * ox == 0
    follows = (F.col("o_i") == F.col("i") + 1) | ((F.col("i") == 0) & (F.col("o_i") == F.col("n") - 1))
    folds = one_line & (dx * ox + dy * oy < 0)
    of_self = met.filter(own & (~follows | folds)).select("id", F.lit("self").alias("fault"))

    # Two rings: more than a point of one line in common, or pieces of one on both sides of the other.
    places = F.array_sort(_parameters("", "o_"))
    share = one_line & (F.least(places[1], F.lit(1.0)) > F.greatest(places[0], F.lit(0.0)))
    touching = materialize(met.filter(~own), "touching")
    overlap = touching.filter(share).select("id", F.lit("crossing").alias("fault"))
    both = touching.select(*[F.col(c).alias(f"o_{c}" if not c.startswith("o_") else c[2:]) for c in touching.columns if c != "id"], "id").unionByName(touching)
    pieces = _middle(split(edges, both, None))
    sides = both.select("id", "ring", F.col("o_ring").alias("_by")).distinct()
    asked = pieces.join(sides, ["id", "ring"]).select("id", "ring", "i", "k", "x", "y", "_by")
    by_ring = edges.withColumn("_by", F.col("ring"))
    within = inside(asked, by_ring, side, ["id", "_by"], ["id", "ring", "i", "k"], ["_by"]).withColumn("_in", F.lit(True))
    # A piece that touches the other ring at both ends only is told by its middle.
    told = asked.join(within, ["id", "ring", "i", "k", "_by"], "left").groupBy("id", "ring", "_by").agg(F.count_if("_in").alias("inner"), F.count(F.lit(1)).alias("all"))
    told = materialize(told, "sides")
    crossing = told.filter("inner > 0 and inner < all").select("id", F.lit("crossing").alias("fault"))

    # Of rings that do not meet one point tells; of those that touch the pieces have told.
    first = rings.filter("fault is null").select("id", "type", "ring", F.element_at("part", 1).alias("p")).select("id", "type", "ring", "p.x", "p.y")
    holes = first.filter("type = 'Polygon' and ring > 0")
    around = inside(holes, by_ring, side, ["id"], ["id", "ring"], ["_by"]).filter("ring <> _by").join(sides, ["id", "ring", "_by"], "left_anti")
    touched = told.filter("inner = all").select("id", "ring", "_by").join(holes.select("id", "ring"), ["id", "ring"])
    around = materialize(around.unionByName(touched), "around")
    outside = holes.join(around.filter("_by = 0"), ["id", "ring"], "left_anti").select("id", F.lit("hole").alias("fault"))
    nested = around.filter("_by > 0").select("id", F.lit("nested").alias("fault"))
    found = simple.unionByName(of_self).unionByName(overlap).unionByName(crossing).unionByName(outside).unionByName(nested)
    return found.distinct()


# --- Which features may hold a point ----------------------------------------------------------------------------------


def candidates(points: DataFrame, rings: DataFrame, keys: list[str]) -> DataFrame:
    """``points`` (x, y, ...) once for each feature ``_g`` with equal ``keys`` whose box holds them.

    Boxes are dealt to tiles of their mean extent, or larger ones where a box would have more than 256 on a side.
    """

    def axis(c: str) -> Column:
        return F.transform("part", lambda q: q[c])

    low, high = ([f(g(axis(c))).alias(f"_{end}{c}") for c in "xy"] for end, f, g in (("low", F.min, F.array_min), ("high", F.max, F.array_max)))
    boxes = rings.groupBy(*keys, F.col("id").alias("_g")).agg(*low, *high)
    extent = F.greatest(F.col("_highx") - F.col("_lowx"), F.col("_highy") - F.col("_lowy"))
    mean, most = boxes.agg(F.avg(extent), F.max(extent)).first()
    side = max(mean or 0, (most or 0) / 256, 1e-9)
    dealt = boxes.withColumn("_tx", F.explode(_span(F.col("_lowx"), F.col("_highx"), side))).withColumn("_ty", F.explode(_span(F.col("_lowy"), F.col("_highy"), side)))
    at = points.withColumn("_tx", F.floor(F.col("x") / side)).withColumn("_ty", F.floor(F.col("y") / side)).join(dealt, [*keys, "_tx", "_ty"])
    within = F.col("x").between(F.col("_lowx"), F.col("_highx")) & F.col("y").between(F.col("_lowy"), F.col("_highy"))
    return at.filter(within).select(*points.columns, "_g")


# --- Clipping ---------------------------------------------------------------------------------------------------------


def clip_lines(lines: DataFrame, polygons: DataFrame) -> DataFrame:
    """id, geometry of the parts of ``lines`` (id, geometry) that lie in any of ``polygons`` (id, geometry), boundaries included.

    Lines are cut where they meet an edge of a polygon; a piece stays if its middle is inside a polygon or if it lies along
    an edge, of a hole too. Pieces that follow each other are joined, so a line that is not cut keeps its points (without
    repeats). A line of which no more than points is left has no row. Null geometries have none either; ids
    of lines must be unique, polygons may overlap.
    """
    own = materialize(edges_of(rings_of(lines)).withColumn("eid", F.struct("id", "ring", "i")), "lines")
    area = rings_of(polygons)
    borders = materialize(edges_of(area).withColumn("eid", F.struct("id", "ring", "i")), "borders")
    side = max(tile_side(own), tile_side(borders))
    met = materialize(meetings(own, borders, side), "meetings")
    pieces = materialize(_middle(split(own, met, None)), "pieces")
    key = ["id", "ring", "i", "k"]
    held = candidates(pieces.select(*key, "x", "y"), area, [])
    inner = inside(held, borders.select(F.col("id").alias("_g"), *EDGE), side, ["_g"], key, ["_g"]).select(*key)
    places = F.array_sort(_parameters("", "o_"))
    along = met.select("eid", places.alias("_s")).filter(F.size("_s") == 2)
    border = pieces.join(along, "eid").filter(F.col("at").between(F.col("_s")[0], F.col("_s")[1])).select(*key)
    kept = pieces.join(inner.unionByName(border).distinct(), key)
    line = W.partitionBy("id", "ring").orderBy("i", "k")
    before = F.lag(F.struct("i", "k", F.col("bx").alias("x"), F.col("by").alias("y"))).over(line)
    next_one = ((F.col("_b.i") == F.col("i")) & (F.col("_b.k") + 1 == F.col("k"))) | ((F.col("_b.i") + 1 == F.col("i")) & (F.col("k") == 0))
    meets = next_one & (F.col("_b.x") == F.col("ax")) & (F.col("_b.y") == F.col("ay"))
    runs = kept.withColumn("_b", before).withColumn("_new", F.when(F.coalesce(meets, F.lit(False)), 0).otherwise(1))
    runs = runs.withColumn("run", F.sum("_new").over(line))
    ends = [F.struct("i", "k", G.point(F.col(f"{e}x"), F.col(f"{e}y")).alias("p")) for e in "ab"]
    parts = runs.groupBy("id", "ring", "run").agg(F.array_sort(F.collect_list(ends[0])).alias("_from"), F.max(ends[1]).alias("_to"))
    parts = parts.withColumn("part", F.concat(F.transform("_from", lambda e: e["p"]), F.array("_to.p")))
    found = parts.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("ring", "run", "part"))).alias("_parts"))
    parts = F.transform("_parts", lambda e: e["part"])
    kind = F.when(F.size("_parts") > 1, "MultiLineString").otherwise("LineString")
    return found.select("id", F.struct(kind.alias("type"), parts.alias("parts")).alias("geometry"))


# --- Dissolving -------------------------------------------------------------------------------------------------------


def signed_area(ring: Column) -> Column:
    """Positive for a ring that turns to the left."""
    cross = F.transform(G.segments(ring), lambda e: e["ax"] * e["by"] - e["bx"] * e["ay"])
    return F.aggregate(cross, F.lit(0.0), lambda s, d: s + d) / 2


def _turned_rings(boundary: DataFrame, keys: list[str]) -> DataFrame:
    """Directed edges (keys, eid, ax, ay, bx, by) as rings: keys, ring (its least eid), part.

    At a point with several ways on the one is taken that turns most to the left, so along the same piece of area.
    """
    outs = boundary.select(*keys, F.col("eid").alias("next"), F.col("ax").alias("bx"), F.col("ay").alias("by"), F.atan2(F.col("by") - F.col("ay"), F.col("bx") - F.col("ax")).alias("_out"))
    back = F.atan2(F.col("ay") - F.col("by"), F.col("ax") - F.col("bx"))
    # Clockwise from where the edge came from; a way straight back comes last.
    turn = F.pmod(F.col("_back") - F.col("_out") - F.lit(1e-12), F.lit(2 * math.pi))
    ways = boundary.withColumn("_back", back).drop("ax", "ay").join(outs, [*keys, "bx", "by"])
    follow = ways.groupBy(*keys, "eid").agg(F.min_by("next", F.struct(turn.alias("t"), F.col("next").alias("n"))).alias("next"))
    places = boundary.select("eid", "ax", "ay")
    follow = materialize(follow.join(places, "eid"), "follow")
    turned = rings_in_order(follow, keys)
    at = F.struct("place", G.point(F.col("ax"), F.col("ay")).alias("p"))
    rings = turned.groupBy(*keys, "ring").agg(F.array_sort(F.collect_list(at)).alias("_ps"))
    line = F.transform("_ps", lambda e: e["p"])
    return rings.select(*keys, "ring", F.concat(line, F.slice(line, 1, 1)).alias("part"))


def rings_in_order(follow: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, eid, next, ax, ay) of edges with their ring (its least eid) and their place in it, from 0 for that edge.

    Edges are dealt out by keys and place, BLOCK_EDGES to a task, which follows them within its share: rings that lie in it
    are done, others are left as chains, a row each, and only these are joined by the graph operators. Edges that lead to
    the same one are an error.
    """
    n, low, high = follow.agg(F.count(F.lit(1)), F.min("ax"), F.max("ax")).first()
    shares = max(1, -(-n // BLOCK_EDGES))
    strip = F.floor((F.col("ax") - F.lit(low or 0.0)) / max(((high or 0.0) - (low or 0.0)) / math.ceil(math.sqrt(shares)), 1e-9))
    dealt = follow.withColumn("_strip", strip).repartitionByRange(shares, *keys, "_strip", "ay").drop("_strip")
    schema = StructType([*dealt.schema.fields, *[StructField(c, LongType()) for c in ("head", "pos", "out", "len", "least", "least_pos")]])
    walked = materialize(dealt.mapInArrow(_walk_share, schema), "walked")
    done = walked.filter("len is null").select(*follow.columns, F.col("head").alias("ring"), F.col("pos").alias("place"))
    chains = materialize(walked.filter("out is not null").select("head", "out", "len", "least", "least_pos"), "chains")
    if chains.isEmpty():
        return done
    if not chains.groupBy("out").count().filter("count > 1").isEmpty() or not chains.join(chains.select(F.col("head").alias("out")), "out", "left_anti").isEmpty():
        raise ValueError("edges of a boundary do not form rings")
    label = connected(chains.select(F.col("head").alias("a"), F.col("out").alias("b"))).withColumnRenamed("id", "head")
    # Each ring of chains is opened before one of them; a chain's place follows from what is left to the end.
    chain = materialize(chains.join(label, "head").withColumn("p", F.when(F.col("out") != F.col("component"), F.col("out"))), "chain")
    left = roots(chain, "head", "p", "len").select("head", F.col("len").cast("long").alias("left"))
    chain = materialize(chain.join(left, "head"), "chain")
    whole = chain.groupBy("component").agg(
        F.sum("len").alias("all"), F.min("least").alias("ring"), F.min(F.struct("least", (F.col("least_pos") - F.col("left")).alias("o"))).alias("first")
    )
    ways = chain.select("head", "component", "left").join(whole, "component").select("head", "left", "all", "ring", F.col("first.o").alias("first"))
    joined = walked.filter("len is not null").join(ways, "head")
    place = F.pmod(F.col("pos") - F.col("left") - F.col("first"), F.col("all"))
    return done.unionByName(joined.select(*follow.columns, "ring", place.alias("place")))


def _walk_share(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with head, the first edge of a ring (its least) or chain, and pos, the steps from there; len is null in rings.

    The last edge of a chain also has out (the edge that follows elsewhere) and the chain's least edge and its place.
    """
    batches = list(batches)
    rows = pa.Table.from_batches(batches).combine_chunks() if batches else None
    if rows is None or not rows.num_rows:
        return
    eid, following = (rows.column(c).to_numpy() for c in ("eid", "next"))
    n, order = len(eid), np.argsort(eid)
    spot = np.minimum(np.searchsorted(eid, following, sorter=order), n - 1)
    to = np.where(eid[order[spot]] == following, order[spot], -1)
    inner = np.flatnonzero(to >= 0)
    if len(np.unique(to[inner])) < len(inner):
        raise ValueError("edges of a boundary do not form rings")
    back = np.arange(n)
    back[to[inner]] = inner
    rounds = n.bit_length() + 1
    jump, least = back, eid
    for _ in range(rounds):  # the least edge of all before an edge: in a ring, of all
        least, jump = np.minimum(least, least[jump]), jump[jump]
    ring = back[jump] != jump
    ring |= (back == np.arange(n)) & (to == np.arange(n))  # an edge that follows itself
    first = ring & (eid == least)
    back = np.where(first, np.arange(n), back)
    head, pos = back, (back != np.arange(n)).astype(np.int64)
    for _ in range(rounds):
        pos, head = pos + pos[head], head[head]
    last = to < 0
    place = np.full(n, -1, np.int64)  # of a chain's least edge, at its head
    at = np.flatnonzero(~ring)
    end_least = np.full(n, np.iinfo(np.int64).max)
    end_least[head[last]] = least[last]
    is_least = at[eid[at] == end_least[head[at]]]
    place[head[is_least]] = pos[is_least]

    def some(values: np.ndarray, where: np.ndarray) -> pa.Array:
        return pa.array(values.astype(np.int64), pa.int64(), mask=~where)

    everywhere = np.ones(n, bool)
    columns = (("head", eid[head], everywhere), ("pos", pos, everywhere), ("out", following, last), ("len", pos + 1, ~ring), ("least", least, last), ("least_pos", place[head], last))
    for name, values, where in columns:
        rows = rows.append_column(name, some(values, where))
    yield from rows.to_batches(max_chunksize=50_000)


def dissolve(features: DataFrame, digits: int = 7) -> DataFrame:
    """group, ring, part, area: the rings of the union of the polygons (group, id, geometry) of each group.

    Shells turn to the left and have a positive area, holes to the right and a negative one, so areas add up to that of
    the union. All edges of a group are split where they meet, to points rounded to ``digits`` decimals; a piece is on the boundary
    if exactly one of its sides is covered: by its own polygons, or on both sides where its middle is inside another. Pieces are joined end to
    end. Where a hole touches its shell in a point, both are one ring. ids must be unique in a group; null geometries
    add nothing. Polygons must be valid; those of a group may overlap, touch and repeat.
    """
    keyed = spread_out(features.filter("geometry is not null").select(F.struct("group", "id").alias("id"), "geometry"), "id")
    exact = F.transform("part", lambda q: G.point(F.round(q["x"], digits) + 0.0, F.round(q["y"], digits) + 0.0))
    rings = rings_of(keyed).withColumn("part", without_repeats(exact)).filter(F.size("part") > 3)
    rings = materialize(rings.withColumn("group", F.col("id.group")).withColumn("_area", signed_area(F.col("part"))), "rings")
    edges = materialize(edges_of(rings).withColumn("eid", F.struct("id", "ring", "i")), "edges")
    side = tile_side(edges)
    several = rings.groupBy("id").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("id")
    first = _middle(edges.filter("i = 0").join(several, "id", "left_semi")).select("id", "ring", "x", "y")
    around = inside(first, edges.withColumn("_by", F.col("ring")), side, ["id"], ["id", "ring"], ["_by"]).filter("ring <> _by")
    depth = around.groupBy("id", "ring").agg(F.count(F.lit(1)).alias("_depth"))
    turned = rings.join(depth, ["id", "ring"], "left").select("id", "ring", ((F.col("_area") > 0) != (F.coalesce("_depth", F.lit(0)) % 2 == 1)).alias("left"))

    once = materialize(meetings(edges, edges, side, ["group"], F.col("eid") < F.col("o_eid")), "meetings")
    back = once.select(*[F.col(c).alias(c if c == "group" else c[2:] if c.startswith("o_") else f"o_{c}") for c in once.columns])
    pieces = split(edges, once.unionByName(back), digits).join(turned, ["id", "ring"])
    forward = F.struct("ax", "ay") < F.struct("bx", "by")
    ends = [G.point(F.col(f"{e}x"), F.col(f"{e}y")) for e in "ab"]
    same = pieces.select("group", "id", F.least(*ends).alias("_l"), F.greatest(*ends).alias("_h"), (F.col("left") == forward).alias("left"))
    same = same.groupBy("group", "_l", "_h").agg(F.bool_or("left").alias("left"), F.bool_or(~F.col("left")).alias("right"), F.collect_set("id").alias("ids"))
    sides = same.filter(F.col("left") != F.col("right")).select(
        "group", F.col("_l.x").alias("ax"), F.col("_l.y").alias("ay"), F.col("_h.x").alias("bx"), F.col("_h.y").alias("by"), "left", "ids"
    )
    sides = materialize(sides.withColumn("eid", F.monotonically_increasing_id()), "sides")
    held = candidates(_middle(sides).select("group", "eid", "ids", "x", "y"), rings, ["group"]).filter(~F.array_contains("ids", F.col("_g")))
    hidden = inside(held.drop("ids"), edges.select(F.col("id").alias("_g"), *EDGE), side, ["_g"], ["eid"], ["_g"]).select("eid").distinct()
    shown = sides.join(hidden, "eid", "left_anti")
    turned = {c: F.when(F.col("left"), F.col(c)).otherwise(F.col({"a": "b", "b": "a"}[c[0]] + c[1])).alias(c) for c in EDGE}
    boundary = materialize(shown.select("group", "eid", *turned.values()), "boundary")
    return _turned_rings(boundary, ["group"]).withColumn("area", signed_area(F.col("part")))


def buffer(features: DataFrame, distance: float, quarter: int = 8, digits: int = 7) -> DataFrame:
    """group, ring, part, area: the rings of all that lies within ``distance`` of each feature (id, geometry), group being its id.

    Every edge, and every single point, has an outline of two half circles of 2 * ``quarter`` edges each, whose corners lie
    at the distance; outlines and a polygon's own area are dissolved.
    """
    rings = materialize(rings_of(spread_out(features, "id")), "parts")
    single = rings.filter(F.size("part") == 1).select("id", "ring", F.lit(0).alias("i"), *[F.element_at("part", 1)[c[1]].alias(c) for c in EDGE])
    edges = edges_of(rings).select("id", "ring", "i", *EDGE).unionByName(single)
    along = F.coalesce(F.atan2(F.col("by") - F.col("ay"), F.col("bx") - F.col("ax")), F.lit(0.0))
    steps = F.sequence(F.lit(0), F.lit(2 * quarter))

    def arc(end: str, start: float) -> Column:
        def corner(k: Column) -> Column:
            angle = along + (start + k * (math.pi / 2 / quarter))
            return G.point(F.col(f"{end}x") + distance * F.cos(angle), F.col(f"{end}y") + distance * F.sin(angle))

        return F.transform(steps, corner)

    outline = F.concat(arc("b", -math.pi / 2), arc("a", math.pi / 2))
    closed = F.concat(outline, F.slice(outline, 1, 1))
    shape = F.struct(F.lit("Polygon").alias("type"), F.array(closed).alias("parts"))
    capsules = edges.select(F.col("id").alias("group"), F.concat_ws("/", "ring", "i").alias("id"), shape.alias("geometry"))
    areas = features.filter(F.col("geometry.type").contains("Polygon")).select(F.col("id").alias("group"), F.lit("area").alias("id"), "geometry")
    return dissolve(capsules.unionByName(areas), digits)
