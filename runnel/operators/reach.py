"""Who reaches whom: strongly connected components of directed graphs, and ancestors in forests by intervals of a tour."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from runnel.operators.contraction import CycleError
from runnel.operators.graph import roots
from runnel.staging import discard, materialize, new_path

#: Positions of a tour in a band.
BAND = 1 << 16


class _Tables:
    """Tables of a loop, of which a name's last one is kept."""

    def __init__(self, spark) -> None:
        self.spark, self.paths = spark, {}

    def put(self, name: str, rows: DataFrame) -> DataFrame:
        path = new_path(self.spark, name)
        out = materialize(rows, name, path)
        old, self.paths[name] = self.paths.get(name), path
        if old:
            discard(self.spark, old)
        return out


def _coin(node: Column, turn: int) -> Column:
    return F.pmod(F.xxhash64(node, F.lit(turn)), F.lit(2)) == 1


def _thinned(edges: DataFrame, tables: _Tables, turn: int) -> tuple[DataFrame, list[DataFrame], int]:
    """Edges without nodes that cannot be on a cycle, or lie between two others alone; the latter as rows (v, u, w), u -> v -> w.

    Nodes without an edge in or out go; of nodes with one of each a fraction goes each round, as neighbours do not go at once,
    and leaves an edge u -> w. So trees and chains, of any length, take log2 of their nodes rounds.
    """
    spliced: list[DataFrame] = []
    while True:
        turn += 1
        ins = edges.groupBy(F.col("dst").alias("v")).agg(F.count(F.lit(1)).alias("i"), F.min("src").alias("u"))
        outs = edges.groupBy(F.col("src").alias("v")).agg(F.count(F.lit(1)).alias("o"), F.min("dst").alias("w"))
        nodes = tables.put("degrees", ins.join(outs, "v", "full").withColumn("thin", F.col("i").eqNullSafe(F.lit(1)) & F.col("o").eqNullSafe(F.lit(1))))
        ends = nodes.filter("i is null or o is null").select("v")
        thin = nodes.filter("thin")
        # One goes where its coin says so and that of a neighbour that could go does not.
        goes = thin.filter(_coin(F.col("v"), turn))
        for side in ("u", "w"):
            goes = goes.join(goes.select(F.col("v").alias(side)).distinct(), side, "left_anti")
        gone = materialize(goes.select("v", "u", "w"), "spliced")
        lost = ends.unionByName(gone.select("v")).distinct()
        if lost.isEmpty():
            if thin.isEmpty():
                return edges, spliced, turn
            continue
        spliced.append(gone)
        kept = edges.join(lost.withColumnRenamed("v", "src"), "src", "left_anti").join(lost.withColumnRenamed("v", "dst"), "dst", "left_anti")
        edges = tables.put("arcs", kept.select("src", "dst").union(gone.filter("u <> w").select("u", "w")).distinct())


def strong_components(edges: DataFrame) -> DataFrame:
    """(id, component, size, cyclic) of all ids in edges (src, dst): component is the smallest id that reaches id and is reached by it.

    cyclic: on a directed cycle, one of a node alone too. The graph is thinned first, which settles trees and chains; in
    what is left each node takes the smallest id that reaches it as its colour, and the nodes of a colour that reach the node of that
    id are its component. Colours spread an edge a round over the thinned graph. Null ends are no nodes.
    """
    edges = edges.select("src", "dst").filter("src is not null and dst is not null").distinct()
    edges = materialize(edges, "directed")
    tables = _Tables(edges.sparkSession)
    every = edges.select(F.explode(F.array("src", "dst")).alias("id")).distinct()
    left = tables.put("arcs", edges.filter("src <> dst"))
    history: list[tuple[str, DataFrame]] = []
    turn = 0
    while True:
        left, spliced, turn = _thinned(left, tables, turn)
        history += [("spliced", s) for s in spliced]
        if left.isEmpty():
            break
        nodes = left.select(F.explode(F.array("src", "dst")).alias("v")).distinct()
        colour = tables.put("colours", nodes.select("v", F.col("v").alias("c")))
        while True:
            offer = left.join(colour.withColumnRenamed("v", "src"), "src").groupBy(F.col("dst").alias("v")).agg(F.min("c").alias("n"))
            new = colour.join(offer, "v", "left").select("v", F.least("c", F.coalesce("n", "c")).alias("c"), (F.col("n") < F.col("c")).alias("moved"))
            new = tables.put("colours", new)
            if new.filter("moved").isEmpty():
                break
            colour = new.select("v", "c")
        colour = new.select("v", "c")
        own = left.join(colour.select(F.col("v").alias("src"), F.col("c").alias("cs")), "src").join(colour.select(F.col("v").alias("dst"), F.col("c").alias("cd")), "dst")
        own = tables.put("inner", own.filter("cs = cd").select("src", "dst"))
        seen = materialize(colour.filter("v = c").select("v", "c"), "reaching")
        front = seen
        while not front.isEmpty():
            back = own.join(front.select(F.col("v").alias("dst"), "c"), "dst").select(F.col("src").alias("v"), "c").distinct()
            front = materialize(back.join(seen, "v", "left_anti"), "reaching")
            seen = materialize(seen.unionByName(front), "reaching")
        history.append(("found", seen))
        rest = left
        for end in ("src", "dst"):
            rest = rest.join(seen.select(F.col("v").alias(end)), end, "left_anti")
        left = tables.put("arcs", rest.select("src", "dst"))
    known = None
    for kind, rows in reversed(history):
        if kind == "found":
            labels = rows.select("v", F.col("c").alias("label"))
        elif known is None:
            labels = rows.select("v", F.when(F.col("u") == F.col("w"), F.col("u")).otherwise(F.col("v")).alias("label"))
        else:
            # A node spliced out lies on a cycle if both its neighbours are of one component.
            at = rows.join(known.select(F.col("v").alias("u"), F.col("label").alias("lu")), "u", "left").join(known.select(F.col("v").alias("w"), F.col("label").alias("lw")), "w", "left")
            one = (F.col("u") == F.col("w")) | (F.coalesce("lu", "u") == F.coalesce("lw", "w"))
            labels = at.select("v", F.when(one, F.coalesce("lu", "u")).otherwise(F.col("v")).alias("label"))
        known = labels if known is None else known.unionByName(labels)
        known = tables.put("labels", known)
    of = every.withColumn("label", F.col("id")) if known is None else every.join(known.withColumnRenamed("v", "id"), "id", "left").withColumn("label", F.coalesce("label", "id"))
    of = materialize(of, "components")
    sizes = of.groupBy("label").agg(F.min("id").alias("component"), F.count(F.lit(1)).alias("size"))
    loops = edges.filter("src = dst").select(F.col("src").alias("id"), F.lit(True).alias("_loop"))
    out = of.join(sizes, "label").join(loops, "id", "left")
    return out.select("id", "component", "size", ((F.col("size") > 1) | F.coalesce("_loop", F.lit(False))).alias("cyclic"))


def _next_siblings(tree: DataFrame) -> DataFrame:
    """id, down, after: the next larger id with the same ``down``, null for the last; ranges of (down, id) are ordered each by itself."""
    order = ["down", "id"]
    ranges = materialize(tree.filter("down is not null").select(*order).repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), "siblings")
    here = F.struct(*order)
    firsts = sorted((r["_part"], r["f"]) for r in ranges.groupBy("_part").agg(F.min(here).alias("f")).collect())  # a row for each range
    ahead = [(part, *after) for (part, _), (_, after) in zip(firsts, firsts[1:], strict=False)]
    kinds = dict(tree.dtypes)
    beyond = tree.sparkSession.createDataFrame(ahead, f"_part int, _down {kinds['down']}, _id {kinds['id']}")
    inner = F.lead(here).over(W.partitionBy("_part").orderBy(*order))
    rows = ranges.withColumn("_n", inner).join(F.broadcast(beyond), "_part", "left")
    rows = rows.withColumn("_n", F.coalesce("_n", F.when(F.col("_id").isNotNull(), F.struct(F.col("_down").alias("down"), F.col("_id").alias("id")))))
    return rows.select("id", "down", F.when(F.col("_n.down") == F.col("down"), F.col("_n.id")).alias("after"))


def tree_intervals(tree: DataFrame) -> DataFrame:
    """(id, root, enter, leave) of a forest (id, down): all that drains through a node has its enter between the node's enter and leave.

    A tour of each tree goes into a node, through what drains to it in the order of ids, and out again; its steps are numbered
    by doubling, log2 of the tree's size rounds whatever its depth. (leave - enter + 1) / 2 nodes drain through a node, itself
    included. ``down`` is null at roots. CycleError if nodes drain in a circle, ValueError if to a node that is not there.
    """
    tree = materialize(tree.select("id", "down"), "forest")
    lost = tree.filter("down is not null").select(F.col("down").alias("id")).distinct().join(tree.select("id"), "id", "left_anti").count()
    if lost:
        raise ValueError(f"{lost} nodes that others drain to are not there")
    siblings = materialize(_next_siblings(tree), "siblings")
    first = siblings.groupBy(F.col("down").alias("id")).agg(F.min("id").alias("first"))

    def step(node: Column, out: bool) -> Column:
        return F.struct(node.alias("id"), F.lit(out).alias("out"))

    into = tree.join(first, "id", "left").select(step(F.col("id"), False).alias("k"), F.when(F.col("first").isNotNull(), step(F.col("first"), False)).otherwise(step(F.col("id"), True)).alias("j"))
    back = F.when(F.col("after").isNotNull(), step(F.col("after"), False)).when(F.col("down").isNotNull(), step(F.col("down"), True))
    leave = tree.join(siblings.select("id", "after"), "id", "left").select(step(F.col("id"), True).alias("k"), back.alias("j"))
    tour = roots(materialize(into.unionByName(leave), "tour"), "k", "j")
    at = tour.select(F.col("k.id").alias("id"), F.col("k.out").alias("out"), F.col("root.id").alias("root"), "depth")
    ends = at.groupBy("id").agg(F.max("root").alias("root"), F.max(F.when(~F.col("out"), F.col("depth"))).alias("e"), F.max(F.when(F.col("out"), F.col("depth"))).alias("l"))
    ends = materialize(ends, "ends")
    if ends.count() != tree.count():
        raise CycleError(tree.count() - ends.count())
    last = ends.filter("id = root").select("root", F.col("e").alias("_last"))
    return ends.join(last, "root").select("id", "root", (F.col("_last") - F.col("e")).alias("enter"), (F.col("_last") - F.col("l")).alias("leave"))


def drains_through(intervals: DataFrame, asked: DataFrame) -> DataFrame:
    """(of, id): all nodes that drain through each asked node (id), itself included, by a join on bands of the tour."""
    of = intervals.join(asked.select("id").distinct(), "id").select(F.col("id").alias("of"), "root", F.col("enter").alias("_from"), F.col("leave").alias("_to"))
    of = of.withColumn("_band", F.explode(F.sequence(F.floor(F.col("_from") / BAND), F.floor(F.col("_to") / BAND))))
    rows = intervals.select("id", "root", "enter").withColumn("_band", F.floor(F.col("enter") / BAND))
    return rows.join(of, ["root", "_band"]).filter(F.col("enter").between(F.col("_from"), F.col("_to"))).select("of", "id")
