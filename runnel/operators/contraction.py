"""Values of a forest's nodes that follow from those of their children, by tree contraction.

A round does two things, wherever in the forest they can be done. Nodes without open children are closed: their value
is known and is handed down. Nodes with one open child are spliced out: what happens to the child's value on its way and
in the node becomes the child's own way to the next node; a coin for each node keeps neighbours from going at once.
A fraction of the nodes goes each round, so log2 of their number rounds do, whatever the shape of the trees. Afterwards the
spliced nodes get their values, last round first. All steps are equi-joins by node and aggregates that combine before
the shuffle, so neither a long chain nor a node with very many children meets in a task.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runnel.staging import materialize


class CycleError(ValueError):
    """Pointers form a cycle; ``unresolved`` is the number of cells on cycles."""

    def __init__(self, unresolved: int):
        super().__init__(f"{unresolved} unresolved cells: the pointers form a cycle")
        self.unresolved = unresolved


@dataclass(frozen=True)
class Algebra:
    """``state`` is what a node knows of its closed children, ``way`` what becomes of a node's value on its way down."""

    leaf: Callable[[Column], Column]  # state -> value of a node whose children are all closed
    through: Callable[[Column, Column], Column]  # state, what the one open child sends -> value
    send: Callable[[Column, Column], Column]  # way, value -> what arrives below
    gather: Callable[[DataFrame], DataFrame]  # rows (p, x) of what arrives -> (p, g), a row for each p
    absorb: Callable[[Column, Column], Column]  # state, g -> state
    splice: Callable[[Column, Column, Column], Column]  # way of the node, its state, way of its child -> the child's new way


def fold(nodes: DataFrame, algebra: Algebra) -> DataFrame:
    """(k, value) of nodes (k, p, state, way); p is the key of the node below, null at roots.

    CycleError if pointers form a cycle, which is spliced until a node points to itself. ValueError if a node points to none
    of the nodes, as its value would be lost.
    """
    live = materialize(nodes.select("k", "p", "state", "way"), "live")
    lost = live.filter("p is not null").select(F.col("p").alias("k")).distinct().join(live.select("k"), "k", "left_anti").count()
    if lost:
        raise ValueError(f"{lost} nodes that others point to are not there")
    closed, spliced, left = [], [], live.count()
    for turn in range(64 + 16 * max(1, left).bit_length()):
        if not left:
            break
        open_above = live.filter("p is not null").select(F.col("p").alias("k")).distinct()
        done = live.join(open_above, "k", "left_anti").withColumn("value", algebra.leaf(F.col("state")))
        done = materialize(done.select("k", "p", "way", "value"), "closed")
        closed.append(done.select("k", "value"))
        came = algebra.gather(done.filter("p is not null").select("p", algebra.send(F.col("way"), F.col("value")).alias("x")))
        rest = live.join(done.select("k"), "k", "left_anti").join(came.withColumnRenamed("p", "k"), "k", "left")
        state = F.when(F.col("g").isNull(), F.col("state")).otherwise(algebra.absorb(F.col("state"), F.col("g")))
        rest = materialize(rest.select("k", "p", state.alias("state"), "way"), "rest")

        def coin(k: Column, turn: int = turn) -> Column:
            return F.pmod(F.xxhash64(k, F.lit(turn)), F.lit(2)) == 1

        only = rest.filter("p is not null").groupBy(F.col("p").alias("k")).agg(F.count(F.lit(1)).alias("n"), F.max("k").alias("u"))
        gone = rest.filter(F.col("p").isNotNull() & coin(F.col("k"))).join(only.filter("n = 1"), "k").filter(~coin(F.col("u")))
        child = rest.select(F.col("k").alias("u"), F.col("way").alias("child_way"))
        gone = materialize(gone.join(child, "u").select("k", "p", "u", "state", "way", "child_way"), "spliced")
        spliced.append(gone)
        moved = gone.select(
            F.col("u").alias("k"), F.col("p").alias("np"), algebra.splice(F.col("way"), F.col("state"), F.col("child_way")).alias("nw")
        )
        live = rest.join(gone.select("k"), "k", "left_anti").join(moved, "k", "left")
        live = live.select("k", F.coalesce("np", "p").alias("p"), "state", F.coalesce("nw", "way").alias("way"))
        live = materialize(live, "live")
        left = live.count()
        if left and live.filter("p is null or p <> k").isEmpty():
            break
    if left:
        raise CycleError(left)
    known = closed
    for gone in reversed(spliced):
        above = reduce(DataFrame.union, known).withColumnRenamed("k", "u").withColumnRenamed("value", "of_child")
        value = algebra.through(F.col("state"), algebra.send(F.col("child_way"), F.col("of_child")))
        known.append(materialize(gone.join(above, "u").select("k", value.alias("value")), "values"))
    return reduce(DataFrame.union, known) if known else nodes.select("k", F.lit(None).alias("value"))


def sums_under_limits() -> Algebra:
    """Totals where a node sends on min(total, limit): state is a total so far, way is struct(plus, limit) of min(x + plus, limit)."""

    def splice(way: Column, state: Column, child: Column) -> Column:
        plus = state + way["plus"]
        return F.struct((child["plus"] + plus).alias("plus"), F.least(child["limit"] + plus, way["limit"]).alias("limit"))

    return Algebra(
        leaf=lambda state: state,
        through=lambda state, x: state + x,
        send=lambda way, x: F.least(x + way["plus"], way["limit"]),
        gather=lambda rows: rows.groupBy("p").agg(F.sum("x").alias("g")),
        absorb=lambda state, g: state + g,
        splice=splice,
    )


def strahler_orders() -> Algebra:
    """Orders: state is struct(m, twice), the largest order so far and whether two nodes have it; way maps order i to its i-th entry."""

    def own(state: Column) -> Column:
        return F.greatest(F.lit(1), state["m"] + state["twice"].cast("int"))

    def through(state: Column, x: Column) -> Column:
        return F.when(x > state["m"], x).when(x == state["m"], x + 1).otherwise(own(state))

    def gather(rows: DataFrame) -> DataFrame:
        counted = rows.groupBy("p", "x").agg(F.count(F.lit(1)).alias("n"))
        return counted.groupBy("p").agg(F.max(F.struct(F.col("x").alias("m"), (F.col("n") > 1).alias("twice"))).alias("g"))

    def absorb(state: Column, g: Column) -> Column:
        both = F.struct(g["m"].alias("m"), F.lit(True).alias("twice"))
        return F.when(g["m"] > state["m"], g).when(g["m"] == state["m"], both).otherwise(state)

    def splice(way: Column, state: Column, child: Column) -> Column:
        # Orders beyond the table cannot occur: they would need more nodes than there are.
        return F.transform(child, lambda x: F.element_at(way, F.least(through(state, x), F.size(way))))

    return Algebra(leaf=own, through=through, send=F.element_at, gather=gather, absorb=absorb, splice=splice)
