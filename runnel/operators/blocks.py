"""Shortest ways from one node over blocks of a graph, in rounds that grow with the blocks that ways cross, not with their edges.

Arcs are dealt by ranges of their first node into blocks of about BLOCK_ARCS arcs, so nodes of near ids share a block. In a
round each block that got an offer takes what is better and lets it spread within itself; what leaves the block is an
offer to the next. Only blocks with better offers are read. A node's arcs lie in one block, however many they are.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runnel.operators.graph import flow_path
from runnel.staging import materialize, new_path

#: Arcs of a block, which one task holds.
BLOCK_ARCS = 1 << 20
#: What a node of a block has been given so far, and what it is offered.
KNOWN, OFFER = 0, 1


def blocks_of(edges: DataFrame, block_arcs: int | None = None) -> DataFrame:
    """block, a, b, w, to (the block of b): the lightest arcs of an undirected graph (src, dst, weight) in both directions."""
    rows = edges.filter("src is not null and dst is not null").select("src", "dst", F.col("weight").cast("double").alias("w"))
    rows = materialize(rows, "weighted")
    if not rows.filter("w is null or isnan(w) or w < 0").isEmpty():
        raise ValueError("weights must be numbers from 0 on")
    both = F.array(F.struct(F.col("src").alias("a"), F.col("dst").alias("b")), F.struct(F.col("dst").alias("a"), F.col("src").alias("b")))
    arcs = rows.select(F.explode(both).alias("e"), "w").groupBy("e.a", "e.b").agg(F.min("w").alias("w"))
    arcs = materialize(arcs, "arcs")
    n = max(1, math.ceil(arcs.count() / (block_arcs or BLOCK_ARCS)))
    # long, as blocks of offers are: equal numbers of two types do not meet in a cogroup of several partitions
    dealt = materialize(arcs.repartitionByRange(n, "a").withColumn("block", F.spark_partition_id().cast("long")), "dealt")
    where = dealt.select(F.col("a").alias("b"), F.col("block").alias("to")).distinct()
    path = new_path(edges.sparkSession, "blocks")
    whole = dealt.join(where, "b").select("a", "b", "w", "to", "block")
    whole.write.partitionBy("block").parquet(path)
    return edges.sparkSession.read.schema(whole.schema).parquet(path)


def _spread(key: tuple, arcs: pa.Table, state: pa.Table) -> pa.Table:
    """Of one block: what its nodes gain by the offers (KNOWN), and what they then offer to others (OFFER)."""
    block = key[0].as_py()
    a, b, w, to = (arcs[c].to_numpy() for c in ("a", "b", "w", "to"))
    nodes, code = np.unique(a, return_inverse=True)
    order = np.argsort(code, kind="stable")
    code, b, w, to = code[order], b[order], w[order], to[order]
    first = np.searchsorted(code, np.arange(len(nodes) + 1)).tolist()
    inside = to == block
    head, weight = np.where(inside, np.searchsorted(nodes, np.where(inside, b, nodes[:1])), -1).tolist(), w.tolist()
    at, kind = np.searchsorted(nodes, state["id"].to_numpy()), state["kind"].to_numpy()
    distance, previous = state["distance"].to_numpy(), state["previous"].to_pylist()
    best = np.full(len(nodes), np.inf)
    np.minimum.at(best, at[kind == KNOWN], distance[kind == KNOWN])
    best, before, queue = best.tolist(), {}, []
    for i in np.flatnonzero(kind == OFFER).tolist():
        v, d = int(at[i]), float(distance[i])
        if d < best[v]:
            best[v], before[v] = d, previous[i]
            queue.append((d, v))
    heapq.heapify(queue)
    names = nodes.tolist()
    while queue:
        d, v = heapq.heappop(queue)
        if d > best[v]:
            continue
        for j in range(first[v], first[v + 1]):
            u = head[j]
            if u >= 0 and d + weight[j] < best[u]:
                best[u], before[u] = d + weight[j], names[v]
                heapq.heappush(queue, (best[u], u))
    best, gained = np.array(best), np.array(sorted(before), np.int64)
    gains = np.zeros(len(nodes), bool)
    gains[gained] = True
    out = np.flatnonzero(~inside & gains[code])
    kind_of, n, m = arcs.schema.field("a").type, len(gained), len(out)
    columns = [
        np.repeat([KNOWN, OFFER], [n, m]), np.r_[np.full(n, block), to[out]], pa.concat_arrays([pa.array(x, kind_of) for x in (nodes[gained], b[out])]),
        np.r_[best[gained], best[code[out]] + w[out]], pa.concat_arrays([pa.array([before[v] for v in gained.tolist()], kind_of), pa.array(nodes[code[out]], kind_of)]),
    ]
    return pa.table([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], names=["kind", "block", "id", "distance", "previous"])


def _best(rows: DataFrame) -> DataFrame:
    best = rows.groupBy("block", "id").agg(F.min(F.struct("distance", "previous")).alias("m"))
    return best.select("block", "id", "m.distance", "m.previous")


def distances(blocks: DataFrame, source) -> DataFrame:
    """(id, distance, previous) of all nodes that ways from ``source`` reach over ``blocks_of`` a graph; no rows if source is no node."""
    spark, kind = blocks.sparkSession, dict(blocks.dtypes)["a"]
    schema = f"kind long, block long, id {kind}, distance double, previous {kind}"
    front = blocks.filter(F.col("a") == F.lit(source).cast(kind)).limit(1)
    front = materialize(front.select(F.col("block").cast("long").alias("block"), F.col("a").alias("id"), F.lit(0.0).alias("distance"), F.lit(None).cast(kind).alias("previous")), "front")
    rounds: list[str] = []
    while active := [r[0] for r in front.select("block").distinct().collect()]:  # numbers of blocks
        state = front.select(F.lit(OFFER).cast("long").alias("kind"), *front.columns)
        if rounds:
            state = state.unionByName(spark.read.schema(schema).parquet(*rounds).filter((F.col("kind") == KNOWN) & F.col("block").isin(active)))
        arcs = blocks.filter(F.col("block").isin(active)).withColumnRenamed("block", "of")
        rounds.append(new_path(spark, "round"))
        done = materialize(arcs.groupBy("of").cogroup(state.groupBy("block")).applyInArrow(_spread, schema), "round", rounds[-1])
        offers = _best(done.filter(F.col("kind") == OFFER))
        known = spark.read.schema(schema).parquet(*rounds).filter(F.col("kind") == KNOWN).join(offers.select("id"), "id", "left_semi").groupBy("id").agg(F.min("distance").alias("_d"))
        front = materialize(offers.join(known, "id", "left").filter("_d is null or distance < _d").select(*front.columns), "front")
    if not rounds:
        return front.select("id", "distance", "previous")
    found = spark.read.schema(schema).parquet(*rounds).filter(F.col("kind") == KNOWN)
    return materialize(_best(found).select("id", "distance", "previous"), "distances")


def route(found: DataFrame, target) -> DataFrame:
    """(step, id, distance) of the nodes on the way that ``distances`` found to target, both ends included; no rows if there is none."""
    back = materialize(flow_path(found, target, "id", "previous"), "back")
    last = back.agg(F.max("step")).first()[0]
    return back.join(found.select("id", "distance"), "id").select((F.lit(last).cast("long") - F.col("step")).alias("step"), "id", "distance")
