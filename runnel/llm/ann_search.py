"""Nearest neighbours by adaptive dimension scan in the probed lists of an inverted file.

Vectors are turned by one random rotation, so that the first d of D dimensions of a difference are a fair sample
of it: its length is about D/d times theirs. Lists are kept as blocks of BLOCK_DIMS columns. A query reads a list
block by block and adds up partial distances; after each block a test asks whether a candidate whose distance is at
most that of the k-th best so far would show so large a part. If not (beyond ``epsilon`` standard errors) the
candidate is abandoned, and the blocks that follow are read for the others only. What survives all blocks is
measured anew in double precision on the original vectors.

The centroids and the number of lists to probe come from a bounded sample (SAMPLE vectors, chosen by a hash of
vec_id); every vector is indexed. A list that the sample shows to be large is dealt over several cells, so a list
with a third of all vectors is no task of its own. Cells go to groups in an order that keeps near lists together, so a
query travels to few groups. Lists number twice the root of the vectors at most, up to MOST_LISTS and an eighth of the
sample: beyond some millions of vectors the work of a query grows in proportion to the table. Equal vectors are brought together before they are shuffled,
with their k+1 smallest ids: more of them cannot enter a result. Equal queries are searched once.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runnel.llm.storage import join_groups, materialize

#: Vectors that the index is fitted on, lists at most, vectors a cell should hold, vectors a task should hold.
SAMPLE, MOST_LISTS, CELL, GROUP = 16_384, 4_096, 4_096, 20_000
BLOCK_DIMS = 16
LEAST_GROUPS = 16


@dataclass
class Index:
    """What every executor needs; at most MOST_LISTS centroids, so its size is bounded."""

    rotation: np.ndarray
    centroids: np.ndarray
    cells: np.ndarray  # of each list
    first_cell: np.ndarray
    group: np.ndarray  # of each cell
    probes: int
    kind: type  # of the components

    def lists(self, x: np.ndarray, n: int) -> np.ndarray:
        """The n nearest lists of each (rotated) vector, nearest first."""
        out = np.empty((len(x), n), np.int64)
        square = (self.centroids**2).sum(1)
        for i in range(0, len(x), 1024):
            d = square - 2 * x[i : i + 1024] @ self.centroids.T
            out[i : i + 1024] = np.argsort(d, axis=1, kind="stable")[:, :n] if n > 1 else np.argmin(d, axis=1)[:, None]
        return out


def rotate(x: np.ndarray, rotation: np.ndarray) -> np.ndarray:
    return (x @ rotation).astype(rotation.dtype)


def near_order(points: np.ndarray) -> np.ndarray:
    """The points in an order that keeps near ones together: halved again and again along the widest dimension."""
    if len(points) < 3:
        return np.arange(len(points))
    turn = np.argsort(points[:, np.argmax(np.ptp(points, axis=0))], kind="stable")
    low, high = turn[: len(turn) // 2], turn[len(turn) // 2 :]
    return np.r_[low[near_order(points[low])], high[near_order(points[high])]]


def fit(sample: np.ndarray, total: int, k: int, recall: float, seed: int = 7) -> Index:
    """Rotation, centroids by k-means, cells, and the probes that reach ``recall`` among the sample itself.

    Neighbours in a sample lie farther than in the whole, so they ask for more probes than the whole does. Small tables
    probe more lists than the sample asks for, until those hold 20 times k vectors between them.
    """
    rng = np.random.default_rng(seed)
    dims = sample.shape[1]
    rotation = np.linalg.qr(rng.standard_normal((dims, dims)))[0].astype(sample.dtype)
    x = np.unique(rotate(sample, rotation), axis=0)
    n = int(max(1, min(MOST_LISTS, len(x) // 8, 2 * np.sqrt(total))))
    centroids = x[rng.choice(len(x), n, replace=False)]
    index = Index(rotation, centroids, np.ones(n, int), np.arange(n), np.zeros(n, int), n, sample.dtype.type)
    for _ in range(6):
        mine = index.lists(x, 1)[:, 0]
        size = np.bincount(mine, minlength=n)
        sums = np.zeros((n, dims))
        np.add.at(sums, mine, x)
        index.centroids = np.where(size[:, None] > 0, sums / np.maximum(size, 1)[:, None], index.centroids).astype(sample.dtype)
    index.centroids = index.centroids[near_order(index.centroids)]
    mine = index.lists(x, 1)[:, 0]
    asked = rng.choice(len(x), min(256, len(x)), replace=False)
    far = (x[asked] ** 2).sum(1)[:, None] + (x**2).sum(1) - 2 * x[asked] @ x.T
    far[np.arange(len(asked)), asked] = np.inf
    near = np.argsort(far, axis=1)[:, : min(k, len(x) - 1)]
    place = np.argsort(index.lists(x[asked], n), axis=1)
    ranks = np.take_along_axis(place, mine[near], axis=1).ravel() if near.size else np.zeros(1, int)
    least = -(-20 * k * n // total)  # lists that hold many more than k vectors between them
    index.probes = int(min(n, max(least, np.quantile(ranks, recall, method="higher") + 1)))
    share = np.bincount(index.lists(rotate(sample, rotation), 1)[:, 0], minlength=n) / len(sample)
    index.cells = np.maximum(1, np.ceil(share * total / CELL)).astype(np.int64)
    index.first_cell = np.cumsum(index.cells) - index.cells
    groups = max(LEAST_GROUPS, -(-total // GROUP))
    held = np.repeat(share / index.cells, index.cells)  # share of all vectors that each cell is likely to hold
    index.group = np.minimum((np.cumsum(held) - held) * groups, groups - 1).astype(np.int64)
    return index


def _matrix(column: pa.Array, dims: int, kind: type) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(-1, dims)


def _digest(row: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(row, digest_size=8).digest(), "little") >> 1


_CANDIDATES = pa.schema([("g", pa.int64()), ("cell", pa.int64()), ("vec_id", pa.int64()), ("vector", pa.binary())])


def _deal_candidates(shared, dims: int, keep: int):
    """Each batch: equal vectors brought together with their smallest ids, then dealt to cells by list and digest."""

    def run(batches):
        index: Index = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch["embedding"], dims, index.kind) + index.kind(0)  # no negative zeros
            ids = batch["vec_id"].to_numpy()
            rows = np.ascontiguousarray(x).view([("", np.void, dims * x.itemsize)]).ravel()
            _, first, group = np.unique(rows, return_index=True, return_inverse=True)
            order = np.lexsort((ids, group))
            fresh = np.r_[True, (group[order][1:] != group[order][:-1]) | (ids[order][1:] != ids[order][:-1])]
            order = order[fresh]
            turn = np.arange(len(order)) - np.searchsorted(group[order], group[order])
            order = order[turn < keep]
            lists = index.lists(rotate(x[first], index.rotation), 1)[:, 0]
            digest = np.array([_digest(x[i].tobytes()) for i in first], np.int64)
            cell = index.first_cell[lists] + digest % index.cells[lists]
            cell = cell[group[order]]
            vectors = pa.array([x[i].tobytes() for i in order], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(index.group[cell]), pa.array(cell), pa.array(ids[order]), vectors], schema=_CANDIDATES
            )

    return run


def _deal_queries(shared, dims: int):
    """A query goes to every group that holds a cell of a list it probes."""

    def run(batches):
        index: Index = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch["embedding"], dims, index.kind) + index.kind(0)
            probed = index.lists(rotate(x, index.rotation), index.probes)
            out_g, out_i = [], []
            for i, lists in enumerate(probed):
                n = index.cells[lists]
                cells = np.repeat(index.first_cell[lists], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                g = np.unique(index.group[cells])
                out_g.append(g)
                out_i.append(np.full(len(g), i))
            at = np.concatenate(out_i)
            ids = batch["vec_id"].to_numpy()[at]
            vectors = pa.array([x[i].tobytes() for i in at], pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(out_g)), pa.array(ids), vectors], names=["g", "query_id", "vector"])

    return run


def scan(query: np.ndarray, blocks: list[np.ndarray], bound: float, epsilon: float) -> np.ndarray:
    """Numbers of the candidates of one list that the tests leave. ``bound``: distance of the k-th best so far."""
    dims = len(query)
    live = np.arange(blocks[0].shape[1])
    part = np.zeros(len(live), blocks[0].dtype)
    d = 0
    for block in blocks:
        rows = block if len(live) == block.shape[1] else block[:, live]
        diff = rows - query[d : d + len(rows), None]
        part = part + np.einsum("ij,ij->j", diff, diff)
        d += len(rows)
        if np.isfinite(bound):
            slack = (1 + epsilon / np.sqrt(d)) ** 2 if d < dims else 1 + 1e-5
            stay = part <= bound * bound * d / dims * slack
            live, part = live[stay], part[stay]
            if not len(live):
                break
    return live


_FOUND = pa.schema([("query_id", pa.int64()), ("vec_ids", pa.list_(pa.int64())), ("scores", pa.list_(pa.float64()))])


def _search_group(shared, dims: int, k: int, epsilon: float):
    def run(candidates: pa.Table, queries: pa.Table) -> pa.Table:
        index: Index = shared.value
        if not candidates.num_rows or not queries.num_rows:
            return _FOUND.empty_table()
        x = np.frombuffer(b"".join(candidates["vector"].to_pylist()), index.kind).reshape(-1, dims)
        ids, cell = candidates["vec_id"].to_numpy(), candidates["cell"].to_numpy()
        order = np.argsort(cell, kind="stable")
        turned = rotate(x, index.rotation)
        cells = {}
        for rows in np.split(order, np.flatnonzero(np.diff(cell[order])) + 1):
            columns = turned[rows].T
            cells[int(cell[rows[0]])] = rows, [np.ascontiguousarray(columns[d : d + BLOCK_DIMS]) for d in range(0, dims, BLOCK_DIMS)]
        list_of = np.repeat(np.arange(len(index.cells)), index.cells)
        by_list: dict[int, list[int]] = {}
        for c in cells:
            by_list.setdefault(int(list_of[c]), []).append(c)
        q = np.frombuffer(b"".join(queries["vector"].to_pylist()), index.kind).reshape(-1, dims)
        q_turned = rotate(q, index.rotation)
        probed = index.lists(q_turned, index.probes)
        out_ids, out_scores = [], []
        for i in range(len(q)):
            best_ids, best = np.zeros(0, np.int64), np.zeros(0)
            exact = q[i].astype(np.float64)
            for a_list in probed[i]:
                for c in by_list.get(int(a_list), ()):
                    rows, blocks = cells[c]
                    bound = best[k - 1] if len(best) >= k else np.inf
                    live = rows[scan(q_turned[i], blocks, bound, epsilon)]
                    if not len(live):
                        continue
                    score = np.sqrt(((x[live].astype(np.float64) - exact) ** 2).sum(axis=1))
                    best, best_ids = np.r_[best, score], np.r_[best_ids, ids[live]]
                    turn = np.lexsort((best_ids, best))
                    best, best_ids = best[turn], best_ids[turn]
                    fresh = np.r_[True, (best[1:] != best[:-1]) | (best_ids[1:] != best_ids[:-1])]
                    best, best_ids = best[fresh][:k], best_ids[fresh][:k]
            out_ids.append(best_ids.tolist())
            out_scores.append(best.tolist())
        return pa.table([queries["query_id"], pa.array(out_ids, pa.list_(pa.int64())), pa.array(out_scores, pa.list_(pa.float64()))], schema=_FOUND)

    return run


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and embedding of the rows that take part; components are floats, or doubles where they are of another type."""
    kind = "float" if dict(vectors.dtypes)["embedding"] == "array<float>" else "double"
    e = F.col("embedding").cast(f"array<{kind}>")
    bad = F.exists(e, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == F.lit(float("inf"))))
    ok = F.col("vec_id").isNotNull() & (F.size(e) > 0) & ~bad & F.exists(e, lambda v: v != 0)
    return vectors.filter(ok).select(F.col("vec_id").cast("long").alias("vec_id"), e.alias("embedding"))


RESULT = "query_id long, rank int, vec_id long, score double"


def search(vectors: DataFrame, queries: DataFrame, k: int = 10, recall: float = 0.985, epsilon: float = 2.4) -> DataFrame:
    """query_id, rank, vec_id, score: for each row of ``queries`` its k nearest rows of ``vectors`` that it finds.

    Both have vec_id and embedding. Score: Euclidean distance in double precision; ties go to the smaller vec_id.
    Rows with the query's vec_id are its own and no candidates. ``recall`` sets how many lists are probed,
    ``epsilon`` how sure a test must be to abandon a candidate.

    Null, empty and zero vectors, those with a null or non-finite component, and rows without vec_id take no part. A
    query is held against vectors of its own length; each length has its index. Repeated rows count once as
    candidates. No usable row gives an empty result. Other columns are not read.
    """
    rows, asked = usable(vectors), usable(queries)
    if rows.schema["embedding"].dataType != asked.schema["embedding"].dataType:
        rows, asked = (d.withColumn("embedding", F.col("embedding").cast("array<double>")) for d in (rows, asked))
    size = F.size("embedding")
    wanted = asked.select(size.alias("dims")).distinct()
    lengths = rows.groupBy(size.alias("dims")).count().join(wanted, "dims").orderBy("dims").collect()  # a row for each length
    parts = [_search_length(rows.filter(size == n["dims"]), asked.filter(size == n["dims"]), n["dims"], n["count"], k, recall, epsilon) for n in lengths]
    return reduce(DataFrame.unionByName, parts) if parts else vectors.sparkSession.createDataFrame([], RESULT)


def _search_length(all_rows: DataFrame, asked: DataFrame, dims: int, total: int, k: int, recall: float, epsilon: float) -> DataFrame:
    """search() for vectors of one length."""
    spark: SparkSession = all_rows.sparkSession
    kind = np.float32 if dict(all_rows.dtypes)["embedding"] == "array<float>" else np.float64
    sample = all_rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("embedding").toArrow()
    index = fit(_matrix(sample["embedding"].combine_chunks(), dims, kind), total, k, recall)
    shared = spark.sparkContext.broadcast(index)

    wanted = k + 1  # a query finds itself
    groups = asked.groupBy("embedding").agg(F.min("vec_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
    groups = materialize(groups, "queries")
    deal = groups.select(F.col("first_id").alias("vec_id"), "embedding")
    left = all_rows.mapInArrow(_deal_candidates(shared, dims, wanted), "g long, cell long, vec_id long, vector binary")
    right = deal.mapInArrow(_deal_queries(shared, dims), "g long, query_id long, vector binary")
    found = left.groupBy("g").cogroup(right.groupBy("g")).applyInArrow(
        _search_group(shared, dims, wanted, epsilon), "query_id long, vec_ids array<long>, scores array<double>"
    )
    pairs = F.arrays_zip(F.col("scores").alias("score"), F.col("vec_ids").alias("vec_id"))
    merged = found.groupBy("query_id").agg(F.slice(F.sort_array(F.array_distinct(F.flatten(F.collect_list(pairs)))), 1, wanted).alias("hits"))
    n_asked = groups.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    each = join_groups(asked.select(F.col("vec_id").alias("own"), "embedding"), groups, "embedding", "n", n_asked)
    sizes = groups.select(F.col("first_id").alias("query_id"), "n").join(merged, "query_id")
    results = join_groups(each.select("own", F.col("first_id").alias("query_id")), sizes, "query_id", "n", n_asked)
    hits = F.slice(F.filter("hits", lambda h: h["vec_id"] != F.col("own")), 1, k)
    return results.select(F.col("own").alias("query_id"), F.posexplode(hits).alias("p", "hit")).select(
        "query_id", (F.col("p") + 1).cast("int").alias("rank"), F.col("hit.vec_id").alias("vec_id"), F.col("hit.score").alias("score")
    )


def op7_ann_search(spark, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return search(vectors, vectors.filter(F.col("vec_id") % 100 == 0))
