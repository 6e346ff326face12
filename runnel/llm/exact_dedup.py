"""Exact dedup through minimal perfect hash tables over the digests of history.

History is kept as shards. A shard is a minimal perfect hash over its distinct SHA-256 digests: ``n`` slots
for ``n`` digests, each slot with the full digest, the locator of the winner (the largest doc_id) and the
number of rows. A new batch is looked up there; a perfect hash sends every key to some slot, so the 32 bytes
are compared, and only equal ones are repeats. Digests that history lacks form groups of their own.

Rows are brought to one per digest before they are shuffled, so a text that a third of all rows share is
one row per task. Only digests travel; the text is read once.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runnel.llm.storage import join_groups, materialize

#: Slots of a shard at most (about 50 bytes each), and how many shards a small table gets.
SHARD_SLOTS, SPREAD, LEAST_SLOTS = 1 << 18, 256, 512

INDEX = "shard long, slots int, displacement binary, digests binary, winners binary, counts binary"
GROUPS = "digest binary, keep_id long, group_size long, in_history boolean"


def _words(digests: np.ndarray) -> np.ndarray:
    """(n, 32) bytes -> (n, 4) unsigned 64-bit words."""
    return np.ascontiguousarray(digests).view("<u8").reshape(len(digests), 4)


def _place(w: np.ndarray, displacement, n: int) -> np.ndarray:
    d = np.asarray(displacement).astype(np.uint64)
    mixed = (w[..., 1] + d * (w[..., 2] | np.uint64(1))) ^ (w[..., 3] >> np.uint64(17))
    return ((mixed >> np.uint64(11)) % np.uint64(n)).astype(np.int64)


def _bucket(w: np.ndarray, n: int) -> np.ndarray:
    return (w[..., 0] % np.uint64(max(1, (n + 3) // 4))).astype(np.int64)


def build_table(digests: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Displacement of each bucket, and the slot of each digest: a permutation of 0..n-1.

    Buckets of about four keys are placed largest first, each by the least displacement that puts all its keys
    into free slots; a bucket of one key names its slot outright, as ``-1 - slot``. Digests must be distinct.
    """
    n = len(digests)
    w = _words(digests)
    bucket = _bucket(w, n)
    displacement = np.zeros(max(1, (n + 3) // 4), dtype=np.int64)
    slot = np.full(n, -1, dtype=np.int64)
    taken = np.zeros(n, dtype=bool)
    order = np.argsort(bucket, kind="stable")
    starts = np.flatnonzero(np.r_[True, np.diff(bucket[order]) != 0]) if n else np.zeros(0, int)
    sizes = np.diff(np.r_[starts, n])
    for i in np.argsort(-sizes, kind="stable"):
        keys = order[starts[i] : starts[i] + sizes[i]]
        if sizes[i] == 1:
            break
        first = 0
        while True:
            tries = np.arange(first, first + 32)
            at = np.sort(_place(w[keys][None], tries[:, None], n), axis=1)
            good = ~taken[at].any(axis=1) & (np.diff(at, axis=1) > 0).all(axis=1)
            if good.any():
                break
            first += 32
        d = first + int(np.argmax(good))
        displacement[bucket[keys[0]]] = d
        slot[keys] = _place(w[keys], d, n)
        taken[slot[keys]] = True
    free = np.flatnonzero(~taken)
    single = np.flatnonzero(slot < 0)
    slot[single] = free
    displacement[bucket[single]] = -1 - free
    return displacement, slot


def look_up(digests: np.ndarray, displacement: np.ndarray, n: int) -> np.ndarray:
    """The only slot in which each digest can lie."""
    w = _words(digests)
    d = displacement[_bucket(w, n)]
    return np.where(d < 0, -1 - d, _place(w, np.maximum(d, 0), n))


def _bytes(column: pa.ChunkedArray) -> np.ndarray:
    values = column.combine_chunks()
    return np.frombuffer(b"".join(values.to_pylist()), np.uint8).reshape(-1, 32)


def _int64(column: pa.ChunkedArray) -> np.ndarray:
    """Null locators (no row of the text has a doc_id) are kept as the least long."""
    return column.fill_null(-(2**63)).to_numpy()


def _build_shard(table: pa.Table) -> pa.Table:
    digests = _bytes(table["digest"])
    displacement, slot = build_table(digests)
    turn = np.argsort(slot)
    row = {
        "shard": table["shard"][0].as_py(),
        "slots": len(digests),
        "displacement": displacement.tobytes(),
        "digests": digests[turn].tobytes(),
        "winners": _int64(table["keep_id"])[turn].tobytes(),
        "counts": table["group_size"].to_numpy()[turn].tobytes(),
    }
    return pa.Table.from_pylist([row], schema=_INDEX_ARROW)


_INDEX_ARROW = pa.schema(
    [("shard", pa.int64()), ("slots", pa.int32())]
    + [(c, pa.binary()) for c in ("displacement", "digests", "winners", "counts")]
)
_GROUPS_ARROW = pa.schema(
    [("digest", pa.binary()), ("keep_id", pa.int64()), ("group_size", pa.int64()), ("in_history", pa.bool_())]
)


def _groups(digests, keep, size, known) -> pa.Table:
    null = keep == -(2**63)
    return pa.table(
        [
            pa.array([bytes(d) for d in digests], pa.binary()),
            pa.array(keep, pa.int64(), mask=null),
            pa.array(size, pa.int64()),
            pa.array(known, pa.bool_()),
        ],
        schema=_GROUPS_ARROW,
    )


def _merge_shard(index: pa.Table, batch: pa.Table) -> pa.Table:
    """All groups of a shard once the batch (one row per digest) is looked up in it."""
    new, keep, size = _bytes(batch["digest"]), _int64(batch["keep_id"]), batch["group_size"].to_numpy()
    if not index.num_rows:
        return _groups(new, keep, size, np.zeros(len(new), bool))
    row = index.to_pylist()[0]
    n = row["slots"]
    held = np.frombuffer(row["digests"], np.uint8).reshape(n, 32)
    winners = np.frombuffer(row["winners"], np.int64).copy()
    counts = np.frombuffer(row["counts"], np.int64).copy()
    at = look_up(new, np.frombuffer(row["displacement"], np.int64), n)
    same = (held[at] == new).all(axis=1)
    winners[at[same]] = np.maximum(winners[at[same]], keep[same])
    counts[at[same]] += size[same]
    out = ~same
    return _groups(
        np.concatenate([held, new[out]]),
        np.concatenate([winners, keep[out]]),
        np.concatenate([counts, size[out]]),
        np.r_[np.ones(n, bool), np.zeros(int(out.sum()), bool)],
    )


def digest_rows(documents: DataFrame) -> DataFrame:
    """doc_id and the digest of the whole text; null counts as empty."""
    return documents.select("doc_id", F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256)).alias("digest"))


def _per_digest(rows: DataFrame, shards: int) -> DataFrame:
    groups = rows.groupBy("digest").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    return groups.withColumn("shard", F.pmod(F.xxhash64("digest"), F.lit(shards)))


def shard_count(distinct_at_most: int) -> int:
    """Shards of at most SHARD_SLOTS digests; a small table is spread over up to SPREAD of them."""
    return max(-(-distinct_at_most // SHARD_SLOTS), min(SPREAD, -(-distinct_at_most // LEAST_SLOTS)), 1)


def build_history(history: DataFrame, shards: int) -> DataFrame:
    """The index over rows (doc_id, digest): one row per shard."""
    return _per_digest(history, shards).groupBy("shard").applyInArrow(_build_shard, INDEX)


def merge_batch(index: DataFrame, batch: DataFrame, shards: int) -> DataFrame:
    """Groups (digest, keep_id, group_size, in_history) of history and a batch of rows (doc_id, digest)."""
    new = _per_digest(batch, shards)
    return index.groupBy("shard").cogroup(new.groupBy("shard")).applyInArrow(_merge_shard, GROUPS)


def exact_dedup(documents: DataFrame, history_upto: int | None = None) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    ``history_upto``: rows with a doc_id up to it are history and go into the index, all others are the new
    batch; by default the middle of the range of doc_ids. The result does not depend on it.

    Null text is empty text. A null doc_id never wins over another; in a group with no doc_id at all keep_id is
    null and all its rows stay. Rows repeated with their doc_id get the same values, all kept, as they are one
    document. An empty table gives no rows. Other columns are not read.
    """
    rows = materialize(digest_rows(documents), "digests")
    low, high, total = rows.agg(F.min("doc_id"), F.max("doc_id"), F.count(F.lit(1))).first()
    if history_upto is None:
        history_upto = 0 if low is None else low + (high - low) // 2
    shards = shard_count(total)
    old = F.coalesce(F.col("doc_id") <= history_upto, F.lit(False))
    index = materialize(build_history(rows.filter(old), shards), "history")
    groups = materialize(merge_batch(index, rows.filter(~old), shards), "groups")
    more = groups.filter("group_size > 1").select("digest", "keep_id", "group_size")
    joined = join_groups(rows, more, "digest", "group_size", total)
    repeated = F.col("group_size").isNotNull()
    keep = F.when(repeated, F.col("keep_id")).otherwise(F.col("doc_id"))
    return joined.select(
        "doc_id",
        keep.alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        keep.eqNullSafe(F.col("doc_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def survivors(documents: DataFrame) -> DataFrame:
    """The documents that stay, with all their columns: one row of each text, that with the largest doc_id.

    Rows are told apart by doc_id and text, so of two texts under one doc_id each is judged by itself. Of rows that
    repeat both, and of a text whose rows have no doc_id at all, one row stays; which one is open where other columns differ.
    """
    judged = exact_dedup(documents).filter("group_size > 1").groupBy("text_sha256")
    judged = judged.agg(F.max("keep_id").alias("_keep"), F.count_if("kept").alias("_ties"))
    judged = materialize(judged.withColumnRenamed("text_sha256", "_sha"), "judged")
    digest = F.sha2(F.coalesce("text", F.lit("")), 256)
    rows = documents.select(F.struct(*documents.columns).alias("_row"), digest.alias("_sha")).join(judged, "_sha", "left")
    rows = rows.filter(F.col("_ties").isNull() | F.col("_keep").eqNullSafe(F.col("_row.doc_id")))
    if judged.filter("_ties > 1").isEmpty():
        return rows.select("_row.*")
    one = rows.filter("_ties > 1").groupBy("_sha").agg(F.first("_row").alias("_row"))
    return rows.filter("_ties is null or _ties = 1").select("_row.*").unionByName(one.select("_row.*"))


def op1_exact_dedup(spark, sf_dir: str) -> DataFrame:
    return exact_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP1_SQL = """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
  doc_id IS NOT DISTINCT FROM max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))
"""
