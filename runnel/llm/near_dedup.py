"""Near-duplicates by MinHash bands, odd sketches and a check on full shingle sets.

1. A document's set of distinct 5-word shingles gives 128 MinHash values, 32 bands of 4 of them, and an odd sketch:
   the MinHash values hashed into 512 bits, each flipping its bit. The exclusive or of two odd sketches has as many
   ones as the samples have differences left after parity, which estimates a high similarity closely.
2. Documents of equal sets are one class, represented by the smallest doc_id; classes are found by a sum hash of the
   set, added up before the shuffle.
3. A band bucket's smallest document leads it. Pairs of a document and a leader that pass the odd sketch are checked
   on full sets, for each document the most similar leader first, then the other pairs whose ends are still apart.
4. In buckets that still hold several components, the pairs across components that pass the sketch are found, and of
   them only a spanning forest is kept. Documents that hang together by it are one suspect group.
5. The full sets of a suspect group meet in blocks, where all pairs across components are compared exactly; of the
   links a block keeps those that join components.

So every pair that shares a band and passes the sketch is either compared on full sets or joins two documents that are
already connected. Steps 1 to 3 have rows linear in the size of a group, and the sets of a leader that many pairs name are
copied for each SPREAD of them. In steps 4 and 5 a group of m rows is dealt to the pairs of its blocks, each a task of its
own, with m * m / BLOCK rows in all (sets by BLOCK_SHINGLES). A pair of similarity 0.75 shares no band with probability
5e-6 and is five standard errors above the sketch's threshold.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runnel.llm.components import components
from runnel.llm.shingles import factors, mix, shingle_sets
from runnel.llm.storage import join_groups, materialize
from runnel.llm.text_arrays import pieces, tidy

SAMPLES, ROWS, BITS = 128, 4, 512
WORDS = BITS // 64
#: Documents are linked from 75 % on; the sketch passes from this estimate on.
SHARE, PASS = 75, 0.54
#: Documents of a bucket, and shingles of a suspect group, in a block; two blocks meet in a task.
BLOCK, BLOCK_SHINGLES = 2000, 500_000
#: Pairs of one leader that meet one copy of its set.
SPREAD = 5000
#: Bytes of text whose words and shingles a worker holds at once (or one longer text).
PIECE = 2 << 20

SIGNATURES = "doc_id long, n_shingles long, s1 long, s2 long, sketch array<long>, bands array<long>"
_SIGNATURES_ARROW = pa.schema(
    [(c, pa.int64()) for c in ("doc_id", "n_shingles", "s1", "s2")] + [(c, pa.list_(pa.int64())) for c in ("sketch", "bands")]
)


def minhash(sets: np.ndarray, bounds: np.ndarray, samples: int = SAMPLES) -> np.ndarray:
    """(samples, documents) 32-bit minima; of an empty set the largest number."""
    low, high = sets.astype(np.uint32), (sets >> np.uint64(32)).astype(np.uint32)
    a, b = (factors(samples, s).astype(np.uint32) | np.uint32(1) for s in (21, 22))
    out = np.full((samples, len(bounds) - 1), 0xFFFFFFFF, np.uint32)
    full = np.flatnonzero(bounds[1:] > bounds[:-1])
    starts = bounds[:-1][full]
    i = 0
    while i < len(full):  # runs that stay in the cache
        j = max(i + 1, int(np.searchsorted(starts, starts[i] + 32_768)))
        end = starts[j] if j < len(full) else len(sets)
        x, y, at = low[starts[i] : end], high[starts[i] : end], starts[i:j] - starts[i]
        for k in range(samples):
            out[k, full[i:j]] = np.minimum.reduceat(x * a[k] + y * b[k], at)
        i = j
    return out


def odd_sketch(minima: np.ndarray) -> np.ndarray:
    """(documents, BITS / 64) words: bit p is the parity of the samples that hash to p."""
    samples, n = minima.shape
    key = (np.arange(samples, dtype=np.uint64)[:, None] << np.uint64(32)) | minima
    place = (mix(key) >> np.uint64(40)) % np.uint64(BITS)
    flat = (np.arange(n, dtype=np.int64)[None] * BITS + place.astype(np.int64)).ravel()
    odd = (np.bincount(flat, minlength=n * BITS) & 1).astype(np.uint8).reshape(n, BITS)
    return np.packbits(odd, axis=1).view(np.int64)


def band_keys(minima: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """(documents, bands) keys; a key also tells its band."""
    bands = minima.shape[0] // rows
    grid = minima.reshape(bands, rows, -1).astype(np.uint64)
    by = factors(rows + 1, 31)
    key = sum((grid[:, r] * by[r] for r in range(rows)), np.zeros(grid[:, 0].shape, np.uint64))
    return mix(mix(key) + np.arange(bands, dtype=np.uint64)[:, None] * by[rows]).T.view(np.int64)


@tidy
def _signatures(batches):
    for batch in pieces(batches, PIECE):
        sets, bounds = shingle_sets(batch["text"])
        n = np.diff(bounds)
        upto = np.r_[np.uint64(0), np.cumsum(mix(sets ^ np.uint64(0x5851F42D4C957F2D)))], np.r_[np.uint64(0), np.cumsum(mix(sets + np.uint64(0x14057B7EF767814F)))]
        s1, s2 = ((u[bounds[1:]] - u[bounds[:-1]]).view(np.int64) for u in upto)
        minima = minhash(sets, bounds)

        def lists(m):
            m = np.ascontiguousarray(m)
            return pa.ListArray.from_arrays(np.arange(len(m) + 1, dtype=np.int32) * m.shape[1], m.ravel())

        yield pa.RecordBatch.from_arrays(
            [batch["doc_id"].cast(pa.int64()), pa.array(n), pa.array(s1), pa.array(s2), lists(odd_sketch(minima)), lists(band_keys(minima))],
            schema=_SIGNATURES_ARROW,
        )


@tidy
def _sets(batches):
    for batch in pieces(batches, PIECE):
        sets, bounds = shingle_sets(batch["text"])
        yield pa.RecordBatch.from_arrays(
            [batch["doc_id"].cast(pa.int64()), pa.ListArray.from_arrays(bounds.astype(np.int32), sets.view(np.int64))], names=["id", "shingles"]
        )


def estimate(a: Column, b: Column) -> Column:
    """Similarity from two odd sketches: 1 + n / 4k * ln(1 - 2z / n)."""
    z = reduce(lambda x, y: x + y, [F.bit_count(a[i].bitwiseXOR(b[i])) for i in range(WORDS)])
    return 1 + BITS / (4 * SAMPLES) * F.ln(F.greatest(1 - 2 * z / F.lit(float(BITS)), F.lit(1e-9)))


def _passes(n_a: Column, n_b: Column, est: Column) -> Column:
    """Sizes that can come to 75 %, and the sketch."""
    return (100 * F.least(n_a, n_b) >= SHARE * F.greatest(n_a, n_b)) & (est >= PASS)


def check_pairs(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Those of the pairs (a, b) whose full sets are similar enough. Many pairs may have the same a, the leader."""
    pairs = materialize(pairs.select("a", "b"), "pairs")
    sizes = pairs.groupBy("a").agg(F.count(F.lit(1)).alias("m")).filter(F.col("m") > SPREAD)
    hot = materialize(sizes.withColumn("copies", F.ceil(F.col("m") / SPREAD)), "leaders")
    of_b = sets.select(F.col("id").alias("b"), F.col("shingles").alias("sb"))
    of_a = sets.select(F.col("id").alias("a"), F.col("shingles").alias("sa"))
    if hot.isEmpty():
        both = pairs.join(of_b, "b").join(of_a, "a")
    else:  # of hot leaders the pairs are dealt to copies of the set
        dealt = join_groups(pairs, hot, "a", "m", pairs.count()).join(of_b, "b")
        both = dealt.filter("copies is null").join(of_a, "a").select("a", "b", "sa", "sb")
        copy = F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)).alias("copy")
        copies = of_a.join(hot, "a").select("a", "sa", copy)
        warm = dealt.filter("copies is not null").withColumn("copy", F.pmod(F.xxhash64("b"), F.col("copies")))
        both = both.union(warm.join(copies, ["a", "copy"]).select("a", "b", "sa", "sb"))
    common = F.size(F.array_intersect("sa", "sb"))
    return both.select("a", "b", common.alias("k"), (F.size("sa") + F.size("sb")).alias("s")).filter(
        100 * F.col("k") >= SHARE * (F.col("s") - F.col("k"))
    ).select("a", "b")


def _popcounts(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """(len(x), len(y)) ones in the exclusive or of sketches. Unsigned, as numpy counts the bits of absolute values."""
    x, y = x.view(np.uint64), y.view(np.uint64)
    out = np.zeros((len(x), len(y)), np.uint16)
    for w in range(WORDS):
        out += np.bitwise_count(x[:, w, None] ^ y[None, :, w])
    return out


_PAIRS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _forest(table: pa.Table) -> pa.Table:
    """A spanning forest of the pairs of a cell that are in different components and pass the sketch."""
    most = int((1 - np.exp((PASS - 1) * 4 * SAMPLES / BITS)) * BITS / 2)
    ci, cj = table["ci"][0].as_py(), table["cj"][0].as_py()
    ids, comp, n = (table[c].to_numpy() for c in ("id", "component", "n_shingles"))
    block, sketch = table["block"].to_numpy(), np.array(table["sketch"].to_pylist(), np.int64).reshape(-1, WORDS)
    ok = np.zeros((len(ids), len(ids)), bool)
    for i in range(0, len(ids), 256):
        r = slice(i, i + 256)
        small, large = np.minimum(n[r, None], n[None]), np.maximum(n[r, None], n[None])
        ok[r] = (comp[r, None] != comp[None]) & (100 * small >= SHARE * large) & (_popcounts(sketch[r], sketch) <= most)
        if ci != cj:
            ok[r] &= block[r, None] != block[None]
    left = ok.any(axis=1)
    out = []
    while left.any():
        front = np.flatnonzero(left)[:1]
        left[front] = False
        while len(front):
            step = ok[front] & left
            new = np.flatnonzero(step.any(axis=0))
            out.append(np.stack([ids[front[step[:, new].argmax(axis=0)]], ids[new]]))
            left[new] = False
            front = new
    pairs = np.concatenate(out, axis=1) if out else np.zeros((2, 0), np.int64)
    return pa.table([pa.array(pairs.min(axis=0)), pa.array(pairs.max(axis=0))], schema=_PAIRS)


def _exact(table: pa.Table) -> pa.Table:
    """Links on full sets between the two blocks of a cell, as far as they join components."""
    ids, label, block = (table[c].to_numpy().copy() for c in ("id", "component", "block"))
    lists = table["shingles"].combine_chunks()
    bounds = np.r_[0, np.cumsum(pc.list_value_length(lists).to_numpy())]
    distinct, code = np.unique(lists.flatten().to_numpy(), return_inverse=True)
    size = np.diff(bounds)
    rows = np.flatnonzero(block == table["ci"][0].as_py())
    others = np.flatnonzero(block == table["cj"][0].as_py())
    begin = np.cumsum(size[others]) - size[others]
    flat = np.concatenate([code[bounds[j] : bounds[j + 1]] for j in others]) if len(others) else code[:0]
    mark, out = np.zeros(len(distinct), bool), []
    for i in rows:
        apart = label[others] != label[i]
        if not apart.any():
            continue
        mine = code[bounds[i] : bounds[i + 1]]
        mark[mine] = True
        common = np.add.reduceat(mark[flat], begin, dtype=np.int64)
        mark[mine] = False
        for j in others[apart & (100 * common >= SHARE * (size[i] + size[others] - common))]:
            if label[i] != label[j]:
                out.append((ids[i], ids[j]))
                label[label == label[j]] = label[i]
    pairs = np.array(out, np.int64).reshape(-1, 2)
    return pa.table([pa.array(pairs.min(axis=1)), pa.array(pairs.max(axis=1))] if len(pairs) else [[], []], schema=_PAIRS)


def _cells(rows: DataFrame) -> DataFrame:
    """Rows dealt to the pairs of blocks (ci, cj) of their key; ``blocks`` says how many the key has."""
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks"))).withColumn("other", other)
    return rows.withColumn("ci", F.least("block", "other")).withColumn("cj", F.greatest("block", "other"))


def suspects(members: DataFrame, reps: DataFrame, comps: DataFrame) -> DataFrame:
    """Forest pairs (a, b) of the buckets that hold several components."""
    at = members.join(comps, "id", "left").select("key", "id", F.coalesce("component", "id").alias("component"))
    at = materialize(at, "labelled")
    open_keys = at.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y"), F.count(F.lit(1)).alias("m"))
    open_keys = open_keys.filter("x <> y").select("key", "m", F.ceil(F.col("m") / BLOCK).alias("blocks"))
    rows = join_groups(at, open_keys, "key", "m", at.count()).filter("m is not null").drop("m")
    cells = _cells(rows.join(reps.select("id", "n_shingles", "sketch"), "id"))
    return cells.groupBy("key", "ci", "cj").applyInArrow(_forest, "a long, b long").distinct()


def links_across(groups: DataFrame, reps: DataFrame, sets: DataFrame, comps: DataFrame) -> DataFrame:
    """Links (a, b) that join components within the suspect groups (id, component as group)."""
    rows = groups.select("id", F.col("component").alias("suspect")).join(reps.select("id", F.col("n_shingles").alias("n")), "id")
    rows = materialize(rows, "suspected")
    size = rows.groupBy("suspect").agg(F.count(F.lit(1)).alias("m"), F.ceil(F.sum("n") / BLOCK_SHINGLES).alias("blocks"))
    # Sets join by id and are dealt by cell, so a large group is many tasks.
    rows = join_groups(rows, size, "suspect", "m", rows.count()).select("suspect", "id", "blocks").join(comps, "id", "left")
    rows = rows.select("suspect", "id", "blocks", F.coalesce("component", "id").alias("component")).join(sets, "id")
    return _cells(rows).groupBy("suspect", "ci", "cj").applyInArrow(_exact, "a long, b long")


def near_dedup(documents: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    Words are runs of non-space, lower-cased in A-Z. A document without text or words has an empty set, is linked
    with nothing and its own component. Fewer than five words are one shingle. Rows that repeat a doc_id are the
    same vertex. A row without doc_id gets the component of the documents with its set, else null, and is kept only
    in that case. An empty table gives no rows. Other columns are not read.
    """
    documents = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sig = materialize(documents.mapInArrow(_signatures, SIGNATURES), "signatures")
    total = sig.count()
    c = F.struct("n_shingles", "s1", "s2").alias("c")
    classes = sig.filter("n_shingles > 0").groupBy(c).agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("size"))
    classes = materialize(classes, "classes")
    reps = sig.join(classes.select(F.col("rep").alias("doc_id")).distinct(), "doc_id").filter("n_shingles > 0")
    reps = materialize(reps.select(F.col("doc_id").alias("id"), "n_shingles", "sketch", "bands"), "representatives")

    rows = reps.select(F.explode("bands").alias("key"), "id")
    buckets = rows.groupBy("key").agg(F.min("id").alias("lead"), F.max("id").alias("last"))
    members = materialize(rows.join(buckets.filter("lead < last").select("key", "lead"), "key"), "members")
    known = reps.select("id", "n_shingles", "sketch")
    star = materialize(members.filter("id <> lead").select("lead", "id").distinct(), "led")
    lead = known.select(*[F.col(x).alias(f"{x}_l") for x in known.columns]).withColumnRenamed("id_l", "lead")
    lead = lead.join(star.groupBy("lead").agg(F.count(F.lit(1)).alias("m")), "lead")
    star = join_groups(star, lead, "lead", "m", star.count()).join(known, "id").select(
        F.col("lead").alias("a"), F.col("id").alias("b"), "n_shingles", "n_shingles_l", estimate(F.col("sketch"), F.col("sketch_l")).alias("est")
    )
    star = materialize(star.filter(_passes(F.col("n_shingles"), F.col("n_shingles_l"), F.col("est"))).select("a", "b", "est"), "star")
    ids = members.select(F.col("id").alias("doc_id")).distinct()
    sets = materialize(documents.join(ids, "doc_id", "left_semi").mapInArrow(_sets, "id long, shingles array<long>"), "sets")

    first = star.groupBy("b").agg(F.max_by("a", F.struct("est", -F.col("a"))).alias("a")).select("a", "b")
    edges = materialize(check_pairs(first, sets), "links")
    comps = components(edges)
    rest = star.select("a", "b")
    for v in ("a", "b"):
        rest = rest.join(comps.select(F.col("id").alias(v), F.col("component").alias(f"c{v}")), v, "left")
    rest = rest.filter(F.coalesce("ca", "a") != F.coalesce("cb", "b")).select("a", "b").join(first, ["a", "b"], "left_anti")
    found = materialize(check_pairs(rest, sets), "links")
    if not found.isEmpty():
        edges = edges.unionByName(found)
        comps = components(edges)
    forest = materialize(suspects(members, reps, comps), "suspects")
    if not forest.isEmpty():
        found = materialize(links_across(components(forest), reps, sets, comps), "links")
        if not found.isEmpty():
            comps = components(edges.unionByName(found))

    linked = classes.join(comps.select(F.col("id").alias("rep"), "component"), "rep", "left")
    linked = linked.select("c", F.coalesce("component", "rep").alias("component"), "size", "rep").filter("size > 1 or component <> rep")
    out = join_groups(sig.select("doc_id", "n_shingles", c), linked.select("c", "component", "size"), "c", "size", total)
    component = F.coalesce("component", "doc_id")
    return out.select(
        "doc_id", "n_shingles", component.alias("component_id"), component.eqNullSafe(F.col("doc_id")).alias("kept")
    )


def survivors(documents: DataFrame) -> DataFrame:
    """One document of each group (the smallest doc_id), with all columns."""
    gone = near_dedup(documents).filter("not kept").select("doc_id")
    return documents.join(gone, "doc_id", "left_anti").select(documents.columns)


def op8_near_dedup(spark, sf_dir: str) -> DataFrame:
    return near_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP8_SQL = r"""
WITH RECURSIVE listed AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, array_to_string(ws[p : p + 4], ' ') AS s
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS p FROM listed WHERE len(ws) > 0)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), common AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * k >= 75 * (x.n + y.n - k)
), reach(id, other) AS (
  SELECT doc_id, doc_id FROM listed UNION SELECT r.id, l.b FROM reach r JOIN links l ON l.a = r.other
), component AS (
  SELECT id, min(other) AS component_id FROM reach GROUP BY id
)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
FROM listed LEFT JOIN sizes USING (doc_id) JOIN component ON id = doc_id
"""
