"""Importance resampling of documents towards a target corpus, by hashed n-gram features.

1. Each piece of the corpus (about PIECE bytes of texts, cut in slices) gives its distinct n-grams once, as strings, with their
   occurrences in the piece, and the counts of each of its documents by the number of the n-gram in the piece.
2. The dictionary adds up the strings of all pieces and of the target. Each distinct string is hashed once, to
   one of ``buckets`` buckets; the buckets add up what their strings count.
3. A bucket's gain is the log ratio of its smoothed shares in target and corpus. Gains go to the strings of the
   dictionary, from there to the pieces that hold them (an n-gram is one row a piece, however frequent it is), and in a
   piece to the counts of its documents, whose mean gain is their weight.
4. Weights plus Gumbel noise, which comes from a digest of seed and doc_id, rank the documents: the largest are a sample without
   replacement by importance. A histogram of the scores finds the last one that can be drawn; only documents from there on
   are ordered, in ranges.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runnel.llm.storage import materialize
from runnel.llm.terms import WORD_TERMS, coded, distinct_pairs, folded, piece_ids
from runnel.llm.text_arrays import pieces, tidy

#: Bytes of text that are a piece, and that are cut into n-grams at once (or one longer text).
PIECE, SLICE = 16 << 20, 4 << 20
#: Hashes of 32 bits as numbers between 0 and 1.
SPAN = 4294967296
#: Digits below which monotonically_increasing_id numbers the rows of a partition.
ROW_BITS = 33


def n_grams(data: np.ndarray, offsets: np.ndarray, shortest: int, longest: int) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """Of folded texts: the distinct n-grams, the number of each n-gram in turn and its text, and the words of each text."""
    terms, code, bounds = coded(data, offsets)
    size = np.diff(bounds)
    text = np.repeat(np.arange(len(size)), size)
    if shortest == longest == 1:
        return terms, code, text, size
    left = np.repeat(bounds[1:], size) - np.arange(len(code))  # words from here to the end of the text
    runs, texts = [], []
    for n in range(shortest, longest + 1):
        at = np.flatnonzero(left >= n)
        runs.append(pc.binary_join_element_wise(*[terms.take(pa.array(code[at + j])) for j in range(n)], pa.scalar(" ", pa.large_string())))
        texts.append(text[at])
    found = pa.concat_arrays(runs).dictionary_encode()
    return found.dictionary, found.indices.to_numpy(), np.concatenate(texts), size


def _counted_schema(kind: str) -> str:
    return f"piece long, features array<string>, totals array<long>, doc_ids array<{kind}>, words array<long>, sizes array<int>, codes array<int>, counts array<int>"


def _one_list(values: pa.Array | np.ndarray) -> pa.Array:
    """A column of one row that holds all the values."""
    values = values if isinstance(values, pa.Array) else pa.array(values)
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def _piece(number: int, parts: list[tuple]) -> pa.RecordBatch:
    """The slices of a piece as one: their n-grams are numbered anew."""
    features, totals, doc_ids, words, sizes, codes, counts = zip(*parts, strict=True)
    found = pa.concat_arrays(features).dictionary_encode()
    into = found.indices.to_numpy()
    total = np.zeros(len(found.dictionary), np.int64)
    np.add.at(total, into, np.concatenate(totals))
    before = np.cumsum([0, *map(len, features)])
    columns = {
        "features": found.dictionary.cast(pa.string()), "totals": total, "doc_ids": pa.concat_arrays(doc_ids),
        "words": np.concatenate(words), "sizes": np.concatenate(sizes),
        "codes": np.concatenate([into[at + code] for at, code in zip(before.tolist(), codes, strict=False)]).astype(np.int32),
        "counts": np.concatenate(counts),
    }
    lists = {name: _one_list(v) for name, v in columns.items()}
    return pa.RecordBatch.from_pydict({"piece": pa.array([number], pa.int64()), **lists})


def _count(shortest: int, longest: int):
    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, parts, size = piece_ids(), [], 0
        for batch in pieces(batches, SLICE):
            data, offsets = folded(batch["text"], WORD_TERMS)
            features, code, text, words = n_grams(data, offsets, shortest, longest)
            owner, feature, n = distinct_pairs(text, code, len(features))
            order = np.argsort(owner, kind="stable")
            sizes = np.bincount(owner, minlength=len(words)).astype(np.int32)
            totals = np.bincount(code, minlength=len(features))
            parts.append((features, totals, batch["doc_id"], words.astype(np.int64), sizes, feature[order].astype(np.int32), n[order].astype(np.int32)))
            size += len(data)
            if size >= PIECE:
                yield _piece(next(number), parts)
                parts, size = [], 0
        if parts:
            yield _piece(next(number), parts)

    return run


_WEIGHED = ["piece", "doc_id", "n_words", "n_features", "weight", "at"]


def _weigh(pieces_of: pa.Table, gains: pa.Table) -> pa.Table:
    """The documents of one piece (a row) with their floored mean gain; gains: i, gain of its n-grams."""
    if not pieces_of.num_rows:
        return pa.table([pa.array([], pieces_of.schema.field("doc_ids").type.value_type if k == "doc_id" else pa.int64()) for k in _WEIGHED], names=_WEIGHED)
    of = {name: pieces_of[name].combine_chunks().flatten() for name in ("doc_ids", "words", "sizes", "codes", "counts")}
    sizes, codes, counts, words = (of[name].to_numpy(zero_copy_only=False) for name in ("sizes", "codes", "counts", "words"))
    gain = np.zeros(gains.num_rows, np.int64)
    gain[gains["i"].to_numpy()] = gains["gain"].to_numpy()
    doc = np.repeat(np.arange(len(sizes)), sizes)
    n, total = np.zeros((2, len(sizes)), np.int64)
    np.add.at(n, doc, counts)
    np.add.at(total, doc, gain[codes] * counts)
    weight = np.where(n > 0, total // np.maximum(n, 1), 0)
    piece = np.full(len(n), pieces_of["piece"][0].as_py())
    return pa.table([pa.array(c) for c in (piece, of["doc_ids"], words, n, weight, np.arange(len(n)))], names=_WEIGHED)


def count_features(texts: DataFrame, shortest: int, longest: int) -> DataFrame:
    """Rows (doc_id, text) by pieces, a row each: the distinct n-grams and the counts of the documents."""
    kind = texts.schema["doc_id"].dataType.simpleString()
    return texts.mapInArrow(_count(shortest, longest), _counted_schema(kind))


def dictionary(corpus: DataFrame, target: DataFrame, buckets: int) -> DataFrame:
    """feature, bucket, s, t: every distinct n-gram with its occurrences in corpus and target, hashed once."""
    nothing = F.lit(0).cast("long")
    sides = []
    for counted, s, t in ((corpus, F.col("f.totals"), nothing), (target, nothing, F.col("f.totals"))):
        rows = counted.select(F.explode(F.arrays_zip("features", "totals")).alias("f"))
        sides.append(rows.select(F.col("f.features").alias("feature"), s.alias("s"), t.alias("t")))
    total = sides[0].unionByName(sides[1]).groupBy("feature").agg(F.sum("s").alias("s"), F.sum("t").alias("t"))
    return materialize(total.withColumn("bucket", F.crc32(F.col("feature").cast("binary")) % buckets), "dictionary")


def bucket_gains(features: DataFrame, buckets: int) -> DataFrame:
    """bucket, gain: at most ``buckets`` rows."""
    per = features.groupBy("bucket").agg(F.sum("s").alias("s"), F.sum("t").alias("t"))
    corpus, target = (float(x or 0) for x in features.agg(F.sum("s"), F.sum("t")).first())
    s, t = F.col("s").cast("double"), F.col("t").cast("double")
    ratio = (t + 1) * F.lit(corpus + buckets) / ((s + 1) * F.lit(target + buckets))
    return per.select("bucket", F.floor(1000 * F.log(ratio)).alias("gain"))


def weigh(corpus: DataFrame, features: DataFrame, gains: DataFrame) -> DataFrame:
    """piece, doc_id, n_words, n_features, weight, at (the document's place in its piece)."""
    by_feature = features.filter("s > 0").join(F.broadcast(gains), "bucket").select("feature", "gain")
    held = corpus.select("piece", F.posexplode("features").alias("i", "feature")).join(by_feature, "feature").select(F.col("piece").alias("of"), "i", "gain")
    rows = corpus.select("piece", "doc_ids", "words", "sizes", "codes", "counts").groupBy("piece").cogroup(held.groupBy("of"))
    kind = corpus.schema["doc_ids"].dataType.elementType.simpleString()
    return rows.applyInArrow(_weigh, f"piece long, doc_id {kind}, n_words long, n_features long, weight long, at long")


def noise(seed: str, key: Column) -> Column:
    """Gumbel noise in thousandths, from the first 32 bits of a SHA-256 of seed and key."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(float(SPAN)))))


def _ranked(candidates: DataFrame) -> DataFrame:
    """``rank`` by falling score, ties by doc_id (null last): ranges are ordered each by itself and numbered in turn."""
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("piece"), F.asc("at")]
    sorted_ranges = candidates.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_row", F.monotonically_increasing_id())
    rows = materialize(sorted_ranges, "ranges")
    part = F.shiftright("_row", ROW_BITS)
    sizes = sorted(tuple(r) for r in rows.groupBy(part.alias("part")).count().collect())  # a row for each range
    before = np.cumsum([0, *[n for _, n in sizes]]).tolist()
    starts = rows.sparkSession.createDataFrame([(p, b) for (p, _), b in zip(sizes, before, strict=False)], "_part long, _before long")
    joined = rows.withColumn("_part", part).join(F.broadcast(starts), "_part")
    return joined.withColumn("rank", F.col("_before") + F.col("_row").bitwiseAND((1 << ROW_BITS) - 1) + 1)


def resample(
    documents: DataFrame, target: DataFrame, shortest: int = 1, longest: int = 1, buckets: int = 10_000, least_words: int = 20, percent: int = 10, seed: str = "2024"
) -> DataFrame:
    """doc_id, n_features, weight, score, rank of every row of ``documents``; rank is null where a document is not drawn.

    target: a table with a column text. Features are runs of ``shortest`` to ``longest`` words. Of the documents with
    ``least_words`` words or more, ``percent`` in a hundred are drawn (rounded down). Null texts are empty, have weight 0 and are not drawn. Rows that
    repeat a doc_id have the same noise and are each ranked; rows equal in score and doc_id are ranked in any
    order, as are rows without doc_id, which come after those that have one. An empty target gives gains
    from the corpus alone; an empty table gives no rows. Other columns are not read.
    """
    # A row is a whole piece: each is a row group of its own, so writers and readers hold one at a time.
    corpus = materialize(count_features(documents.select("doc_id", "text"), shortest, longest), "counts", options={"parquet.block.row.count.limit": "1"})
    wanted = count_features(target.select(F.lit(None).cast("long").alias("doc_id"), "text"), shortest, longest)
    features = dictionary(corpus, wanted, buckets)
    weighed = weigh(corpus, features, bucket_gains(features, buckets))
    scored = materialize(weighed.withColumn("score", F.col("weight") + noise(seed, F.col("doc_id"))), "scores")
    able = F.col("n_words") >= least_words
    # Logarithms of 64-bit counts and the noise of 32 bits, in thousandths, allow some 200,000 different scores at most.
    histogram = sorted(tuple(r) for r in scored.filter(able).groupBy("score").count().collect())[::-1]
    up_to = np.cumsum([n for _, n in histogram])
    drawn = int(up_to[-1]) * percent // 100 if histogram else 0
    columns = ["doc_id", "n_features", "weight", "score"]
    nothing = F.lit(None).cast("long").alias("rank")
    if not drawn:
        return scored.select(*columns, nothing)
    last = histogram[int(np.searchsorted(up_to, drawn))][0]
    candidate = able & (F.col("score") >= last)
    ranked = _ranked(scored.filter(candidate))
    return ranked.select(*columns, F.when(F.col("rank") <= drawn, F.col("rank")).alias("rank")).unionByName(scored.filter(~candidate).select(*columns, nothing))


def drawn_documents(documents: DataFrame, target: DataFrame, **options) -> DataFrame:
    """The rows of ``documents`` whose doc_id is drawn, all columns as they are."""
    drawn = resample(documents, target, **options).filter("rank is not null").select(F.col("doc_id").alias("_drawn")).distinct()
    return documents.join(drawn, F.col("doc_id").eqNullSafe(F.col("_drawn")), "left_semi")


def op12_importance_resampling(spark, sf_dir: str) -> DataFrame:
    return resample(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


OP12_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
b AS (
  SELECT unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS f
  FROM benchmark),
per AS (SELECT doc_id, f, count(*) AS n FROM (SELECT doc_id, unnest(w) AS f FROM d) GROUP BY ALL),
f AS (
  SELECT f, sum(s) AS s, sum(t) AS t, hex(f) AS h
  FROM (SELECT f, n AS s, 0 AS t FROM per UNION ALL SELECT f, 0, 1 FROM b) GROUP BY f),
-- CRC-32, as the library has no function of it.
step AS (
  SELECT list(list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) ORDER BY i) AS of
  FROM range(256) r(i)),
hashed AS (
  SELECT f, s, t, xor(4294967295, list_reduce(
      list_transform(range(length(h) // 2), lambda k: ('0x' || substr(h, 2 * k + 1, 2))::BIGINT),
      lambda c, x: xor(c >> 8, of[(xor(c, x) & 255) + 1]), 4294967295)) % 10000 AS bucket
  FROM f, step),
gain AS (
  SELECT bucket, floor(1000 * ln((sum(t) + 1)::DOUBLE * ((SELECT sum(s) FROM f) + 10000)::DOUBLE
    / ((sum(s) + 1)::DOUBLE * ((SELECT sum(t) FROM f) + 10000)::DOUBLE)))::BIGINT AS gain
  FROM hashed GROUP BY bucket),
weighed AS (
  SELECT doc_id, sum(n)::BIGINT AS n, sum(n * gain)::BIGINT AS total FROM per JOIN hashed USING (f) JOIN gain USING (bucket) GROUP BY doc_id),
scored AS (
  SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_features, coalesce(floor(total::DOUBLE / n), 0)::BIGINT AS weight,
    coalesce(floor(total::DOUBLE / n), 0)::BIGINT
      + floor(-1000 * ln(-ln((('0x' || left(sha256('2024:' || d.doc_id), 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
  FROM d LEFT JOIN weighed USING (doc_id)),
ranked AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS able FROM scored WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= 10 * able // 100 THEN rank END::BIGINT AS rank
FROM scored LEFT JOIN ranked USING (doc_id)
"""
