"""Mixing sources to target weights by Pareto order sampling.

A source's target is its weighted share of a budget of words, at most ``cap`` times what it has; what the cap
leaves over is shared anew by weight. A document of weight w is due e = min(cap, level * w) copies; a source's level is
the one at which its due words come to its target. floor(e) whole copies are certain. The fraction
p = e - floor(e) is an inclusion probability: documents are ranked by random odds over inclusion odds,
(u / (1 - u)) / (p / (1 - p)), and the first ones are taken until the source's remaining words are used.

u comes from an MD5 of seed and doc_id, so every rerun and every executor agrees.

The rank is not found by sorting a source: a histogram of its ranks (BUCKETS rows a source, added up before
the shuffle) names the one bucket in which the words run out, and only that bucket is ordered.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from runnel.llm.storage import materialize

WORD = r"[^\x20\x09-\x0D]+"
BUCKETS = 4096
#: A table of up to so many sources (about 100 bytes each) is broadcast; a larger one is joined on salted keys.
BROADCAST_SOURCES, SALTS = 200_000, 64
#: Weights are rounded to so many steps to a power of two, so a source has a bounded number of classes of them.
STEPS = 8


def n_words(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def uniform(seed: str, key: Column) -> Column:
    """52 bits of an MD5 as a number in [0, 1)."""
    digest = F.md5(F.concat(F.lit(seed + "|"), F.coalesce(key.cast("string"), F.lit(""))))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


def source_targets(sizes: DataFrame, weights: tuple = (3, 1, 2), share: float = 1.5, cap: int = 2) -> DataFrame:
    """source, source_size, target. Sources by code point, null last, take the weights in turn.

    The targets that stop at the cap are those of the least cap/weight: going through the sources in that
    order, the first whose cap bears the level that is left ends the capped ones.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    turn = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    pick = F.element_at(F.array(*[F.lit(w).cast("long") for w in weights]), (turn % len(weights) + 1).cast("int"))
    per = per.withColumn("w", pick).withColumn("cap", F.col("source_size") * cap)
    by_level = W.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    per = per.select(
        "*",
        F.row_number().over(by_level).alias("i"),
        (
            F.sum("source_size").over(W.partitionBy()) * F.lit(share)
            - F.coalesce(F.sum("cap").over(by_level.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
        ).alias("left"),
        F.sum("w").over(by_level.rowsBetween(0, W.unboundedFollowing)).alias("w_left"),
    )
    bears = F.col("cap") * F.col("w_left") >= F.col("w") * F.col("left")
    first = F.min_by(F.struct("i", "left", "w_left"), F.when(bears, F.col("i"))).over(W.partitionBy())
    per = per.withColumn("first", first)
    target = F.when(F.col("i") < F.col("first.i"), F.col("cap").cast("double")).otherwise(
        F.col("w") * F.col("first.left") / F.col("first.w_left")
    )
    return per.select("source", "source_size", target.alias("target"))


def source_levels(sizes: DataFrame, targets: DataFrame, cap: int) -> DataFrame:
    """source, source_size, target, level: at ``level`` the words due, min(cap, level * dw) * size, come to the target.

    Heavier classes of weights reach the cap first. Going down the weights, the first class that the level of what is
    left keeps within the cap gives it; where none does, all are at the cap.
    """
    classes = sizes.filter("size > 0 and dw > 0").groupBy("source", "dw").agg(F.sum("size").alias("s"))
    t = targets.select(F.col("source").alias("_s"), "target")
    down = W.partitionBy("source").orderBy(F.desc("dw"))
    capped = F.coalesce(F.sum("s").over(down.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)) * cap
    rest = F.sum(F.col("dw") * F.col("s")).over(down.rowsBetween(0, W.unboundedFollowing))
    classes = classes.join(t, F.col("source").eqNullSafe(F.col("_s"))).withColumn("level", (F.col("target") - capped) / rest)
    bears = F.col("level") * F.col("dw") <= cap
    found = classes.groupBy("source").agg(F.coalesce(F.max_by("level", F.when(bears, F.col("dw"))), F.min_by("level", "dw")).alias("level"))
    found = found.withColumnRenamed("source", "_s")
    return targets.join(found, F.col("source").eqNullSafe(F.col("_s")), "left").drop("_s")


def _with_source(rows: DataFrame, sources: DataFrame, n_sources: int) -> DataFrame:
    """Join on source, nulls equal. A source may have a third of all rows, so rows are never dealt by source alone."""
    b = sources.withColumnRenamed("source", "_source")
    if n_sources <= BROADCAST_SOURCES:
        return rows.join(F.broadcast(b), F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)))
    b = b.withColumn("_with", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)).cast("array<long>")))
    on = F.col("source").eqNullSafe(F.col("_source")) & (F.col("_salt") == F.col("_with"))
    return salted.join(b, on).drop("_source", "_salt", "_with")


def mix_sources(
    documents: DataFrame,
    weights: tuple = (3, 1, 2),
    share: float = 1.5,
    cap: int = 2,
    seed: str = "mix",
    document_weight: str | Callable[[Column], Column] | None = None,
) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken, copies, source.

    ``document_weight`` makes inclusion unequal inside a source: a column of positive numbers, or a function of the
    document's size. A document is due copies in proportion to it (rounded to 2**(1/STEPS)), up to ``cap``. Without it
    all documents of a source are due alike.

    Null text has size 0 and takes no words; its copies follow its rank as any other's. A null source is a
    source of its own, the last. Null, missing or negative weights count as 0. Rows that repeat a doc_id get the
    same rank, ties go by doc_id. A source's words come within half a document of its target. An empty table
    gives no rows.
    """
    of_size = callable(document_weight)
    given = F.lit(1.0) if document_weight is None or of_size else F.col(document_weight).cast("double")
    sizes = documents.select("doc_id", "source", n_words().alias("size"), uniform(seed, F.col("doc_id")).alias("u"), given.alias("dw"))
    if of_size:
        sizes = sizes.withColumn("dw", document_weight(F.col("size")).cast("double"))
    if document_weight is not None:
        fine = F.pow(F.lit(2.0), F.rint(F.log2("dw") * STEPS) / STEPS)
        sizes = sizes.withColumn("dw", F.when((F.col("dw") > 0) & (F.col("dw") < float("inf")), fine).otherwise(0.0))
    sizes = materialize(sizes, "sizes")
    targets = materialize(source_targets(sizes, weights, share, cap), "targets")
    n_sources = targets.count()
    levels = materialize(source_levels(sizes, targets, cap), "levels")
    due = _with_source(sizes, levels, n_sources)
    most = F.lit(float(cap))
    e = F.when(F.col("dw") == 0, 0.0).when(F.col("target") >= F.col("source_size") * cap, most)
    due = due.withColumn("e", e.otherwise(F.coalesce(F.least(most, F.col("level") * F.col("dw")), F.lit(0.0)))).drop("level")
    p = F.col("e") - F.col("whole")
    q = F.try_divide(F.try_divide(F.col("u"), 1 - F.col("u")) * (1 - p), p)
    due = due.withColumn("whole", F.floor("e")).withColumn("q", F.when(p > 0, q / (1 + q)))
    due = due.withColumn("bucket", F.when(F.col("q").isNotNull(), F.least(F.floor(F.col("q") * BUCKETS), F.lit(BUCKETS - 1))))

    certain = due.groupBy("source").agg(F.first("target").alias("t"), F.sum(F.col("whole") * F.col("size")).alias("certain"))
    rest = certain.select(F.col("source").alias("_s"), (F.col("t") - F.col("certain")).alias("rest"))
    hist = due.filter("q is not null").groupBy("source", "bucket").agg(F.sum("size").alias("words"))
    upto = W.partitionBy("source").orderBy("bucket").rowsBetween(W.unboundedPreceding, 0)
    level = hist.withColumn("upto", F.sum("words").over(upto)).join(rest, F.col("source").eqNullSafe(F.col("_s")))
    over = F.col("upto") > F.col("rest")
    cuts = level.groupBy("source").agg(
        F.min(F.when(over, F.col("bucket"))).alias("cut"),
        F.min_by(F.col("upto") - F.col("words"), F.when(over, F.col("bucket"))).alias("before"),
        F.first("rest").alias("rest"),
    )
    # Sources without a fraction to draw have no histogram.
    cuts = materialize(
        targets.select(F.col("source").alias("_t")).join(cuts, F.col("_t").eqNullSafe(F.col("source")), "left").select(
            F.col("_t").alias("source"), F.coalesce("cut", F.lit(BUCKETS)).alias("cut"), "before", "rest"
        ),
        "cuts",
    )
    ranked = _with_source(due, cuts, n_sources)
    sure = ranked.filter("q is null or bucket <> cut")
    sure = sure.withColumn("extra", F.when(F.col("bucket") < F.col("cut"), 1).otherwise(0))
    edge = ranked.filter("bucket = cut")
    mine = W.partitionBy("source").orderBy("q", "doc_id").rowsBetween(W.unboundedPreceding, -1)
    so_far = F.col("before") + F.coalesce(F.sum("size").over(mine), F.lit(0))
    edge = edge.withColumn("extra", F.when(so_far + F.col("size") / 2 <= F.col("rest"), 1).otherwise(0))
    out = sure.unionByName(edge).withColumn("copies", (F.col("whole") + F.col("extra")).cast("long"))
    return out.select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies", "source"
    )


def mixed_documents(documents: DataFrame, **how) -> DataFrame:
    """The mix itself: every document as often as it has copies, with all its columns. Rows of a doc_id go together."""
    copies = mix_sources(documents, **how).groupBy(F.col("doc_id").alias("_id")).agg(F.max("copies").alias("_copies")).filter("_copies > 0")
    rows = documents.select(F.struct(*documents.columns).alias("_row"))  # other columns may have any name
    joined = rows.join(copies, F.col("_row.doc_id").eqNullSafe(F.col("_id")))
    return joined.select("_row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies")))).select("_row.*")


def about_root(size: Column) -> Column:
    """A power of two near the square root of a size: longer documents are due more often, but not in proportion."""
    return F.pow(F.lit(2.0), F.floor(F.length(F.bin(size)) / 2))


def op6_source_mix(spark, sf_dir: str) -> DataFrame:
    """Inclusion odds differ inside a source: they grow with about the root of a document's size."""
    mixed = mix_sources(spark.read.parquet(f"{sf_dir}/documents.parquet"), document_weight=about_root)
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


OP6_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
    ('0x' || substr(md5('mix|' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS u
  FROM documents
), per AS (
  SELECT source, sum(size)::BIGINT AS source_size, ([3, 1, 2])[(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w
  FROM sized GROUP BY source
), levels AS (
  SELECT *, 2 * source_size AS cap, row_number() OVER l AS i,
    (sum(source_size) OVER ())::DOUBLE * 1.5::DOUBLE - coalesce(sum(2 * source_size) OVER (l ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE AS remaining,
    (sum(w) OVER (l ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS w_left
  FROM per WINDOW l AS (ORDER BY (2 * source_size)::DOUBLE / w, source NULLS LAST)
), base AS (
  SELECT i, remaining, w_left FROM levels WHERE cap * w_left >= w * remaining ORDER BY i LIMIT 1
), targets AS (
  SELECT source, source_size, CASE WHEN l.i < b.i THEN cap::DOUBLE ELSE w::DOUBLE * b.remaining / b.w_left END AS target
  FROM levels l, base b
), weighted AS (
  SELECT *, (1::BIGINT << (length(bin(size)) // 2)::INT)::DOUBLE AS dw FROM sized
), classes AS (
  SELECT c.source, dw, s, target FROM (SELECT source, dw, sum(size)::BIGINT AS s FROM weighted WHERE size > 0 GROUP BY source, dw) c
  JOIN targets t ON c.source IS NOT DISTINCT FROM t.source
), leveled AS (
  SELECT source, dw, (target - (coalesce(sum(s) OVER (down ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) * 2)::DOUBLE)
    / sum(dw * s) OVER (down ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM classes WINDOW down AS (PARTITION BY source ORDER BY dw DESC)
), chosen AS (
  SELECT source, coalesce(max_by(level, dw) FILTER (level * dw <= 2), min_by(level, dw)) AS level FROM leveled GROUP BY source
), due AS (
  SELECT s.*, t.source_size, t.target,
    CASE WHEN t.target >= t.source_size * 2 THEN 2::DOUBLE ELSE coalesce(least(2::DOUBLE, level * dw), 0::DOUBLE) END AS e
  FROM weighted s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source LEFT JOIN chosen c ON s.source IS NOT DISTINCT FROM c.source
), odds AS (
  SELECT *, floor(e)::BIGINT AS whole, e - floor(e) AS p, target - sum(floor(e) * size) OVER (PARTITION BY source) AS rest,
    CASE WHEN e - floor(e) > 0 THEN u / (1 - u) * (1 - (e - floor(e))) / (e - floor(e)) END AS ratio
  FROM due
), ranked AS (
  SELECT *, coalesce(sum(size) OVER (PARTITION BY source, p > 0 ORDER BY ratio / (1 + ratio), doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS so_far
  FROM odds
)
SELECT doc_id, size, source_size, target,
  ((whole + CASE WHEN p > 0 AND so_far + size / 2::DOUBLE <= rest THEN 1 ELSE 0 END) * size)::BIGINT AS taken
FROM ranked
"""
