"""Relational operators: interval pairs, first/last of a key, strict lookups, counts, histograms, names in order."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from runnel.functions import exprs as E
from runnel.staging import materialize


def rain_intervals(points: DataFrame) -> DataFrame:
    """start_min, end_min, mm from points (minutes, intensity in mm/h). A scenario has few points: one ordered window."""
    w = W.orderBy("minutes")
    pairs = points.select(
        F.col("minutes").alias("start_min"), F.lead("minutes").over(w).alias("end_min"), F.col("intensity"), F.lead("intensity").over(w).alias("after")
    )
    mm = E.trapezoid_mm(F.col("intensity"), F.col("after"), F.col("start_min"), F.col("end_min"))
    return pairs.filter("end_min is not null").select("start_min", "end_min", mm.alias("mm"))


def _ordered(order: list, descending: bool) -> list[Column]:
    return [F.col(c).desc() if descending else F.col(c).asc() for c in order]


def keep_first(df: DataFrame, key: list[str], order: list[str], columns: list[str]) -> DataFrame:
    """The first row of each key by ``order``. As an aggregate it is combined before the shuffle, unlike row_number."""
    top = df.groupBy(*key).agg(F.min(F.struct(*order)).alias("_s"))
    return top.select(*key, *[F.col(f"_s.{c}").alias(c) for c in columns])


def keep_last(df: DataFrame, key: list[str], order: list[str], columns: list[str]) -> DataFrame:
    """The last row of each key by ``order``."""
    top = df.groupBy(*key).agg(F.max(F.struct(*order)).alias("_s"))
    return top.select(*key, *[F.col(f"_s.{c}").alias(c) for c in columns])


def top_row(df: DataFrame, key: str, value: str, ties: list[str]) -> DataFrame:
    """The row of the largest value of each key; ties go to the smallest of the other columns, which are integers."""
    best = df.groupBy(key).agg(F.max(F.struct(F.col(value), *[(-F.col(t)).alias(t) for t in ties])).alias("_s"))
    return best.select(key, *[(-F.col(f"_s.{t}")).alias(t) for t in ties], F.col(f"_s.{value}").alias(value))


def duplicates(df: DataFrame, key: list[str]) -> DataFrame:
    """Keys that occur more than once, with ``extra`` rows beyond the first."""
    return df.groupBy(*key).agg((F.count(F.lit(1)) - 1).alias("extra")).filter("extra > 0")


def strict_lookup(rows: DataFrame, lookup: DataFrame, key: str) -> DataFrame:
    """Left join to a lookup whose key is unique and complete; the job fails otherwise.

    The lookup's rows are counted in the aggregate that makes it unique; a missing key fails in a filter, without another
    pass and whichever columns are read afterwards.
    """
    values = [c for c in lookup.columns if c != key]
    one = lookup.groupBy(key).agg(F.first(F.struct(*values)).alias("_v"), F.count(F.lit(1)).alias("_n"))
    joined = rows.join(one, key, "left")
    fault = F.when(F.col("_n").isNull(), F.raise_error(F.concat(F.lit(f"no {key} "), F.coalesce(F.col(key).cast("string"), F.lit("null"))))).when(
        F.col("_n") > 1, F.raise_error(F.concat(F.lit(f"{key} is not unique: "), F.col(key).cast("string")))
    )
    return joined.filter(fault.isNull()).select(*rows.columns, *[F.col(f"_v.{c}").alias(c) for c in values])


def set_difference_counts(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """only_a and only_b: how many keys one side has alone. Both 0: the sets are equal."""
    left, right = a.select(key).distinct().withColumn("_a", F.lit(1)), b.select(key).distinct().withColumn("_b", F.lit(1))
    both = left.join(right, key, "full")
    return both.agg(F.count_if(F.col("_b").isNull()).alias("only_a"), F.count_if(F.col("_a").isNull()).alias("only_b"))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """value, n and percent of all rows; null is a value."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n").alias("_t"))
    return counts.crossJoin(F.broadcast(total)).select(column, "n", (F.lit(100.0) * F.col("n") / F.col("_t")).alias("percent"))


def histogram(df: DataFrame, column: str, edges: list) -> DataFrame:
    """Counts of half-open bins [edge, next), the last one open."""
    labels = [f"[{a},{b})" for a, b in zip(edges, [*edges[1:], "inf"], strict=True)]
    c, out = F.col(column), F.lit(labels[-1])
    for edge, label in reversed(list(zip(edges[1:], labels[:-1], strict=True))):
        out = F.when(c < edge, label).otherwise(out)
    return df.groupBy(out.alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def code_counts(df: DataFrame, column: str, first: int, last: int) -> DataFrame:
    """Counts of the codes first..last, 0 for those that do not occur."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    codes = df.sparkSession.range(first, last + 1).withColumnRenamed("id", column)
    return codes.join(counts.withColumn(column, F.col(column).cast("long")), column, "left").select(column, F.coalesce("n", F.lit(0)).alias("n"))


def percentiles(df: DataFrame, keys: list[str], column: str, shares: dict[str, float]) -> DataFrame:
    """keys and a column for each share: exact percentiles, between two neighbours in proportion; nulls do not count.

    Equal values are counted before the shuffle. Values are dealt by ranges of (keys, value), so a group need not fit in
    a task: each range knows how many of its group lie before it, and only the neighbours of each percentile are kept.
    """
    order = [*keys, column]
    dealt = df.filter(F.col(column).isNotNull()).groupBy(*order).agg(F.count(F.lit(1)).alias("_m")).repartitionByRange(*order)
    dealt = materialize(dealt.withColumn("_p", F.spark_partition_id()), "ranges")
    counts = dealt.groupBy(*keys, "_p").agg(F.sum("_m").alias("_c"))  # a row for each range and group in it
    per = W.partitionBy(*keys)
    before = per.orderBy("_p").rowsBetween(W.unboundedPreceding, -1)
    counts = counts.select(*keys, "_p", F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_s"), F.sum("_c").over(per).alias("_n"), "_c")
    at = {name: (F.col("_n") - 1) * F.lit(float(share)) for name, share in shares.items()}
    ranks = F.array_distinct(F.flatten(F.array(*[F.array(F.floor(x), F.ceil(x)) for x in at.values()])))
    wanted = counts.withColumn("_w", F.filter(ranks, lambda r: (r >= F.col("_s")) & (r < F.col("_s") + F.col("_c"))))
    wanted = wanted.filter(F.size("_w") > 0).select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.col("_p").alias("_q"), "_s", "_n", "_w")
    on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys], F.col("_p") == F.col("_q"))
    upto = F.sum("_m").over(W.partitionBy(*keys, "_p").orderBy(column).rowsBetween(W.unboundedPreceding, 0))
    found = dealt.join(wanted, on).withColumn("_t", F.col("_s") + upto)
    found = found.filter(F.exists("_w", lambda r: (r < F.col("_t")) & (r >= F.col("_t") - F.col("_m"))))

    def at_rank(rank: Column) -> Column:
        return F.max(F.when((rank < F.col("_t")) & (rank >= F.col("_t") - F.col("_m")), F.col(column).cast("double")))

    ends = [at_rank(side(at[name])).alias(f"{end}_{name}") for name in shares for end, side in (("_a", F.floor), ("_b", F.ceil))]
    one = found.groupBy(*keys).agg(F.max("_n").alias("_n"), *ends)
    return one.select(*keys, *[
        (F.col(f"_a_{name}") + (F.col(f"_b_{name}") - F.col(f"_a_{name}")) * (x - F.floor(x))).alias(name) for name, x in at.items()
    ])


def bad_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """column, n_null, n_nonfinite of numeric columns, one row each, from one pass."""
    aggs = [F.struct(F.lit(c).alias("column"), F.count_if(F.col(c).isNull()).alias("n_null"), F.count_if(F.col(c).isNotNull() & ~E.finite(F.col(c).cast("double"))).alias("n_nonfinite")) for c in columns]
    return df.agg(F.array(*aggs).alias("a")).select(F.explode("a").alias("r")).select("r.*")


def assert_none(bad: DataFrame, what: str) -> None:
    """ValueError with an example if the frame has a row."""
    row = bad.limit(1).collect()
    if row:
        raise ValueError(f"{what}: {row[0].asDict()}")
