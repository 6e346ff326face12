"""Relational queries of the model over the star-schema tables, each with its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from runnel.functions import exprs as E
from runnel.operators import graph
from runnel.operators import relational as R

QUERIES: dict = {}
ORACLES: dict = {}


def query(sql: str | None = None):
    """Registers a query under its function's name, with its SQL."""

    def put(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return put


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def hourly_rain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """minutes (since the epoch, on the hour) and intensity: events added up by the hour."""
    ts = F.col("ts")
    minutes = F.unix_date(F.to_date(ts)).cast("long") * 1440 + F.hour(ts) * 60
    return table(spark, sf_dir, "events").groupBy(minutes.alias("minutes")).agg(
        F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("intensity")
    )


RAIN_SQL = """rain AS (
  SELECT (epoch(date_trunc('hour', ts)) / 60)::BIGINT AS minutes, sum(value::DECIMAL(18,2))::DOUBLE AS intensity FROM events GROUP BY 1
)"""

STEPS_SQL = (
    RAIN_SQL
    + """, steps AS (
  SELECT minutes AS start_min, lead(minutes) OVER (ORDER BY minutes) AS end_min,
    (intensity + lead(intensity) OVER (ORDER BY minutes)) / 2 * (lead(minutes) OVER (ORDER BY minutes) - minutes) / 60 AS mm FROM rain
)"""
)


@query(f"WITH {STEPS_SQL} SELECT start_min, end_min, round(mm, 6) AS mm FROM steps WHERE end_min IS NOT NULL")
def rain_trapezoid(spark, sf_dir):
    return R.rain_intervals(hourly_rain(spark, sf_dir)).withColumn("mm", F.round("mm", 6))


@query(f"""WITH {RAIN_SQL}, pairs AS (SELECT minutes, intensity, lag(minutes) OVER (ORDER BY minutes) AS m0, lag(intensity) OVER (ORDER BY minutes) AS i0 FROM rain)
SELECT count(*) AS points, count(*) FILTER (m0 >= minutes) AS order_violations, count(*) FILTER (intensity < 0) AS negative,
  count(*) FILTER (i0 > intensity) AS falling FROM pairs""")
def rain_monotonic_violations(spark, sf_dir):
    w = W.orderBy("minutes")
    pairs = hourly_rain(spark, sf_dir).select("minutes", "intensity", F.lag("minutes").over(w).alias("m0"), F.lag("intensity").over(w).alias("i0"))
    return pairs.agg(
        F.count(F.lit(1)).alias("points"),
        F.count_if(F.col("m0") >= F.col("minutes")).alias("order_violations"),
        F.count_if(F.col("intensity") < 0).alias("negative"),
        F.count_if(F.col("i0") > F.col("intensity")).alias("falling"),
    )


CLASS_SQL = """CASE WHEN abs(c - 0.3) <= 1e-8 + 1e-5 * 0.3 THEN 'green_open' WHEN abs(c - 0.75) <= 1e-8 + 1e-5 * 0.75 THEN 'default_urban'
  WHEN abs(c - 0.85) <= 1e-8 + 1e-5 * 0.85 THEN 'road' WHEN abs(c - 0.9) <= 1e-8 + 1e-5 * 0.9 THEN 'building' ELSE 'unknown' END"""
PART_COEF_SQL = "CASE p_size % 5 WHEN 0 THEN 0.3 WHEN 1 THEN 0.75 WHEN 2 THEN 0.85 WHEN 3 THEN 0.9 ELSE 0.5 END"


def part_coefficient():
    k = F.col("p_size") % 5
    return F.when(k == 0, 0.3).when(k == 1, 0.75).when(k == 2, 0.85).when(k == 3, 0.9).otherwise(0.5)


@query(f"""WITH {STEPS_SQL}, cells AS (SELECT {PART_COEF_SQL}::DOUBLE AS coef, count(*) AS n FROM part GROUP BY 1)
SELECT start_min, round(sum(mm / 1000 * coef * 900 * n), 6) AS volume_m3 FROM steps, cells WHERE end_min IS NOT NULL GROUP BY start_min""")
def scenario_volume(spark, sf_dir):
    cells = table(spark, sf_dir, "part").groupBy(part_coefficient().alias("coef")).agg(F.count(F.lit(1)).alias("n"))
    steps = R.rain_intervals(hourly_rain(spark, sf_dir))
    volume = E.runoff_m3(F.col("mm"), F.col("coef"), F.lit(900.0)) * F.col("n")
    return steps.crossJoin(F.broadcast(cells)).groupBy("start_min").agg(F.round(F.sum(volume), 6).alias("volume_m3"))


@query(f"WITH {STEPS_SQL} SELECT start_min, round(mm * 0.8, 6) AS runoff_mm, round(mm * 0.8 / 1000 * 900, 6) AS runoff_m3 FROM steps WHERE end_min IS NOT NULL")
def lumped_runoff(spark, sf_dir):
    mm = F.col("mm") * E.LUMPED_COEFFICIENT
    return R.rain_intervals(hourly_rain(spark, sf_dir)).select(
        "start_min", F.round(mm, 6).alias("runoff_mm"), F.round(mm / 1000 * E.LUMPED_AREA, 6).alias("runoff_m3")
    )


@query(f"SELECT {CLASS_SQL} AS surface_class, count(*) AS cells FROM (SELECT ({PART_COEF_SQL})::FLOAT AS c FROM part) GROUP BY 1")
def class_by_isclose(spark, sf_dir):
    c = part_coefficient().cast("float")
    return table(spark, sf_dir, "part").groupBy(E.surface_class(c).alias("surface_class")).agg(F.count(F.lit(1)).alias("cells"))


@query("""SELECT CASE WHEN l_quantity <= 0.5 THEN 'intersection' WHEN l_quantity <= 10 THEN 'near' WHEN l_quantity <= 20 THEN 'moderate' ELSE 'distant_candidate' END AS spatial_class,
  (l_quantity <= 20)::INT AS coupling_eligible, count(*) AS n FROM lineitem GROUP BY 1, 2""")
def distance_class_ladder(spark, sf_dir):
    d = F.col("l_quantity")
    return table(spark, sf_dir, "lineitem").groupBy(
        E.distance_class(d).alias("spatial_class"), (d <= E.COUPLING_M).cast("int").alias("coupling_eligible")
    ).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT CASE WHEN l_discount * 10 <= 0.5 THEN 'road_intersection' ELSE 'road_proximity' END AS candidate_method, count(*) AS n FROM lineitem GROUP BY 1")
def two_way_label(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").groupBy(E.candidate_method(F.col("l_discount") * 10).alias("candidate_method")).agg(F.count(F.lit(1)).alias("n"))


@query("""WITH o AS (SELECT p_partkey, p_size % 6 AS o, p_retailprice / 100000 AS slope FROM part),
g AS (SELECT *, CASE least(greatest(o, 1), 4) WHEN 1 THEN 0.4 WHEN 2 THEN 0.7 WHEN 3 THEN 1.0 ELSE 1.4 END::DOUBLE AS w,
  CASE least(greatest(o, 1), 4) WHEN 1 THEN 0.3 WHEN 2 THEN 0.45 WHEN 3 THEN 0.6 ELSE 0.8 END::DOUBLE AS d FROM o)
SELECT p_partkey, CASE WHEN o <= 1 THEN 'low' WHEN o <= 2 THEN 'medium' WHEN o <= 3 THEN 'high' ELSE 'very_high' END AS capacity_class,
  round(1 / 0.035 * (w * d) * pow(w * d / (w + 2 * d), 2.0 / 3.0) * sqrt(greatest(slope, 0.001)), 6) AS capacity_m3s FROM g""")
def manning_capacity(spark, sf_dir):
    o = F.col("p_size") % 6
    width, depth = E.section(o)
    return table(spark, sf_dir, "part").select(
        "p_partkey", E.capacity_class(o).alias("capacity_class"),
        F.round(E.manning_m3s(width, depth, F.col("p_retailprice") / 100000), 6).alias("capacity_m3s"),
    )


@query("""WITH v AS (SELECT event_id, CASE event_id % 4 WHEN 0 THEN value::VARCHAR WHEN 1 THEN 'n/a' WHEN 2 THEN 'inf' ELSE json_extract_string(props, '$.k') END AS t FROM events)
SELECT event_id, round(CASE WHEN isfinite(try_cast(t AS DOUBLE)) THEN try_cast(t AS DOUBLE) ELSE -1 END, 6) AS as_double,
  CASE WHEN event_id % 4 = 3 THEN try_cast(t AS INTEGER) ELSE 7 END AS as_int FROM v""")
def safe_cast_defaults(spark, sf_dir):
    k = F.col("event_id") % 4
    t = F.when(k == 0, F.col("value").cast("string")).when(k == 1, "n/a").when(k == 2, "inf").otherwise(F.get_json_object("props", "$.k"))
    return table(spark, sf_dir, "events").select(
        "event_id", F.round(E.safe_double(t, -1.0), 6).alias("as_double"), E.safe_int(F.when(k == 3, t).otherwise("x"), 7).alias("as_int")
    )


@query("""WITH t AS (SELECT CASE o_orderstatus WHEN 'F' THEN 'TRUE' WHEN 'O' THEN ' yes ' ELSE 'no' END AS s FROM orders)
SELECT s AS raw, lower(trim(s)) IN ('true', 'yes', '1') AS flag, lower(trim(s)) IN ('0', 'false', '0.0') AS is_false, count(*) AS n FROM t GROUP BY 1, 2, 3""")
def string_bool_map(spark, sf_dir):
    s = F.when(F.col("o_orderstatus") == "F", "TRUE").when(F.col("o_orderstatus") == "O", " yes ").otherwise("no")
    t = table(spark, sf_dir, "orders").select(s.alias("raw"))
    return t.groupBy("raw", E.yes_no(F.col("raw")).alias("flag"), E.is_false_text(F.col("raw")).alias("is_false")).agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT s_suppkey, printf('RN_SUPP_%05d', row_number() OVER (ORDER BY s_acctbal DESC, s_suppkey)) AS label,
  printf('R%03d_C%03d', (s_suppkey // 10)::INT, (s_suppkey % 10)::INT) AS cell_id, printf('%03d_%03d', s_nationkey * 30, s_nationkey * 30 + 30) AS interval_id FROM supplier""")
def padded_ids(spark, sf_dir):
    t = table(spark, sf_dir, "supplier").withColumn("_rank", -F.col("s_acctbal"))
    t = graph.relabel(t, ["_rank", "s_suppkey"], "RN_SUPP", "label")
    start = F.col("s_nationkey") * 30
    return t.select(
        "s_suppkey", "label", E.cell_id(F.floor(F.col("s_suppkey") / 10), F.col("s_suppkey") % 10).alias("cell_id"),
        E.interval_id(start, start + 30).alias("interval_id"),
    )


@query("""SELECT event_type, sum(json_extract_string(props, '$.k')::BIGINT)::BIGINT AS sum_k, max(json_extract_string(props, '$.k')::BIGINT) AS max_k,
  count(*) FILTER (json_extract_string(props, '$.none') IS NULL) AS without_none FROM events GROUP BY 1""")
def json_extract_props(spark, sf_dir):
    k = F.from_json("props", "k long, none string")
    return table(spark, sf_dir, "events").select("event_type", k.alias("p")).groupBy("event_type").agg(
        F.sum("p.k").alias("sum_k"), F.max("p.k").alias("max_k"), F.count_if(F.col("p.none").isNull()).alias("without_none")
    )


@query("""WITH v AS (SELECT CASE WHEN event_id % 11 = 0 THEN 'nan'::DOUBLE WHEN event_id % 11 = 1 THEN 'inf'::DOUBLE WHEN event_id % 11 = 2 THEN -9999
  WHEN event_id % 11 = 3 THEN NULL ELSE value END AS v FROM events)
SELECT count(*) AS n, count(*) FILTER (v IS NULL) AS n_null, count(*) FILTER (v IS NOT NULL AND NOT isfinite(v)) AS n_nonfinite,
  count(*) FILTER (isfinite(v) AND v <> -9999) AS n_valid, round(sum(v) FILTER (isfinite(v) AND v <> -9999), 4) AS total FROM v""")
def not_null_finite_filter(spark, sf_dir):
    k = F.col("event_id") % 11
    v = F.when(k == 0, float("nan")).when(k == 1, float("inf")).when(k == 2, E.NODATA).when(k == 3, None).otherwise(F.col("value"))
    t = table(spark, sf_dir, "events").select(v.cast("double").alias("v"))
    ok = E.valid(F.col("v"))
    return t.agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("v").isNull()).alias("n_null"),
        F.count_if(F.col("v").isNotNull() & ~E.finite(F.col("v"))).alias("n_nonfinite"),
        F.count_if(ok).alias("n_valid"), F.round(F.sum(F.when(ok, F.col("v"))), 4).alias("total"),
    )


@query("""WITH t AS (SELECT CASE WHEN o_orderpriority LIKE '5%' THEN NULL ELSE o_orderpriority END AS v FROM orders)
SELECT v AS value, count(*) AS n, round(100.0 * count(*) / sum(count(*)) OVER (), 6) AS percent FROM t GROUP BY 1""")
def value_counts_nulls(spark, sf_dir):
    v = F.when(~F.col("o_orderpriority").startswith("5"), F.col("o_orderpriority"))
    out = R.value_counts(table(spark, sf_dir, "orders").select(v.alias("value")), "value")
    return out.withColumn("percent", F.round("percent", 6))


@query("""SELECT count(*) AS n, count(DISTINCT l_partkey) AS parts, count(DISTINCT l_suppkey) AS suppliers,
  (SELECT sum(k - 1)::BIGINT FROM (SELECT count(*) AS k FROM lineitem GROUP BY l_partkey, l_suppkey)) AS duplicates FROM lineitem""")
def distinct_and_duplicates(spark, sf_dir):
    # Grouped twice and added up: no task sees more than its share of keys.
    pairs = table(spark, sf_dir, "lineitem").groupBy("l_partkey", "l_suppkey").agg(F.count(F.lit(1)).alias("k"))
    return pairs.agg(
        F.sum("k").alias("n"), F.countDistinct("l_partkey").alias("parts"), F.countDistinct("l_suppkey").alias("suppliers"),
        F.sum(F.col("k") - 1).alias("duplicates"),
    )


@query("""SELECT l_returnflag, count(*) FILTER (l_discount >= 0.02) AS ge_002, count(*) FILTER (l_discount >= 0.05) AS ge_005, count(*) FILTER (l_discount >= 0.1) AS ge_010,
  sum(CASE WHEN l_tax = 0 THEN 1 ELSE 0 END)::BIGINT AS untaxed, bool_and(l_quantity > 0) AS all_positive, bool_or(l_quantity > 49) AS any_large FROM lineitem GROUP BY 1""")
def conditional_counts(spark, sf_dir):
    d = F.col("l_discount")
    return table(spark, sf_dir, "lineitem").groupBy("l_returnflag").agg(
        *[F.count_if(d >= b).alias(f"ge_{int(b * 100):03d}") for b in (0.02, 0.05, 0.1)],
        F.count_if(F.col("l_tax") == 0).alias("untaxed"), F.bool_and(F.col("l_quantity") > 0).alias("all_positive"),
        F.bool_or(F.col("l_quantity") > 49).alias("any_large"),
    )


@query("""SELECT l_linestatus, round(quantile_cont(l_extendedprice, 0.5), 4) AS p50, round(quantile_cont(l_extendedprice, 0.9), 4) AS p90, round(quantile_cont(l_extendedprice, 0.95), 4) AS p95,
  round(quantile_cont(l_extendedprice, 0.99), 4) AS p99, round(median(l_quantity), 4) AS median_quantity FROM lineitem GROUP BY 1""")
def percentiles_exact(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    values = [F.struct(F.lit(c).alias("of"), F.col(c).cast("double").alias("v")) for c in ("l_extendedprice", "l_quantity")]
    both = lines.select("l_linestatus", F.explode(F.array(*values)).alias("x")).select("l_linestatus", "x.of", "x.v")  # one pass for both columns
    found = R.percentiles(both, ["l_linestatus", "of"], "v", {"p50": 0.5, "p90": 0.9, "p95": 0.95, "p99": 0.99})
    price, quantity = F.col("of") == "l_extendedprice", F.col("of") == "l_quantity"
    shares = [F.round(F.max(F.when(price, F.col(c))), 4).alias(c) for c in ("p50", "p90", "p95", "p99")]
    return found.groupBy("l_linestatus").agg(*shares, F.round(F.max(F.when(quantity, F.col("p50"))), 4).alias("median_quantity"))


@query("""SELECT CASE WHEN l_quantity < 5 THEN '[0,5)' WHEN l_quantity < 10 THEN '[5,10)' WHEN l_quantity < 20 THEN '[10,20)' WHEN l_quantity < 30 THEN '[20,30)' ELSE '[30,inf)' END AS bin,
  count(*) AS n FROM lineitem GROUP BY 1""")
def histogram_bins(spark, sf_dir):
    return R.histogram(table(spark, sf_dir, "lineitem"), "l_quantity", [0, 5, 10, 20, 30])


@query("SELECT c AS code, count(p_partkey) AS n FROM range(1, 9) r(c) LEFT JOIN part ON p_size % 10 = c GROUP BY 1")
def code_histogram(spark, sf_dir):
    return R.code_counts(table(spark, sf_dir, "part").select((F.col("p_size") % 10).alias("code")), "code", 1, 8)


@query("SELECT * EXCLUDE (r) FROM (SELECT l_partkey, l_orderkey, l_linenumber, l_quantity, row_number() OVER (PARTITION BY l_partkey ORDER BY l_quantity, l_orderkey, l_linenumber, l_suppkey, l_extendedprice) AS r FROM lineitem) WHERE r = 1")
def dedupe_first(spark, sf_dir):
    t = table(spark, sf_dir, "lineitem")
    return R.keep_first(t, ["l_partkey"], ["l_quantity", "l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice"], ["l_orderkey", "l_linenumber", "l_quantity"])


@query("SELECT * EXCLUDE (r) FROM (SELECT l_partkey, l_orderkey, l_linenumber, l_quantity, row_number() OVER (PARTITION BY l_partkey ORDER BY l_quantity DESC, l_orderkey DESC, l_linenumber DESC, l_suppkey DESC, l_extendedprice DESC) AS r FROM lineitem) WHERE r = 1")
def dedupe_last(spark, sf_dir):
    t = table(spark, sf_dir, "lineitem")
    return R.keep_last(t, ["l_partkey"], ["l_quantity", "l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice"], ["l_orderkey", "l_linenumber", "l_quantity"])


@query("SELECT o_orderkey, o_totalprice, c_custkey, c_name, c_acctbal FROM orders LEFT JOIN customer ON o_custkey = c_custkey")
def strict_one_to_one_merge(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", F.col("o_custkey").alias("c_custkey"))
    return R.strict_lookup(orders, table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal"), "c_custkey")


@query("SELECT (SELECT count(*) FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)) AS without_orders, (SELECT count(*) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)) AS orphans")
def foreign_key_anti(spark, sf_dir):
    c, o = table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders")
    a = c.join(o, c["c_custkey"] == o["o_custkey"], "left_anti").agg(F.count(F.lit(1)).alias("without_orders"))
    return a.crossJoin(F.broadcast(o.join(c, c["c_custkey"] == o["o_custkey"], "left_anti").agg(F.count(F.lit(1)).alias("orphans"))))


@query("""SELECT (SELECT count(*) FROM (SELECT p_partkey FROM part EXCEPT SELECT l_partkey FROM lineitem)) AS only_a,
  (SELECT count(*) FROM (SELECT l_partkey FROM lineitem EXCEPT SELECT p_partkey FROM part)) AS only_b""")
def id_set_equality(spark, sf_dir):
    a = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"))
    return R.set_difference_counts(a, table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("id")), "id")


@query(f"WITH {STEPS_SQL} SELECT start_min, round(sum(mm) OVER (ORDER BY start_min), 4) AS total_mm FROM steps WHERE end_min IS NOT NULL")
def running_totals(spark, sf_dir):
    steps = R.rain_intervals(hourly_rain(spark, sf_dir))
    return steps.select("start_min", F.round(F.sum("mm").over(W.orderBy("start_min")), 4).alias("total_mm"))


@query("""SELECT l_suppkey, l_partkey, l_orderkey, l_linenumber, l_quantity FROM (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_quantity DESC, l_partkey, l_orderkey, l_linenumber) AS r FROM lineitem) WHERE r = 1""")
def top_edge_per_node(spark, sf_dir):
    t = table(spark, sf_dir, "lineitem")
    return R.top_row(t, "l_suppkey", "l_quantity", ["l_partkey", "l_orderkey", "l_linenumber"])


@query("SELECT l_orderkey, l_linenumber, l_partkey, round(l_quantity / sum(l_quantity) OVER (PARTITION BY l_orderkey), 9) AS share, min(l_quantity) OVER (PARTITION BY l_orderkey) AS least FROM lineitem")
def per_group_normalised_share(spark, sf_dir):
    w = W.partitionBy("l_orderkey")
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", F.round(F.col("l_quantity") / F.sum("l_quantity").over(w), 9).alias("share"),
        F.min("l_quantity").over(w).alias("least"),
    )


@query("""SELECT n_name, count(*) AS n, rank() OVER (ORDER BY count(*) DESC, n_name) AS position FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY 1 ORDER BY n DESC, n_name LIMIT 5""")
def largest_groups(spark, sf_dir):
    n = table(spark, sf_dir, "supplier").join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    top = n.groupBy("n_name").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "n_name").limit(5)
    return top.withColumn("position", F.row_number().over(W.orderBy(F.desc("n"), "n_name")).cast("long"))


@query("""SELECT event_type, count(*) AS n, array_to_string(list_sort(list_distinct(list(user_id % 7)::BIGINT[])), ';') AS residues FROM events GROUP BY 1""")
def sorted_unique_join(spark, sf_dir):
    ids = F.sort_array(F.collect_set(F.col("user_id") % 7))
    return table(spark, sf_dir, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), E.joined(F.transform(ids, lambda x: x.cast("string"))).alias("residues"))


@query("""SELECT event_type, count(*) FILTER (abs(value - round(value, 1)) <= 1e-6) AS close, count(*) FILTER (abs(value - round(value, 1)) > 1e-6) AS far, round(sum(value), 2) AS q, round(sum(value / 1800.0) * 1800.0, 2) AS back FROM events GROUP BY 1""")
def flow_volume_round_trip(spark, sf_dir):
    v = F.col("value")
    flow = E.volume_to_flow(v, F.lit(1800.0))
    near = F.abs(v - F.round(v, 1)) <= 1e-6
    return table(spark, sf_dir, "events").groupBy("event_type").agg(
        F.count_if(near).alias("close"), F.count_if(~near).alias("far"), F.round(F.sum(v), 2).alias("q"),
        F.round(E.flow_to_volume(F.sum(flow), F.lit(1800.0)), 2).alias("back"),
    )


@query("""SELECT c_mktsegment, round(sum(least(q, cap)), 4) AS conveyed, round(sum(greatest(0, q - least(q, cap))), 4) AS overflow, round(CASE WHEN sum(q) > 0 THEN sum(least(q, cap)) / sum(q) ELSE 0 END, 6) AS fraction
FROM (SELECT c_mktsegment, greatest(c_acctbal, 0) AS q, 4000.0::DOUBLE AS cap FROM customer) GROUP BY 1""")
def clamp_conveyed(spark, sf_dir):
    q, cap = F.greatest(F.col("c_acctbal"), F.lit(0.0)), F.lit(4000.0)
    passed = F.sum(E.conveyed(q, cap))
    return table(spark, sf_dir, "customer").groupBy("c_mktsegment").agg(
        F.round(passed, 4).alias("conveyed"), F.round(F.sum(E.overflow(q, cap)), 4).alias("overflow"),
        F.round(E.ratio(passed, F.sum(q)), 6).alias("fraction"),
    )


@query("""SELECT p_brand, count(*) AS n, round(avg(drop_m), 6) AS mean_drop, round(max(CASE WHEN len > 0 THEN drop_m / len END), 6) AS max_slope, count(*) FILTER (len <= 0) AS no_length
FROM (SELECT p_brand, (p_size - 10)::DOUBLE AS drop_m, (p_size % 7)::DOUBLE AS len FROM part) GROUP BY 1""")
def slope_with_guard(spark, sf_dir):
    drop, length = (F.col("p_size") - 10).cast("double"), (F.col("p_size") % 7).cast("double")
    return table(spark, sf_dir, "part").groupBy("p_brand").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg(drop), 6).alias("mean_drop"), F.round(F.max(E.slope_of(drop, length)), 6).alias("max_slope"),
        F.count_if(length <= 0).alias("no_length"),
    )
