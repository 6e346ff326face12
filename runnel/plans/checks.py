"""Validation of every artefact, each as one frame (metric, value, ok) from one aggregate over its table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runnel.functions import exprs as E
from runnel.functions import geo as G
from runnel.operators import graph, grid, planar
from runnel.operators import relational as R
from runnel.operators.spatial import MAPPING_STATUS
from runnel.schema import PROVENANCE, require_columns
from runnel.staging import materialize


def report(df: DataFrame, metrics: list[tuple[str, Column, str]]) -> DataFrame:
    """metrics: (name, aggregate, rule), rule being SQL about ``v``, such as "v = 0"; "" for information."""
    one = df.agg(*[a.cast("double").alias(n) for n, a, _ in metrics])
    rows = F.array(*[
        F.struct(F.lit(n).alias("metric"), F.col(n).alias("value"), (F.coalesce(F.expr(rule.replace("v", f"`{n}`", 1)), F.lit(False)) if rule else F.lit(True)).alias("ok"))
        for n, _, rule in metrics
    ])
    return one.select(F.explode(rows).alias("r")).select("r.*")


def both(*parts: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def passed(result: DataFrame) -> bool:
    return result.filter("not ok").isEmpty()


def require(result: DataFrame) -> DataFrame:
    """The result itself; ValueError naming the metrics that fail (a report has a handful of rows)."""
    bad = result.filter("not ok").collect()
    if bad:
        raise ValueError("; ".join(f"{r['metric']} = {r['value']}" for r in bad))
    return result


def _none(cond: Column) -> Column:
    return F.count_if(F.coalesce(cond, F.lit(True)))


def rainfall(scenario: DataFrame) -> DataFrame:
    """V1: fields, order, signs, horizon and number of points."""
    f = F.col("forecast")
    minutes = F.transform(f, lambda p: p["minutes"])
    n = F.size(f)
    steps = F.zip_with(F.slice(minutes, F.lit(1), F.greatest(n - 1, F.lit(0))), F.slice(minutes, F.lit(2), F.greatest(n - 1, F.lit(0))), lambda a, b: b > a)
    missing = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in ("scenario_id", "location", "source", "interval_minutes", "forecast_horizon_minutes", "forecast")])
    return report(scenario, [
        ("missing_fields", _none(missing), "v = 0"), ("empty_forecast", _none(n < 1), "v = 0"),
        ("not_increasing", _none(~F.forall(steps, lambda s: s)), "v = 0"),
        ("negative", _none(F.exists(f, lambda p: (p["minutes"] < 0) | (p["rainfall_mm_hr"] < 0))), "v = 0"),
        ("wrong_horizon", _none(F.try_element_at(minutes, F.lit(-1)) != F.col("forecast_horizon_minutes")), "v = 0"),
        ("wrong_count", _none(n != F.floor(F.col("forecast_horizon_minutes") / F.col("interval_minutes")) + 1), "v = 0"),
    ])


def marked_polygons(features: DataFrame) -> DataFrame:
    """The features with ``_id`` and ``usable``: a geometry that is there, not empty and, for a polygon, valid."""
    marked = materialize(features.withColumn("_id", F.monotonically_increasing_id()), "features")
    faulty = planar.polygon_faults(marked.select(F.col("_id").alias("id"), "geometry")).select(F.col("id").alias("_id"), F.lit(True).alias("_fault")).distinct()
    usable = G.is_usable(F.col("geometry")) & F.col("_fault").isNull()
    return marked.join(faulty, "_id", "left").withColumn("usable", usable).drop("_fault")


def area(aoi: DataFrame) -> DataFrame:
    """V2, V5: features, usable geometry, bounds."""
    b = G.bounds(F.col("geometry"))
    return report(marked_polygons(aoi), [
        ("features", F.count(F.lit(1)), "v > 0"), ("unusable_geometry", _none(~F.col("usable")), "v = 0"),
        ("min_x", F.min(b["min_x"]), ""), ("min_y", F.min(b["min_y"]), ""), ("max_x", F.max(b["max_x"]), ""), ("max_y", F.max(b["max_y"]), ""),
    ])


def raster_statistics(cells: DataFrame, value: str) -> DataFrame:
    """V3: min, max, mean and count of one band."""
    v = F.col(value)
    return report(cells, [("cells", F.count(v), ""), ("min", F.min(v), ""), ("max", F.max(v), ""), ("mean", F.avg(v), "")])


def alignment(meta: DataFrame, tolerance: float = 1e-6) -> DataFrame:
    """V4: all grids of a grid_meta table agree in system, size, resolution and origin."""
    same = [(f"distinct_{c}", F.countDistinct(c), "v = 1") for c in ("srid", "width", "height")]
    return report(meta, [*same, *[(f"spread_{c}", F.max(c) - F.min(c), f"v <= {tolerance}") for c in ("x0", "y0", "dx", "dy")]])


def surface_features(features: DataFrame, aoi: DataFrame) -> DataFrame:
    """V5: usable, area, and features that have no point in common with any polygon of the area (not with its bounds).

    An area has few polygons; a feature meets only those whose bounds meet its own, by tiles of the area's mean size.
    """
    areas = aoi.filter("geometry is not null").select(F.col("geometry.parts").alias("area"), G.bounds(F.col("geometry")).alias("a"))
    span = F.greatest(F.avg(F.col("a.max_x") - F.col("a.min_x")), F.avg(F.col("a.max_y") - F.col("a.min_y")), F.lit(1e-9))
    size = areas.agg(span.alias("side"))

    def tiles(rows: DataFrame, box: str) -> DataFrame:
        at = rows.crossJoin(F.broadcast(size))
        for k, axis in (("tx", "x"), ("ty", "y")):
            ends = [F.floor(F.col(f"{box}.{end}_{axis}") / F.col("side")) for end in ("min", "max")]
            at = at.withColumn(k, F.explode(F.sequence(*ends)))
        return at.drop("side")

    marked = materialize(marked_polygons(features), "usable")
    own = marked.filter("geometry is not null").select("_id", F.col("geometry.parts").alias("own"), G.bounds(F.col("geometry")).alias("b"))
    pairs = tiles(own, "b").join(tiles(areas, "a"), ["tx", "ty"])
    meet = (F.col("a.min_x") <= F.col("b.max_x")) & (F.col("b.min_x") <= F.col("a.max_x")) & (F.col("a.min_y") <= F.col("b.max_y")) & (F.col("b.min_y") <= F.col("a.max_y"))
    hits = pairs.filter(meet).filter(G.parts_meet(F.col("own"), F.col("area"))).select("_id", F.lit(True).alias("_in")).distinct()
    marked = marked.join(hits, "_id", "left")
    misses = F.col("geometry").isNotNull() & F.col("_in").isNull()
    return report(marked, [
        ("features", F.count(F.lit(1)), "v > 0"), ("unusable_geometry", _none(~F.col("usable")), "v = 0"),
        ("outside", F.count_if(misses), "v = 0"), ("area", F.sum(G.area_of(F.col("geometry"))), ""),
    ])


def runoff_coefficient(cells: DataFrame, expected_cells: int | None = None) -> DataFrame:
    """V6: every class occurs, every value is a class, range, number of cells."""
    kind = E.surface_class(F.col("coefficient"))
    rows = [(f"cells_{c}", F.count_if(kind == c), "v > 0") for c in E.COEFFICIENTS]
    rows += [("unknown", F.count_if(kind == "unknown"), "v = 0"), ("out_of_range", _none(~F.col("coefficient").between(0, 1)), "v = 0")]
    return report(cells, [*rows, ("cells", F.count(F.lit(1)), f"v = {expected_cells}" if expected_cells else "v > 0")])


def volumes(rows: DataFrame, cells: DataFrame) -> DataFrame:
    """The same valid cells in every interval, finite and not negative."""
    per = rows.groupBy("interval_id").agg(F.count(F.lit(1)).alias("n"), F.count_if(~E.finite(F.col("volume").cast("double"))).alias("bad"), F.count_if(F.col("volume") < 0).alias("neg"))
    want = cells.agg(F.count(F.lit(1)).alias("want"))
    return report(per.crossJoin(F.broadcast(want)), [
        ("intervals", F.count(F.lit(1)), "v > 0"), ("wrong_cell_count", F.count_if(F.col("n") != F.col("want")), "v = 0"),
        ("not_finite", F.sum("bad"), "v = 0"), ("negative", F.sum("neg"), "v = 0"),
    ])


def timeseries(series: DataFrame, cells: DataFrame, steps: int = 6) -> DataFrame:
    """V8: keys once, every cell in every step, known cells only, finite and not negative."""
    keys = series.groupBy("cell_id", "start_min").agg(F.count(F.lit(1)).alias("n"), F.min("runoff_m3").alias("least"), F.count_if(~E.finite(F.col("runoff_m3"))).alias("bad"))
    per = keys.groupBy("cell_id").agg(F.sum(F.col("n") - 1).alias("dup"), F.count(F.lit(1)).alias("steps"), F.min("least").alias("least"), F.sum("bad").alias("bad"))
    all_cells = per.join(cells.select("cell_id", F.lit(1).alias("known")), "cell_id", "full")
    return report(all_cells, [
        ("cells", F.count(F.lit(1)), "v > 0"), ("duplicates", F.sum("dup"), "v = 0"), ("unknown_cells", F.count_if(F.col("known").isNull()), "v = 0"),
        ("wrong_steps", F.count_if(F.coalesce("steps", F.lit(0)) != steps), "v = 0"), ("negative", F.count_if(F.col("least") < 0), "v = 0"), ("not_finite", F.sum("bad"), "v = 0"),
    ])


def flow_direction(cells: DataFrame, tolerance: float = 0.01) -> DataFrame:
    """V9: codes, exits, and whether water runs downhill. cells: row, col, direction, z."""
    moved = grid.downstream_by_code(cells, strict=False)
    to = cells.select(F.col("row").alias("down_row"), F.col("col").alias("down_col"), F.col("z").alias("z1"))
    j = moved.join(to, ["down_row", "down_col"], "left")
    d = F.col("z") - F.col("z1")
    return report(j, [
        *[(f"code_{k}", F.count_if(F.col("direction") == k), "") for k in grid.DIRECTIONS], ("bad_code", F.count_if("bad_code"), "v = 0"),
        ("exits", F.count_if(F.col("z1").isNull() & ~F.col("bad_code")), "v > 0"), ("downhill", F.count_if(d > tolerance), ""),
        ("level", F.count_if(F.abs(d) <= tolerance), ""), ("uphill", F.count_if(d < -tolerance), ""),
    ])


def lines(df: DataFrame, key: str, needed: list[str], area: list | None = None, tolerance: float = 0.05) -> DataFrame:
    """Columns, geometry, ids, lengths as recomputed, and cover by the union of the area's polygons (lists of
    rings) grown by ``tolerance``."""
    require_columns(df, needed, key)
    once = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"), F.first("geometry").alias("geometry"), F.first("length_m").alias("length_m"))
    rows = [
        ("rows", F.count(F.lit(1)), "v > 0"), ("duplicate_ids", F.sum(F.col("_n") - 1), "v = 0"), ("null_ids", F.count_if(F.col(key).isNull()), "v = 0"),
        ("unusable_geometry", _none(~G.is_usable(F.col("geometry"))), "v = 0"), ("no_length", _none(F.col("length_m") <= 0), "v = 0"),
        ("length_differs", _none(F.abs(G.length(F.col("geometry")) - F.col("length_m")) > 1.0), "v = 0"),
    ]
    if area:
        rows.append(("outside_area", F.count_if(F.exists("geometry.parts", lambda part: G.leaves_area(part, area, tolerance))), "v = 0"))
    return report(once, rows)


def drainage_provenance(df: DataFrame) -> DataFrame:
    """Inferred rows say so, and hydrology is positive."""
    return report(df, [
        ("wrong_source", _none(F.col("source_type") != PROVENANCE["drainage"]), "v = 0"), ("not_inferred", _none(~F.col("is_inferred")), "v = 0"),
        ("no_accumulation", _none(F.col("acc_cells") <= 0), "v = 0"), ("no_area", _none(F.col("upstream_area_m2") <= 0), "v = 0"),
    ])


def drainage_attributes(df: DataFrame) -> DataFrame:
    """Elevations, drops and slopes agree with each other within their tolerances."""
    drop = F.col("start_elevation_m") - F.col("end_elevation_m")
    slope = E.slope_of(F.col("elevation_drop_m"), F.col("length_m"))
    return report(df, [
        ("not_finite", F.count_if(~E.finite(F.col("start_elevation_m")) | ~E.finite(F.col("end_elevation_m"))), "v = 0"), ("uphill", F.count_if(drop < -0.05), "v = 0"),
        ("drop_differs", F.count_if(F.abs(drop - F.col("elevation_drop_m")) > 0.01), "v = 0"),
        ("slope_differs", F.count_if(F.abs(slope - F.col("slope_m_per_m")) > 1e-4), "v = 0"),
        ("percent_differs", F.count_if(F.abs(F.col("slope_m_per_m") * 100 - F.col("slope_percent")) > 0.01), "v = 0"),
    ])


def network(nodes: DataFrame, edges: DataFrame, forest: bool = True) -> DataFrame:
    """Ends are nodes, isolates, loops, components; for a drainage forest also branching and edges = nodes - components."""
    ids = nodes.select(F.col("node_id").alias("id"))
    deg = graph.degrees(ids, edges)
    comps = graph.components(ids, edges).agg(F.countDistinct("component").alias("components"), F.count(F.lit(1)).alias("nodes"))
    n_edges = edges.agg(F.count(F.lit(1)).alias("edges"), F.count_if(F.col("src") == F.col("dst")).alias("loops"))
    dangling = edges.select(F.explode(F.array("src", "dst")).alias("id")).join(ids, "id", "left_anti").agg(F.count(F.lit(1)).alias("dangling"))
    of_nodes = deg.agg(F.count_if((F.col("in_degree") == 0) & (F.col("out_degree") == 0)).alias("isolates"), F.count_if(F.col("out_degree") > 1).alias("branching"))
    one = comps.crossJoin(n_edges).crossJoin(dangling).crossJoin(of_nodes)
    rows = [("nodes", F.max("nodes"), "v > 0"), ("edges", F.max("edges"), "v > 0"), ("components", F.max("components"), ""), ("dangling", F.max("dangling"), "v = 0"), ("isolates", F.max("isolates"), "v = 0")]
    if forest:
        rows += [("loops", F.max("loops"), "v = 0"), ("branching", F.max("branching"), "v = 0"), ("forest_relation", F.max(F.col("edges") - F.col("nodes") + F.col("components")), "v = 0")]
    return report(one, rows)


def road_placeholders(edges: DataFrame) -> DataFrame:
    """A network without flood data has its placeholders, and costs are lengths."""
    return report(edges, [
        ("depth", _none(F.col("flood_depth_m") != -1), "v = 0"), ("risk", _none(F.col("flood_risk") != "unknown"), "v = 0"),
        ("passable", _none(F.col("is_passable") != 1), "v = 0"), ("cost", _none(F.abs(F.col("routing_cost") - F.col("length_m")) > 1e-9), "v = 0"),
    ])


def capacity(edges: DataFrame) -> DataFrame:
    """Class, section, slope floor, provenance, and the discharge as recomputed."""
    o = F.col("strahler_order")
    width, depth = E.section(o)
    again = E.manning_m3s(F.col("scenario_width_m"), F.col("scenario_depth_m"), F.col("capacity_effective_slope"))
    return report(edges, [
        ("order", _none(o < 1), "v = 0"), ("class", _none(E.capacity_class(o) != F.col("capacity_class")), "v = 0"),
        ("section", _none((F.col("scenario_width_m") != width) | (F.col("scenario_depth_m") != depth)), "v = 0"),
        ("slope", _none(F.col("capacity_effective_slope") < E.SLOPE_FLOOR), "v = 0"), ("discharge", _none(F.abs(again - F.col("capacity_m3s")) > 1e-6), "v = 0"),
        ("provenance", _none((F.col("capacity_source") != PROVENANCE["capacity_source"]) | (F.col("capacity_is_observed") != 0)), "v = 0"),
    ])


def capacity_matches(layer: DataFrame, edges: DataFrame, tolerance: float = 1e-6) -> DataFrame:
    """Every line of the layer has an edge of its name in the graph, with the same order and capacity."""
    there = edges.groupBy("drain_id").agg(F.last("strahler_order").alias("o"), F.last("capacity_m3s").alias("c"), F.lit(True).alias("in_graph"))
    j = layer.select("drain_id", "strahler_order", "capacity_m3s").join(there, "drain_id", "left")
    differs = (F.col("o").cast("int") != F.col("strahler_order").cast("int")) | (F.abs(F.col("c") - F.col("capacity_m3s")) > tolerance)
    return report(j, [
        ("lines", F.count(F.lit(1)), "v > 0"), ("missing_in_graph", F.count_if(F.col("in_graph").isNull()), "v = 0"),
        ("graph_differs", F.count_if(F.col("in_graph").isNotNull() & F.coalesce(differs, F.lit(True))), "v = 0"),
    ])


def inlet_graph(df: DataFrame, nodes: DataFrame, edges: DataFrame, tolerance: float = 0.01) -> DataFrame:
    """Degrees of the inlets' nodes, and drain, accumulation and area of their outgoing edge of largest accumulation."""
    degree = graph.degrees(nodes.select(F.col("node_id").alias("id")), edges).withColumnRenamed("id", "drain_node_id")
    top = edges.groupBy(F.col("src").alias("drain_node_id")).agg(
        F.max(F.struct(F.col("acc_cells").cast("double").alias("a"), "drain_id", "upstream_area_m2")).alias("top")
    )
    j = df.join(degree, "drain_node_id").join(top, "drain_node_id", "left")
    has = F.col("top").isNotNull()
    return report(j, [
        ("sinks_used", F.count_if(F.col("out_degree") <= 0), "v = 0"),
        ("degrees", _none((F.col("graph_in_degree") != F.col("in_degree")) | (F.col("graph_out_degree") != F.col("out_degree"))), "v = 0"),
        ("drain", F.count_if(has & F.coalesce(F.col("drain_id") != F.col("top.drain_id"), F.lit(True))), "v = 0"),
        ("accumulation", F.count_if(has & F.coalesce(F.col("acc_cells").cast("int") != F.col("top.a").cast("int"), F.lit(True))), "v = 0"),
        ("area", F.count_if(has & F.coalesce(F.abs(F.col("upstream_area_m2") - F.col("top.upstream_area_m2")) > tolerance, F.lit(True))), "v = 0"),
    ])


def inlets(df: DataFrame, nodes: DataFrame, edges: DataFrame, roads: DataFrame) -> DataFrame:
    """Ids, distances, methods, provenance, and references to nodes, edges and roads."""
    n = nodes.select(F.col("node_id").alias("drain_node_id"), F.col("x").alias("nx"), F.col("y").alias("ny"), F.lit(True).alias("n_ok"))
    e = edges.select("drain_id", F.lit(True).alias("e_ok")).dropDuplicates(["drain_id"])
    r = roads.select("road_id", F.lit(True).alias("r_ok")).dropDuplicates(["road_id"])
    j = materialize(df.join(n, "drain_node_id", "left").join(e, "drain_id", "left").join(r, "road_id", "left"), "inlets")
    d = F.col("distance_to_road_m")
    median = R.percentiles(j.select(d.cast("double").alias("d")), [], "d", {"median_distance": 0.5})
    return both(report(j, [
        ("rows", F.count(F.lit(1)), "v > 0"), ("duplicate_ids", F.count(F.lit(1)) - F.countDistinct("inlet_id"), "v = 0"), ("distance", _none(~d.between(0, E.SEARCH_M)), "v = 0"),
        ("method", F.count_if((d > E.INTERSECTION_M + 0.001) & (F.col("candidate_method") == "road_intersection")), "v = 0"),
        ("provenance", _none((F.col("source_type") != PROVENANCE["inlets"]) | (F.col("is_observed") != 0)), "v = 0"), ("unknown_node", F.count_if(F.col("n_ok").isNull()), "v = 0"),
        ("unknown_edge", F.count_if(F.col("e_ok").isNull()), "v = 0"), ("unknown_road", F.count_if(F.col("r_ok").isNull()), "v = 0"),
        ("moved", F.count_if(E.distance(F.col("x"), F.col("y"), F.col("nx"), F.col("ny")) > 0.001), "v = 0"),
    ]), report(median, [("median_distance", F.max("median_distance"), "")]))


def inlet_flags(df: DataFrame) -> DataFrame:
    """Eligibility, class and thresholds follow the rounded distance."""
    d = F.col("distance_to_road_m")
    return report(df, [
        ("eligibility", _none(F.col("coupling_eligible") != (d <= E.COUPLING_M).cast("int")), "v = 0"), ("class", _none(F.col("spatial_class") != E.distance_class(d)), "v = 0"),
        ("thresholds", _none((F.col("mapping_tolerance_m") != E.SEARCH_M) | (F.col("coupling_threshold_m") != E.COUPLING_M)), "v = 0"), ("horizon", F.count_if(d > E.SEARCH_M), "v = 0"),
    ])


def coupling(tables: dict[str, DataFrame]) -> DataFrame:
    """The audit, V and Q, node balances, capacities and the mass balance."""
    status = F.col("surface_mapping_status")
    audit = report(tables["inlet_surface_mapping"], [
        ("unknown_status", _none(~status.isin(*MAPPING_STATUS)), "v = 0"),
        ("audited", F.count(F.lit(1)), "v > 0"), ("selected_differs", F.count_if((F.col("surface_mapping_status") == "mapped") != (F.col("surface_mapping_selected") == 1)), "v = 0"),
        ("shared_cells", F.count_if(F.col("surface_mapping_selected") == 1) - F.countDistinct(F.when(F.col("surface_mapping_selected") == 1, F.struct("surface_row", "surface_col"))), "v = 0"),
    ])
    q = F.col("potential_inflow_q_m3s") * F.col("duration_s")
    flows = report(tables["inlet_interval_coupling"], [("volume_and_flow", F.count_if(F.abs(q - F.col("arrival_volume_m3")) > 1e-5), "v = 0")])
    t = F.col("total_q_m3s")
    out = F.col("conveyed_q_m3s") + F.col("overflow_q_m3s") + F.col("export_q_m3s")
    nodes = report(tables["drainage_interval_routing"], [
        ("node_balance", F.count_if(F.abs(t - out) > 1e-8), "v = 0"), ("inflow", F.count_if(F.abs(F.col("local_inlet_q_m3s") + F.col("upstream_q_m3s") - t) > 1e-8), "v = 0"),
        ("over_capacity", F.count_if(F.col("conveyed_q_m3s") > F.col("capacity_m3s") + 1e-8), "v = 0"), ("overflow_rows", F.count_if(F.col("overflow_volume_m3") > 1e-9), ""),
    ])
    return both(audit, flows, nodes, balance(tables["interval_mass_balance"]))


def balance(df: DataFrame) -> DataFrame:
    """Both balances of every interval close within max(0.05, 1e-8 of the volume)."""
    s = F.col("generated_surface_volume_m3") - F.col("captured_to_drain_volume_m3") - F.col("surface_export_volume_m3")
    d = F.col("drainage_input_volume_m3") - F.col("drainage_export_volume_m3") - F.col("drainage_overflow_volume_m3")
    return report(df, [
        ("intervals", F.count(F.lit(1)), "v > 0"), ("surface_balance", _none(~E.within_tolerance(s, F.col("generated_surface_volume_m3"))), "v = 0"),
        ("drainage_balance", _none(~E.within_tolerance(d, F.col("drainage_input_volume_m3"))), "v = 0"),
        ("captured_is_input", _none(~E.within_tolerance(F.col("captured_to_drain_volume_m3") - F.col("drainage_input_volume_m3"), F.col("drainage_input_volume_m3"))), "v = 0"),
    ])


def flood_depth(depth: DataFrame, overflow: DataFrame, cell_area: float) -> DataFrame:
    """Finite, not negative, percentiles, and the volume of each interval conserved."""
    d = F.col("depth_m").cast("double")
    stats = report(depth, [("negative", F.count_if(d < 0), "v = 0"), ("not_finite", F.count_if(~E.finite(d)), "v = 0"), ("max", F.max(d), "")])
    p = R.percentiles(depth.select(d.alias("d")), [], "d", {f"p{n}": n / 100 for n in (50, 90, 95, 99)})
    stats = both(stats, report(p, [(f"p{n}", F.max(f"p{n}"), "") for n in (50, 90, 95, 99)]))
    a = depth.groupBy("interval_id").agg(F.sum(d * cell_area).alias("a"))
    b = overflow.groupBy("interval_id").agg(F.sum(F.col("volume").cast("double")).alias("b"))
    off = ~E.within_tolerance(F.coalesce("a", F.lit(0.0)) - F.coalesce("b", F.lit(0.0)), F.coalesce("b", F.lit(0.0)) * 100, 0.01)
    return both(stats, report(a.join(b, "interval_id", "full"), [("volume_lost", F.count_if(off), "v = 0")]))


def hotspot(depth: DataFrame, dem: DataFrame, overflow: DataFrame, radius: int = 5) -> DataFrame:
    """The deepest cell and its disc: elevations, depths and overflow around it. One interval."""
    cells = dem.select("row", "col", "z").join(depth.select("row", "col", F.col("depth_m").cast("double").alias("d")), ["row", "col"], "left")
    cells = cells.join(overflow.select("row", "col", F.col("volume").cast("double").alias("v")), ["row", "col"], "left")
    hot = grid.hottest(depth.select("row", "col", F.col("depth_m").cast("double").alias("d")), "d").select("row", "col")
    return report(grid.neighbourhood(hot, cells, grid.disc(radius)), [
        ("row", F.max("row"), ""), ("col", F.max("col"), ""), ("cells", F.count(F.lit(1)), ""), ("z_min", F.min("n_z"), ""), ("z_median", F.median("n_z"), ""), ("z_max", F.max("n_z"), ""),
        ("depth_max", F.max("n_d"), ""), ("depth_median", F.median("n_d"), ""), ("overflow", F.sum("n_v"), ""), ("sources", F.count_if(F.col("n_v") > 0), ""),
    ])
