"""The stages from rainfall to flood depth, as functions from frames to frames. Intervals are rows, not loops."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runnel.functions import exprs as E
from runnel.functions import geo as G
from runnel.operators import graph, grid, planar, relational, spatial
from runnel.schema import PROVENANCE, require_columns
from runnel.staging import materialize

# --- runoff ---


def runoff_coefficient(cells: DataFrame, meta: dict, green: DataFrame, roads: DataFrame, buildings: DataFrame) -> DataFrame:
    """row, col, coefficient: default, then green areas, roads (all touched cells) and buildings, later ones win."""
    layers = [
        (grid.cells_in_polygons(cells, green, meta), E.COEFFICIENTS["green_open"]),
        (grid.cells_on_lines(roads, meta), E.COEFFICIENTS["road"]),
        (grid.cells_in_polygons(cells, buildings, meta), E.COEFFICIENTS["building"]),
    ]
    return grid.overlay(cells, layers, E.COEFFICIENTS["default_urban"])


def intervals(points: DataFrame) -> DataFrame:
    """interval_id, start_min, end_min, duration_s, mm from scenario points (minutes, intensity)."""
    steps = relational.rain_intervals(points)
    return steps.select(
        E.interval_id(F.col("start_min"), F.col("end_min")).alias("interval_id"), "start_min", "end_min",
        ((F.col("end_min") - F.col("start_min")) * 60).cast("int").alias("duration_s"), "mm",
    )


def runoff_volumes(cells: DataFrame, steps: DataFrame, cell_area: float) -> DataFrame:
    """Volume of every cell (row, col, coefficient) in every interval; volume is stored as float."""
    volume = E.runoff_m3(F.col("mm"), F.col("coefficient"), F.lit(cell_area))
    return cells.crossJoin(F.broadcast(steps)).select("interval_id", "start_min", "end_min", "row", "col", volume.cast("float").alias("volume"))


def runoff_cells(cells: DataFrame, meta: dict) -> DataFrame:
    x, y = grid.centre_of(F.col("row"), F.col("col"), meta)
    return cells.select(
        E.cell_id(F.col("row"), F.col("col")).alias("cell_id"), "row", "col", x.alias("x"), y.alias("y"),
        F.lit(abs(meta["dx"] * meta["dy"])).alias("cell_area_m2"), F.col("coefficient").cast("double").alias("runoff_coefficient"),
        E.surface_class(F.col("coefficient")).alias("surface_class"),
    )


def runoff_timeseries(cell_table: DataFrame, volumes: DataFrame) -> DataFrame:
    """cell_id, start_min, end_min, runoff_m3 of every cell and interval; a missing or bad value fails the job."""
    joined = cell_table.select("cell_id", "row", "col").join(volumes, ["row", "col"], "left")
    bad = ~E.valid(F.col("volume")) | (F.col("volume") < 0)
    value = F.when(F.coalesce(bad, F.lit(True)), F.raise_error(F.concat(F.lit("no valid runoff in "), "cell_id"))).otherwise(F.col("volume"))
    return joined.select("cell_id", "start_min", "end_min", value.cast("double").alias("runoff_m3"))


# --- surface flow ---


def pointers(cells: DataFrame, strict: bool = True) -> DataFrame:
    """cell and down (names of cells) from direction codes."""
    moved = grid.downstream_by_code(cells, strict=strict)
    down = F.when(F.col("down_row").isNotNull(), E.cell_id(F.col("down_row"), F.col("down_col")))
    return moved.withColumn("cell", E.cell_id(F.col("row"), F.col("col"))).withColumn("down", down).drop("down_row", "down_col")


def wide(volumes: DataFrame, names: list[str]) -> DataFrame:
    """A column of volumes for each interval, so that one routing carries all of them."""
    at = [F.sum(F.when(F.col("interval_id") == n, F.col("volume").cast("double"))).alias(f"v_{n}") for n in names]
    return volumes.groupBy("row", "col").agg(*at)


def long(routed: DataFrame, names: list[str], keys: list[str]) -> DataFrame:
    cells = F.explode(F.array(*[F.struct(F.lit(n).alias("interval_id"), F.col(f"v_{n}").alias("volume")) for n in names]))
    return routed.select(*keys, cells.alias("_v")).select(*keys, "_v.*")


def route_surface(cells: DataFrame, volumes: DataFrame, names: list[str]) -> tuple[DataFrame, DataFrame]:
    """Accumulated volume of each cell and interval, and the exported volume of each interval."""
    at = pointers(cells.select("row", "col", "direction")).join(wide(volumes, names), ["row", "col"])
    total = materialize(graph.accumulate(at, [f"v_{n}" for n in names]), "routed")
    outlets = at.filter("down is null").select("cell").join(total, "cell")
    exported = long(outlets, names, ["cell"]).groupBy("interval_id").agg(F.sum("volume").alias("surface_export_volume_m3"))
    return long(at.select("cell", "row", "col").join(total, "cell"), names, ["row", "col"]), exported


# --- drainage ---


def derive_segments(cells: DataFrame, meta: dict, least: int = 25) -> DataFrame:
    """Two-point lines from each cell of ``least`` or more accumulation to its downstream cell, with a status.

    cells: row, col, direction, accumulation. status: segment, bad_direction or no_downstream_cell; only segments have
    a geometry.
    """
    moved = grid.downstream_by_code(cells, strict=False).filter(F.col("accumulation") >= least)
    x0, y0 = grid.centre_of(F.col("row"), F.col("col"), meta)
    x1, y1 = grid.centre_of(F.col("down_row"), F.col("down_col"), meta)
    status = F.when(F.col("bad_code"), "bad_direction").when(F.col("down_row").isNull(), "no_downstream_cell").otherwise("segment")
    line = F.struct(F.lit("LineString").alias("type"), F.array(F.array(G.point(x0, y0), G.point(x1, y1))).alias("parts"))
    out = moved.withColumn("status", status).withColumn("geometry", F.when(F.col("status") == "segment", line))
    return out.select(
        "row", "col", "status", F.lit(PROVENANCE["drainage"]).alias("source_type"), F.lit(True).alias("is_inferred"),
        F.rint("accumulation").cast("int").alias("acc_cells"), (F.rint("accumulation") * abs(meta["dx"] * meta["dy"])).alias("upstream_area_m2"),
        E.rint_n(G.length(F.col("geometry")), 3).alias("length_m"), "geometry",
    )


def name_segments(segments: DataFrame) -> DataFrame:
    kept = segments.filter("status = 'segment' and length_m > 0").drop("status")
    return graph.relabel(kept, ["row", "col"], "RN_DRAIN", "drain_id")


def enrich_segments(segments: DataFrame, dem: DataFrame, slope: DataFrame, meta: dict) -> DataFrame:
    """Elevations at both ends, drop, slopes, and the terrain slope half way; null where a sample is missing."""

    def sampled(rows: DataFrame, p: Column, cells: DataFrame, value: str, name: str) -> DataFrame:
        row, col = grid.cell_of(p["x"], p["y"], meta)
        at = rows.withColumn("_r", row).withColumn("_c", col)
        there = cells.select(F.col("row").alias("_r"), F.col("col").alias("_c"), F.col(value).alias(name))
        return at.join(there, ["_r", "_c"], "left").drop("_r", "_c")

    out = sampled(segments, G.first_point(F.col("geometry")), dem, "z", "start_elevation_m")
    out = sampled(out, G.last_point(F.col("geometry")), dem, "z", "end_elevation_m")
    out = sampled(out, G.midpoint(F.element_at("geometry.parts", 1)), slope, "slope", "terrain_slope_deg")
    out = out.withColumn("elevation_drop_m", F.col("start_elevation_m") - F.col("end_elevation_m"))
    s = E.slope_of(F.col("elevation_drop_m"), F.col("length_m"))
    out = out.withColumn("slope_m_per_m", s).withColumn("slope_percent", s * 100)
    digits = {"start_elevation_m": 3, "end_elevation_m": 3, "elevation_drop_m": 3, "slope_m_per_m": 6, "slope_percent": 4, "terrain_slope_deg": 3}
    return out.withColumns({c: E.rint_n(F.col(c), n) for c, n in digits.items()})


def drainage_network(segments: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes and directed edges; the edge takes the line's columns and hydraulic_capacity_known = 0."""
    lines = segments.withColumn("id", F.col("drain_id")).withColumn("parts", F.col("geometry.parts")).withColumnRenamed("drain_id", "source_drain_id")
    nodes, edges = graph.network(lines.drop("geometry"), "RN_DNODE")
    edges = edges.withColumn("geometry_wkt", G.wkt_line(F.col("part"))).withColumn("hydraulic_capacity_known", F.lit(0))
    return nodes, edges.withColumnRenamed("edge_id", "drain_id").drop("id", "part")


def with_capacity(edges: DataFrame) -> DataFrame:
    """Strahler order of the upstream node, class, section, effective slope and Manning capacity of every edge."""
    require_columns(edges, ["src", "dst", "slope_m_per_m"], "drainage edges")
    tree = materialize(edges.select("src", "dst").distinct(), "tree")
    relational.assert_none(tree.groupBy("src").count().filter("count > 1"), "a node has more than one outgoing edge")
    ids = tree.select(F.col("src").alias("id")).union(tree.select("dst")).distinct()
    roots = graph.roots(materialize(ids.join(tree.select(F.col("src").alias("id"), "dst"), "id", "left"), "nodes"), "id", "dst")
    orders = graph.strahler(tree, roots).select(F.col("id").alias("src"), F.col("order").alias("strahler_order"))
    width, depth = E.section(F.col("strahler_order"))
    out = edges.join(orders, "src").withColumn("capacity_class", E.capacity_class(F.col("strahler_order")))
    out = out.withColumn("scenario_width_m", width).withColumn("scenario_depth_m", depth).withColumn("scenario_manning_n", F.lit(E.MANNING_N))
    slope = F.greatest(E.safe_double(F.col("slope_m_per_m"), 0.0), F.lit(E.SLOPE_FLOOR))
    out = out.withColumn("capacity_effective_slope", slope).withColumn("capacity_slope_floor", F.lit(E.SLOPE_FLOOR))
    capacity = E.manning_m3s(F.col("scenario_width_m"), F.col("scenario_depth_m"), F.col("capacity_effective_slope"))
    out = out.withColumn("capacity_m3s", capacity).withColumn("capacity_scenario", F.lit(PROVENANCE["capacity_scenario"]))
    return out.withColumn("capacity_source", F.lit(PROVENANCE["capacity_source"])).withColumn("capacity_is_observed", F.lit(0))


def capacity_lookup(edges: DataFrame) -> DataFrame:
    """One row per source_drain_id: of its parts the one of the highest order."""
    rest = [c for c in ("strahler_order", "capacity_class", "capacity_m3s", "capacity_effective_slope") if c in edges.columns]
    return relational.keep_last(edges, ["source_drain_id"], ["strahler_order", "drain_id", *[c for c in rest if c != "strahler_order"]], rest)


# --- inlets ---


def derive_inlets(nodes: DataFrame, edges: DataFrame, roads: DataFrame, dem: DataFrame, meta: dict) -> DataFrame:
    """Inlet candidates: nodes with an outgoing edge and a road within 30 m.

    roads: road_id and geometry. The method is judged on the distance as measured, class and eligibility on the
    distance rounded to 3 digits.
    """
    degree = graph.degrees(nodes.select(F.col("node_id").alias("id")), edges).filter("out_degree > 0")
    top = relational.keep_last(edges, ["src"], ["acc_cells", "drain_id", "upstream_area_m2"], ["drain_id", "acc_cells", "upstream_area_m2"])
    points = nodes.select(F.col("node_id").alias("id"), "x", "y").join(degree.select("id"), "id", "left_semi")
    part = roads.select("road_id", F.explode("geometry.parts").alias("p"))
    pairs = F.explode(F.arrays_zip(F.slice("p", F.lit(1), F.size("p") - 1).alias("a"), F.slice("p", F.lit(2), F.size("p") - 1).alias("b")))
    segs = part.filter(F.size("p") > 1).select(F.col("road_id").alias("sid"), pairs.alias("s")).select(
        "sid", F.col("s.a.x").alias("ax"), F.col("s.a.y").alias("ay"), F.col("s.b.x").alias("bx"), F.col("s.b.y").alias("by")
    )
    near = spatial.nearest_segment(points, segs, E.SEARCH_M)
    at = near.join(points, "id").join(degree, "id").join(top.withColumnRenamed("src", "id"), "id")
    sampled = grid.sample_points(at, dem, meta, "z")
    d = F.col("distance_to_road_m")
    out = sampled.withColumn("candidate_method", E.candidate_method(F.col("distance"))).withColumn("distance_to_road_m", E.rint_n(F.col("distance"), 3))
    out = out.withColumn("coupling_eligible", (d <= E.COUPLING_M).cast("int")).withColumn("spatial_class", E.distance_class(d))
    out = graph.relabel(out, ["x", "y", "id"], "RN_INLET", "inlet_id")
    return out.select(
        "inlet_id", F.col("id").alias("drain_node_id"), "drain_id", F.col("sid").alias("road_id"), "candidate_method", "spatial_class", "coupling_eligible",
        "distance_to_road_m", E.rint_n(F.col("z"), 3).alias("elevation_m"), "acc_cells", "upstream_area_m2",
        F.col("in_degree").cast("int").alias("graph_in_degree"), F.col("out_degree").cast("int").alias("graph_out_degree"),
        F.lit(PROVENANCE["inlets"]).alias("source_type"), F.lit(0).alias("is_observed"), F.lit(E.SEARCH_M).alias("mapping_tolerance_m"),
        F.lit(E.COUPLING_M).alias("coupling_threshold_m"), "x", "y",
    )


# --- coupling ---


def couple(cells: DataFrame, volumes: DataFrame, steps: DataFrame, inlets: DataFrame, nodes: DataFrame, edges: DataFrame, meta: dict, scenario: str) -> dict[str, DataFrame]:
    """Surface runoff to first inlets, inlet flow through the network, overflow where capacity ends.

    cells: row, col, direction; volumes per interval; inlets: inlet_id, drain_node_id, drain_id, road_id,
    coupling_eligible, x, y; nodes: node_id, x, y; edges: src, dst, drain_id, capacity_m3s. Water overflows at its node,
    which need not have an inlet. Returns inlet_surface_mapping,
    inlet_interval_coupling, drainage_interval_routing, drainage_overflow_points and interval_mass_balance.
    """
    names = [r[0] for r in steps.select("interval_id").orderBy("start_min").collect()]  # a scenario has few intervals
    eligible = inlets.filter("coupling_eligible = 1")
    audit = spatial.map_inlets(eligible, cells, meta, F.lit(meta["width"]), F.lit(meta["height"]), ["inlet_id"])
    audit = materialize(audit, "mapping")
    at = pointers(cells.select("row", "col", "direction")).join(wide(volumes, names), ["row", "col"])
    at = materialize(at, "surface")
    mapped = audit.filter("surface_mapping_selected = 1").withColumn("cell", E.cell_id(F.col("surface_row"), F.col("surface_col")))
    routed = materialize(graph.capture_at(at, mapped, [f"v_{n}" for n in names]), "captured")
    arrived = long(routed.filter("captured"), names, ["cell"])
    per_inlet = arrived.join(mapped, "cell").join(F.broadcast(steps), "interval_id")
    one_edge = edges.groupBy(F.col("src").alias("drain_node_id")).agg(F.first("capacity_m3s").alias("entry_capacity_m3s"), F.count(F.lit(1)).alias("_n"))
    relational.assert_none(one_edge.filter("_n > 1"), "the network branches")
    q = E.volume_to_flow(F.col("volume"), F.col("duration_s"))
    coupling = per_inlet.join(one_edge.drop("_n"), "drain_node_id", "left").select(
        "interval_id", F.lit(scenario).alias("scenario_id"), "start_min", "end_min", "duration_s", "inlet_id", "drain_node_id", "drain_id", "road_id",
        "surface_row", "surface_col", F.col("volume").alias("arrival_volume_m3"), q.alias("potential_inflow_q_m3s"), "entry_capacity_m3s",
        F.lit(PROVENANCE["capacity_source"]).alias("entry_capacity_source"), F.lit(0).alias("entry_capacity_is_observed"),
        F.lit("first_inlet_surface_capture").alias("coupling_method"),
    )
    coupling = materialize(coupling, "coupling")
    local = coupling.groupBy("interval_id", "drain_node_id").agg(F.sum("potential_inflow_q_m3s").alias("local"))
    ids = edges.select(F.col("src").alias("id")).union(edges.select("dst")).union(nodes.select("node_id")).distinct()
    tree = ids.join(edges.select(F.col("src").alias("id"), F.col("dst").alias("down"), F.col("capacity_m3s").alias("capacity"), F.col("drain_id").alias("outgoing_drain_id")), "id", "left")
    tree = materialize(tree, "tree")
    dealt = tree.join(graph.roots(tree, "id", "down").select("id", "root"), "id").crossJoin(F.broadcast(steps.select("interval_id")))
    dealt = dealt.join(local.withColumnRenamed("drain_node_id", "id"), ["interval_id", "id"], "left")
    flows = graph.capacity_route(dealt.select("interval_id", "id", "down", "capacity", "root", "local"), ["interval_id"])
    routing = flows.join(tree.select("id", "outgoing_drain_id", "capacity"), "id").join(F.broadcast(steps), "interval_id")
    routing = materialize(
        routing.select(
            "interval_id", F.lit(scenario).alias("scenario_id"), "start_min", "end_min", "duration_s", F.col("id").alias("drain_node_id"),
            F.col("local").alias("local_inlet_q_m3s"), F.col("upstream").alias("upstream_q_m3s"), F.col("total").alias("total_q_m3s"), "outgoing_drain_id",
            F.col("capacity").alias("capacity_m3s"), F.lit(PROVENANCE["capacity_source"]).alias("capacity_source"), F.lit(0).alias("capacity_is_observed"),
            F.col("conveyed").alias("conveyed_q_m3s"), F.col("overflow").alias("overflow_q_m3s"), F.col("export").alias("export_q_m3s"),
            E.flow_to_volume(F.col("overflow"), F.col("duration_s")).alias("overflow_volume_m3"),
        ),
        "routing",
    )
    xy = nodes.select(F.col("node_id").alias("drain_node_id"), "x", "y")
    points = routing.filter("overflow_q_m3s > 0").join(xy, "drain_node_id", "left").withColumn("source_type", F.lit(PROVENANCE["overflow"]))
    generated = volumes.groupBy("interval_id").agg(F.sum(F.col("volume").cast("double")).alias("g"))
    surface = long(routed, names, ["captured", "outlet"]).groupBy("interval_id").agg(
        F.sum(F.when(F.col("captured"), F.col("volume")).otherwise(0.0)).alias("c"), F.sum(F.when(F.col("outlet"), F.col("volume")).otherwise(0.0)).alias("e")
    )
    drained = routing.groupBy("interval_id").agg(
        F.sum(F.col("local_inlet_q_m3s") * F.col("duration_s")).alias("i"), F.sum(F.col("export_q_m3s") * F.col("duration_s")).alias("x"), F.sum("overflow_volume_m3").alias("o")
    )
    g, c, e, i, x, o = (F.col(k) for k in "gceixo")
    balance = F.broadcast(steps).join(generated, "interval_id").join(surface, "interval_id").join(drained, "interval_id").select(
        "interval_id", F.lit(scenario).alias("scenario_id"), "start_min", "end_min", "duration_s", g.alias("generated_surface_volume_m3"),
        c.alias("captured_to_drain_volume_m3"), e.alias("surface_export_volume_m3"), (g - c - e).alias("surface_balance_error_m3"),
        i.alias("drainage_input_volume_m3"), x.alias("drainage_export_volume_m3"), o.alias("drainage_overflow_volume_m3"),
        (i - x - o).alias("drainage_balance_error_m3"), E.ratio(c, g).alias("surface_capture_fraction"),
    )
    ok = E.within_tolerance(F.col("surface_balance_error_m3"), F.col("generated_surface_volume_m3")) & E.within_tolerance(
        F.col("drainage_balance_error_m3"), F.col("drainage_input_volume_m3")
    )
    balance = materialize(balance, "balance")
    relational.assert_none(balance.filter(~ok), "mass is not conserved")
    return {
        "inlet_surface_mapping": audit, "inlet_interval_coupling": coupling, "drainage_interval_routing": routing,
        "drainage_overflow_points": points, "interval_mass_balance": balance,
    }


# --- flood ---


def overflow_cells(points: DataFrame, cells: DataFrame, balance: DataFrame, meta: dict) -> DataFrame:
    """interval_id, row, col, volume: overflow points added up in valid cells; fails off the grid or off balance."""
    row, col = grid.cell_of(F.col("x"), F.col("y"), meta)
    summed = points.groupBy("interval_id", row.alias("row"), col.alias("col")).agg(F.sum("overflow_volume_m3").alias("volume"))
    summed = materialize(summed.join(cells.select("row", "col", F.lit(True).alias("_in")), ["row", "col"], "left"), "overflow")
    relational.assert_none(summed.filter("_in is null"), "an overflow point lies on no valid cell")
    totals = summed.groupBy("interval_id").agg(F.sum("volume").alias("v"))
    check = balance.select("interval_id", "drainage_overflow_volume_m3").join(totals, "interval_id", "left")
    off = ~E.within_tolerance(F.coalesce("v", F.lit(0.0)) - F.col("drainage_overflow_volume_m3"), F.col("drainage_overflow_volume_m3"), 0.01)
    relational.assert_none(check.filter(off), "overflow does not match the mass balance")
    return summed.select("interval_id", "row", "col", F.col("volume").cast("float").alias("volume"))


def flood_depth(overflow: DataFrame, dem: DataFrame, cell_area: float, radius: int = 5) -> DataFrame:
    """interval_id, row, col, depth_m of all cells that overflow reaches; dem: row, col, z of the cells in the area.

    Sources off the dem take no part; ``dropped_volume`` tells what they hold.
    """
    from pyspark.sql import Window as W

    sources = overflow.join(dem.select("row", "col"), ["row", "col"], "left_semi").filter("volume > 0")
    near = grid.neighbourhood(sources, dem.select("row", "col", "z"), grid.disc(radius))
    one = W.partitionBy("interval_id", "row", "col")
    d = F.sqrt((F.col("dr") * F.col("dr") + F.col("dc") * F.col("dc")).cast("double"))
    w = near.withColumn("_w", E.decay_weight(F.col("n_z"), F.min("n_z").over(one), d))
    part = w.withColumn("_v", F.col("volume").cast("double") * F.col("_w") / F.sum("_w").over(one))
    summed = part.groupBy("interval_id", F.col("n_row").alias("row"), F.col("n_col").alias("col")).agg(F.sum("_v").alias("volume"))
    return summed.select("interval_id", "row", "col", "volume", (F.col("volume") / cell_area).cast("float").alias("depth_m"))


def dropped_volume(overflow: DataFrame, dem: DataFrame) -> DataFrame:
    off = overflow.join(dem.select("row", "col"), ["row", "col"], "left_anti")
    return off.groupBy("interval_id").agg(F.sum(F.col("volume").cast("double")).alias("dropped_volume"))


def depth_summary(depth: DataFrame) -> DataFrame:
    d = F.col("depth_m").cast("double")
    bands = [F.count_if(d >= b).alias(f"cells_ge_{b:.2f}m") for b in E.DEPTH_BANDS]
    out = depth.groupBy("interval_id").agg(F.count_if(d > 0).alias("wet_cells"), *bands, F.avg(d).alias("mean_m"), F.max(d).alias("max_m"))
    shares = {f"p{n}_m": n / 100 for n in (50, 90, 95, 99)}
    return out.join(relational.percentiles(depth.select("interval_id", d.alias("d")), ["interval_id"], "d", shares), "interval_id")


# --- roads ---


def process_roads(raw: DataFrame, area: DataFrame | None = None) -> DataFrame:
    """OSM ways to the roads table: lists joined, oneway as boolean, lines clipped to the area, stable ids.

    area: polygons (id, geometry) of the area of interest.
    """
    names = {"osmid": "osm_id", "highway": "road_class"}
    texts = ["name", "lanes", "maxspeed", "surface", "bridge", "tunnel", "access"]
    kinds = dict(raw.dtypes)

    def text(c: str) -> Column:
        if c not in raw.columns:
            return F.lit(None).cast("string")
        return E.joined(F.transform(c, lambda x: x.cast("string"))) if kinds[c].startswith("array") else F.col(c).cast("string")

    out = raw.select(
        *[text(c).alias(n) for c, n in names.items()], *[text(c).alias(c) for c in texts],
        E.yes_no(F.col("oneway") if "oneway" in raw.columns else F.lit(None)).alias("oneway"), "geometry",
    )
    out = out.filter(G.is_usable(F.col("geometry")) & F.col("geometry.type").isin("LineString", "MultiLineString"))
    if area is not None:
        whole = materialize(out.withColumn("id", F.monotonically_increasing_id()), "ways")
        out = whole.drop("geometry").join(planar.clip_lines(whole.select("id", "geometry"), area), "id").drop("id")
    out = out.withColumn("length_m", E.rint_n(G.length(F.col("geometry")), 3)).filter("length_m > 0")
    out = out.withColumn("_w", F.array_join(F.transform("geometry.parts", G.wkt_line), ";"))
    out = graph.relabel(out, ["osm_id", "_w"], "RN_ROAD", "road_id").drop("_w")
    return out.select("road_id", "osm_id", "road_class", "name", "oneway", *texts[1:], "geometry", "length_m")


def road_network(roads: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes and undirected edges with the placeholders of a network without flood data."""
    lines = roads.withColumn("id", F.col("road_id")).withColumn("parts", F.col("geometry.parts")).withColumnRenamed("road_id", "source_road_id")
    nodes, edges = graph.network(lines.drop("geometry"), "RN_NODE")
    edges = edges.withColumn("length_m", E.rint_n(G.part_length(F.col("part")), 3)).withColumn("geometry_wkt", G.wkt_line(F.col("part")))
    edges = edges.withColumn("flood_depth_m", F.lit(-1.0)).withColumn("flood_risk", F.lit("unknown")).withColumn("is_passable", F.lit(1))
    return nodes, edges.withColumn("routing_cost", F.col("length_m")).withColumnRenamed("edge_id", "road_id").drop("id")


def flooded_network(edges: DataFrame, depth: DataFrame, meta: dict, impassable_m: float = 0.30) -> DataFrame:
    """Edges with the greatest depth of the cells their line touches: risk, passability and a cost that grows with depth.

    edges keep the column ``part``; depth: row, col, depth_m of one interval. An edge deeper than ``impassable_m`` is
    not passable, its cost is null.
    """
    cells = edges.select("road_id", F.explode(G.touched_cells(F.col("part"), meta["x0"], meta["y0"], meta["dx"], abs(meta["dy"]))).alias("c"))
    deep = cells.select("road_id", "c.row", "c.col").join(depth.select("row", "col", F.col("depth_m").cast("double").alias("d")), ["row", "col"])
    worst = deep.groupBy("road_id").agg(F.max("d").alias("_d"))
    d = F.coalesce("_d", F.lit(0.0))
    risk = F.when(d < E.DEPTH_BANDS[0], "none").when(d < E.DEPTH_BANDS[1], "low").when(d < E.DEPTH_BANDS[2], "medium").otherwise("high")
    out = edges.join(worst, "road_id", "left").withColumn("flood_depth_m", d).withColumn("flood_risk", risk)
    out = out.withColumn("is_passable", (F.col("flood_depth_m") < impassable_m).cast("int"))
    return out.withColumn("routing_cost", F.when(F.col("is_passable") == 1, F.col("length_m") * (1 + F.col("flood_depth_m") / impassable_m))).drop("_d")
