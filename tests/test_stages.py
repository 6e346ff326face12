import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from runnel.operators import relational
from runnel.plans import checks, stages
from runnel.sources import files

META = {"srid": 32643, "width": 12, "height": 10, "x0": 1000.0, "y0": 2000.0, "dx": 30.0, "dy": -30.0}
GOLDEN_MM = [13.75, 23.75, 35.0, 37.5, 28.75, 17.5]
GOLDEN_RAIN = [20, 35, 60, 80, 70, 45, 25]


@pytest.fixture(scope="module")
def scenario(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("rain") / "scenario.json"
    points = [{"minutes": 30 * i, "rainfall_mm_hr": v} for i, v in enumerate(GOLDEN_RAIN)]
    path.write_text(json.dumps({"scenario_id": "demo", "location": "x", "source": "synthetic", "interval_minutes": 30, "forecast_horizon_minutes": 180, "forecast": points}, indent=1))
    return files.read_scenario(spark, str(path))


@pytest.fixture(scope="module")
def steps(scenario):
    return stages.intervals(files.scenario_points(scenario)).cache()


@pytest.fixture(scope="module")
def cells(spark):
    """A valley that drains east along row 5; the left column is invalid."""
    rows = []
    for r in range(10):
        for c in range(1, 12):
            code = 8 if r == 5 else 6 if r < 5 else 2
            rows.append((r, c, code, float(20 * abs(r - 5) + 2 * (12 - c)), float(1 if r != 5 else 10 * c)))
    return spark.createDataFrame(rows, "row int, col int, direction int, z double, accumulation double").cache()


def test_rain(scenario, steps):
    assert [r.mm for r in steps.orderBy("start_min").collect()] == GOLDEN_MM
    assert checks.passed(checks.rainfall(scenario))


def test_golden_ratio_of_volume_to_rain(steps):
    """A catchment with 2186.95 cells' worth of coefficients gives the published volumes."""
    got = [r.v for r in steps.orderBy("start_min").select((F.col("mm") / 1000 * 900 * 2186.95).alias("v")).collect()]
    want = [27063.51, 46746.06, 68888.93, 73809.57, 56587.33, 34444.46]
    assert all(abs(a - b) < 0.05 for a, b in zip(got, want, strict=True))


def polygon(spark, *rings):
    return spark.createDataFrame([(("Polygon", [[(float(x), float(y)) for x, y in ring]]),) for ring in rings], "geometry struct<type:string,parts:array<array<struct<x:double,y:double>>>>")


def lines(spark, rows):
    return spark.createDataFrame([(n, ("LineString", [[(float(x), float(y)) for x, y in p]])) for n, p in rows], "road_id string, geometry struct<type:string,parts:array<array<struct<x:double,y:double>>>>")


def test_end_to_end(spark, cells, steps):
    box = lambda c, r, n=1: [(1000 + 30 * c, 2000 - 30 * r), (1000 + 30 * (c + n), 2000 - 30 * r), (1000 + 30 * (c + n), 2000 - 30 * (r + n)), (1000 + 30 * c, 2000 - 30 * (r + n)), (1000 + 30 * c, 2000 - 30 * r)]
    road = lines(spark, [("RN_ROAD_00001", [(1000.0 + 45, 2000 - 168), (1000 + 355, 2000 - 168)])])
    coef = stages.runoff_coefficient(cells, META, polygon(spark, box(2, 1, 3)), road, polygon(spark, box(3, 2)))
    by = {(r.row, r.col): r.coefficient for r in coef.collect()}
    assert by[1, 2] == 0.3 and by[2, 3] == 0.9 and by[5, 4] == 0.85 and by[9, 9] == 0.75
    coef = spark.createDataFrame([(r, c, v) for (r, c), v in by.items()], "row int, col int, coefficient double").cache()
    assert checks.passed(checks.runoff_coefficient(coef, 110))

    volumes = stages.runoff_volumes(coef, steps, 900.0).cache()
    assert volumes.count() == 660 and checks.passed(checks.volumes(volumes, cells))
    table = stages.runoff_cells(coef, META)
    assert checks.passed(checks.timeseries(stages.runoff_timeseries(table, volumes), table))
    names = [r[0] for r in steps.select("interval_id").orderBy("start_min").collect()]
    routed, exported = stages.route_surface(cells, volumes, names)
    total = {r.interval_id: r.s for r in volumes.groupBy("interval_id").agg(F.sum(F.col("volume").cast("double")).alias("s")).collect()}
    for r in exported.collect():
        assert abs(r.surface_export_volume_m3 - total[r.interval_id]) < 1e-6
    assert routed.count() == 660

    segments = stages.name_segments(stages.derive_segments(cells, META))
    assert [r.status for r in stages.derive_segments(cells, META).filter("status <> 'segment'").collect()] == ["no_downstream_cell"]
    slope = cells.select("row", "col", F.lit(1.5).alias("slope"))
    rich = stages.enrich_segments(segments, cells, slope, META)
    assert checks.passed(checks.drainage_provenance(rich)) and checks.passed(checks.drainage_attributes(rich))
    assert checks.passed(checks.lines(rich, "drain_id", ["source_type", "length_m"]))
    nodes, edges = stages.drainage_network(rich)
    edges = stages.with_capacity(edges).cache()
    assert checks.passed(checks.network(nodes, edges)) and checks.passed(checks.capacity(edges))
    assert stages.capacity_lookup(edges).count() == edges.count() == 8
    inlets = stages.derive_inlets(nodes, edges, road, cells, META).cache()
    assert inlets.count() == 8 and checks.passed(checks.inlets(inlets, nodes, edges, road)) and checks.passed(checks.inlet_flags(inlets))

    tables = stages.couple(cells, volumes, steps, inlets, nodes, edges, META, "demo")
    result = checks.coupling(tables)
    assert checks.passed(result), result.collect()
    balance = tables["interval_mass_balance"].collect()
    assert all(0 < r.surface_capture_fraction <= 1 and r.drainage_overflow_volume_m3 > 0 for r in balance)
    over = stages.overflow_cells(tables["drainage_overflow_points"], cells, tables["interval_mass_balance"], META).cache()
    depth = stages.flood_depth(over, cells, 900.0).cache()
    result = checks.flood_depth(depth, over, 900.0)
    assert checks.passed(result), result.collect()
    assert stages.depth_summary(depth).count() == 6 and stages.dropped_volume(over, cells).count() == 0
    last = depth.filter(F.col("interval_id") == names[3])
    assert checks.hotspot(last, cells, over.filter(F.col("interval_id") == names[3])).count() == 10

    rnodes, redges = stages.road_network(road.withColumn("length_m", F.lit(310.0)))
    assert checks.passed(checks.road_placeholders(redges)) and rnodes.count() == 2
    wet = stages.flooded_network(redges, last, META).first()
    assert wet.flood_risk in ("low", "medium", "high") and (wet.is_passable == 1) == (wet.routing_cost is not None)
    flow = checks.flow_direction(cells)
    assert checks.passed(flow)


def test_water_overflows_at_a_node_without_inlet(spark, cells, steps):
    """N1 takes all water in; the pipe after N2 is too small, so it overflows at N2 and arrives in N2's cell."""
    volumes = stages.runoff_volumes(cells.select("row", "col", F.lit(0.9).alias("coefficient")), steps, 900.0).cache()
    at = lambda row, col: (1000 + 30 * (col + 0.5), 2000 - 30 * (row + 0.5))
    nodes = spark.createDataFrame([(f"N{i}", *at(5, c)) for i, c in ((1, 3), (2, 6), (3, 9))], "node_id string, x double, y double")
    edges = spark.createDataFrame([("N1", "N2", "D1", 100.0), ("N2", "N3", "D2", 0.001)], "src string, dst string, drain_id string, capacity_m3s double")
    inlet = "inlet_id string, drain_node_id string, drain_id string, road_id string, coupling_eligible int, x double, y double"
    rows = [("I1", "N1", "D1", "R", 1, *at(5, 3)), ("I2", "N1", "D1", "R", 1, at(5, 3)[0] + 4, at(5, 3)[1]), ("I3", "N1", "D1", "R", 1, *at(50, 3))]
    rows += [("I4", "N1", "D1", "R", 1, *at(5, 0)), ("I5", "N1", "D1", "R", 1, None, None), ("I6", "N1", "D1", "R", 0, *at(5, 8))]
    tables = stages.couple(cells, volumes, steps, spark.createDataFrame(rows, inlet), nodes, edges, META, "demo")
    status = {r.inlet_id: (r.surface_mapping_status, r.surface_row, r.surface_col) for r in tables["inlet_surface_mapping"].collect()}
    assert status == {
        "I1": ("mapped", 5, 3), "I2": ("excluded_same_30m_cell", 5, 3), "I3": ("excluded_outside_grid", -1, -1),
        "I4": ("excluded_outside_runoff_aoi", 5, 0), "I5": ("excluded_invalid_geometry", -1, -1),
    }
    result = checks.coupling(tables)
    assert checks.passed(result), result.collect()
    points = tables["drainage_overflow_points"].collect()
    assert {(r.drain_node_id, r.x, r.y) for r in points} == {("N2", *at(5, 6))} and len(points) == 6
    over = stages.overflow_cells(tables["drainage_overflow_points"], cells, tables["interval_mass_balance"], META).collect()
    assert {(r.row, r.col) for r in over if r.volume > 0} == {(5, 6)}
    assert abs(sum(r.volume for r in over) - sum(r.overflow_volume_m3 for r in points)) < 0.01
    assert not checks.passed(checks.coupling(tables | {"inlet_surface_mapping": tables["inlet_surface_mapping"].withColumn("surface_mapping_status", F.lit("lost"))}))


def test_percentiles_of_ranges(spark):
    rnd = random.Random(2)
    rows = [(k, rnd.choice((1.0, 2.0, rnd.random() * 50))) for k in ("a", "b", None) for _ in range(rnd.randrange(1, 400))] + [("c", 7.0), ("d", None), ("a", None)]
    df = spark.createDataFrame(rows, "k string, v double").repartition(7)
    got = {r.k: (r.p0, r.p50, r.p99, r.p100) for r in relational.percentiles(df, ["k"], "v", {"p0": 0, "p50": 0.5, "p99": 0.99, "p100": 1}).collect()}
    for k in ("a", "b", "c", None):
        want = np.percentile([v for x, v in rows if x == k and v is not None], [0, 50, 99, 100])
        assert np.allclose(got[k], want), k
    assert len(got) == 4
    assert abs(relational.percentiles(df, [], "v", {"m": 0.5}).first().m - np.median([v for _, v in rows if v is not None])) < 1e-9
    assert relational.percentiles(df.limit(0), [], "v", {"m": 0.5}).first().m is None


def test_golden_mass_balance_closes(spark, tmp_path):
    """The rounded published rows pass the same rule."""
    head = "interval_id,scenario_id,start_min,end_min,duration_s,generated_surface_volume_m3,captured_to_drain_volume_m3,surface_export_volume_m3,surface_balance_error_m3,drainage_input_volume_m3,drainage_export_volume_m3,drainage_overflow_volume_m3,drainage_balance_error_m3,surface_capture_fraction"
    rows = ["000_030,d,0,30,1800,27063.51,23705.55,3357.96,0,23705.55,2478.51,21227.04,0,0.8759", "030_060,d,30,60,1800,46746.06,40945.95,5800.11,0,40945.95,2485.15,38460.80,0,0.8759"]
    (tmp_path / "b.csv").write_text("\n".join([head, *rows]))
    df = files.read_table(spark, str(tmp_path / "b.csv"), "interval_mass_balance")
    assert [r.interval_id for r in df.collect()] == ["000_030", "030_060"]
    assert checks.passed(checks.balance(df))
    with pytest.raises(ValueError, match="surface_balance"):
        checks.require(checks.balance(df.withColumn("surface_export_volume_m3", F.lit(0.0))))


def test_roads_from_osm(spark):
    raw = spark.createDataFrame(
        [([1, 2], "residential", "True", ("LineString", [[(0.0, 0.0), (10.0, 0.0)]])), ([3], "primary", None, ("LineString", [[(-5.0, 1.0), (20.0, 1.0)]])), ([4], "x", "no", None)],
        "osmid array<long>, highway string, oneway string, geometry struct<type:string,parts:array<array<struct<x:double,y:double>>>>",
    )
    shape = ("Polygon", [[(0.0, -5.0), (12.0, -5.0), (12.0, 5.0), (0.0, 5.0), (0.0, -5.0)]])
    area = spark.createDataFrame([(1, shape)], "id int, geometry struct<type:string,parts:array<array<struct<x:double,y:double>>>>")
    got = stages.process_roads(raw, area).orderBy("road_id").collect()
    assert [(r.osm_id, r.oneway, r.length_m, r.name) for r in got] == [("1;2", True, 10.0, None), ("3", False, 12.0, None)]


def test_files_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("a", ("Polygon", [[(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 0.0)]])), ("b", ("Point", [[(2.0, 3.0)]])), ("c", None)], "name string, geometry struct<type:string,parts:array<array<struct<x:double,y:double>>>>")
    files.write_geojson(df, str(tmp_path / "l"))
    (tmp_path / "one.geojson").write_text(files.feature_collection(df))
    for path, by_line in (("l", True), ("one.geojson", False)):
        got = files.read_geojson(spark, str(tmp_path / path), "name string", lines=by_line)
        assert sorted(got.collect(), key=str) == sorted(df.collect(), key=str)
    assert json.loads(files.feature_collection(df.limit(0)))["features"] == []

    nodes = spark.createDataFrame([("n<1>", 1.5), ("n2", None)], "id string, x double")
    edges = spark.createDataFrame([("n<1>", "n2", 0, "A&B"), ("n<1>", "n2", 1, "C")], "src string, dst string, key int, label string")
    (tmp_path / "g.graphml").write_text(files.graphml(nodes, edges))
    n, e = files.read_graphml(spark, str(tmp_path / "g.graphml"))
    assert {r.id: r.data.get("x") for r in n.collect()} == {"n<1>": "1.5", "n2": None}
    assert sorted((r.src, r.dst, r.key, r.data["label"]) for r in e.collect()) == [("n<1>", "n2", 0, "A&B"), ("n<1>", "n2", 1, "C")]

    rnd = random.Random(1)
    band = np.array([[rnd.random() if (r + c) % 3 else -9999.0 for c in range(7)] for r in range(5)], np.float32)
    (tmp_path / "v_000_030.tif").write_bytes(files.tiff_bytes(band, 1000.0, 2000.0, 30.0, 30.0, tags={"units": "m3"}))
    got = files.with_interval(files.read_tiff(spark, str(tmp_path / "*.tif"))).collect()
    assert {(r.row, r.col): r.value for r in got} == {(r, c): float(band[r, c]) for r in range(5) for c in range(7) if band[r, c] != -9999}
    assert {r.interval_id for r in got} == {"000_030"}
    meta = files.read_tiff_meta(spark, str(tmp_path / "*.tif")).first()
    assert (meta.width, meta.x0, meta.dy, meta.nodata, meta.tags, meta.srid) == (7, 1000.0, -30.0, -9999.0, {"units": "m3"}, None)


def gdal_tiff(band, end="<", tile=None, predictor=1, packed=8, bands=1):
    """A file as the common raster library lays it out: header, values, blocks, and the directory last, in either byte order."""
    import struct
    import zlib

    height, width = band.shape
    wide, high = tile or (width, 3)
    blocks = []
    for r in range(0, height, high):
        for c in range(0, width, wide):
            part = band[r : r + high, c : c + wide]
            if tile:
                part = np.pad(part, ((0, high - part.shape[0]), (0, wide - part.shape[1])))
            if predictor == 2:
                part = np.diff(part, axis=1, prepend=part.dtype.type(0))
            raw = part.astype(part.dtype.newbyteorder(end))
            if predictor == 3:
                size = part.itemsize
                planes = part.astype(f">f{size}").view(np.uint8).reshape(*part.shape, size).transpose(0, 2, 1).reshape(part.shape[0], -1)
                raw = np.diff(planes, axis=1, prepend=np.uint8(0))
            blocks.append(zlib.compress(raw.tobytes()) if packed != 1 else raw.tobytes())
    sample = {"f": 3, "u": 1, "i": 2}[band.dtype.kind]
    metadata = b'<GDALMetadata>\n  <Item name="units">m3_per_cell</Item>\n  <Item name="start_minutes">30</Item>\n  <Item name="end_minutes">60</Item>\n  <Item name="S" sample="0">x</Item>\n</GDALMetadata>\n\0'
    keys = (1, 1, 0, 4, 1024, 0, 1, 1, 1025, 0, 1, 1, 2048, 0, 1, 4326, 3072, 0, 1, 32643)
    tags = {256: (3, [width]), 257: (3, [height]), 258: (3, [band.itemsize * 8] * bands), 259: (3, [packed]), 262: (3, [1]), 277: (3, [bands]), 284: (3, [2]), 339: (3, [sample] * bands), 317: (3, [predictor])}
    tags |= {322: (3, [wide]), 323: (3, [high])} if tile else {278: (3, [high])}
    tags |= {33550: (12, [30.0, 30.0, 0.0]), 33922: (12, [0.0, 0.0, 0.0, 1000.0, 2000.0, 0.0]), 34735: (3, list(keys)), 42112: (2, metadata), 42113: (2, b"-9999\0")}
    out = bytearray((b"II" if end == "<" else b"MM") + struct.pack(end + "HI", 42, 0))
    offsets = []
    for b in blocks * bands:
        offsets.append(len(out))
        out += b + b"\0" * (len(b) % 2)
    tags |= {324 if tile else 273: (4, offsets), 325 if tile else 279: (4, [len(b) for b in blocks * bands])}
    entries = b""
    for tag in sorted(tags):
        kind, values = tags[tag]
        data = values if kind == 2 else struct.pack(f"{end}{len(values)}{ {3: 'H', 4: 'I', 12: 'd'}[kind]}", *values)
        if len(data) > 4:
            entries += struct.pack(end + "HHII", tag, kind, len(values), len(out))
            out += data + b"\0" * (len(data) % 2)
        else:
            entries += struct.pack(end + "HHI", tag, kind, len(values)) + data.ljust(4, b"\0")
    struct.pack_into(end + "I", out, 4, len(out))
    return bytes(out + struct.pack(end + "H", len(tags)) + entries + b"\0\0\0\0")


@pytest.mark.parametrize("end", ["<", ">"])
@pytest.mark.parametrize("kind,predictor", [("f4", 1), ("f4", 3), ("f8", 3), ("u1", 2), ("i2", 2), ("u2", 1)])
@pytest.mark.parametrize("tile", [None, (16, 16)])
def test_rasters_as_common_libraries_write_them(end, kind, predictor, tile):
    rnd = np.random.default_rng(3)
    band = (rnd.random((21, 37)) * 200).astype(kind)
    got, meta = files.parse_tiff(gdal_tiff(band, end, tile, predictor, packed=8 if predictor > 1 or tile else 1, bands=2))
    assert (got == band).all() and got.dtype == np.dtype(kind)
    assert (meta["srid"], meta["nodata"], meta["x0"], meta["y0"], meta["dx"], meta["dy"]) == (32643, -9999.0, 1000.0, 2000.0, 30.0, -30.0)
    assert meta["tags"] == {"units": "m3_per_cell", "start_minutes": "30", "end_minutes": "60"}


def test_rasters_from_rows_and_back(spark, tmp_path):
    rows = [(k, r, c, float(r * 10 + c + len(k)), "m3", s) for k, s in (("v_a", 0), ("v_b", 30)) for r in range(10) for c in range(12) if (r + c) % 4]
    df = spark.createDataFrame(rows, "name string, row int, col int, depth double, units string, start_minutes int").repartition(3)
    files.save_tiffs(files.write_tiffs(df, "name", "depth", META, ["units", "start_minutes"]), f"file://{tmp_path}/out")
    got = {(r.path.split("/")[-1], r.row, r.col): r.value for r in files.read_tiff(spark, f"{tmp_path}/out/*.tif").collect()}
    assert got == {(f"{k}.tif", r, c): v for k, r, c, v, _, _ in rows}
    meta = files.read_tiff_meta(spark, f"{tmp_path}/out/*.tif")
    assert {(r.srid, r.tags["units"], r.tags["start_minutes"]) for r in meta.collect()} == {(32643, "m3", "0"), (32643, "m3", "30")}
    assert checks.passed(checks.alignment(meta))
    (tmp_path / "other.tif").write_bytes(gdal_tiff(np.zeros((10, 13), np.float32)))
    assert not checks.passed(checks.alignment(meta.union(files.read_tiff_meta(spark, f"{tmp_path}/other.tif"))))


def test_geopackage(spark, tmp_path):
    import sqlite3
    import struct

    path = tmp_path / "a.gpkg"
    base = sqlite3.connect(path)
    base.execute('CREATE TABLE roads (name TEXT, geom BLOB)')
    wkb = b"\x01" + struct.pack("<II4d", 2, 2, 0, 0, 3, 4)
    base.execute("INSERT INTO roads VALUES ('r1', ?), ('r2', NULL)", (b"GP\0\x01" + struct.pack("<i", 4326) + wkb,))
    base.commit()
    got = {r.name: r.geometry for r in files.read_gpkg(spark, str(path), "roads", "name string").collect()}
    assert got["r2"] is None and [tuple(p) for p in got["r1"].parts[0]] == [(0, 0), (3, 4)]


def test_geopackage_round_trip(spark, tmp_path):
    shapes = [("Point", [[(1.0, 2.0)]]), ("LineString", [[(0.0, 0.0), (1.0, 5.0)]]), ("Polygon", [[(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 0.0)], [(1.0, 0.5), (2.0, 0.5), (2.0, 1.0), (1.0, 0.5)]])]
    shapes += [("MultiLineString", [[(0.0, 0.0), (1.0, 1.0)], [(2.0, 2.0), (3.0, 3.0), (4.0, 2.0)]]), ("MultiPolygon", [[(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 0.0)]]), None]
    df = spark.createDataFrame([(f"n{i}", i, i / 4, i % 2 == 0, g) for i, g in enumerate(shapes)], "name string, k long, v double, b boolean, geometry struct<type:string,parts:array<array<struct<x:double,y:double>>>>")
    files.write_gpkg(df, f"file://{tmp_path}/out.gpkg", "layer one", 32643)
    got = files.read_gpkg(spark, f"{tmp_path}/out.gpkg", "layer one", "name string, k long, v double")
    assert sorted(got.collect(), key=str) == sorted(df.drop("b").collect(), key=str)


def test_paths_overwrite_and_types(spark, tmp_path):
    for n in ("b_1.txt", "a_2.txt", "c.csv"):
        (tmp_path / n).write_text("x")
    assert [p.split("/")[-1] for p in files.matching(spark, f"file://{tmp_path}/*.txt")] == ["a_2.txt", "b_1.txt"]
    assert files.first_existing(spark, [f"file://{tmp_path}/none", f"file://{tmp_path}/c.csv"]).endswith("c.csv")
    with pytest.raises(FileNotFoundError):
        files.first_existing(spark, [f"file://{tmp_path}/none"])
    path = f"file://{tmp_path}/t"
    spark.range(5).write.parquet(path)
    files.overwrite(spark.read.parquet(path).filter("id > 2"), path)
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [3, 4]
    rows = spark.createDataFrame([("n", {"x": "1.5", "k": "7", "ok": "True"}), ("m", {"x": "nan", "k": "?"})], "id string, data map<string,string>")
    got = [tuple(r) for r in files.typed(rows, "x double, k int, ok boolean, name string").orderBy("id").collect()]
    assert got == [("m", 0.0, 0, False, ""), ("n", 1.5, 7, True, "")]


def test_stream_gives_interval_depths(spark, tmp_path):
    from runnel.streaming import rain

    src = tmp_path / "in"
    spark.sql("SELECT 'd' AS scenario_id, timestamp'2024-01-01 00:00:00' + make_interval(0,0,0,0,0,10*id) AS ts, 20.0D AS rainfall_mm_hr FROM range(13)").write.parquet(str(src))
    stream = spark.readStream.schema("scenario_id string, ts timestamp, rainfall_mm_hr double").parquet(str(src))
    seen = []
    q = rain.start(rain.interval_depths(stream), lambda df, _: seen.extend(df.collect()), str(tmp_path / "ck"))
    q.processAllAvailable()
    q.stop()
    assert len(seen) >= 3 and all(r.mm == 10.0 for r in seen)
