"""Readers and writers: scenario JSON, CSV, GeoJSON, GraphML, GeoTIFF, GeoPackage.

Everything is read through Spark's own readers (text, xml, binaryFile), so any path Spark can open will do.
"""

from __future__ import annotations

import json
import sqlite3
import struct
import zlib
from collections.abc import Iterator
from xml.etree import ElementTree

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from runnel import schema
from runnel.functions import exprs as E
from runnel.staging import exists, materialize

# --- paths ---


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """The paths that a glob names, in order."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(pattern)
    found = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(at)
    return sorted(f.getPath().toString() for f in found or [])


def first_existing(spark: SparkSession, paths: list[str]) -> str:
    """The first of several places at which there is something; FileNotFoundError if none has it."""
    for path in paths:
        if exists(spark, path):
            return path
    raise FileNotFoundError(f"none of {', '.join(paths)}")


def overwrite(df: DataFrame, path: str) -> None:
    """Replace a Parquet table by a frame that may read it: the rows are complete elsewhere before the old ones go."""
    materialize(df, "overwrite").write.mode("overwrite").parquet(path)


def save_bytes(spark: SparkSession, path: str, content: bytes) -> None:
    """Write one file through the cluster's file system."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    out = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(at, True)
    out.write(bytearray(content))
    out.close()


# --- scenario and CSV ---


def read_scenario(spark: SparkSession, path: str) -> DataFrame:
    """One row per scenario document."""
    return spark.read.schema(schema.TABLES["rainfall"]).option("multiLine", True).json(path)


def scenario_points(scenario: DataFrame) -> DataFrame:
    """scenario_id, minutes, intensity."""
    return scenario.select("scenario_id", F.explode("forecast").alias("f")).select(
        "scenario_id", F.col("f.minutes").alias("minutes"), F.col("f.rainfall_mm_hr").alias("intensity")
    )


def read_table(spark: SparkSession, path: str, name: str) -> DataFrame:
    """A CSV with a header as table ``name`` of runnel.schema; interval_id stays text."""
    return spark.read.schema(schema.TABLES[name]).csv(path, header=True)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.csv(path, header=True)


def with_interval(df: DataFrame, start: Column | None = None, end: Column | None = None) -> DataFrame:
    """start_min, end_min and interval_id from tags if given, else from the file name; fails where end <= start."""
    from_name = E.interval_from_name(F.regexp_extract(F.col("_metadata.file_path") if "path" not in df.columns else F.col("path"), r"([^/]+)$", 1))
    s = F.coalesce(start, from_name[0]) if start is not None else from_name[0]
    e = F.coalesce(end, from_name[1]) if end is not None else from_name[1]
    bad = F.raise_error(F.lit("an interval must end after it starts"))
    df = df.withColumn("start_min", s).withColumn("end_min", F.when(e > s, e).otherwise(bad))
    return df.withColumn("interval_id", E.interval_id(F.col("start_min"), F.col("end_min")))


# --- GeoJSON ---

_PT = "struct<x:double,y:double>"


def _points(c: Column) -> Column:
    return F.transform(c, lambda p: F.struct(p[0].alias("x"), p[1].alias("y")))


def _geometry(g: Column) -> Column:
    """struct(type, parts) of a struct(type, coordinates as JSON text)."""
    kind, text = g["type"], g["coordinates"]
    flat = F.from_json(text, "array<double>")
    line = F.from_json(text, "array<array<double>>")
    rings = F.from_json(text, "array<array<array<double>>>")
    many = F.flatten(F.from_json(text, "array<array<array<array<double>>>>"))
    parts = (
        F.when(kind == "Point", F.array(F.array(F.struct(flat[0].alias("x"), flat[1].alias("y")))))
        .when(kind.isin("LineString", "MultiPoint"), F.array(_points(line)))
        .when(kind.isin("Polygon", "MultiLineString"), F.transform(rings, _points))
        .when(kind == "MultiPolygon", F.transform(many, _points))
    )
    return F.when(kind.isNotNull(), F.struct(kind.alias("type"), parts.alias("parts")))


def read_geojson(spark: SparkSession, path: str, properties: str, lines: bool = False) -> DataFrame:
    """Properties (a schema; absent ones are null) and geometry of a FeatureCollection, or, with ``lines``, of features
    one a line, which is the form for large layers: a collection is one document and read by one task."""
    feature = f"struct<properties:struct<{properties}>,geometry:struct<type:string,coordinates:string>>"
    if lines:
        rows = spark.read.text(path).select(F.from_json("value", feature).alias("f"))
    else:
        doc = spark.read.text(path, wholetext=True).select(F.from_json("value", f"struct<features:array<{feature}>>").alias("d"))
        rows = doc.select(F.explode("d.features").alias("f"))
    return rows.select("f.properties.*", _geometry(F.col("f.geometry")).alias("geometry"))


def geojson_features(df: DataFrame) -> DataFrame:
    """Column ``value``: each row as a feature."""
    g = F.col("geometry")
    pairs = F.transform(g["parts"], lambda part: F.transform(part, lambda p: F.array(p["x"], p["y"])))
    one = F.element_at(pairs, 1)
    text = (
        F.when(g["type"] == "Point", F.to_json(F.element_at(one, 1)))
        .when(g["type"].isin("LineString", "MultiPoint"), F.to_json(one))
        .when(g["type"] == "MultiPolygon", F.to_json(F.transform(pairs, lambda ring: F.array(ring))))
        .otherwise(F.to_json(pairs))
    )
    geometry = F.when(g.isNull(), "null").otherwise(F.concat(F.lit('{"type":"'), g["type"], F.lit('","coordinates":'), text, F.lit("}")))
    rest = [c for c in df.columns if c != "geometry"]
    props = F.to_json(F.struct(*rest), {"ignoreNullFields": "false"}) if rest else F.lit("{}")
    return df.select(F.concat(F.lit('{"type":"Feature","properties":'), props, F.lit(',"geometry":'), geometry, F.lit("}")).alias("value"))


def write_geojson(df: DataFrame, path: str) -> None:
    """Features one a line, in parallel; an empty frame writes an empty, readable set."""
    geojson_features(df).write.text(path)


def feature_collection(df: DataFrame) -> str:
    """The layer as one document, for layers small enough for one; an empty layer is an empty collection."""
    return '{"type":"FeatureCollection","features":[' + ",".join(r.value for r in geojson_features(df).toLocalIterator()) + "]}"


# --- GraphML ---


def read_graphml(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Nodes (id, data) and edges (src, dst, key, data); data maps attribute names to text, to be cast by the caller.

    Parallel edges are kept. The number of declared keys is that of attributes, not of rows.
    """
    data = "data array<struct<_key:string,_VALUE:string>>"
    keys = spark.read.format("xml").option("rowTag", "key").schema("_id string, `_attr.name` string").load(path)
    names = {r[0]: r[1] for r in keys.select("_id", "`_attr.name`").collect()}
    pairs = [x for k, v in names.items() for x in (F.lit(k), F.lit(v))]
    of = F.create_map(*pairs) if pairs else F.create_map(F.lit(""), F.lit(""))
    attrs = F.map_from_entries(F.transform(F.coalesce("data", F.array().cast("array<struct<_key:string,_VALUE:string>>")), lambda d: F.struct(of[d["_key"]], d["_VALUE"])))
    nodes = spark.read.format("xml").option("rowTag", "node").schema(f"_id string, {data}").load(path)
    edges = spark.read.format("xml").option("rowTag", "edge").schema(f"_source string, _target string, _id string, {data}").load(path)
    return nodes.select(F.col("_id").alias("id"), attrs.alias("data")), edges.select(
        F.col("_source").alias("src"), F.col("_target").alias("dst"), F.coalesce(F.col("_id").try_cast("int"), F.lit(0)).alias("key"), attrs.alias("data")
    )


def typed(rows: DataFrame, columns: str) -> DataFrame:
    """The attributes in ``data`` as columns of a schema; text that is no number is 0, no truth false, absent text empty."""
    from pyspark.sql import types as T

    def cast(f: T.StructField) -> Column:
        text = F.try_element_at("data", F.lit(f.name))
        kind = f.dataType.simpleString()
        if kind in ("double", "float"):
            return E.safe_double(text).cast(kind)
        if kind in ("int", "bigint"):
            return E.safe_int(text).cast(kind)
        return E.yes_no(text) if kind == "boolean" else E.safe_string(text)

    fields = T._parse_datatype_string(columns).fields
    return rows.select(*[c for c in rows.columns if c != "data"], *[cast(f).alias(f.name) for f in fields])


def _xml(c: Column) -> Column:
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def graphml(nodes: DataFrame, edges: DataFrame, directed: bool = True) -> str:
    """A GraphML document of nodes (id, attributes) and edges (src, dst, key, attributes), for exchange of small graphs."""

    def rows(df: DataFrame, tag: str, fixed: dict[str, str], prefix: str) -> tuple[list[str], list[str]]:
        attrs = [c for c in df.columns if c not in fixed]
        kinds = dict(df.dtypes)
        named = {"bigint": "long", "int": "int", "double": "double", "boolean": "boolean"}
        heads = [f'<key id="{prefix}{i}" for="{tag}" attr.name="{c}" attr.type="{named.get(kinds[c], "string")}"/>' for i, c in enumerate(attrs)]
        opened = F.concat(*[x for c, a in fixed.items() for x in (F.lit(f' {a}="'), _xml(F.col(c).cast("string")), F.lit('"'))])
        cells = [F.coalesce(F.concat(F.lit(f'<data key="{prefix}{i}">'), _xml(F.col(c).cast("string")), F.lit("</data>")), F.lit("")) for i, c in enumerate(attrs)]
        line = F.concat(F.lit(f"<{tag}"), opened, F.lit(">"), *cells, F.lit(f"</{tag}>"))
        return heads, [r[0] for r in df.select(line).toLocalIterator()]

    nh, nl = rows(nodes, "node", {"id": "id"}, "n")
    eh, el = rows(edges, "edge", {"src": "source", "dst": "target", "key": "id"}, "e")
    head = '<?xml version="1.0" encoding="utf-8"?>\n<graphml xmlns="http://graphml.graphdrawing.org/xmlns">'
    kind = "directed" if directed else "undirected"
    return "\n".join([head, *nh, *eh, f'<graph edgedefault="{kind}">', *nl, *el, "</graph>", "</graphml>"])


# --- GeoTIFF ---

_SIZES = {1: 1, 2: 1, 3: 2, 4: 4, 5: 8, 12: 8}
_READS = {1: "B", 3: "H", 4: "I", 12: "d"}


def _tags(data: bytes) -> dict[int, tuple]:
    end = "<" if data[:2] == b"II" else ">"
    (at,) = struct.unpack_from(end + "I", data, 4)
    (n,) = struct.unpack_from(end + "H", data, at)
    out: dict = {0: (end,)}
    for i in range(n):
        tag, kind, count = struct.unpack_from(end + "HHI", data, at + 2 + 12 * i)
        size = _SIZES.get(kind, 1) * count
        place = at + 10 + 12 * i if size <= 4 else struct.unpack_from(end + "I", data, at + 10 + 12 * i)[0]
        out[tag] = (data[place : place + size].rstrip(b"\0").decode("latin-1"),) if kind == 2 else struct.unpack_from(f"{end}{count}{_READS.get(kind, 'B')}", data, place)
    return out


def _unpredict(block: np.ndarray, predictor: int) -> np.ndarray:
    """Undo horizontal differences (2), or differences of the bytes of floats, most significant first (3)."""
    if predictor == 2:
        block = block.astype(block.dtype.newbyteorder("="))
        return np.cumsum(block, axis=1, dtype=block.dtype)
    rows, width, size = *block.shape, block.dtype.itemsize
    planes = np.cumsum(np.ascontiguousarray(block).view(np.uint8).reshape(rows, width * size), axis=1, dtype=np.uint8)
    return np.ascontiguousarray(planes.reshape(rows, size, width).transpose(0, 2, 1)).view(f">f{size}")[:, :, 0]


def _srid(t: dict) -> int | None:
    """EPSG code out of the key directory: of the projected system (3072), else of the geographic one (2048)."""
    keys = t.get(34735, ())
    found = {keys[i]: keys[i + 3] for i in range(4, len(keys) - 3, 4) if keys[i + 1] == 0}
    code = found.get(3072, found.get(2048))
    return None if code in (None, 0, 32767) else int(code)


def parse_tiff(data: bytes) -> tuple[np.ndarray, dict]:
    """First band and meta (width, height, x0, y0, dx, dy, nodata, srid, tags) of a GeoTIFF.

    Strips or tiles, plain or deflate, with or without a predictor, one band or several that lie apart or together.
    Tags are the items of GDAL's metadata (42112) of the whole file, and the JSON of an image description.
    """
    t = _tags(data)
    end, width, height = t[0][0], t[256][0], t[257][0]
    bits, bands = t.get(258, (1,))[0], t.get(277, (1,))[0]
    kind = {(32, 3): "f4", (64, 3): "f8", (8, 1): "u1", (16, 1): "u2", (32, 1): "u4", (8, 2): "i1", (16, 2): "i2", (32, 2): "i4"}[bits, t.get(339, (1,))[0]]
    packed, predictor = t.get(259, (1,))[0], t.get(317, (1,))[0]
    if packed not in (1, 8, 32946) or predictor not in (1, 2, 3):
        raise ValueError(f"compression {packed} with predictor {predictor} cannot be read")
    together = bands if t.get(284, (1,))[0] == 1 else 1
    tiled = 322 in t
    wide, high = (t[322][0], t[323][0]) if tiled else (width, min(height, t.get(278, (height,))[0]))
    across, down = -(-width // wide), -(-height // high)
    places = list(zip(t[324] if tiled else t[273], t[325] if tiled else t[279], strict=True))[: across * down]  # of the first band
    band = np.zeros((height, width), np.dtype(end + kind).newbyteorder("="))
    for i, (offset, size) in enumerate(places):
        r, c = i // across * high, i % across * wide
        rows = high if tiled else min(high, height - r)
        raw = data[offset : offset + size]
        block = np.frombuffer(zlib.decompress(raw) if packed != 1 else raw, end + kind, rows * wide * together).reshape(rows, wide, together)
        if predictor > 1 and together > 1:
            raise ValueError("a predictor over bands that lie together cannot be read")
        block = _unpredict(block[:, :, 0], predictor) if predictor > 1 else block[:, :, 0]
        band[r : r + rows, c : c + wide] = block[: height - r, : width - c]
    scale, tie = t.get(33550, (1.0, 1.0, 0.0)), t.get(33922, (0, 0, 0, 0.0, 0.0, 0.0))
    meta = {"width": width, "height": height, "x0": tie[3] - tie[0] * scale[0], "y0": tie[4] + tie[1] * scale[1], "dx": scale[0], "dy": -scale[1]}
    meta["nodata"] = float(t[42113][0]) if 42113 in t else None
    meta["srid"] = _srid(t)
    tags = json.loads(t[270][0]) if 270 in t and t[270][0].startswith("{") else {}
    if 42112 in t:
        tags |= {i.get("name"): i.text or "" for i in ElementTree.fromstring(t[42112][0]).iter("Item") if i.get("sample") is None}
    meta["tags"] = tags
    return band, meta


def tiff_bytes(band: np.ndarray, x0: float, y0: float, dx: float, dy: float, nodata: float = E.NODATA, tags: dict | None = None, srid: int | None = None) -> bytes:
    """A float32 deflate GeoTIFF of one strip, with its projected system; tags are GDAL metadata items."""
    height, width = band.shape
    body = zlib.compress(band.astype("<f4").tobytes(), 6)
    none = f"{nodata:g}".encode() + b"\0"
    extra = [(33550, 12, struct.pack("<3d", dx, abs(dy), 0.0)), (33922, 12, struct.pack("<6d", 0, 0, 0, x0, y0, 0)), (42113, 2, none)]
    if tags:
        root = ElementTree.Element("GDALMetadata")
        for name, value in sorted(tags.items()):
            ElementTree.SubElement(root, "Item", name=str(name)).text = str(value)
        extra.append((42112, 2, ElementTree.tostring(root) + b"\0"))
    if srid is not None:
        extra.append((34735, 3, struct.pack("<16H", 1, 1, 0, 3, 1024, 0, 1, 1, 1025, 0, 1, 1, 3072, 0, 1, srid)))
    plain = [(256, 4, width), (257, 4, height), (258, 3, 32), (259, 3, 8), (262, 3, 1), (277, 3, 1), (278, 4, height), (279, 4, len(body)), (339, 3, 3)]
    entries, blob = [], b""
    n = len(extra) + len(plain) + 1
    start = 8 + 2 + 12 * n + 4
    for tag, kind, value in extra:
        count = len(value) // _SIZES[kind]
        if len(value) <= 4:
            entries.append((tag, struct.pack("<HHI", tag, kind, count) + value.ljust(4, b"\0")))
        else:
            entries.append((tag, struct.pack("<HHII", tag, kind, count, start + len(blob))))
            blob += value + b"\0" * (len(value) % 2)  # values begin at even places
    entries += [(tag, struct.pack("<HHI", tag, kind, 1) + (struct.pack("<HH", v, 0) if kind == 3 else struct.pack("<I", v))) for tag, kind, v in plain]
    entries.append((273, struct.pack("<HHII", 273, 4, 1, start + len(blob))))
    return b"II*\0" + struct.pack("<IH", 8, n) + b"".join(e for _, e in sorted(entries)) + b"\0\0\0\0" + blob + body


def write_tiffs(cells: DataFrame, name: str, value: str, meta: dict, tags: list[str] | None = None) -> DataFrame:
    """(name, content): a GeoTIFF for each value of the column ``name``, from rows (row, col, value), made on the executors.

    meta: width, height, x0, y0, dx, dy, and srid if known. ``tags`` are columns that are the same in all rows of a file.
    Cells without a row, or with null, hold NODATA. A file is one task's unit, as it is when it is read.
    """
    tags = tags or []

    def run(table: pa.Table) -> pa.Table:
        band = np.full((meta["height"], meta["width"]), E.NODATA, np.float32)
        v = table[value].cast(pa.float64()).fill_null(E.NODATA).to_numpy()
        band[table["row"].to_numpy(), table["col"].to_numpy()] = v
        items = {t: table[t][0].as_py() for t in tags}
        data = tiff_bytes(band, meta["x0"], meta["y0"], meta["dx"], meta["dy"], tags=items, srid=meta.get("srid"))
        return pa.table([pa.array([str(table[name][0].as_py())]), pa.array([data], pa.binary())], names=["name", "content"])

    return cells.select(name, "row", "col", value, *tags).groupBy(name).applyInArrow(run, "name string, content binary")


def save_tiffs(made: DataFrame, path: str) -> None:
    """Write the files of write_tiffs under ``path``, through the cluster's file system."""
    for row in made.toLocalIterator():  # one file at a time
        save_bytes(made.sparkSession, f"{path.rstrip('/')}/{row['name']}.tif", row["content"])


_CELLS = "path string, row int, col int, value double"
_META = "path string, srid int, width int, height int, x0 double, y0 double, dx double, dy double, nodata double, tags map<string,string>"


def read_tiff(spark: SparkSession, path: str) -> DataFrame:
    """path, row, col, value of the valid cells of all files under ``path``; a file is a task's unit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, data in zip(batch["path"].to_pylist(), batch["content"].to_pylist(), strict=True):
                band, meta = parse_tiff(data)
                good = np.isfinite(band.astype(float)) & (band != meta["nodata"] if meta["nodata"] is not None else True)
                r, c = np.nonzero(good)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(r)), pa.array(r.astype(np.int32)), pa.array(c.astype(np.int32)), pa.array(band[r, c].astype(float))],
                    names=["path", "row", "col", "value"],
                )

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(run, _CELLS)


def read_tiff_meta(spark: SparkSession, path: str) -> DataFrame:
    """One row of meta and tags per file."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for name, data in zip(batch["path"].to_pylist(), batch["content"].to_pylist(), strict=True):
                meta = parse_tiff(data)[1]
                rows.append({"path": name} | meta | {"tags": [(k, str(v)) for k, v in meta["tags"].items()]})
            kinds = [("path", pa.string()), ("srid", pa.int32()), ("width", pa.int32()), ("height", pa.int32())] + [(c, pa.float64()) for c in ("x0", "y0", "dx", "dy", "nodata")]
            yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([*kinds, ("tags", pa.map_(pa.string(), pa.string()))]))

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(run, _META)


# --- GeoPackage ---


def _wkb(data: bytes, at: int) -> tuple[str, list, int]:
    end = "<" if data[at] else ">"
    (kind,) = struct.unpack_from(end + "I", data, at + 1)
    at += 5
    names = {1: "Point", 2: "LineString", 3: "Polygon", 4: "MultiPoint", 5: "MultiLineString", 6: "MultiPolygon"}

    def points(n: int, at: int) -> tuple[list, int]:
        v = struct.unpack_from(f"{end}{2 * n}d", data, at)
        return [{"x": x, "y": y} for x, y in zip(v[::2], v[1::2], strict=True)], at + 16 * n

    if kind == 1:
        p, at = points(1, at)
        return names[kind], [p], at
    (n,) = struct.unpack_from(end + "I", data, at)
    at += 4
    if kind == 2:
        p, at = points(n, at)
        return names[kind], [p], at
    parts = []
    for _ in range(n):
        if kind == 3:
            (m,) = struct.unpack_from(end + "I", data, at)
            p, at = points(m, at + 4)
            parts.append(p)
        else:
            _, more, at = _wkb(data, at)
            parts += more
    return names[kind], parts, at


def gpkg_geometry(blob: bytes) -> dict | None:
    """A GeoPackage geometry (header and well-known binary) as struct(type, parts)."""
    if not blob or blob[3] & 0x10:
        return None
    kind, parts, _ = _wkb(blob, 8 + (0, 32, 48, 48, 64)[blob[3] >> 1 & 7])
    return {"type": kind, "parts": parts}


def _blob(kind: str, parts: list, srid: int) -> bytes:
    """A GeoPackage geometry: header without bounds, then well-known binary of points, lines or one polygon's rings."""
    codes = {"Point": 1, "LineString": 2, "Polygon": 3, "MultiPoint": 4, "MultiLineString": 5, "MultiPolygon": 6}
    head = b"GP\0\x01" + struct.pack("<i", srid)

    def points(part: list) -> bytes:
        return b"".join(struct.pack("<2d", p["x"], p["y"]) for p in part)

    def one(code: int, part: list) -> bytes:
        start = struct.pack("<BI", 1, code)
        return start + points(part) if code == 1 else start + (struct.pack("<I", 1) if code == 3 else b"") + struct.pack("<I", len(part)) + points(part)

    code = codes[kind]
    if code in (1, 2):
        return head + one(code, parts[0])
    if code == 3:
        return head + struct.pack("<BII", 1, 3, len(parts)) + b"".join(struct.pack("<I", len(p)) + points(p) for p in parts)
    if code == 4:
        parts = [[p] for part in parts for p in part]
    return head + struct.pack("<BII", 1, code, len(parts)) + b"".join(one(code - 3, p) for p in parts)


def write_gpkg(df: DataFrame, path: str, layer: str, srid: int, geometry: str = "geom") -> None:
    """A GeoPackage of one layer. It is one database file, so its rows pass through the driver, a partition at a time.

    A ring of a multipolygon is written as a polygon of its own.
    """
    kinds = {"bigint": "INTEGER", "int": "INTEGER", "double": "REAL", "float": "REAL", "boolean": "BOOLEAN"}
    attrs = [c for c in df.columns if c != "geometry"]
    base = sqlite3.connect(":memory:")
    base.execute("PRAGMA application_id = 1196444487")
    base.execute("PRAGMA user_version = 10300")
    base.execute("CREATE TABLE gpkg_spatial_ref_sys (srs_name TEXT NOT NULL, srs_id INTEGER PRIMARY KEY, organization TEXT NOT NULL, organization_coordsys_id INTEGER NOT NULL, definition TEXT NOT NULL, description TEXT)")
    systems = [("undefined", -1, "NONE", -1, "undefined", None), ("undefined", 0, "NONE", 0, "undefined", None), (f"EPSG:{srid}", srid, "EPSG", srid, "undefined", None)]
    base.executemany("INSERT INTO gpkg_spatial_ref_sys VALUES (?, ?, ?, ?, ?, ?)", systems)
    base.execute("CREATE TABLE gpkg_contents (table_name TEXT PRIMARY KEY, data_type TEXT NOT NULL, identifier TEXT UNIQUE, description TEXT, last_change TEXT, min_x DOUBLE, min_y DOUBLE, max_x DOUBLE, max_y DOUBLE, srs_id INTEGER)")
    base.execute("CREATE TABLE gpkg_geometry_columns (table_name TEXT NOT NULL, column_name TEXT NOT NULL, geometry_type_name TEXT NOT NULL, srs_id INTEGER NOT NULL, z TINYINT NOT NULL, m TINYINT NOT NULL, PRIMARY KEY (table_name, column_name))")
    columns = ", ".join(f'"{c}" {kinds.get(dict(df.dtypes)[c], "TEXT")}' for c in attrs)
    base.execute(f'CREATE TABLE "{layer}" (fid INTEGER PRIMARY KEY AUTOINCREMENT, "{geometry}" BLOB{", " + columns if columns else ""})')
    names = ", ".join(f'"{c}"' for c in [geometry, *attrs])
    marks = ", ".join("?" * (1 + len(attrs)))
    plain = df.select("geometry", *[F.col(c) if dict(df.dtypes)[c] in kinds else F.col(c).cast("string").alias(c) for c in attrs])
    for r in plain.toLocalIterator():
        g = r["geometry"]
        base.execute(f'INSERT INTO "{layer}" ({names}) VALUES ({marks})', [None if g is None else _blob(g["type"], g["parts"], srid), *[r[c] for c in attrs]])
    base.execute("INSERT INTO gpkg_contents VALUES (?, 'features', ?, '', '2024-01-01T00:00:00.000Z', NULL, NULL, NULL, NULL, ?)", (layer, layer, srid))
    base.execute("INSERT INTO gpkg_geometry_columns VALUES (?, ?, 'GEOMETRY', ?, 0, 0)", (layer, geometry, srid))
    base.commit()
    save_bytes(df.sparkSession, path, base.serialize())


def read_gpkg(spark: SparkSession, path: str, layer: str, columns: str, geometry: str = "geom") -> DataFrame:
    """Columns (a schema) and geometry of a layer. A GeoPackage is one database, read by one task in memory."""
    from pyspark.sql import types as T

    fields = T._parse_datatype_string(columns).fields
    kinds = T.StructType([*fields, *T._parse_datatype_string(f"geometry {schema.GEOMETRY}").fields])

    def run(batches: Iterator) -> Iterator:
        import pandas as pd

        for frame in batches:
            for content in frame["content"]:
                base = sqlite3.connect(":memory:")
                base.deserialize(bytes(content))
                names = ", ".join(f'"{f.name}"' for f in fields)
                rows = base.execute(f'SELECT {names}, "{geometry}" FROM "{layer}"').fetchall()
                out = pd.DataFrame([r[:-1] for r in rows], columns=[f.name for f in fields], dtype=object)
                out["geometry"] = [gpkg_geometry(r[-1]) for r in rows]
                yield out

    return spark.read.format("binaryFile").load(path).select("content").mapInPandas(run, kinds)
