"""Column expressions of the hydrology model. All stay inside whole-stage code generation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Model constants.
NODATA = -9999.0
COEFFICIENTS = {"green_open": 0.30, "default_urban": 0.75, "road": 0.85, "building": 0.90}
LUMPED_COEFFICIENT, LUMPED_AREA = 0.80, 900.0
MANNING_N, SLOPE_FLOOR = 0.035, 0.001
SECTIONS = {1: (0.40, 0.30), 2: (0.70, 0.45), 3: (1.00, 0.60), 4: (1.40, 0.80)}
CAPACITY_CLASSES = {1: "low", 2: "medium", 3: "high"}
INTERSECTION_M, NEAR_ROAD_M, COUPLING_M, SEARCH_M = 0.5, 10.0, 20.0, 30.0
DEPTH_BANDS = (0.02, 0.10, 0.30, 1.00)
ELEVATION_SCALE, DISTANCE_SCALE = 2.0, 3.0
TRUE_WORDS = ("true", "yes", "1")
FALSE_WORDS = ("0", "false", "0.0")


def finite(c: Column) -> Column:
    """False for null, NaN and infinities (Spark would call NaN equal to itself)."""
    return c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))


def valid(c: Column, nodata: float = NODATA) -> Column:
    return finite(c) & (c != F.lit(nodata))


def isclose(c: Column, reference: float, rtol: float = 1e-5, atol: float = 1e-8) -> Column:
    return F.abs(c - F.lit(reference)) <= F.lit(atol + rtol * abs(reference))


def rint_n(c: Column, digits: int) -> Column:
    """Scale, round half to even, scale back."""
    return F.rint(c * F.lit(10.0**digits)) / F.lit(10.0**digits)


def ladder(c: Column, steps: list[tuple[float, str]], otherwise: str) -> Column:
    """The label of the first step whose bound is not exceeded."""
    out = None
    for bound, label in steps:
        out = F.when(c <= bound, label) if out is None else out.when(c <= bound, label)
    return out.otherwise(otherwise)


def trapezoid_mm(i0: Column, i1: Column, t0: Column, t1: Column) -> Column:
    """Rain depth of an interval in mm, from intensities in mm/h at its ends (minutes)."""
    return (i0 + i1) / 2 * (t1 - t0) / 60


def runoff_m3(mm: Column, coefficient: Column, area: Column) -> Column:
    return mm / 1000 * coefficient * area


def surface_class(coefficient: Column) -> Column:
    out = F.lit("unknown")
    for name, value in COEFFICIENTS.items():
        out = F.when(isclose(coefficient, value), name).otherwise(out)
    return out


def distance_class(d: Column) -> Column:
    steps = [(INTERSECTION_M, "intersection"), (NEAR_ROAD_M, "near"), (COUPLING_M, "moderate")]
    return ladder(d, steps, "distant_candidate")


def candidate_method(d: Column) -> Column:
    return F.when(d <= INTERSECTION_M, "road_intersection").otherwise("road_proximity")


def capacity_class(order: Column) -> Column:
    out = F.lit("very_high")
    for bound in sorted(CAPACITY_CLASSES, reverse=True):
        out = F.when(order <= bound, CAPACITY_CLASSES[bound]).otherwise(out)
    return out


def section(order: Column) -> tuple[Column, Column]:
    """Width and depth of a channel; orders are held to 1..4."""
    held = F.least(F.greatest(order, F.lit(1)), F.lit(4))
    width, depth = F.lit(SECTIONS[4][0]), F.lit(SECTIONS[4][1])
    for k in (3, 2, 1):
        width = F.when(held == k, SECTIONS[k][0]).otherwise(width)
        depth = F.when(held == k, SECTIONS[k][1]).otherwise(depth)
    return width, depth


def manning_m3s(width: Column, depth: Column, slope: Column, n: float = MANNING_N) -> Column:
    """Full-section discharge of an open rectangular channel; slopes below the floor count as the floor."""
    area, perimeter = width * depth, width + 2 * depth
    return F.lit(1 / n) * area * F.pow(area / perimeter, F.lit(2.0 / 3.0)) * F.sqrt(F.greatest(slope, F.lit(SLOPE_FLOOR)))


def slope_of(drop: Column, length: Column) -> Column:
    """Null without a drop or a positive length."""
    return F.when(length > 0, drop / length)


def ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def decay_weight(z: Column, zmin: Column, cells: Column) -> Column:
    return F.exp(-(z - zmin) / ELEVATION_SCALE) * F.exp(-cells / DISTANCE_SCALE)


def safe_double(c: Column, default: float | None = 0.0) -> Column:
    value = c.cast("string").try_cast("double")
    return F.when(finite(value), value).otherwise(F.lit(default).cast("double"))


def safe_int(c: Column, default: int | None = 0) -> Column:
    value = F.rint(c.cast("string").try_cast("double"))
    return F.when(finite(value) & (F.abs(value) < 2.0**31), value.cast("int")).otherwise(F.lit(default).cast("int"))


def safe_string(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def yes_no(c: Column) -> Column:
    """Text to boolean; what is not plainly true is false."""
    return F.coalesce(F.lower(F.trim(c.cast("string"))).isin(*TRUE_WORDS), F.lit(False))


def is_false_text(c: Column) -> Column:
    return F.coalesce(F.lower(F.trim(c.cast("string"))).isin(*FALSE_WORDS), F.lit(False))


def joined(items: Column) -> Column:
    return F.concat_ws(";", items)


def cell_id(row: Column, col: Column) -> Column:
    return F.format_string("R%03d_C%03d", row.cast("int"), col.cast("int"))


def numbered(prefix: str, n: Column) -> Column:
    return F.format_string(prefix + "_%05d", n.cast("int"))


def interval_id(start: Column, end: Column) -> Column:
    return F.format_string("%03d_%03d", start.cast("int"), end.cast("int"))


def interval_from_name(name: Column) -> tuple[Column, Column]:
    """Start and end minutes out of a file name like ..._030_060.tif; null where there are none."""
    pattern = r"_(\d{3})_(\d{3})\.[A-Za-z]+$"
    return tuple(F.regexp_extract(name, pattern, i).try_cast("int") for i in (1, 2))


def volume_to_flow(volume: Column, seconds: Column) -> Column:
    return volume / seconds


def flow_to_volume(flow: Column, seconds: Column) -> Column:
    return flow * seconds


def conveyed(total: Column, capacity: Column) -> Column:
    return F.least(total, capacity)


def overflow(total: Column, capacity: Column) -> Column:
    return F.greatest(F.lit(0.0), total - F.least(total, capacity))


def distance(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    return F.sqrt((x1 - x0) * (x1 - x0) + (y1 - y0) * (y1 - y0))


def within_tolerance(error: Column, volume: Column, floor: float = 0.05) -> Column:
    """The conservation rule: |error| up to max(floor, 1e-8 of the volume)."""
    return F.abs(error) <= F.greatest(F.lit(floor), volume * 1e-8)
