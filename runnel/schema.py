"""Table schemas, required columns and provenance values."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

GEOMETRY = "struct<type:string,parts:array<array<struct<x:double,y:double>>>>"

TABLES = {
    "grid_meta": "grid_id string, srid int, width int, height int, x0 double, y0 double, dx double, dy double, nodata double, tags map<string,string>",
    "roads": "road_id string, osm_id string, road_class string, name string, oneway boolean, lanes string, maxspeed string, surface string, bridge string, tunnel string, access string, geometry " + GEOMETRY + ", length_m double",
    "drainage": "drain_id string, source_type string, is_inferred boolean, acc_cells int, upstream_area_m2 double, length_m double, geometry " + GEOMETRY,
    "inlets": "inlet_id string, drain_node_id string, drain_id string, road_id string, candidate_method string, spatial_class string, coupling_eligible int, distance_to_road_m double, elevation_m double, acc_cells int, upstream_area_m2 double, graph_in_degree int, graph_out_degree int, source_type string, is_observed int, mapping_tolerance_m double, coupling_threshold_m double, geometry " + GEOMETRY,
    "runoff_cells": "cell_id string, row int, col int, x double, y double, cell_area_m2 double, runoff_coefficient double, surface_class string",
    "runoff_cell_timeseries": "cell_id string, start_min int, end_min int, runoff_m3 double",
    "inlet_surface_mapping": "inlet_id string, drain_node_id string, road_coupling_eligible int, surface_mapping_selected int, surface_mapping_status string, surface_row int, surface_col int",
    "interval_mass_balance": "interval_id string, scenario_id string, start_min int, end_min int, duration_s int, generated_surface_volume_m3 double, captured_to_drain_volume_m3 double, surface_export_volume_m3 double, surface_balance_error_m3 double, drainage_input_volume_m3 double, drainage_export_volume_m3 double, drainage_overflow_volume_m3 double, drainage_balance_error_m3 double, surface_capture_fraction double",
    "rainfall": "scenario_id string, location string, source string, interval_minutes int, forecast_horizon_minutes int, forecast array<struct<minutes:int,rainfall_mm_hr:double>>",
}

# Provenance labels that must stay with synthetic and inferred rows.
PROVENANCE = {
    "drainage": "dem_inferred_surface_flow",
    "inlets": "inferred_surface_to_drainage_coupling",
    "capacity_source": "synthetic_manning_scenario",
    "capacity_scenario": "prototype_open_channel_base",
    "overflow": "prototype_drainage_capacity_overflow",
}


def require_columns(df: DataFrame, names: list[str], what: str = "table") -> DataFrame:
    """The frame itself; ValueError if it lacks one of the columns."""
    missing = sorted(set(names) - set(df.columns))
    if missing:
        raise ValueError(f"{what} lacks {', '.join(missing)}")
    return df


def conform(df: DataFrame, schema: str) -> DataFrame:
    """Exactly the columns of ``schema``: absent ones null, others cast or dropped."""
    fields = T._parse_datatype_string(schema).fields
    return df.select(
        *[(F.col(f.name).cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType)).alias(f.name) for f in fields]
    )
