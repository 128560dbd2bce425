"""Registered queries: one per operator of the inventory.

Each query takes ``(spark, sf_dir)``, derives its inputs from the driver
tables with Spark, runs the library operator and returns a DataFrame.  The
DuckDB twin (when the operator is SQL-expressible) is registered next to
it; ``None`` means rows-only checking.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazardpanel import fixtures as fx
from hazardpanel import landing
from hazardpanel.constants import DETECTION_KEY
from hazardpanel.oracle import panel_sql, rd, sql
from hazardpanel.operators.dedup import dedup_keep_first
from hazardpanel.operators.panel import dense_grid, fuse_panel, panel_summary, top_regions
from hazardpanel.operators.persistence import drop_recurring, with_grid
from hazardpanel.operators.spatial import assign_all_regions, assign_region
from hazardpanel.plans.rebuild import (build_panel, detection_chain, forest_panel,
                                       vegetation_or_unknown, vegetation_strict)
from hazardpanel.schemas import FEED_SCHEMA
from hazardpanel.sources import detections as src

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(key: str, oracle: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[key] = fn
        if oracle is not None:
            ORACLE[key] = oracle
        return fn
    return deco


DET_COLS = "event_id, pri, latitude, longitude, acq_date, acq_time, satellite, type, frp"


def _chain(spark, sf, strict=False):
    return detection_chain(fx.detections(spark, sf), fx.edges(spark, sf), fx.region_dim(spark, sf),
                           strict_type=strict)


# ---------------------------------------------------------------- flagship
@register("fused_panel", sql("SELECT * FROM panel", "panel"))
def q_fused_panel(spark, sf):
    return build_panel(fx.detections(spark, sf), fx.edges(spark, sf), fx.weather(spark, sf), fx.region_dim(spark, sf))


@register("fused_panel_strict", sql(panel_sql("daily_strict", coverage=None), "weather", "daily_strict", "region_dim"))
def q_fused_panel_strict(spark, sf):
    # first-generation job: strict type filter, no coverage flag
    return build_panel(fx.detections(spark, sf), fx.edges(spark, sf), fx.weather(spark, sf), fx.region_dim(spark, sf),
                       strict_type=True, coverage_start=None)


@register("forest_panel", sql("SELECT * FROM panel WHERE is_forest_zone", "panel"))
def q_forest_panel(spark, sf):
    return forest_panel(q_fused_panel(spark, sf))


# ---------------------------------------------------------------- dedup, filters, rounding
@register("dedup_keep_first", sql(f"SELECT {DET_COLS} FROM ded", "ded"))
def q_dedup_keep_first(spark, sf):
    return dedup_keep_first(fx.detections(spark, sf), DETECTION_KEY, ["pri", "event_id"])


@register("filter_type_strict", sql(f"SELECT {DET_COLS} FROM ded WHERE type = 0", "ded"))
def q_filter_type_strict(spark, sf):
    return vegetation_strict(q_dedup_keep_first(spark, sf))


@register("filter_type_or_null", sql(f"SELECT {DET_COLS} FROM ded WHERE type = 0 OR type IS NULL", "ded"))
def q_filter_type_or_null(spark, sf):
    return vegetation_or_unknown(q_dedup_keep_first(spark, sf))


@register("grid_round", sql(f"""
SELECT event_id, pri, latitude, longitude, {rd('latitude')} AS lat_grid, {rd('longitude')} AS lon_grid,
       {rd('frp * 1.005e0')} AS frp_scaled
FROM detections""", "detections"))
def q_grid_round(spark, sf):
    from hazardpanel.functions.scalar import round_half_even
    d = with_grid(fx.detections(spark, sf))
    return d.select("event_id", "pri", "latitude", "longitude", "lat_grid", "lon_grid",
                    round_half_even(F.col("frp") * F.lit(1.005), 2).alias("frp_scaled"))


# ---------------------------------------------------------------- spatial
@register("pip_join", sql("SELECT event_id, pri, wilaya_id, pos AS region_pos FROM hits_all", "hits_all"))
def q_pip_join(spark, sf):
    d = q_dedup_keep_first(spark, sf).select("event_id", "pri", "latitude", "longitude")
    out = assign_all_regions(d, fx.edges(spark, sf))
    return out.select("event_id", "pri", "wilaya_id", "region_pos")


@register("pip_first_match", sql("SELECT event_id, pri, wilaya_id, n_matches FROM assigned", "assigned"))
def q_pip_first_match(spark, sf):
    d = q_dedup_keep_first(spark, sf).select("event_id", "pri", "latitude", "longitude")
    out = assign_region(d, fx.edges(spark, sf))
    return out.select("event_id", "pri", "wilaya_id", F.col("n_matches").cast("long").alias("n_matches"))


# ---------------------------------------------------------------- persistence
@register("persistence_spots", sql("SELECT * FROM spots", "spots"))
def q_persistence_spots(spark, sf):
    return _chain(spark, sf).spots


@register("spot_anti_join", sql(f"SELECT {DET_COLS}, wilaya_id, lat_grid, lon_grid FROM kept", "kept"))
def q_spot_anti_join(spark, sf):
    ch = _chain(spark, sf)
    return drop_recurring(ch.matched, ch.spots).select(
        *DET_COLS.split(", "), "wilaya_id", "lat_grid", "lon_grid")


# ---------------------------------------------------------------- aggregation
@register("daily_region_agg", sql("SELECT * FROM daily", "daily"))
def q_daily_region_agg(spark, sf):
    return _chain(spark, sf).daily


@register("panel_summary", sql("""
SELECT count(*) AS n_rows, count(DISTINCT wilaya_id) AS n_regions, count(DISTINCT date) AS n_days,
       min(date) AS min_date, max(date) AS max_date, CAST(sum(fire_detected) AS BIGINT) AS n_positive,
       CAST(sum(fire_detected) AS DOUBLE) / count(*) AS positive_rate
FROM panel""", "panel"))
def q_panel_summary(spark, sf):
    return panel_summary(q_fused_panel(spark, sf))


@register("top_regions", sql("""
SELECT wilaya_name, CAST(sum(fire_detected) AS BIGINT) AS positive_days FROM panel
WHERE fire_data_coverage AND is_forest_zone
GROUP BY wilaya_name ORDER BY positive_days DESC, wilaya_name LIMIT 15""", "panel"))
def q_top_regions(spark, sf):
    p = forest_panel(q_fused_panel(spark, sf)).filter(F.col("fire_data_coverage"))
    return top_regions(p, 15)


@register("stage_funnel", sql("""
SELECT 'raw' AS stage, 0 AS step, count(*) AS n_rows FROM detections
UNION ALL SELECT 'dedup', 1, count(*) FROM ded
UNION ALL SELECT 'overlap_pairs', 2, count(*) FROM hits_all
UNION ALL SELECT 'matched', 3, count(*) FROM assigned WHERE wilaya_id IS NOT NULL
UNION ALL SELECT 'type_kept', 4, count(*) FROM matched
UNION ALL SELECT 'recurring_spots', 5, count(*) FROM spots
UNION ALL SELECT 'persistence_kept', 6, count(*) FROM kept""", "detections", "ded", "hits_all",
    "assigned", "matched", "spots", "kept"))
def q_stage_funnel(spark, sf):
    from hazardpanel.operators.funnel import stage_funnel
    return stage_funnel(fx.detections(spark, sf), fx.edges(spark, sf))


@register("rebuild_funnel_strict", sql("""
SELECT 'raw' AS stage, 0 AS step, count(*) AS n_rows FROM detections
UNION ALL SELECT 'dedup', 1, count(*) FROM ded
UNION ALL SELECT 'overlap_pairs', 2, count(*) FROM hits_all
UNION ALL SELECT 'matched', 3, count(*) FROM assigned WHERE wilaya_id IS NOT NULL
UNION ALL SELECT 'type_kept', 4, count(*) FROM matched_strict
UNION ALL SELECT 'recurring_spots', 5, count(*) FROM spots_strict
UNION ALL SELECT 'persistence_kept', 6, count(*) FROM matched_strict m
  WHERE NOT EXISTS (SELECT 1 FROM spots_strict s WHERE s.lat_grid = m.lat_grid AND s.lon_grid = m.lon_grid)""",
    "detections", "ded", "hits_all", "assigned", "matched_strict", "spots_strict"))
def q_rebuild_funnel_strict(spark, sf):
    chain = detection_chain(fx.detections(spark, sf), fx.edges(spark, sf), fx.region_dim(spark, sf), strict_type=True, report=True)
    return chain.funnel


@register("panel_left_join", sql("""
SELECT g.wilaya_id, g.date, d.nb_detections, d.frp_total, d.frp_max, d.fire_detected
FROM event_grid g LEFT JOIN daily d ON d.wilaya_id = g.wilaya_id AND d.date = g.date""",
    "event_grid", "daily"))
def q_panel_left_join(spark, sf):
    dim = fx.region_dim(spark, sf)
    grid = dense_grid(dim, "wilaya_id", fx.detections(spark, sf).select(F.col("acq_date").alias("date")))
    daily = _chain(spark, sf).daily.drop("wilaya_code")
    return grid.join(daily, ["wilaya_id", "date"], "left").select(
        "wilaya_id", "date", "nb_detections", "frp_total", "frp_max", "fire_detected")


@register("zero_fill", sql(f"""
SELECT g.wilaya_id, g.date, CAST(coalesce(d.nb_detections, 0) AS INTEGER) AS nb_detections,
       {rd('coalesce(d.frp_total, 0.0)')} AS frp_total, {rd('coalesce(d.frp_max, 0.0)')} AS frp_max,
       CAST(coalesce(d.fire_detected, 0) AS INTEGER) AS fire_detected
FROM event_grid g LEFT JOIN daily d ON d.wilaya_id = g.wilaya_id AND d.date = g.date""",
    "event_grid", "daily"))
def q_zero_fill(spark, sf):
    dim = fx.region_dim(spark, sf)
    grid = dense_grid(dim, "wilaya_id", fx.detections(spark, sf).select(F.col("acq_date").alias("date")))
    fused = fuse_panel(grid, _chain(spark, sf).daily, None, coverage_start=None)
    return fused.select("wilaya_id", "date", "nb_detections", "frp_total", "frp_max", "fire_detected")


@register("union_sources", sql(f"SELECT {DET_COLS} FROM detections", "detections"))
def q_union_sources(spark, sf):
    _, sources = landing.land_detection_feeds(spark, sf)       # one landed feed per (satellite, quality)
    feeds = [src.read_csv_by_header(spark, path, FEED_SCHEMA) for path, _ in sources if "absent" not in path]
    out = feeds[0]
    for f in feeds[1:]:
        out = out.unionByName(f)
    return out.select(*DET_COLS.split(", "))


def entry_query(spark: SparkSession, sf: str) -> DataFrame:
    return q_fused_panel(spark, sf)
