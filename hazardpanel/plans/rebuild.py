"""Full rebuild of the dense panel from detections, polygons and a base grid.

Plan shape (what Catalyst/AQE end up running):

* dedup: one aggregation on the natural key (partial on the map side);
* type filter: applied before the spatial step (``type`` is a point column
  and the spatial step works per point, so the result is unchanged while
  far fewer points reach it);
* spatial: broadcast cell lookup + per-row parity test, no point shuffle;
* persistence: distinct-days count per 0.01° cell (two partial
  aggregations), then an anti join planned at runtime by AQE;
* daily: one aggregation on (region, day); the base grid is joined on
  (region, date); the region dimension is a stored table, broadcast by its size.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazardpanel.constants import COVERAGE_START, DETECTION_KEY, PANEL_COLUMNS, PERSISTENCE_THRESHOLD_DAYS, WEATHER_VARS
from hazardpanel.functions.scalar import EXACT
from hazardpanel.operators.dedup import dedup_keep_first
from hazardpanel.operators.funnel import COPIES, funnel_of, placed_summary
from hazardpanel.operators.panel import dense_grid, fixed_layout, fuse_panel
from hazardpanel.operators.persistence import drop_recurring, persistent_cells, with_grid
from hazardpanel.operators.spatial import assign_region
from hazardpanel.session import materialize as materialize_table


def vegetation_or_unknown(df: DataFrame) -> DataFrame:
    """``type = 0 OR type IS NULL`` (near-real-time feeds carry no type)."""
    return df.filter((F.col("type") == 0) | F.col("type").isNull())


def vegetation_strict(df: DataFrame) -> DataFrame:
    """``type = 0``; rows without a type are dropped."""
    return df.filter(F.col("type") == 0)


@dataclass
class Chain:
    deduped: DataFrame
    matched: DataFrame      # row level: in a polygon, type kept, with grid cell
    summary: DataFrame      # (cell, region, day) partial aggregate of ``matched``
    spots: DataFrame
    kept: DataFrame         # row level, recurring cells removed
    daily: DataFrame
    funnel: DataFrame | None = None     # rows after each stage, when a report is wanted


def cell_day_summary(matched: DataFrame, region_col: str = "wilaya_id") -> DataFrame:
    """Rows per (grid cell, region, day) with the partial sums the daily
    aggregate needs.  Everything downstream (spot list, anti join, daily
    totals) reads this summary instead of the row-level points, so the raw
    detections are deduplicated and placed exactly once."""
    return matched.groupBy("lat_grid", "lon_grid", region_col, "acq_date").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count("frp").alias("n_frp"),
        F.sum(F.col("frp").cast(EXACT)).alias("frp_sum"),
        F.max("frp").alias("frp_max"))


def detection_chain(detections: DataFrame, edges: DataFrame, dim: DataFrame,
                    order=("pri", "event_id"), strict_type: bool = False,
                    threshold: int = PERSISTENCE_THRESHOLD_DAYS,
                    region_col: str = "wilaya_id", materialize: bool = True, report: bool = False) -> Chain:
    """Dedup → type → polygon (first match) → persistence → daily aggregate.
    ``report`` adds the stage funnel from the same pass; as it counts matches of
    all types, the points of other types are then placed as well.

    With ``materialize`` the (cell, region, day) summary is written as a
    Parquet table in the shared checkpoint folder: it is orders of magnitude
    smaller than the raw rows, and both the spot list and the daily totals
    read it, so the shuffle of the raw detections runs once, survives
    executor loss, and downstream joins are sized from real file statistics.
    """
    deduped = dedup_keep_first(detections, DETECTION_KEY, list(order), COPIES if report else None)
    kind = vegetation_strict if strict_type else vegetation_or_unknown
    assigned = assign_region(deduped if report else kind(deduped), edges, region_col=region_col)
    funnel = None
    if report:
        whole = materialize_table(placed_summary(assigned, strict_type, region_col), "placed-summary")
        funnel = funnel_of(whole, threshold, region_col)
        summary = whole.filter(F.col(region_col).isNotNull() & F.col("type_ok")).drop("n_raw", "pairs", "type_ok")
        assigned, deduped = kind(assigned).drop(COPIES), deduped.drop(COPIES)
    matched = with_grid(assigned.drop("n_matches").filter(F.col(region_col).isNotNull()))
    if not report:
        summary = cell_day_summary(matched, region_col)
        if materialize:
            summary = materialize_table(summary, "cell-day-summary")
    spots = persistent_cells(summary, threshold)
    kept_cells = drop_recurring(summary, spots)
    daily = (kept_cells.groupBy(region_col, F.col("acq_date").alias("date"))
             .agg(F.sum("n_frp").alias("nb_detections"),
                  F.coalesce(F.sum("frp_sum").cast("double"), F.lit(0.0)).alias("frp_total"),
                  F.max("frp_max").alias("frp_max"))
             .withColumn("fire_detected", F.lit(1)))
    codes = dim.select(region_col, "wilaya_code")
    daily = daily.join(codes, region_col, "left").select(
        region_col, "wilaya_code", "date", "nb_detections", "frp_total", "frp_max", "fire_detected")
    kept = drop_recurring(matched, spots)
    return Chain(deduped, matched, summary, spots, kept, daily, funnel)


def panel_layout(base_columns, coverage: bool = True) -> list[str]:
    """The published columns; a base without any weather variable (a bare calendar)
    leaves all of them out, one that has some must have every one."""
    weather = [c for c in WEATHER_VARS if c in base_columns]
    return [c for c in PANEL_COLUMNS if (weather or c not in WEATHER_VARS) and (coverage or c != "fire_data_coverage")]


def build_panel(detections: DataFrame, edges: DataFrame, base: DataFrame | None, dim: DataFrame,
                threshold: int = PERSISTENCE_THRESHOLD_DAYS, strict_type: bool = False,
                coverage_start: str | None = COVERAGE_START, order=("pri", "event_id"),
                region_col: str = "wilaya_id") -> DataFrame:
    """Dense, zero-filled region x day panel.

    ``base`` is the dense weather table (one row per region and date).  When
    it is ``None`` a calendar grid of all regions x detection dates is used.
    """
    chain = detection_chain(detections, edges, dim, order, strict_type, threshold, region_col)
    if base is None:
        base = dense_grid(dim, region_col, detections.select(F.col("acq_date").alias("date")))
    panel = fuse_panel(base, chain.daily, dim, region_col, coverage_start=coverage_start)
    return fixed_layout(panel, panel_layout(base.columns, coverage_start is not None))


def forest_panel(panel: DataFrame) -> DataFrame:
    """Rows of regions with forest cover."""
    return panel.filter(F.col("is_forest_zone"))


def refresh_spot_list(spark, feeds_glob: str, out_path: str | None = None,
                      threshold: int = PERSISTENCE_THRESHOLD_DAYS, schema=None,
                      source_regex: str = r"feed=([^/]+)/") -> DataFrame:
    """Stored spot list from every landed feed (glob scan, no dedup, no polygon
    match): cells seen on more than ``threshold`` distinct days among rows of
    type 0 or without type.  Written to ``out_path`` when given."""
    from hazardpanel.operators.persistence import recurring_spot_table
    from hazardpanel.schemas import DETECTION_CSV
    from hazardpanel.sources.detections import scan_glob
    raw = scan_glob(spark, feeds_glob, schema or DETECTION_CSV, source_regex=source_regex)
    spots = recurring_spot_table(raw.select("latitude", "longitude", "acq_date", "type"), threshold)
    if out_path:
        spots.write.mode("overwrite").parquet(out_path)
        return spark.read.schema(spots.schema).parquet(out_path)
    return spots
