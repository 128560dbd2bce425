"""Daily aggregation and dense panel fusion."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazardpanel.constants import COVERAGE_START, PANEL_COLUMNS
from hazardpanel.functions.scalar import coverage_flag, exact_sum, round_half_even, zero_fill

DIM_COLUMNS = ["wilaya_code", "wilaya_name", "area_km2", "centroid_lat", "centroid_lon", "is_forest_zone"]


def daily_region_agg(df: DataFrame, group_cols: Sequence[str] = ("wilaya_id", "wilaya_code"),
                     date_col: str = "acq_date") -> DataFrame:
    """Per (region, day): count of non-null frp, exact frp sum (0.0 when every
    frp is missing, as a pandas grouped sum), frp max."""
    return (df.groupBy(*group_cols, F.col(date_col).alias("date"))
              .agg(F.count("frp").alias("nb_detections"),
                   F.coalesce(exact_sum("frp"), F.lit(0.0)).alias("frp_total"),
                   F.max("frp").alias("frp_max"))
              .withColumn("fire_detected", F.lit(1)))


def dense_grid(entities: DataFrame, entity_col: str, dates: DataFrame, date_col: str = "date") -> DataFrame:
    """Every entity on every date that ``dates`` has.

    Each entity fans out over the calendar between the first and the last date
    (two values reach the driver), and days that ``dates`` lacks are dropped by
    a semi join with its few distinct days.
    """
    days = dates.select(F.col(date_col).cast("date").alias("date")).distinct()
    lo, hi = days.agg(F.min("date"), F.max("date")).first()
    calendar = F.sequence(F.lit(lo).cast("date"), F.lit(hi).cast("date"))
    grid = entities.select(entity_col).distinct().select(F.explode(calendar).alias("date"), entity_col)
    return grid.join(days, "date", "left_semi")


def fuse_panel(base: DataFrame, daily: DataFrame, dim: DataFrame | None = None,
               region_col: str = "wilaya_id", coverage_start: str | None = COVERAGE_START,
               constant_coverage: bool | None = None) -> DataFrame:
    """Left join daily detections onto the dense base, zero-fill, add the dimension.

    ``base`` has one row per (region, date) (weather or a calendar grid).
    """
    small = daily.select(region_col, "date", "nb_detections", "frp_total", "frp_max", "fire_detected")
    merged = base.join(small, on=[region_col, "date"], how="left")
    merged = (merged
              .withColumn("nb_detections", zero_fill("nb_detections", "int"))
              .withColumn("frp_total", round_half_even(F.coalesce("frp_total", F.lit(0.0)), 2))
              .withColumn("frp_max", round_half_even(F.coalesce("frp_max", F.lit(0.0)), 2))
              .withColumn("fire_detected", zero_fill("fire_detected", "int")))
    if dim is not None:
        cols = [c for c in DIM_COLUMNS if c in dim.columns and c not in merged.columns]
        merged = merged.join(dim.select(region_col, *cols), on=region_col, how="left")
    if constant_coverage is not None:
        merged = merged.withColumn("fire_data_coverage", F.lit(bool(constant_coverage)))
    elif coverage_start is not None:
        merged = merged.withColumn("fire_data_coverage", coverage_flag("date", coverage_start))
    return merged


def fixed_layout(df: DataFrame, columns: Sequence[str] = PANEL_COLUMNS) -> DataFrame:
    """Project to the published column order; a missing column is an error."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"columns missing from the published layout: {missing}")
    return df.select(*columns)


def panel_summary(panel: DataFrame, region_col: str = "wilaya_id",
                  label_col: str = "fire_detected") -> DataFrame:
    """Rows, distinct regions/days, date range, positives and positive rate."""
    return panel.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.countDistinct(region_col).alias("n_regions"),
        F.countDistinct("date").alias("n_days"),
        F.min("date").alias("min_date"),
        F.max("date").alias("max_date"),
        F.sum(label_col).cast("long").alias("n_positive"),
        (F.sum(label_col).cast("double") / F.count(F.lit(1))).alias("positive_rate"),
    )


def top_regions(panel: DataFrame, n: int = 15, name_col: str = "wilaya_name",
                label_col: str = "fire_detected") -> DataFrame:
    """Top-n regions by positive days (ties by name)."""
    return (panel.groupBy(name_col).agg(F.sum(label_col).cast("long").alias("positive_days"))
                 .orderBy(F.desc("positive_days"), F.asc(name_col)).limit(n))


def uncovered_days(panel: DataFrame, region_col: str = "wilaya_id") -> DataFrame:
    """Rows without satellite coverage, and days = rows / regions."""
    return (panel.agg(F.count_if(~F.col("fire_data_coverage")).alias("uncovered_rows"),
                      F.countDistinct(region_col).alias("n_regions"))
                 .withColumn("uncovered_days", (F.col("uncovered_rows") / F.col("n_regions")).cast("long")))
