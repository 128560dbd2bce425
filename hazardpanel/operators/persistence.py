"""Recurring-source suppression on a 0.01 degree grid.

``persistent_cells`` counts exact distinct days per cell.  Spark plans the
distinct count as two aggregations (cell+day first, then cell), both with
map-side partial aggregation, so a cell that holds a third of all rows is
reduced to at most one row per (cell, day) per task before it shuffles.

The anti join against the spot list is left to AQE: the spot list is the
output of an aggregation, so its real size is known at runtime and it is
broadcast only when below ``spark.sql.adaptive.autoBroadcastJoinThreshold``;
otherwise a sort-merge anti join runs with skew splitting.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazardpanel.constants import GRID_DECIMALS, PERSISTENCE_THRESHOLD_DAYS
from hazardpanel.functions.scalar import round_half_even

GRID_KEY = ["lat_grid", "lon_grid"]


def with_grid(df: DataFrame, lat: str = "latitude", lon: str = "longitude",
              decimals: int = GRID_DECIMALS) -> DataFrame:
    return (df.withColumn("lat_grid", round_half_even(F.col(lat), decimals))
              .withColumn("lon_grid", round_half_even(F.col(lon), decimals)))


def persistent_cells(df: DataFrame, threshold: int = PERSISTENCE_THRESHOLD_DAYS,
                     date_col: str = "acq_date") -> DataFrame:
    """Cells seen on strictly more than ``threshold`` distinct days.

    Expects ``lat_grid``/``lon_grid`` (see ``with_grid``).
    """
    return (df.groupBy(*GRID_KEY)
              .agg(F.countDistinct(date_col).alias("n_days_detected"))
              .filter(F.col("n_days_detected") > threshold))


def drop_recurring(df: DataFrame, spots: DataFrame) -> DataFrame:
    """Rows whose grid cell is not a recurring spot (composite-key anti join)."""
    return df.join(spots.select(*GRID_KEY), on=GRID_KEY, how="left_anti")


def recurring_spot_table(raw: DataFrame, threshold: int = PERSISTENCE_THRESHOLD_DAYS) -> DataFrame:
    """Stored spot list from all raw rows: type 0 or unknown, no polygon match."""
    kept = raw.filter((F.col("type") == 0) | F.col("type").isNull())
    return persistent_cells(with_grid(kept), threshold)
