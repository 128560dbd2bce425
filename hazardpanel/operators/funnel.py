"""Stage funnel: rows in/out of every cleaning step, as one small table.

All counts come from one summary of the placed points, the same that the rebuild
derives its daily totals from: a kept row knows how many raw rows it stands for, so
the raw count needs no scan of its own.  (Metrics observed while a job runs would
need no summary, but count twice what an executor's loss makes Spark run again.)
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazardpanel.constants import DETECTION_KEY, PERSISTENCE_THRESHOLD_DAYS
from hazardpanel.functions.scalar import EXACT
from hazardpanel.operators.dedup import dedup_keep_first
from hazardpanel.operators.persistence import drop_recurring, persistent_cells, with_grid
from hazardpanel.operators.spatial import assign_region
from hazardpanel.session import materialize

COPIES = "_copies"


def type_rule(strict: bool) -> Column:
    """Rows that the type filter keeps: type 0, and unless ``strict`` no type."""
    return F.coalesce(F.col("type") == 0, F.lit(not strict))


def placed_summary(assigned: DataFrame, strict: bool = False, region_col: str = "wilaya_id") -> DataFrame:
    """Per grid cell, region (or none), day and verdict of the type filter: rows, raw
    rows (column ``COPIES`` of ``assigned``), polygon matches, and the partial sums
    of the daily totals."""
    return with_grid(assigned).groupBy("lat_grid", "lon_grid", region_col, "acq_date", type_rule(strict).alias("type_ok")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(COPIES).alias("n_raw"), F.sum("n_matches").alias("pairs"),
        F.count("frp").alias("n_frp"), F.sum(F.col("frp").cast(EXACT)).alias("frp_sum"), F.max("frp").alias("frp_max"))


def funnel_of(summary: DataFrame, threshold: int = PERSISTENCE_THRESHOLD_DAYS, region_col: str = "wilaya_id") -> DataFrame:
    """(stage, step, n_rows) from a stored ``placed_summary``."""
    n, zero = F.col("n_rows"), F.lit(0).cast("long")
    in_region = F.col(region_col).isNotNull()
    total = lambda c, when=F.lit(True): F.coalesce(F.sum(F.when(when, c)), zero)
    matched = summary.filter(in_region & F.col("type_ok"))
    spots = persistent_cells(matched, threshold)
    stages = [(summary, {"raw": total(F.col("n_raw")), "dedup": total(n), "overlap_pairs": total(F.col("pairs")),
                         "matched": total(n, in_region), "type_kept": total(n, in_region & F.col("type_ok"))}),
              (spots, {"recurring_spots": F.count(F.lit(1))}),
              (drop_recurring(matched, spots), {"persistence_kept": total(n)})]
    out, step = None, 0
    for df, counts in stages:
        entries = [F.struct(F.lit(stage).alias("stage"), F.lit(step + i).alias("step"), F.col(stage).cast("long").alias("n_rows")) for i, stage in enumerate(counts)]
        rows = df.agg(*[c.alias(stage) for stage, c in counts.items()]).select(F.inline(F.array(*entries)))
        step += len(counts)
        out = rows if out is None else out.unionByName(rows)
    return out


def stage_funnel(detections: DataFrame, edges: DataFrame, order=("pri", "event_id"),
                 threshold: int = PERSISTENCE_THRESHOLD_DAYS, region_col: str = "wilaya_id", strict: bool = False) -> DataFrame:
    """Counts after dedup, polygon matching, type filter and persistence, where no
    rebuild is made (that has them from its own pass)."""
    deduped = dedup_keep_first(detections, DETECTION_KEY, list(order), COPIES)
    assigned = assign_region(deduped, edges, region_col=region_col)
    return funnel_of(materialize(placed_summary(assigned, strict, region_col), "funnel-summary"), threshold, region_col)
