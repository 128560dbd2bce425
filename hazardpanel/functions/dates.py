"""Date windows and period boundaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazardpanel.operators.joins import dimension


def window_plan(bounds: DataFrame, landed: DataFrame, source_col: str = "source",
                date_col: str = "acq_date", step_days: int = 5) -> DataFrame:
    """Request windows ``lo, lo+step, ... <= hi`` per source and what landed in each.

    ``bounds`` has one row per source (``lo``, ``hi``).  Landed rows are
    bucketed into their window by arithmetic on the date (an equi join, not a
    range join); the last window may extend past ``hi``, overlaps are
    absorbed later by dedup.
    """
    step = F.expr(f"INTERVAL {int(step_days)} DAYS")
    windows = bounds.select(source_col, F.explode(F.sequence("lo", "hi", step)).alias("window_start"))
    b = dimension(bounds.select(source_col, "lo"))
    idx = F.floor(F.datediff(F.col(date_col), F.col("lo")) / F.lit(step_days))
    counts = (landed.join(b, source_col)
                    .groupBy(source_col, F.date_add("lo", (idx * step_days).cast("int")).alias("window_start"))
                    .agg(F.count(F.lit(1)).alias("n_rows")))
    out = windows.join(counts, [source_col, "window_start"], "left")
    return out.select(source_col, "window_start", F.coalesce("n_rows", F.lit(0)).alias("n_rows"),
                      F.col("n_rows").isNotNull().alias("landed"))


def lookback_starts(as_of_col, offsets=(14, 9, 4)):
    """Start dates of the look-back requests (today-14, today-9, today-4)."""
    return F.array(*[F.date_sub(as_of_col, o) for o in offsets])
