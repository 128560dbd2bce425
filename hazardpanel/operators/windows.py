"""Per-series window features (lag, strictly-prior rolling windows, days since).

All features of one call share a single ``partitionBy(entity).orderBy(date)``
spec, so Spark plans one exchange and one sort for all of them.  The panel
is dense (one row per entity and day), so every series has the same length
and no entity can be hot; rolling windows count rows, so the model table
checks density first (``assert_dense``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hazardpanel.constants import DAYS_SINCE_CAP, RAIN_THRESHOLD_MM
from hazardpanel.functions.scalar import EXACT


def _spec(by: str | list[str], order: str):
    return Window.partitionBy(by).orderBy(order)


def lag_prev_day(df: DataFrame, col: str, by: str = "wilaya_id", order: str = "date",
                 out: str | None = None) -> DataFrame:
    return df.withColumn(out or f"{col}_prev", F.lag(col, 1).over(_spec(by, order)))


def prior_sum(col: str, rows: int, min_count: int, by: str | list[str], order: str):
    """Sum of the ``rows`` previous rows (not the current one), null below ``min_count``."""
    w = _spec(by, order).rowsBetween(-rows, -1)
    c = F.col(col)
    exact = F.sum(c.cast(EXACT)).over(w).cast("double")
    return F.when(F.count(c).over(w) >= min_count, exact)


def prior_mean(col: str, rows: int, min_count: int, by: str | list[str], order: str):
    w = _spec(by, order).rowsBetween(-rows, -1)
    c = F.col(col)
    n = F.count(c).over(w)
    exact = F.sum(c.cast(EXACT)).over(w).cast("double")
    return F.when(n >= min_count, exact / n)


def with_days_since(df: DataFrame, flag_col: str, out: str, by: str = "wilaya_id",
                    order: str = "date", cap: int = DAYS_SINCE_CAP) -> DataFrame:
    """Rows since the last row where ``flag_col`` is true (0 on that row).

    Before the first flagged row the count starts at 0 on the series' first
    row.  Null flags count as false.  Capped at ``cap``.
    """
    w_all = _spec(by, order)
    upto = w_all.rowsBetween(Window.unboundedPreceding, 0)
    with_rn = df.withColumn("_rn", F.row_number().over(w_all))
    last = F.max(F.when(F.coalesce(F.col(flag_col), F.lit(False)), F.col("_rn"))).over(upto)
    return (with_rn.withColumn(out, F.least(F.col("_rn") - F.coalesce(last, F.lit(1)), F.lit(cap)))
                   .drop("_rn"))


def dryness_features(df: DataFrame, by: str = "wilaya_id", order: str = "date",
                     precip: str = "precipitation_sum", temp: str = "temperature_2m_max",
                     et0: str = "et0_fao_evapotranspiration",
                     rain_mm: float = RAIN_THRESHOLD_MM, cap: int = DAYS_SINCE_CAP) -> DataFrame:
    """Strictly-prior dryness: 7/30-row rain sums, 7-row mean max temperature,
    30-row ET0 sum and days since the last rainy day (all from the previous
    row backwards, so only information available the day before is used)."""
    prev = F.lag(precip, 1).over(_spec(by, order))
    out = (df
           .withColumn("precip_sum_7d", prior_sum(precip, 7, 4, by, order))
           .withColumn("precip_sum_30d", prior_sum(precip, 30, 15, by, order))
           .withColumn("temp_max_mean_7d", prior_mean(temp, 7, 4, by, order))
           .withColumn("et0_sum_30d", prior_sum(et0, 30, 15, by, order))
           .withColumn("_rained", prev >= F.lit(rain_mm)))
    return with_days_since(out, "_rained", "days_since_rain", by, order, cap).drop("_rained")


def assert_dense(df: DataFrame, by: str = "wilaya_id", order: str = "date") -> DataFrame:
    """One row per (entity, day) and no gaps: checked with two aggregations."""
    per = df.groupBy(by).agg(F.count(F.lit(1)).alias("n"), F.countDistinct(order).alias("d"),
                             F.min(order).alias("lo"), F.max(order).alias("hi"))
    bad = per.filter((F.col("n") != F.col("d"))
                     | (F.col("n") != F.datediff("hi", "lo") + 1)).limit(1).collect()
    if bad:
        raise ValueError(f"panel is not dense for {by}={bad[0][by]}")
    return df


def topk_per_group(df: DataFrame, group_col: str, score_col: str, k: int,
                   tiebreak: str, out: str = "rank") -> DataFrame:
    """Top ``k`` rows per group by descending score (ties by ``tiebreak``).

    ``row_number() <= k`` lets Spark insert a partial WindowGroupLimit before
    the shuffle: each map task forwards at most ``k`` rows per group, so a
    hot group does not move whole into one task.
    """
    w = Window.partitionBy(group_col).orderBy(F.desc(score_col), F.asc(tiebreak))
    return df.withColumn(out, F.row_number().over(w)).filter(F.col(out) <= k)
