"""Model-table features: seasonality, weekday, era filter and temporal split."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazardpanel.constants import ERA_START, TRAIN_END
from hazardpanel.functions.scalar import month_cyclic, weekday_cyclic


def with_month_cyclic(df: DataFrame, date_col: str = "date") -> DataFrame:
    s, c = month_cyclic(date_col)
    return df.withColumn("month_sin", s).withColumn("month_cos", c)


def with_weekday_cyclic(df: DataFrame, date_col: str = "date") -> DataFrame:
    s, c, w = weekday_cyclic(date_col)
    return df.withColumn("dow_sin", s).withColumn("dow_cos", c).withColumn("is_weekend", w)


def temporal_split(df: DataFrame, era_start: str = ERA_START, train_end: str = TRAIN_END,
                   coverage_col: str | None = "fire_data_coverage", date_col: str = "date",
                   out: str = "split") -> DataFrame:
    """Keep the homogeneous era (and covered rows); label train (<= train_end) / test.

    Filters on the date column prune year partitions of a partitioned panel.
    """
    cond = F.col(date_col) >= F.to_date(F.lit(era_start))
    if coverage_col:
        cond = cond & F.col(coverage_col)
    kept = df.filter(cond)
    return kept.withColumn(out, F.when(F.col(date_col) <= F.to_date(F.lit(train_end)), F.lit("train"))
                           .otherwise(F.lit("test")))
