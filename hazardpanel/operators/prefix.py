"""Running totals over a global order without a single-partition window.

A window with ``orderBy`` but no ``partitionBy`` moves every row into one task.
Instead rows are dealt by ranges of the order column and written once with the
number of their range; each range sums its values (a table of one row per
range), offsets come from a window over those few rows, and every range computes
its local running sum in its own task.  Range bounds only balance the work: the
result is exact for any of them, the same at every size, and keeps the order
column's own type (long integers are never compared as doubles).

Order: Spark's own.  Nulls come first (last when descending) and form one place
like any other value; NaN is larger than every number.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hazardpanel.session import materialize


def running_totals(df: DataFrame, order_col: str, value_cols: Sequence[str],
                   descending: bool = False, n_ranges: int | None = None,
                   prefix: str = "cum_") -> DataFrame:
    """Add ``cum_<v>`` = sum of ``v`` over all rows up to and including this one.

    ``order_col`` is of any orderable type and unique (pre-aggregate ties
    first).  ``descending`` accumulates from the largest key down.  ``n_ranges``
    defaults to the session's shuffle width, which AQE reduces for small inputs.
    """
    order = F.desc(order_col) if descending else F.asc(order_col)
    dealt = df.repartitionByRange(n_ranges, order) if n_ranges else df.repartitionByRange(order)
    ranged = materialize(dealt.withColumn("_range", F.spark_partition_id()), "running-totals")
    totals = ranged.groupBy("_range").agg(*[F.sum(v).alias(f"_t_{v}") for v in value_cols])
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_range", *[F.coalesce(F.sum(f"_t_{v}").over(before), F.lit(0)).alias(f"_o_{v}")
                                        for v in value_cols])
    local = Window.partitionBy("_range").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    out = ranged.join(offsets, "_range")
    for v in value_cols:
        out = out.withColumn(f"{prefix}{v}", F.col(f"_o_{v}") + F.sum(v).over(local))
    return out.drop("_range", *[f"_o_{v}" for v in value_cols])


def row_numbers(df: DataFrame, order_col: str, out_col: str = "rn", n_ranges: int | None = None) -> DataFrame:
    """1-based global row number (long) by a unique ``order_col``."""
    counted = df.withColumn("_one", F.lit(1))
    return running_totals(counted, order_col, ["_one"], n_ranges=n_ranges) \
        .withColumnRenamed("cum__one", out_col).drop("_one")
