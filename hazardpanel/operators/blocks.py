"""Window features of long series, cut into blocks of rows.

A window partitioned by the series alone puts a whole series into one task: few
long series leave most of a cluster idle, and one very long series fits no task.
Here rows get their place in their series without such a window, places are cut
into blocks, and a window runs per (series, block):

* rolling features look back a bounded number of rows, so the last rows of a block
  are repeated as the *halo* of the next and dropped after the window;
* features that look back without bound (rows since the last event) need one value
  from all earlier blocks, the *carry*: the last event of each block, summed up over
  a series' blocks (one row per block), and joined back.

The results equal ``operators/windows.py`` for every block size.  Rows of a series
need distinct order values; a null series is a series of its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hazardpanel.constants import DAYS_SINCE_CAP, RAIN_THRESHOLD_MM
from hazardpanel.operators.windows import prior_mean, prior_sum
from hazardpanel.session import materialize

BLOCK_ROWS = 100_000


def row_places(df: DataFrame, by: str, order: str, n_ranges: int | None = None) -> DataFrame:
    """``df`` with ``_place``: the row's number in its series from 1.

    Rows are dealt by ranges of (series, order) and written once with the number of
    their range; the rows of a series in earlier ranges come from a table of one row
    per (range, series), so no task holds more than a range.
    """
    keys = [F.col(by), F.col(order)]
    dealt = df.repartitionByRange(n_ranges, *keys) if n_ranges else df.repartitionByRange(*keys)
    ranged = materialize(dealt.withColumn("_range", F.spark_partition_id()), "row-places")
    earlier = Window.partitionBy("_by").orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)
    before = (ranged.groupBy(F.col(by).alias("_by"), F.col("_range").alias("_r")).agg(F.count(F.lit(1)).alias("_n"))
              .select("_by", "_r", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before")))
    inside = Window.partitionBy("_range", by).orderBy(order)
    return (ranged.join(before, (F.col("_range") == F.col("_r")) & F.col(by).eqNullSafe(F.col("_by")))
            .withColumn("_place", F.col("_before") + F.row_number().over(inside))
            .drop("_range", "_by", "_r", "_before"))


def with_blocks(placed: DataFrame, halo: int, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``_block`` of each row, and a second copy (``_halo`` true) of the last
    ``halo`` rows of a block under the next block."""
    if not 0 <= halo <= block_rows:
        raise ValueError("a halo reaches into the block before, so it has at most a block's rows")
    block = F.floor((F.col("_place") - 1) / F.lit(block_rows))
    inside = F.pmod(F.col("_place") - 1, F.lit(block_rows))
    both = F.array(F.struct(block.alias("b"), F.lit(False).alias("h")), F.struct((block + 1).alias("b"), F.lit(True).alias("h")))
    own = F.array(F.struct(block.alias("b"), F.lit(False).alias("h")))
    return (placed.withColumn("_at", F.explode(F.when(inside >= block_rows - halo, both).otherwise(own)))
            .withColumns({"_block": F.col("_at.b"), "_halo": F.col("_at.h")}).drop("_at"))


def days_since_in_blocks(blocked: DataFrame, flag_col: str, out: str, by: str, cap: int = DAYS_SINCE_CAP) -> DataFrame:
    """Rows since the last flagged row (``windows.with_days_since``) of a table with
    ``_place`` and ``_block`` and without halo rows; read twice, so written before."""
    event = F.when(F.coalesce(F.col(flag_col), F.lit(False)), F.col("_place"))
    earlier = Window.partitionBy("_by").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    carry = (blocked.groupBy(F.col(by).alias("_by"), F.col("_block").alias("_b")).agg(F.max(event).alias("_last"))
             .select("_by", "_b", F.max("_last").over(earlier).alias("_carry")))
    upto = Window.partitionBy(by, "_block").orderBy("_place").rowsBetween(Window.unboundedPreceding, 0)
    last = F.coalesce(F.max(event).over(upto), F.col("_carry"), F.lit(1))
    return (blocked.join(carry, (F.col("_block") == F.col("_b")) & F.col(by).eqNullSafe(F.col("_by")))
            .withColumn(out, F.least(F.col("_place") - last, F.lit(cap))).drop("_by", "_b", "_carry"))


def dryness_in_blocks(df: DataFrame, by: str = "wilaya_id", order: str = "date", precip: str = "precipitation_sum",
                      temp: str = "temperature_2m_max", et0: str = "et0_fao_evapotranspiration",
                      rain_mm: float = RAIN_THRESHOLD_MM, cap: int = DAYS_SINCE_CAP,
                      block_rows: int = BLOCK_ROWS, n_ranges: int | None = None) -> DataFrame:
    """``windows.dryness_features`` for series of any length and number."""
    series = [by, "_block"]
    blocked = with_blocks(row_places(df, by, order, n_ranges), 30, block_rows)
    previous = F.lag(precip, 1).over(Window.partitionBy(*series).orderBy("_place"))
    rolled = blocked.withColumns({
        "precip_sum_7d": prior_sum(precip, 7, 4, series, "_place"),
        "precip_sum_30d": prior_sum(precip, 30, 15, series, "_place"),
        "temp_max_mean_7d": prior_mean(temp, 7, 4, series, "_place"),
        "et0_sum_30d": prior_sum(et0, 30, 15, series, "_place"),
        "_rained": previous >= F.lit(rain_mm)})
    own = materialize(rolled.filter(~F.col("_halo")).drop("_halo"), "blocks")
    return days_since_in_blocks(own, "_rained", "days_since_rain", by, cap).drop("_rained", "_place", "_block")
