"""The recurring-spot list kept up to date feed by feed.

A cell's days are a sparse bitmap: one long of 64 days' bits per (cell, word), built
and merged with ``bit_or`` (a fixed-width aggregate with map-side combine).  It is
exact, and merging the bitmaps of feeds that share days counts no day twice.  The
bitmaps of each feed are stored as one partition of a committed table, so

* a new feed is read alone: only the cells that it touches are counted again, from
  the stored bitmaps and never from raw rows; all other cells keep their entry;
* a feed that is sent again, corrected, replaces its own bitmaps, and cells that it
  no longer touches are counted again as well;
* a job that stops leaves bitmaps and list as they were or is noticed by the next one
  (the list names the bitmap commit it was made from; another one means a recount of
  all cells from the bitmaps).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazardpanel.constants import PERSISTENCE_THRESHOLD_DAYS
from hazardpanel.operators.persistence import GRID_KEY, with_grid
from hazardpanel.session import materialize
from hazardpanel.sources import committed


def day_bitmaps(raw: DataFrame, date_col: str = "acq_date") -> DataFrame:
    """(lat_grid, lon_grid, word, bits) of the rows of type 0 or unknown; rows without a date have none."""
    kept = raw.filter((F.col("type") == 0) | F.col("type").isNull()).filter(F.col(date_col).isNotNull())
    day = F.unix_date(F.col(date_col).cast("date"))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(day, F.lit(64)))
    return with_grid(kept).groupBy(*GRID_KEY, F.shiftright(day, 6).alias("word")).agg(F.bit_or(bit).alias("bits"))


def days_per_cell(bitmaps: DataFrame) -> DataFrame:
    """Distinct days of each cell over all the given bitmaps."""
    merged = bitmaps.groupBy(*GRID_KEY, "word").agg(F.bit_or("bits").alias("bits"))
    return merged.groupBy(*GRID_KEY).agg(F.sum(F.bit_count("bits")).cast("long").alias("n_days_detected"))


def _same_cell(a: DataFrame, b: DataFrame):
    return a["lat_grid"].eqNullSafe(b["lat_grid"]) & a["lon_grid"].eqNullSafe(b["lon_grid"])


def update_spot_list(spark: SparkSession, store: str, feed: str, raw: DataFrame, threshold: int = PERSISTENCE_THRESHOLD_DAYS) -> int:
    """Take ``feed``, all rows of which are ``raw``, into the list below ``store``; returns the list's commit.

    ``feed`` is any name; its bitmaps take the place of those under the same name."""
    bitmaps, spots = f"{store}/bitmaps", f"{store}/spots"
    version, before = committed.latest(spark, bitmaps)
    _, listed = committed.latest(spark, spots)
    new = materialize(day_bitmaps(raw), "feed-bitmaps")
    touched = new.select(*GRID_KEY)
    if version:
        touched = touched.unionByName(committed.read(spark, bitmaps, version).filter(F.col("feed") == feed).select(*GRID_KEY))
    touched = materialize(touched.distinct(), "touched-cells")
    made_from = committed.replace(spark, bitmaps, new.withColumn("feed", F.lit(feed)), "feed",
                                  drop=lambda name: name == feed and not new.take(1))
    rows = committed.read(spark, bitmaps, made_from).select(*GRID_KEY, "word", "bits")
    current = version and "schema" in listed and listed["note"] == {"bitmaps": version, "threshold": threshold}
    if current:
        rows = rows.join(touched, _same_cell(rows, touched), "left_semi")
    found = days_per_cell(rows).filter(F.col("n_days_detected") > threshold)
    if current:
        old = committed.read(spark, spots).drop("part")
        found = old.join(touched, _same_cell(old, touched), "left_anti").unionByName(found)
    return committed.replace(spark, spots, found.withColumn("part", F.lit("all")), "part", drop=lambda _: True,
                             note={"bitmaps": made_from, "threshold": threshold})


def read_spot_list(spark: SparkSession, store: str, version: int | None = None) -> DataFrame:
    return committed.read(spark, f"{store}/spots", version).drop("part")
