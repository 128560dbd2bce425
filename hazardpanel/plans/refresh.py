"""Incremental refresh of the current period (batch form).

* ``next_period_start``: first day after the frozen history (H6);
* ``window_replace``: newly aggregated days replace every stored row from
  the first new day on; older rows stay; rows before the period start go (H1);
* ``write_window_replace``: the same on a date-partitioned table, touching
  only the partitions from the window start on (dynamic overwrite);
* ``commit_window_replace``: the same on a committed table, where readers see the
  days before or after the change and nothing between;
* ``current_panel``: the period's dense panel with coverage constant true (H7);
* ``rolling_archive``: append, keep the last issue per key, retain N days (H8).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazardpanel.constants import FORECAST_RETENTION_DAYS
from hazardpanel.operators.dedup import dedup_keep_last
from hazardpanel.operators.panel import fixed_layout, fuse_panel
from hazardpanel.session import materialize
from hazardpanel.sources import committed


def next_period_start(frozen: DataFrame, date_col: str = "date") -> DataFrame:
    return frozen.agg(F.date_add(F.max(date_col), 1).alias("period_start"))


def _scalar_min(df: DataFrame, col: str):
    return df.agg(F.min(col)).first()[0]


def window_replace(stored: DataFrame, new: DataFrame, window_start: dt.date | None = None,
                   period_start: dt.date | None = None, date_col: str = "date") -> DataFrame:
    """Stored rows before ``window_start`` plus all new rows, from ``period_start`` on.

    ``window_start`` defaults to the first new day; with no new rows the stored
    table is returned unchanged.
    """
    if window_start is None:
        window_start = _scalar_min(new, date_col)
        if window_start is None:
            return stored
    ws = F.lit(window_start).cast("date")
    out = stored.filter(F.col(date_col) < ws).unionByName(new.select(*stored.columns))
    if period_start is not None:
        out = out.filter(F.col(date_col) >= F.lit(period_start).cast("date"))
    return out


def write_window_replace(spark: SparkSession, path: str, new: DataFrame,
                         window_start: dt.date | None = None, date_col: str = "date") -> str:
    """Date-partitioned table: rewrite only partitions on or after the window start.

    Partitions present in ``new`` are replaced by dynamic partition overwrite;
    stored dates from the window start on that ``new`` no longer has are
    deleted (partition directories, via the session's Hadoop file system).
    Older partitions are never touched, so re-running is idempotent.
    """
    new = materialize(new, "window-replace")       # computed once, read by the minimum and the write
    if window_start is None:
        window_start = _scalar_min(new, date_col)
        if window_start is None:
            return path
    (new.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(date_col).parquet(path))
    # days of the window that are stored but no longer in ``new``: folder names, not rows
    kept = {r[0] for r in new.select(date_col).distinct().collect()}       # days of one window
    stale = [d for d in partition_days(spark, path, date_col) if d >= window_start and d not in kept]
    drop_partitions(spark, path, date_col, stale)
    return path


def commit_window_replace(spark: SparkSession, path: str, new: DataFrame, window_start: dt.date | None = None,
                          period_start: dt.date | None = None, date_col: str = "date") -> int | None:
    """``window_replace`` on a committed table (created by the first call): the new days
    are staged, then one commit puts them in place of all stored days from the window
    start on and drops those before ``period_start``.  Without new rows (and no
    ``window_start``) nothing is replaced.  Returns the commit's number."""
    new = materialize(new, "window-replace")       # computed once, read by the minimum and the write
    if window_start is None:
        window_start = _scalar_min(new, date_col)
        if window_start is None:
            return committed.latest(spark, path)[0] or None
    if period_start is not None:
        new = new.filter(F.col(date_col) >= F.lit(period_start).cast("date"))

    def gone(day: str) -> bool:
        return not day[:1].isdigit() or dt.date.fromisoformat(day) >= window_start or (period_start is not None and dt.date.fromisoformat(day) < period_start)
    return committed.replace(spark, path, new, date_col, drop=gone)


def current_panel(weather: DataFrame, daily: DataFrame, dim: DataFrame,
                  region_col: str = "wilaya_id") -> DataFrame:
    """Current-period panel: left join, zero-fill, dimension, coverage true."""
    from hazardpanel.plans.rebuild import panel_layout
    return fixed_layout(fuse_panel(weather, daily, dim, region_col, constant_coverage=True), panel_layout(weather.columns))


def rolling_archive(existing: DataFrame, new: DataFrame | None, as_of: dt.date,
                    retention_days: int = FORECAST_RETENTION_DAYS,
                    key=("issued_date", "target_date", "wilaya_id"), arrival: str = "arrival") -> DataFrame:
    """Append ``new`` to the archive, keep the last arrival per key, keep
    issues from ``as_of - retention_days`` on (older partitions drop out)."""
    combined = existing if new is None else existing.unionByName(new)
    kept = dedup_keep_last(combined, list(key), [arrival])
    return kept.filter(F.col("issued_date") >= F.date_sub(F.lit(as_of).cast("date"), retention_days))


def path_exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def partition_days(spark: SparkSession, path: str, col: str = "date") -> list[dt.date]:
    """Days that a table partitioned by ``col`` has folders for (a listing, no scan)."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    names = [s.getPath().getName() for s in p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(p) if s.isDirectory()]
    return sorted(dt.date.fromisoformat(n.partition("=")[2]) for n in names if n.startswith(f"{col}=") and not n.endswith("__HIVE_DEFAULT_PARTITION__"))


def drop_partitions(spark: SparkSession, path: str, col: str, values) -> None:
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for v in values:
        p = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{col}={v.isoformat()}")
        p.getFileSystem(conf).delete(p, True)


def remove_folders(spark: SparkSession, path: str, which) -> None:
    """Remove the folders below ``path`` whose name ``which`` accepts."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for s in fs.listStatus(p):
        if s.isDirectory() and which(s.getPath().getName()):
            fs.delete(s.getPath(), True)


def write_rolling_archive(spark: SparkSession, path: str, new: DataFrame, as_of: dt.date,
                          retention_days: int = FORECAST_RETENTION_DAYS,
                          key=("issued_date", "target_date", "wilaya_id"), arrival: str = "arrival") -> str:
    """Archive partitioned by ``issued_date``: the issue dates present in
    ``new`` are merged keep-last with what is stored for them and rewritten
    (dynamic overwrite); partitions older than the retention are dropped.
    Only touched and expired partitions are ever written or removed."""
    new = materialize(new, "archive-new")
    merged = new
    if path_exists(spark, path) and partition_days(spark, path, "issued_date"):
        # any error of reading what is stored stops the job: a merge without it would delete it
        archive = spark.read.parquet(path)
        if set(archive.columns) != set(new.columns):
            raise ValueError(f"archive columns {sorted(archive.columns)} differ from the new rows' {sorted(new.columns)}")
        stored = archive.join(new.select("issued_date").distinct(), "issued_date", "left_semi")
        merged = stored.unionByName(new)
    # written first: the merge reads partitions that are rewritten below
    kept = materialize(dedup_keep_last(merged, list(key), [arrival]), "archive-merged")
    (kept.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("issued_date").parquet(path))
    cutoff = as_of - dt.timedelta(days=retention_days)
    drop_partitions(spark, path, "issued_date", [d for d in partition_days(spark, path, "issued_date") if d < cutoff])
    return path


def lookback_daily(points: DataFrame, edges: DataFrame, dim: DataFrame, spots: DataFrame,
                   order=("pri", "event_id"), region_col: str = "wilaya_id") -> DataFrame:
    """Daily aggregate of re-read detections: priority dedup, type filter,
    polygon (first match), stored spot list, (region, day) totals."""
    from hazardpanel.constants import DETECTION_KEY
    from hazardpanel.operators.dedup import dedup_keep_first
    from hazardpanel.operators.panel import daily_region_agg
    from hazardpanel.operators.persistence import drop_recurring, with_grid
    from hazardpanel.operators.spatial import assign_region
    d = dedup_keep_first(points, DETECTION_KEY, list(order))
    d = d.filter((F.col("type") == 0) | F.col("type").isNull())
    placed = assign_region(d, edges, region_col=region_col).filter(F.col(region_col).isNotNull())
    kept = drop_recurring(with_grid(placed), spots)
    daily = daily_region_agg(kept, (region_col,), "acq_date")
    return daily.join(dim.select(region_col, "wilaya_code"), region_col, "left").select(
        region_col, "wilaya_code", "date", "nb_detections", "frp_total", "frp_max", "fire_detected")


class RefreshResult:
    def __init__(self, period_start, daily: DataFrame, panel: DataFrame, new_daily: DataFrame):
        self.period_start = period_start
        self.daily = daily
        self.panel = panel
        self.new_daily = new_daily      # what the look-back found: the days that replace stored ones


def daily_refresh(frozen: DataFrame, stored_daily: DataFrame, lookback_points: DataFrame,
                  weather_current: DataFrame, edges: DataFrame, dim: DataFrame, spots: DataFrame,
                  order=("pri", "event_id"), region_col: str = "wilaya_id") -> RefreshResult:
    """The daily job: period boundary from the frozen table (H6), look-back
    detections through polygon, type and stored-spot filters (H4, D1),
    window replace of the stored daily table (H1) and the current-period
    panel on the period's weather (H7)."""
    period_start = next_period_start(frozen).first()[0]
    # the look-back chain runs once; its first day and the replaced table read the result
    new = materialize(lookback_daily(lookback_points, edges, dim, spots, order, region_col), "refresh-daily")
    daily = window_replace(stored_daily, new, period_start=period_start)
    base = weather_current.filter(F.col("date") >= F.lit(period_start))
    return RefreshResult(period_start, daily, current_panel(base, daily, dim, region_col), new)
