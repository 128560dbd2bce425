"""Structured Streaming refresh of detections (look-back with late data).

Source: a file stream of landed detection batches.  Event time is cast to
``timestamp`` (session time zone) because watermarks reject
``timestamp_ntz``.

``DetectionBatchWriter`` is the ``foreachBatch`` body:

1. the batch's rows are placed (polygon, stored spot list, type filter), which
   depends on a row alone, so stored rows are never placed again;
2. they are merged with the stored rows of the batch's days by priority dedup on
   the natural key (``min_by`` on (priority, id)): whichever copy arrives first,
   the one of better priority ends up stored, as in the batch job;
3. the merged days replace their partitions; the daily aggregate of those days is
   recomputed from them; a day that has nothing left loses its partition;
4. with a weather base, the current-period panel rows of those days (left join,
   zero-fill, dimension, coverage true) are replaced as well.

The batch's placed rows are written once below ``staging/fresh=N``; the merge is
written below ``staging/batch=N`` (all of it, or nothing is committed) and the sinks
are rewritten from there.  A retried micro-batch finds
its finished staging table and rewrites the same partitions from it, so the sinks
stay exactly-once under the streaming checkpoint, even if the first try stopped
between two partitions.  Staging folders of earlier batches are removed.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazardpanel.constants import DETECTION_KEY, LOOKBACK_DAYS
from hazardpanel.operators.dedup import dedup_keep_first
from hazardpanel.operators.panel import daily_region_agg
from hazardpanel.operators.persistence import with_grid
from hazardpanel.operators.spatial import assign_region, cell_index
from hazardpanel.plans.refresh import current_panel, drop_partitions, partition_days, path_exists, remove_folders
from hazardpanel.schemas import DAILY_DETECTIONS


#: Rows of a merge task.
TASK_ROWS = 1_000_000


def _overwrite(df: DataFrame, path: str, *partition_cols: str) -> None:
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy(*partition_cols).parquet(path))


class DetectionBatchWriter:
    """``foreachBatch`` sink: place → merge by priority → daily upsert (see module doc)."""

    def __init__(self, root: str, edges: DataFrame, dim: DataFrame, spots: DataFrame,
                 order=("pri", "event_id"), region_col: str = "wilaya_id",
                 weather: DataFrame | None = None):
        self.root = root.rstrip("/")
        # built and stored once per query, reused by every micro-batch
        self.cells = cell_index(edges, region_col)
        self.codes = dim.select(region_col, "wilaya_code")
        self.dim = dim
        self.weather = weather          # dense (region, date) base: enables the panel sink
        self.spots = spots.select("lat_grid", "lon_grid", F.lit(True).alias("_spot"))
        self.order = list(order)
        self.region_col = region_col

    @property
    def placed_path(self) -> str:
        """Deduplicated rows with ``wilaya_id``, grid cell and ``kept``."""
        return f"{self.root}/placed"

    @property
    def daily_path(self) -> str:
        return f"{self.root}/daily"

    @property
    def panel_path(self) -> str:
        return f"{self.root}/panel"

    def deduplicated(self, spark: SparkSession) -> DataFrame:
        """All rows stored so far, one per natural key."""
        return spark.read.parquet(self.placed_path).drop(self.region_col, "lat_grid", "lon_grid", "kept")

    def enriched(self, spark: SparkSession) -> DataFrame:
        """Rows in a region, of a kept type, off the recurring spots."""
        return spark.read.parquet(self.placed_path).filter("kept").drop("kept")

    def _place(self, rows: DataFrame) -> DataFrame:
        placed = with_grid(assign_region(rows, None, region_col=self.region_col, cells=self.cells).drop("n_matches"))
        marked = placed.join(self.spots, ["lat_grid", "lon_grid"], "left")
        typed = (F.col("type") == 0) | F.col("type").isNull()
        return marked.withColumn("kept", typed & F.col(self.region_col).isNotNull() & F.col("_spot").isNull()).drop("_spot")

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        staging = f"{self.root}/staging/batch={batch_id}"
        if path_exists(spark, f"{staging}/_SUCCESS"):
            days = [r[0] for r in spark.read.parquet(staging).select("acq_date").distinct().collect()]
        else:
            days = self._stage(spark, batch, f"{self.root}/staging/fresh={batch_id}", staging)
        if days:
            self._publish(spark, spark.read.parquet(staging), days)
        remove_folders(spark, f"{self.root}/staging", lambda name: name != f"batch={batch_id}")

    def _stage(self, spark: SparkSession, batch: DataFrame, arrived: str, staging: str) -> list:
        """Write the batch merged with the stored rows of its days; those days."""
        # the batch is evaluated here and nowhere else: it holds the stream's state
        self._place(dedup_keep_first(batch, DETECTION_KEY, self.order)).write.mode("overwrite").parquet(arrived)
        fresh = spark.read.parquet(arrived)
        counted = fresh.groupBy("acq_date").count().collect()                   # the batch's days
        days, n_rows = [r[0] for r in counted], sum(r[1] for r in counted)
        if days and path_exists(spark, self.placed_path):
            # a late copy may change any stored row of its day (the key holds the day)
            known = [d for d in days if d is not None]
            of_days = F.col("acq_date").isin(known) if known else F.lit(False)
            if len(known) < len(days):
                of_days = of_days | F.col("acq_date").isNull()
            stored = spark.read.parquet(self.placed_path).filter(of_days)       # other days' folders are not read
            n_rows += stored.count()                                            # from the files' footers
            both = self._by_day(spark, stored.unionByName(fresh), len(days), n_rows)
            merged = dedup_keep_first(both, [*DETECTION_KEY, "_slot"], self.order)
        else:
            merged = self._by_day(spark, fresh, len(days), n_rows)
        merged.drop("_slot").write.mode("overwrite").parquet(staging)
        return days

    def _by_day(self, spark: SparkSession, rows: DataFrame, n_days: int, n_rows: int) -> DataFrame:
        """``rows`` dealt by (day, ``_slot``), copies of a key together: few days share a
        file, so that a day's folder gets a few files and not one of every task.  The
        merge needs no further shuffle."""
        cores = spark.sparkContext.defaultParallelism
        tasks = max(cores, -(-n_rows // TASK_ROWS))
        slots = -(-4 * tasks // max(n_days, 1))        # enough pieces to spread evenly
        slot = F.pmod(F.xxhash64(*DETECTION_KEY), F.lit(slots)).cast("int")
        return rows.withColumn("_slot", slot).repartition(tasks, "acq_date", "_slot")

    def _publish(self, spark: SparkSession, merged: DataFrame, days: list) -> None:
        _overwrite(merged, self.placed_path, "acq_date")
        daily = daily_region_agg(merged.filter("kept"), (self.region_col,), "acq_date")
        # a few rows per day, computed once for the two tables and the days that have any
        daily = daily.join(self.codes, self.region_col, "left").repartition("date").persist()
        try:
            _overwrite(daily.withColumn("acq_date", F.col("date")).drop("date"), self.daily_path, "acq_date")
            left = {r[0] for r in daily.select("date").distinct().collect()}
            drop_partitions(spark, self.daily_path, "acq_date", [d for d in days if d is not None and d not in left])
            if self.weather is not None:
                # current-period panel rows of the batch's days, rebuilt from the day totals
                touched = spark.createDataFrame([(d,) for d in days], "date date")
                base = self.weather.join(touched, "date", "left_semi")
                _overwrite(current_panel(base, daily, self.dim, self.region_col), self.panel_path, "date")
        finally:
            daily.unpersist()


def event_time(col: str):
    """Event-time instant of a ``timestamp_ntz`` wall clock, read as UTC.

    Watermarks need ``timestamp``; a plain cast would read the wall clock in
    the session zone, and day windows (aligned to UTC epoch days) would then
    straddle calendar days.  Building the instant in UTC keeps windows on
    calendar days whatever the session zone.
    """
    c = F.col(col)
    secs = F.second(c).cast("decimal(8,6)")
    return F.make_timestamp(F.year(c), F.month(c), F.dayofmonth(c), F.hour(c), F.minute(c), secs,
                            F.lit("UTC"))


def epoch_day(ts_col):
    """Calendar day of a UTC-aligned window bound, independent of the session zone."""
    return F.date_from_unix_date(F.floor(F.unix_seconds(ts_col) / F.lit(86400)).cast("int"))


def detection_stream(spark: SparkSession, source_dir: str, event_schema, to_detections,
                     watermark: str = f"{LOOKBACK_DAYS} days", id_col: str = "event_id",
                     ts_col: str = "ts", feed_col: str = "pri") -> DataFrame:
    """Streaming detections: watermark on event time, rows re-sent by one feed
    dropped by (id, feed); copies of other feeds are the writer's to rank."""
    raw = spark.readStream.schema(event_schema).parquet(source_dir)
    timed = raw.withColumn("_event_ts", event_time(ts_col))
    deduped = timed.withWatermark("_event_ts", watermark).dropDuplicatesWithinWatermark([id_col, feed_col])
    return to_detections(deduped)


@contextmanager
def state_partitions(spark: SparkSession, n: int | None = None):
    """Number of state-store partitions for queries started inside the block.

    Stateful operators keep one state partition per shuffle partition, fixed
    in the checkpoint when the query first starts, and every micro-batch
    touches all of them.  Size them to the cluster (default parallelism)
    rather than inheriting whatever batch setting the session carries.
    """
    n = n or spark.sparkContext.defaultParallelism
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    try:
        yield n
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def run_available_now(stream: DataFrame, writer, checkpoint: str, name: str | None = None,
                      output_mode: str = "append", partitions: int | None = None) -> None:
    """Process everything landed so far, then stop (``availableNow`` trigger)."""
    q = (stream.writeStream.outputMode(output_mode).foreachBatch(writer)
               .option("checkpointLocation", checkpoint).trigger(availableNow=True))
    if name:
        q = q.queryName(name)
    with state_partitions(stream.sparkSession, partitions):
        handle = q.start()
    handle.awaitTermination()


def read_daily(spark: SparkSession, path: str) -> DataFrame:
    """The daily table of the stream (empty once no stored day has a kept row)."""
    if not path_exists(spark, path) or not partition_days(spark, path, "acq_date"):
        return spark.createDataFrame([], DAILY_DETECTIONS)
    return spark.read.parquet(path).withColumnRenamed("acq_date", "date")


def daily_event_counts_stream(spark: SparkSession, source_dir: str, event_schema,
                              watermark: str = f"{LOOKBACK_DAYS} days", id_col: str = "event_id",
                              ts_col: str = "ts") -> DataFrame:
    """Native stateful stream: late rows beyond the watermark dropped, resent
    rows dropped by id, event counts per tumbling day window (update mode)."""
    raw = spark.readStream.schema(event_schema).parquet(source_dir)
    timed = raw.withColumn("_event_ts", event_time(ts_col))
    deduped = timed.withWatermark("_event_ts", watermark).dropDuplicatesWithinWatermark([id_col])
    return (deduped.groupBy(F.window("_event_ts", "1 day").alias("w"))
                   .agg(F.count(F.lit(1)).alias("n_events"))
                   .select(epoch_day(F.col("w.start")).alias("day"), "n_events"))


class DayUpsert:
    """``foreachBatch`` for update-mode aggregates keyed by day: each update row
    carries the full running value, so its day partition is simply replaced."""

    def __init__(self, path: str, day_col: str = "day"):
        self.path = path
        self.day_col = day_col

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        _overwrite(batch, self.path, self.day_col)
