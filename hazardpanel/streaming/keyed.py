"""Priority dedup in keyed state and daily totals by signed deltas.

``winner_changes`` keeps a register per natural key in the state store: the best
copy seen so far.  A copy of better priority replaces it, and the change goes out
as two signed rows, the old copy with -1 and the new one with +1; any other copy
goes nowhere.  The registers of a day are dealt over buckets, each one state value,
so that a batch pays per bucket it touches, not per key.  A timer at the end of the
day clears them once the watermark (``LOOKBACK_DAYS`` behind the newest detection)
has passed it: from then on every copy of those keys is late and dropped by the
engine, so the state holds the look-back and no more.

``DeltaWriter`` is the ``foreachBatch`` body.  A micro-batch is written below
``changes/batch=N`` (its changed rows, placed) and ``deltas/batch=N`` (signed counts
per region, day and measured value); both depend on the batch alone, stored days
are not read.  Adding counts up gives the daily totals whatever the order of the
batches.  The value is part of the key because a maximum cannot be taken back: the
largest value with a positive count is the maximum of what is left.  Published
values have few decimals, so there are far fewer keys than detections.

Every ``COMPACT_EVERY`` batches the deltas are added up into ``base/batch=N``, which
stands for all batches up to N.  Readers take the newest base that has its success
marker and the deltas after it, so they see one state of the table, before or after
a compaction; a base and the deltas it holds are removed only when the next base
stands.  A retried batch overwrites its own folders with the same rows.
"""

from __future__ import annotations

import calendar
import datetime as dt
import io
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from hazardpanel.constants import DETECTION_KEY, LOOKBACK_DAYS
from hazardpanel.functions.scalar import EXACT
from hazardpanel.operators.persistence import with_grid
from hazardpanel.operators.spatial import assign_region, cell_index
from hazardpanel.plans.refresh import path_exists
from hazardpanel.schemas import DAILY_DETECTIONS

COMPACT_EVERY = 24
#: State values that share the keys of a day.
BUCKETS = 16
DAY_MS = 86_400_000
#: ``transformWithState`` needs state in RocksDB; a commit stores its changes, not whole
#: snapshots.  Expired timers are handled with the next data, not in a batch of their own.
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
}


@contextmanager
def keyed_state(spark: SparkSession):
    """``STATE_CONF`` for queries started inside."""
    old = {k: spark.conf.get(k, None) for k in STATE_CONF}
    for k, v in STATE_CONF.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def minute_of(date_col: str = "acq_date", time_col: str = "acq_time"):
    """The minute of a detection as an instant, read as UTC."""
    d, t = F.col(date_col), F.col(time_col)
    return F.make_timestamp(F.year(d), F.month(d), F.day(d), F.floor(t / 100).cast("int"), (t % 100).cast("int"), F.lit(0).cast("decimal(8,6)"), F.lit("UTC"))


class Registers(StatefulProcessor):
    """The best copies of the natural keys of one (day, bucket), as an Arrow table
    in one state value: a batch reads and writes it once, not once per key.

    Each row carries the hash of its key.  Only rows whose hash another row shares,
    held or new, are compared by their keys; all others are copies of nothing and stay
    in Arrow (held) or are put as they are (new)."""

    def __init__(self, key: Sequence[str], order: Sequence[str], columns: T.StructType, date_col: str):
        self.key, self.order, self.date_col = list(key), list(order), date_col
        self.columns = columns.names
        # the day is the group's: it is neither stored nor compared
        self.inner = [c for c in self.key if c != date_col]
        self.held_columns = [*(c for c in self.columns if c != date_col), "key_hash"]
        self.schema = to_arrow_schema(T.StructType([*(f for f in columns.fields if f.name != date_col), T.StructField("key_hash", T.LongType())]))

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.best = handle.getValueState("best", "registers binary")

    def _arrow(self, rows: pd.DataFrame) -> pa.Table:
        return pa.Table.from_pandas(rows[self.held_columns], self.schema, preserve_index=False)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        new = pd.concat(list(rows), ignore_index=True)[self.held_columns]
        state = self.best.get()
        rest, held = None, new.iloc[:0]
        shared = new["key_hash"].duplicated(keep=False)
        if state is None:
            # the end of the day: a copy that comes after the watermark has passed it is late
            self.handle.registerTimer(calendar.timegm(key[0].timetuple()) * 1000 + DAY_MS)
        else:
            table = pa.ipc.open_stream(state[0]).read_all()
            met = pc.is_in(table["key_hash"], value_set=pa.array(new["key_hash"].unique()))
            rest, held = table.filter(pc.invert(met)), table.filter(met).to_pandas()
            shared |= new["key_hash"].isin(held["key_hash"])
        alone, put, gone = new[~shared], new.iloc[:0], held.iloc[:0]
        if shared.any():
            # stable sort: of equal ranks the held copy stays; nulls first, as the batch job orders them
            some = new[shared].assign(_held=False)
            both = pd.concat([held.assign(_held=True), some], ignore_index=True) if len(held) else some
            best = both.sort_values(self.order, kind="stable", na_position="first").drop_duplicates(self.inner)
            put = best[~best["_held"].astype(bool)][self.held_columns]
            if len(held) and len(put):
                gone = held.merge(put[self.inner], on=self.inner)
            held = best[best["_held"].astype(bool)][self.held_columns]
        if not len(alone) and not len(put):
            return
        parts = [*([rest] if rest is not None else []), *(self._arrow(x) for x in (held, put, alone) if len(x))]
        with io.BytesIO() as out:
            with pa.ipc.new_stream(out, self.schema) as writer:
                for part in parts:
                    writer.write_table(part)
            self.best.update((out.getvalue(),))
        for changed, sign in ((gone, -1), (put, 1), (alone, 1)):
            if len(changed):
                yield changed.assign(**{self.date_col: key[0], "n": sign})[[*self.columns, "n"]]

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.best.clear()
        yield from ()

    def close(self) -> None:
        pass


def winner_changes(detections: DataFrame, key: Sequence[str] = DETECTION_KEY, order: Sequence[str] = ("pri", "event_id"),
                   watermark: str = f"{LOOKBACK_DAYS} days", date_col: str = "acq_date", buckets: int = BUCKETS) -> DataFrame:
    """Streaming ``detections`` as signed changes (column ``n``) of the best copy per key.
    ``buckets`` is how many state values share a day (about a thousand keys each is
    a good size); it belongs to the checkpoint, as the number of state partitions does."""
    out = T.StructType([*detections.schema.fields, T.StructField("n", T.IntegerType())])
    timed = detections.withColumn("_event_ts", minute_of()).withWatermark("_event_ts", watermark)
    dealt = timed.withColumn("key_hash", F.xxhash64(*key)).withColumnRenamed(date_col, "_day").withColumn("_bucket", F.pmod("key_hash", F.lit(buckets)))
    processor = Registers(key, order, detections.schema, date_col)
    return dealt.groupBy("_day", "_bucket").transformWithStateInPandas(processor, out, "Update", "EventTime")


def folders(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the finished ``batch=N`` folders below ``path``."""
    if not path_exists(spark, path):
        return []
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    names = [s.getPath().getName() for s in p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(p)]
    found = [int(n.partition("=")[2]) for n in names if n.startswith("batch=")]
    return sorted(n for n in found if path_exists(spark, f"{path}/batch={n}/_SUCCESS"))


def _remove(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


class DeltaWriter:
    """``foreachBatch`` sink over ``winner_changes`` (see module doc)."""

    def __init__(self, root: str, edges: DataFrame, dim: DataFrame, spots: DataFrame, region_col: str = "wilaya_id",
                 compact_every: int = COMPACT_EVERY):
        self.root, self.region_col, self.compact_every = root.rstrip("/"), region_col, compact_every
        self.cells = cell_index(edges, region_col)
        self.codes = dim.select(region_col, "wilaya_code")
        self.spots = spots.select("lat_grid", "lon_grid", F.lit(True).alias("_spot"))
        self.delta_key = [region_col, "acq_date", "frp"]
        kind = dict(dim.dtypes)[region_col]
        self.delta_schema = f"{region_col} {kind}, acq_date date, frp double, n bigint"

    def _place(self, rows: DataFrame) -> DataFrame:
        placed = with_grid(assign_region(rows, None, region_col=self.region_col, cells=self.cells).drop("n_matches"))
        marked = placed.join(self.spots, ["lat_grid", "lon_grid"], "left")
        typed = (F.col("type") == 0) | F.col("type").isNull()
        return marked.withColumn("kept", typed & F.col(self.region_col).isNotNull() & F.col("_spot").isNull()).drop("_spot")

    def _summed(self, deltas: DataFrame) -> DataFrame:
        return deltas.groupBy(*self.delta_key).agg(F.sum("n").alias("n")).filter("n <> 0")

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        changes = f"{self.root}/changes/batch={batch_id}"
        self._place(batch).write.mode("overwrite").parquet(changes)
        placed = spark.read.parquet(changes).filter("kept")
        self._summed(placed.select(*self.delta_key, F.col("n").cast("long").alias("n"))).coalesce(1).write.mode("overwrite").parquet(f"{self.root}/deltas/batch={batch_id}")
        if (batch_id + 1) % self.compact_every == 0:
            self.compact(spark, batch_id)

    def compact(self, spark: SparkSession, upto: int) -> None:
        """Add the deltas up to a batch to the newest base.  Its folder counts from
        the moment its success marker stands; what an older base stood for goes then."""
        before = [b for b in folders(spark, f"{self.root}/base") if b < upto]
        self._summed(self.deltas(spark, upto)).write.mode("overwrite").parquet(f"{self.root}/base/batch={upto}")
        if before:
            for b in before[:-1]:
                _remove(spark, f"{self.root}/base/batch={b}")
            for d in folders(spark, f"{self.root}/deltas"):
                if d <= before[-1]:
                    _remove(spark, f"{self.root}/deltas/batch={d}")

    def deltas(self, spark: SparkSession, upto: int | None = None) -> DataFrame:
        """Signed counts whose sum is the table after ``upto`` (default: the last batch)."""
        bases = [b for b in folders(spark, f"{self.root}/base") if upto is None or b < upto]
        after = bases[-1] if bases else -1
        paths = [f"{self.root}/base/batch={after}"] if bases else []
        paths += [f"{self.root}/deltas/batch={d}" for d in folders(spark, f"{self.root}/deltas") if d > after and (upto is None or d <= upto)]
        return spark.read.schema(self.delta_schema).parquet(*paths) if paths else spark.createDataFrame([], self.delta_schema)

    def daily(self, spark: SparkSession, days: Sequence[dt.date] | None = None) -> DataFrame:
        """Daily totals per region, of all days or of some."""
        deltas = self.deltas(spark)
        if days is not None:
            deltas = deltas.filter(F.col("acq_date").isin(list(days)))
        rows = self._summed(deltas)
        value = F.col("frp").cast(EXACT)
        totals = rows.groupBy(self.region_col, F.col("acq_date").alias("date")).agg(
            F.coalesce(F.sum(F.when(F.col("frp").isNotNull(), F.col("n"))), F.lit(0)).alias("nb_detections"),
            F.coalesce(F.sum(value * F.col("n").cast("decimal(10,0)")).cast("double"), F.lit(0.0)).alias("frp_total"),
            F.max("frp").alias("frp_max")).withColumn("fire_detected", F.lit(1))
        joined = totals.join(self.codes, self.region_col, "left")
        return joined.select(*[F.col(f.name).cast(f.dataType) for f in DAILY_DETECTIONS.fields])

    def deduplicated(self, spark: SparkSession) -> DataFrame:
        """One row per natural key, the best copy: what the signed rows add up to."""
        changes = spark.read.parquet(f"{self.root}/changes").drop("batch")
        columns = [c for c in changes.columns if c != "n"]
        rows = changes.groupBy(*columns).agg(F.sum("n").alias("_n")).filter("_n > 0")
        return rows.drop("_n")


def run_changes(changes: DataFrame, writer: Callable[[DataFrame, int], None], checkpoint: str, partitions: int | None = None):
    """Process everything landed so far, then stop; the finished query."""
    from hazardpanel.streaming.detections import state_partitions
    spark = changes.sparkSession
    q = changes.writeStream.outputMode("update").foreachBatch(writer).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    with state_partitions(spark, partitions), keyed_state(spark):
        handle = q.start()
    handle.awaitTermination()
    return handle
