"""Registers in keyed state and daily totals by signed deltas."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from hazardpanel import fixtures as fx
from hazardpanel.constants import DETECTION_KEY
from hazardpanel.operators.dedup import dedup_keep_first
from hazardpanel.operators.persistence import recurring_spot_table
from hazardpanel.plans.refresh import lookback_daily
from hazardpanel.session import scratch_path
from hazardpanel.streaming.keyed import DeltaWriter, folders, run_changes, winner_changes
from tests.conftest import SF_SMALL


def rows(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


@pytest.fixture(scope="module")
def det(spark):
    return fx.detections(spark, SF_SMALL).checkpoint()


@pytest.fixture(scope="module")
def inputs(spark, det):
    dim, edges, spots = fx.region_dim(spark, SF_SMALL), fx.edges(spark, SF_SMALL), recurring_spot_table(det).checkpoint()
    return dim, edges, spots, lookback_daily(det, edges, dim, spots)


def writer(spark, inputs, name, **kw):
    dim, edges, spots, _ = inputs
    return DeltaWriter(scratch_path(spark, name), edges, dim, spots, **kw)


def stream(spark, sink, slices, root, partitions=2):
    last = None
    for part in slices:
        part.coalesce(1).write.mode("append").parquet(f"{root}/landing")
        last = run_changes(winner_changes(spark.readStream.schema(part.schema).parquet(f"{root}/landing"), buckets=2), sink, f"{root}/checkpoint", partitions)
    return last


def test_copies_in_any_order_equal_the_batch_view(spark, det, inputs):
    """Science rows and near-real-time copies dealt over three batches by hash, some twice."""
    h = F.pmod(F.xxhash64("event_id", "pri"), F.lit(3))
    slices = [det.filter(h == k).unionByName(det.filter((h == (k + 1) % 3) & (F.col("event_id") % 5 == 0))) for k in range(3)]
    # one day late of 14 is inside the look-back: the fixture spans a month, so take its last 10 days
    hi = det.agg(F.max("acq_date")).first()[0]
    recent = F.col("acq_date") > F.lit(hi - dt.timedelta(days=10))
    slices = [s.filter(recent) for s in slices]
    sink = writer(spark, inputs, "keyed-any")
    stream(spark, sink, slices, scratch_path(spark, "keyed-any"))
    dim, edges, spots, _ = inputs
    assert rows(sink.deduplicated(spark).select(*det.columns)) == rows(dedup_keep_first(det.filter(recent), DETECTION_KEY, ["pri", "event_id"]))
    assert rows(sink.daily(spark)) == rows(lookback_daily(det.filter(recent), edges, dim, spots).withColumn("wilaya_id", F.col("wilaya_id").cast("int")))


def test_state_is_bounded_by_the_look_back(spark, det, inputs):
    lo = det.agg(F.min("acq_date")).first()[0]
    day = F.datediff("acq_date", F.lit(lo))
    span = det.agg(F.max(day)).first()[0]
    sink = writer(spark, inputs, "keyed-state")
    root = scratch_path(spark, "keyed-state")
    cuts = [0, span // 3, 2 * span // 3, span + 1]
    last = stream(spark, sink, [det.filter((day >= a) & (day < b)) for a, b in zip(cuts, cuts[1:])], root)
    # a further batch lets the engine clear what the watermark of the one before has passed
    last = stream(spark, sink, [det.filter(day == span)], root)
    state = last.lastProgress.stateOperators[0]
    assert span > 20 and state.numRowsTotal < 2 * 2 * (14 + 3) * 1.2      # value and timer of two buckets a day of the look-back
    assert rows(sink.daily(spark)) == rows(inputs[3].withColumn("wilaya_id", F.col("wilaya_id").cast("int")))


def change(det, event_id, sign, **new):
    row = det.filter((F.col("event_id") == event_id) & (F.col("pri") == 0))
    for c, v in new.items():
        row = row.withColumn(c, F.lit(v).cast(dict(det.dtypes)[c]))
    return row.withColumn("n", F.lit(sign))


def test_late_row_writes_its_own_keys_only(spark, det, inputs):
    sink = writer(spark, inputs, "keyed-late")
    placed = sink._place(det.filter("pri = 0 and type = 0")).filter("kept").orderBy("event_id").select("event_id", "acq_date", "frp").first()
    whole = dedup_keep_first(det, DETECTION_KEY, ["pri", "event_id"]).withColumn("n", F.lit(1))
    sink(whole, 0)
    assert rows(sink.daily(spark)) == rows(inputs[3].withColumn("wilaya_id", F.col("wilaya_id").cast("int")))
    # the largest value of its day is taken back: another becomes the maximum
    sink(change(det, placed.event_id, -1).unionByName(change(det, placed.event_id, 1, frp=placed.frp + 1000)), 1)
    delta = spark.read.parquet(f"{sink.root}/deltas/batch=1").collect()
    assert sorted((r.acq_date, r.n) for r in delta) == [(placed.acq_date, -1), (placed.acq_date, 1)]
    assert sink.daily(spark, [placed.acq_date]).agg(F.max("frp_max")).first()[0] == placed.frp + 1000
    sink(change(det, placed.event_id, -1, frp=placed.frp + 1000).unionByName(change(det, placed.event_id, 1)), 2)
    assert rows(sink.daily(spark)) == rows(inputs[3].withColumn("wilaya_id", F.col("wilaya_id").cast("int")))


def test_compaction_and_retry_change_nothing(spark, det, inputs):
    plain, compacted = writer(spark, inputs, "keyed-plain"), writer(spark, inputs, "keyed-compact", compact_every=2)
    ded = dedup_keep_first(det, DETECTION_KEY, ["pri", "event_id"]).withColumn("n", F.lit(1))
    for k in range(7):
        part = ded.filter(F.col("event_id") % 7 == k)
        for sink in (plain, compacted):
            sink(part, k)
            if k in (3, 5):
                sink(part, k)                       # the batch is tried again
        assert rows(plain.daily(spark)) == rows(compacted.daily(spark))
    assert folders(spark, f"{compacted.root}/base") == [3, 5] and folders(spark, f"{compacted.root}/deltas") == [4, 5, 6]
    assert rows(compacted.daily(spark)) == rows(inputs[3].withColumn("wilaya_id", F.col("wilaya_id").cast("int")))


def test_unfinished_compaction_is_not_read(spark, det, inputs):
    sink = writer(spark, inputs, "keyed-unfinished")
    sink(dedup_keep_first(det, DETECTION_KEY, ["pri", "event_id"]).withColumn("n", F.lit(1)), 0)
    before = rows(sink.daily(spark))
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{sink.root}/base/batch=0/part-0")
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(path).close()      # no success marker
    assert rows(sink.daily(spark)) == before
    sink.compact(spark, 0)
    assert rows(sink.daily(spark)) == before


def test_nothing_yet(spark, det, inputs):
    sink = writer(spark, inputs, "keyed-none")
    assert sink.daily(spark).count() == 0
    sink(det.limit(0).withColumn("n", F.lit(1)), 0)
    assert sink.daily(spark).count() == 0 and sink.deduplicated(spark).count() == 0


class _Handle:
    """One state value and the timers set, as the engine's handle offers them."""

    def __init__(self):
        self.value, self.timers = None, []

    def getValueState(self, *_):
        return self

    def registerTimer(self, at):
        self.timers.append(at)

    def get(self):
        return self.value

    def update(self, value):
        self.value = value


@pytest.mark.parametrize("collide", [False, True])
def test_registers_compare_keys_and_not_hashes_alone(spark, det, collide):
    """Rows that share no hash are never compared; rows that share one are, by key."""
    from hazardpanel.streaming.keyed import Registers
    day = det.agg(F.min("acq_date")).first()[0]
    rows_of_day = det.filter(F.col("acq_date") == F.lit(day)).withColumn("key_hash", F.lit(7).cast("long") if collide else F.xxhash64(*DETECTION_KEY)).toPandas()
    handle = _Handle()
    registers = Registers(DETECTION_KEY, ["pri", "event_id"], det.schema, "acq_date")
    registers.init(handle)
    total = {}
    for part in (rows_of_day[rows_of_day["pri"] == 1], rows_of_day, rows_of_day[rows_of_day["event_id"] % 2 == 0]):
        for out in registers.handleInputRows((day, 0), iter([part]), None):
            for r in out.itertuples():
                total[(r.event_id, r.pri)] = total.get((r.event_id, r.pri), 0) + r.n
    want = dedup_keep_first(det.filter(F.col("acq_date") == F.lit(day)), DETECTION_KEY, ["pri", "event_id"]).collect()
    assert {k for k, n in total.items() if n} == {(r.event_id, r.pri) for r in want} and set(total.values()) <= {0, 1}
    assert len(handle.timers) == 1


def test_slice_lands_in_a_file_per_core(spark):
    from hazardpanel import landing
    root = scratch_path(spark, "test-slices")
    writers, schema = landing.stream_feed_writers(spark, SF_SMALL, f"{root}/landing")
    for k, land in enumerate(writers[:2]):
        land()
        assert len(spark.read.schema(schema).parquet(f"{root}/landing").inputFiles()) == (k + 1) * landing.slice_files(spark)
