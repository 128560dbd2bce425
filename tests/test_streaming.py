"""Streaming: watermark drops rows later than the look-back, keeps the rest."""

import datetime as dt

from hazardpanel.session import scratch_path
from hazardpanel.streaming.detections import DayUpsert, daily_event_counts_stream, run_available_now

SCHEMA = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"


def _events(spark, rows):
    return spark.createDataFrame(
        [(i, dt.datetime(2024, 1, d, 12), 1, "view", 1.0, None) for i, d in rows], SCHEMA)


def test_late_rows_beyond_watermark_are_dropped(spark):
    root = scratch_path(spark, "test-late")
    sink = DayUpsert(f"{root}/daily", "day")
    arrivals = [
        [(1, 20), (2, 25), (3, 30)],            # watermark moves to Jan 30 - 14 days = Jan 16
        [(4, 1), (5, 18), (2, 25)],             # Jan 1 is too late; Jan 18 is late but inside; id 2 re-sent
    ]
    for rows in arrivals:
        _events(spark, rows).write.mode("append").parquet(f"{root}/landing")
        stream = daily_event_counts_stream(spark, f"{root}/landing", _events(spark, []).schema)
        run_available_now(stream, sink, f"{root}/checkpoint", output_mode="update")
    got = sorted((r.day.day, r.n_events) for r in spark.read.parquet(sink.path).collect())
    assert got == [(18, 1), (20, 1), (25, 1), (30, 1)]


def _writer(spark, name, spots=None, weather=None):
    from hazardpanel import fixtures as fx
    from hazardpanel.streaming.detections import DetectionBatchWriter
    from tests.conftest import SF_SMALL
    spots = spots if spots is not None else spark.createDataFrame([], "lat_grid double, lon_grid double, n_days_detected long")
    return DetectionBatchWriter(scratch_path(spark, name), fx.edges(spark, SF_SMALL), fx.region_dim(spark, SF_SMALL), spots, weather=weather)


def _snapshot(spark, sink):
    from hazardpanel.streaming.detections import read_daily
    rows = lambda df: sorted(map(str, df.select(*sorted(df.columns)).collect()))
    return rows(sink.deduplicated(spark)), rows(sink.enriched(spark)), rows(read_daily(spark, sink.daily_path))


def test_any_arrival_order_and_retries_equal_the_batch(spark):
    from pyspark.sql import functions as F

    from hazardpanel import fixtures as fx
    from hazardpanel.operators.persistence import recurring_spot_table
    from hazardpanel.plans.refresh import lookback_daily
    from hazardpanel.streaming.detections import read_daily
    from tests.conftest import SF_SMALL

    det = fx.detections(spark, SF_SMALL)
    spots = recurring_spot_table(det)
    parts = [det.filter((F.col("pri") == 1) & (F.col("event_id") < 600)), det.filter((F.col("pri") == 0) & (F.col("event_id") < 700)),
             det.filter((F.col("pri") == 1) & (F.col("event_id") >= 500)), det.filter((F.col("pri") == 0) & (F.col("event_id") >= 650))]
    seen = []
    for name, order in (("forward", [0, 1, 2, 3]), ("backward", [3, 2, 1, 0])):
        sink = _writer(spark, f"test-{name}", spots)
        for batch_id, k in enumerate(order):
            sink(parts[k], batch_id)
            once = _snapshot(spark, sink)
            sink(parts[k], batch_id)                     # a retried batch changes nothing
            assert _snapshot(spark, sink) == once
        seen.append(_snapshot(spark, sink))
    assert seen[0] == seen[1]
    want = lookback_daily(det, fx.edges(spark, SF_SMALL), fx.region_dim(spark, SF_SMALL), spots)
    cols = ["wilaya_id", "date", "nb_detections", "frp_total", "frp_max"]
    assert sorted(map(tuple, read_daily(spark, sink.daily_path).select(*cols).collect())) == sorted(map(tuple, want.select(*cols).collect()))


def test_science_row_after_its_near_real_time_copy_wins(spark):
    from pyspark.sql import functions as F

    from hazardpanel import fixtures as fx
    from tests.conftest import SF_SMALL
    from hazardpanel.streaming.detections import read_daily

    point = fx.detections(spark, SF_SMALL).filter("pri = 0 and type = 0")
    sink = _writer(spark, "test-rank")
    first = sink._place(point).filter("kept").orderBy("event_id").select("event_id").limit(1)
    one = spark.createDataFrame(point.join(first, "event_id", "left_semi").collect(), point.schema)
    sink(one.withColumn("pri", F.lit(1)).withColumn("type", F.lit(None).cast("int")), 0)
    assert read_daily(spark, sink.daily_path).count() == 1
    sink(one.withColumn("type", F.lit(2)), 1)            # the science row says: industrial
    assert read_daily(spark, sink.daily_path).count() == 0 and sink.enriched(spark).count() == 0 and sink.deduplicated(spark).count() == 1


def test_retry_after_a_stop_between_partitions(spark):
    """The first try lost a day's partition: the retry restores it from staging."""
    from hazardpanel import fixtures as fx
    from hazardpanel.plans.refresh import drop_partitions, partition_days
    from tests.conftest import SF_SMALL
    det = fx.detections(spark, SF_SMALL)
    sink = _writer(spark, "test-stop")
    sink(det.filter("event_id < 500"), 0)
    sink(det.filter("event_id >= 400"), 1)
    whole = _snapshot(spark, sink)
    days = partition_days(spark, sink.placed_path, "acq_date")
    drop_partitions(spark, sink.placed_path, "acq_date", days[-2:])
    drop_partitions(spark, sink.daily_path, "acq_date", days[-1:])
    sink(det.filter("event_id >= 400"), 1)
    assert _snapshot(spark, sink) == whole


def test_stream_maintains_current_panel(spark):
    from hazardpanel import fixtures as fx
    from hazardpanel import landing
    from hazardpanel.operators.persistence import recurring_spot_table
    from hazardpanel.plans.refresh import current_panel, lookback_daily
    from hazardpanel.streaming.detections import detection_stream
    from tests.conftest import SF_SMALL

    dim, edges = fx.region_dim(spark, SF_SMALL), fx.edges(spark, SF_SMALL)
    det = fx.detections(spark, SF_SMALL)
    spots = recurring_spot_table(det)
    weather = fx.weather(spark, SF_SMALL)
    root = scratch_path(spark, "test-stream-panel")
    writers, schema = landing.stream_feed_writers(spark, SF_SMALL, f"{root}/landing")
    sink = _writer(spark, "test-stream-panel-sinks", spots, weather)
    for land in writers:
        land()
        run_available_now(detection_stream(spark, f"{root}/landing", schema, fx.detections_from_events), sink,
                          f"{root}/checkpoint")
    got = spark.read.parquet(sink.panel_path)
    want = current_panel(weather, lookback_daily(det, edges, dim, spots), dim)
    cols = sorted(want.columns)
    assert len(cols) == 26
    assert sorted(map(str, got.select(*cols).collect())) == sorted(map(str, want.select(*cols).collect()))


def test_day_windows_ignore_session_time_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        root = scratch_path(spark, "test-tz")
        sink = DayUpsert(f"{root}/daily", "day")
        rows = [(1, dt.datetime(2024, 1, 5, 0, 30)), (2, dt.datetime(2024, 1, 5, 23, 30)),
                (3, dt.datetime(2024, 1, 6, 1, 0))]
        spark.createDataFrame([(i, t, 1, "view", 1.0, None) for i, t in rows], SCHEMA) \
            .write.parquet(f"{root}/landing")
        stream = daily_event_counts_stream(spark, f"{root}/landing", _events(spark, []).schema)
        run_available_now(stream, sink, f"{root}/checkpoint", output_mode="update")
        got = sorted((r.day.isoformat(), r.n_events) for r in spark.read.parquet(sink.path).collect())
        assert got == [("2024-01-05", 2), ("2024-01-06", 1)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_first_batch_with_nothing_enriched(spark):
    from hazardpanel import fixtures as fx
    from tests.conftest import SF_SMALL

    det = fx.detections(spark, SF_SMALL).filter("pri = 0")
    sink = _writer(spark, "test-empty-enriched")
    sink(det.filter("false"), 0)                         # nothing at all
    sink(det.filter("type = 2"), 1)                      # industrial only: nothing survives the type filter
    sink(det.filter("type = 0").limit(50), 2)
    assert spark.read.parquet(sink.daily_path).count() > 0


def test_batch_is_evaluated_once_and_days_get_few_files(spark):
    """Of a stream, a batch holds the stateful operators: each evaluation reads and
    commits their state again."""
    from pyspark.sql import functions as F

    from hazardpanel import fixtures as fx
    from tests.conftest import SF_SMALL

    seen = spark.sparkContext.accumulator(0)

    @F.udf("date")
    def counted(day):
        seen.add(1)
        return day
    det = fx.detections(spark, SF_SMALL)
    sink = _writer(spark, "test-once")
    sink(det, 0)
    some = det.filter("event_id < 300")
    sink(some.withColumn("acq_date", counted.asNondeterministic()("acq_date")), 1)
    assert seen.value == some.count()
    stored = spark.read.parquet(sink.placed_path)
    days, cores = stored.select("acq_date").distinct().count(), spark.sparkContext.defaultParallelism
    assert len(stored.inputFiles()) <= 4 * max(cores, days)          # before: up to cores x days
