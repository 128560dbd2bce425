"""Registered streaming queries: near-real-time rows arrive before the science
rows they give way to, some rows a second time; ``availableNow`` runs of one
checkpointed query process what has landed."""

from __future__ import annotations

from pyspark.sql import functions as F

from hazardpanel import fixtures as fx
from hazardpanel import landing
from hazardpanel.oracle import VIEWS, rd, sql
from hazardpanel.queries import DET_COLS, register
from hazardpanel.queries_io import _stored_spots
from hazardpanel.session import scratch_path
from hazardpanel.streaming.detections import (DayUpsert, DetectionBatchWriter, daily_event_counts_stream,
                                              detection_stream, run_available_now)
from hazardpanel.streaming.keyed import DeltaWriter, run_changes, winner_changes

VIEWS["stream_enriched"] = (f"""
SELECT d.*, a.wilaya_id, {rd('d.latitude')} AS lat_grid, {rd('d.longitude')} AS lon_grid
FROM ded d JOIN pt_assigned a ON a.latitude = d.latitude AND a.longitude = d.longitude
WHERE (d.type = 0 OR d.type IS NULL)
  AND NOT EXISTS (SELECT 1 FROM spots_static s WHERE s.lat_grid = {rd('d.latitude')}
                                                AND s.lon_grid = {rd('d.longitude')})""",
                            ["ded", "pt_assigned", "spots_static"])


_SINKS: dict[tuple, DetectionBatchWriter | DeltaWriter] = {}


def _run_detection_stream(spark, sf):
    """The stream over all landed slices; three queries read its sinks, so it runs
    once per application and input."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _SINKS:
        root = scratch_path(spark, "stream")
        writers, schema = landing.stream_feed_writers(spark, sf, f"{root}/landing")
        sink = DetectionBatchWriter(f"{root}/sinks", fx.edges(spark, sf), fx.region_dim(spark, sf),
                                    _stored_spots(spark, sf))
        for land in writers:
            land()
            stream = detection_stream(spark, f"{root}/landing", schema, fx.detections_from_events)
            run_available_now(stream, sink, f"{root}/checkpoint")
        _SINKS[key] = sink
    return _SINKS[key]


def _run_keyed_stream(spark, sf):
    """The same slices through registers in the state store and signed deltas; two
    queries read its tables."""
    key = (spark.sparkContext.applicationId, sf, "keyed")
    if key not in _SINKS:
        root = scratch_path(spark, "stream-keyed")
        writers, schema = landing.stream_feed_writers(spark, sf, f"{root}/landing")
        sink = DeltaWriter(f"{root}/sinks", fx.edges(spark, sf), fx.region_dim(spark, sf), _stored_spots(spark, sf))
        # a first run and a restart, two landed slices per micro-batch at most: the
        # watermark of a batch drops what later batches bring too late
        for some in (writers[:3], writers[3:]):
            for land in some:
                land()
            raw = spark.readStream.schema(schema).option("maxFilesPerTrigger", 2 * landing.slice_files(spark)).parquet(f"{root}/landing")
            run_changes(winner_changes(fx.detections_from_events(raw), buckets=4), sink, f"{root}/checkpoint")
        _SINKS[key] = sink
    return _SINKS[key]


@register("stream_dedup", sql(f"SELECT {DET_COLS} FROM ded", "ded"))
def q_stream_dedup(spark, sf):
    sink = _run_detection_stream(spark, sf)
    return sink.deduplicated(spark).select(*DET_COLS.split(", "))


@register("stream_enrich", sql(f"SELECT {DET_COLS}, wilaya_id, lat_grid, lon_grid FROM stream_enriched",
                               "stream_enriched"))
def q_stream_enrich(spark, sf):
    sink = _run_detection_stream(spark, sf)
    return sink.enriched(spark).select(*DET_COLS.split(", "), "wilaya_id", "lat_grid", "lon_grid")


@register("stream_daily_agg", sql("""
SELECT k.wilaya_id, r.wilaya_code, k.acq_date AS date, count(k.frp) AS nb_detections,
       coalesce(round(sum(k.frp), 6), 0e0) AS frp_total, max(k.frp) AS frp_max, 1 AS fire_detected
FROM stream_enriched k LEFT JOIN region_dim r ON r.wilaya_id = k.wilaya_id
GROUP BY k.wilaya_id, r.wilaya_code, k.acq_date""", "stream_enriched", "region_dim"))
def q_stream_daily_agg(spark, sf):
    return _run_keyed_stream(spark, sf).daily(spark)


@register("stream_dedup_state", sql(f"SELECT {DET_COLS} FROM ded", "ded"))
def q_stream_dedup_state(spark, sf):
    return _run_keyed_stream(spark, sf).deduplicated(spark).select(*DET_COLS.split(", "))


# copies that arrive with the last slice count only inside the 14 days before what came earlier
@register("stream_late_data", f"""
WITH b AS (SELECT min(event_id) AS lo, max(event_id) - min(event_id) + 1 AS span FROM events),
earlier AS (SELECT max(ts) AS hi FROM events, b WHERE event_id < lo + (3 * span + 3) // 4),
seen AS (SELECT ts FROM events
         UNION ALL
         SELECT ts FROM events, earlier WHERE event_id % {landing.LATE_EVERY} = 0 AND ts > hi - INTERVAL 14 DAY)
SELECT CAST(ts AS DATE) AS day, count(*) AS n_events FROM seen GROUP BY 1""")
def q_stream_late_data(spark, sf):
    root = scratch_path(spark, "stream-late")
    writers, schema = landing.stream_late_writers(spark, sf, f"{root}/landing")
    sink = DayUpsert(f"{root}/daily", "day")
    for land in writers:
        land()
        counts = daily_event_counts_stream(spark, f"{root}/landing", schema)
        run_available_now(counts, sink, f"{root}/checkpoint", output_mode="update")
    return spark.read.parquet(sink.path).select("day", "n_events")
