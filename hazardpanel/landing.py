"""Land the fixture inputs as files, the way the feeds arrive.

Each function writes Spark-derived stand-ins below the shared checkpoint
root (``scratch_path``) and returns where they are: tagged CSV feeds (the
near-real-time ones without ``type``), raw response bodies (including
rejected error/empty bodies), JSON payload bodies, GeoJSON features.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazardpanel import fixtures as fx
from hazardpanel.operators.joins import dimension
from hazardpanel.session import scratch_path
from hazardpanel.sources.geojson import edges_to_features, write_features

FEED_COLUMNS = ["event_id", "pri", "latitude", "longitude", "acq_date", "acq_time", "satellite", "type", "frp"]
PAYLOAD_BLOCK = 512          # events per payload object (bounded request size)
PAYLOAD_BATCH = 12           # regions per request


def feed_name(sat_col="satellite", pri_col="pri"):
    return F.concat(F.lower(F.col(sat_col)), F.lit("_"),
                    F.when(F.col(pri_col) == 0, F.lit("sp")).otherwise(F.lit("nrt")))


def land_detection_feeds(spark: SparkSession, sf: str) -> tuple[str, list[tuple[str, dict]]]:
    """CSV feeds per (satellite, quality); NRT feeds are written without ``type``."""
    root = scratch_path(spark, "feeds")
    det = fx.detections(spark, sf).withColumn("feed", feed_name())
    # as other tools write them: whole measurements without a point, types of a column with gaps as 2.0
    det = det.withColumn("frp", F.regexp_replace(F.col("frp").cast("string"), "[.]0$", "")) \
             .withColumn("type", F.col("type").cast("double").cast("string"))
    sp = det.filter(F.col("pri") == 0).select(*FEED_COLUMNS, "feed")
    nrt = det.filter(F.col("pri") == 1).select(*[c for c in FEED_COLUMNS if c != "type"], "feed")
    sp.write.mode("overwrite").option("header", True).partitionBy("feed").csv(f"{root}/sp")
    nrt.write.mode("overwrite").option("header", True).partitionBy("feed").csv(f"{root}/nrt")
    sources = []
    for sat in ("N", "N20", "N21"):
        for q, sub in (("SP", "sp"), ("NRT", "nrt")):
            name = f"{sat.lower()}_{sub}"
            sources.append((f"{root}/{sub}/feed={name}", {"data_quality": q, "source_satellite": sat}))
    sources.append((f"{root}/sp/feed=absent_sp", {"data_quality": "SP", "source_satellite": "absent"}))
    return root, sources


def land_bodies(spark: SparkSession, sf: str, step_days: int = 5) -> str:
    """Response bodies per (feed, 5-day window), plus an error body and an
    empty (header-only) body per feed around its date range."""
    root = scratch_path(spark, "bodies")
    det = fx.detections(spark, sf).withColumn("feed", feed_name())
    lo = det.groupBy("feed").agg(F.min("acq_date").alias("lo"), F.max("acq_date").alias("hi"))
    idx = F.floor(F.datediff("acq_date", "lo") / F.lit(step_days))
    bodies = det.join(dimension(lo), "feed").withColumn(
        "window", F.date_format(F.date_add("lo", (idx * step_days).cast("int")), "yyyy-MM-dd"))
    # a column of remarks, quoted because of its commas
    (bodies.select(*FEED_COLUMNS, F.lit("placed, checked").alias("remark"), F.col("feed").alias("source"), "window")
           .write.mode("overwrite").option("header", True).partitionBy("source", "window").csv(root))
    header = ",".join(FEED_COLUMNS)
    junk = lo.select(F.col("feed").alias("source"), F.explode(F.array(
        F.struct(F.date_format(F.date_sub("lo", step_days), "yyyy-MM-dd").alias("window"),
                 F.lit("Invalid API call.").alias("value")),
        F.struct(F.date_format(F.date_add("hi", step_days), "yyyy-MM-dd").alias("window"),
                 F.lit(header + "\n\n").alias("value")),
        F.struct(F.date_format(F.date_add("hi", 2 * step_days), "yyyy-MM-dd").alias("window"),
                 F.lit(header + "\n1,0,20.5\n").alias("value")))).alias("j")).select("source", "j.*")      # cut off
    junk.select("value", "source", "window").write.mode("append").partitionBy("source", "window").text(root)
    return root


def payload_requests(spark: SparkSession, sf: str) -> DataFrame:
    """Which region each list position of each request batch asks for."""
    regions = fx.table(spark, sf, "nation").select(F.col("n_nationkey").cast("int").alias("wilaya_id"))
    batch = F.least(F.floor(F.col("wilaya_id") / PAYLOAD_BATCH), F.lit(2)).cast("int")
    return regions.select("wilaya_id", batch.alias("batch"),
                          (F.col("wilaya_id") - batch * PAYLOAD_BATCH).cast("int").alias("pos"))


def land_payloads(spark: SparkSession, sf: str) -> tuple[str, DataFrame]:
    """JSON bodies: per (batch, block of event ids), a list of region objects in
    request order (an object alone when the batch has one region)."""
    root = scratch_path(spark, "payloads")
    req = payload_requests(spark, sf)
    ev = fx.table(spark, sf, "events").select(
        "event_id", (F.col("user_id") % 25).cast("int").alias("wilaya_id"),
        F.date_format(F.to_date("ts"), "yyyy-MM-dd").alias("time"), "value",
        F.floor(F.col("event_id") / PAYLOAD_BLOCK).alias("block"))
    arrays = ev.groupBy("wilaya_id", "block").agg(
        F.sort_array(F.collect_list(F.struct("event_id", "time", "value"))).alias("items"))
    blocks = ev.select("block").distinct()
    bounds = blocks.agg(F.min("block"), F.max("block")).first()
    grid = req.withColumn("block", F.explode(F.sequence(F.lit(bounds[0]), F.lit(bounds[1])))).join(blocks, "block", "left_semi")
    filled = grid.join(arrays, ["wilaya_id", "block"], "left")
    items = F.coalesce(F.col("items"), F.array().cast("array<struct<event_id:bigint,time:string,value:double>>"))
    obj = F.struct(F.struct(F.transform(items, lambda i: i["time"]).alias("time"),
                            F.transform(items, lambda i: i["event_id"]).alias("event_id"),
                            F.transform(items, lambda i: i["value"]).alias("value")).alias("daily"))
    per_req = filled.groupBy("batch", "block").agg(
        F.sort_array(F.collect_list(F.struct("pos", obj.alias("obj")))).alias("objs"))
    single = F.size("objs") == 1
    body = F.when(single, F.to_json(F.col("objs")[0]["obj"])).otherwise(
        F.to_json(F.transform("objs", lambda o: o["obj"])))
    per_req.select(body.alias("value"), "batch").write.mode("overwrite").partitionBy("batch").text(root)
    # a truncated body and an error answer, which must not pass for empty ones
    junk = req.select("batch").distinct().select(F.explode(F.array(F.lit('[{"daily":{"time":["2024-01-'), F.lit('{"error":true}'))).alias("value"), "batch")
    junk.write.mode("append").partitionBy("batch").text(root)
    return root, req


def land_features(spark: SparkSession, sf: str) -> str:
    root = scratch_path(spark, "features")
    write_features(edges_to_features(fx.edges(spark, sf)), root)
    return root


SLICE_FILES = 4                      # files of a landed slice, at least
EVENT_COLUMNS = ["event_id", "ts", "user_id", "event_type", "value", "props"]
LATE_OFFSET = 1_000_000_000          # ids of copies that arrive late under a new id
LATE_EVERY = 9


def slice_files(spark: SparkSession) -> int:
    """Files of a landed slice: one per core, as few files keep the other cores idle
    when a slice is written and when the stream reads it."""
    return max(SLICE_FILES, spark.sparkContext.defaultParallelism)


def _id_slices(ev: DataFrame, n_slices: int) -> list[int]:
    lo, hi = ev.agg(F.min("event_id"), F.max("event_id")).first()
    span = hi - lo + 1
    return [lo + (k * span + n_slices - 1) // n_slices for k in range(n_slices)] + [hi + 1]


def stream_feed_writers(spark: SparkSession, sf: str, root: str, n_slices: int = 4, resend: int = 250):
    """Writers landing events as two feeds arrive: near-real-time copies (priority
    1) of a slice of ids first, the science rows (priority 0) of that slice with
    the next one, and some science rows a second time with the one after."""
    ev = fx.table(spark, sf, "events").select(*EVENT_COLUMNS)
    start = _id_slices(ev, n_slices)
    between = lambda a, b: (F.col("event_id") >= a) & (F.col("event_id") < b)

    def writer(k):
        def land():
            parts = []
            if k < n_slices:
                parts.append(ev.filter(between(start[k], start[k + 1]) & fx.has_copy()).withColumn("pri", F.lit(1)))
            if 1 <= k <= n_slices:
                parts.append(ev.filter(between(start[k - 1], start[k])).withColumn("pri", F.lit(0)))
            if 2 <= k <= n_slices:
                parts.append(ev.filter(between(start[k - 1] - resend, start[k - 1])).withColumn("pri", F.lit(0)))
            out = parts[0]
            for p in parts[1:]:
                out = out.unionByName(p)
            out.repartition(slice_files(spark), "event_id").write.mode("append").parquet(root)
        return land
    return [writer(k) for k in range(n_slices + 1)], ev.withColumn("pri", F.lit(0)).schema


def stream_late_writers(spark: SparkSession, sf: str, root: str, n_slices: int = 4, resend: int = 250):
    """Writers landing ``events`` in id slices; each re-sends the ids just before
    it, and the last one brings copies of every ``LATE_EVERY``-th event of the
    whole period under a new id: some inside the look-back, some beyond it."""
    ev = fx.table(spark, sf, "events").select(*EVENT_COLUMNS)
    start = _id_slices(ev, n_slices)

    def writer(k):
        def land():
            part = ev.filter((F.col("event_id") >= start[k] - (resend if k else 0)) & (F.col("event_id") < start[k + 1]))
            if k == n_slices - 1:
                late = ev.filter(F.col("event_id") % LATE_EVERY == 0).withColumn("event_id", F.col("event_id") + LATE_OFFSET)
                part = part.unionByName(late)
            part.write.mode("append").parquet(root)
        return land
    return [writer(k) for k in range(n_slices)], ev.schema
