"""Registered queries: sources, sinks, geometry, stored spots and refresh."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from hazardpanel import fixtures as fx
from hazardpanel import landing
from hazardpanel.operators.panel import dense_grid
from hazardpanel.operators.persistence import drop_recurring, recurring_spot_table
from hazardpanel.operators.spatial import polygon_measures
from hazardpanel.oracle import VIEWS, panel_sql, rd, sql
from hazardpanel.plans.rebuild import detection_chain
from hazardpanel.plans.refresh import current_panel, next_period_start
from hazardpanel.queries import DET_COLS, register
from hazardpanel.queries_more import FIX_FROZEN_END
from hazardpanel.schemas import FEED_SCHEMA, MULTI_POLYGON_RINGS, POLYGON_RINGS, RECURRING_SPOTS
from hazardpanel.session import scratch_path
from hazardpanel.sources import detections as src
from hazardpanel.sources import sinks
from hazardpanel.sources.geojson import edges_to_features, read_edges, write_features
from hazardpanel.sources.payload import coverage, payload_to_rows, read_payloads

TAGGED = DET_COLS + ", data_quality, source_satellite"

WEATHER_SCHEMA = T.StructType([
    T.StructField("wilaya_id", T.IntegerType()), T.StructField("date", T.DateType()),
    T.StructField("precipitation", T.DoubleType()), T.StructField("temp_max", T.DoubleType()),
    T.StructField("et0", T.DoubleType()),
])

# extra oracle views for the refresh chain (assignment per distinct point)
VIEWS["pt_assigned"] = ("""
SELECT latitude, longitude, arg_min(wilaya_id, pos) AS wilaya_id FROM (
  SELECT d.latitude, d.longitude, e.wilaya_id, e.pos
  FROM (SELECT DISTINCT latitude, longitude FROM detections) d JOIN edges e ON {c} OR {o}
  GROUP BY d.latitude, d.longitude, e.wilaya_id, e.pos
  HAVING sum(CASE WHEN {c} THEN 1 ELSE 0 END) % 2 = 1 AND sum(CASE WHEN {o} THEN 1 ELSE 0 END) = 0) t
GROUP BY latitude, longitude""".format(
    c="((e.y1 > d.latitude) <> (e.y2 > d.latitude) AND d.longitude < (e.x2-e.x1)*(d.latitude-e.y1)/(e.y2-e.y1)+e.x1)",
    o="((e.x2-e.x1)*(d.latitude-e.y1) - (e.y2-e.y1)*(d.longitude-e.x1) = 0 AND d.longitude BETWEEN least(e.x1,e.x2) "
      "AND greatest(e.x1,e.x2) AND d.latitude BETWEEN least(e.y1,e.y2) AND greatest(e.y1,e.y2))"),
    ["detections", "edges"])
VIEWS["spots_static"] = (f"""
SELECT {rd('latitude')} AS lat_grid, {rd('longitude')} AS lon_grid, count(DISTINCT acq_date) AS n_days_detected
FROM detections WHERE type = 0 OR type IS NULL GROUP BY 1, 2 HAVING count(DISTINCT acq_date) > 15""",
                         ["detections"])
VIEWS["params"] = ("""
SELECT as_of, as_of - 14 AS lookback_start,
       (SELECT max(date) FROM panel WHERE date < p.as_of - 20) + 1 AS period_start
FROM (SELECT max(acq_date) + 1 AS as_of FROM detections) p""", ["detections", "panel"])


def _refresh_daily_sql(where: str, order: str) -> str:
    return f"""
SELECT k.wilaya_id, r.wilaya_code, k.acq_date AS date, count(k.frp) AS nb_detections,
       coalesce(round(sum(k.frp), 6), 0e0) AS frp_total, max(k.frp) AS frp_max, 1 AS fire_detected
FROM (SELECT d.*, a.wilaya_id FROM (
        SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY latitude, longitude, acq_date, acq_time, satellite
                                                    ORDER BY {order}) AS rn
                       FROM detections, params WHERE {where}) x WHERE rn = 1) d
      JOIN pt_assigned a ON a.latitude = d.latitude AND a.longitude = d.longitude
      WHERE (d.type = 0 OR d.type IS NULL)
        AND NOT EXISTS (SELECT 1 FROM spots_static s
                        WHERE s.lat_grid = {rd('d.latitude')} AND s.lon_grid = {rd('d.longitude')})) k
LEFT JOIN region_dim r ON r.wilaya_id = k.wilaya_id
GROUP BY k.wilaya_id, r.wilaya_code, k.acq_date"""


VIEWS["stored_daily"] = (_refresh_daily_sql("pri = 1", "event_id"),
                         ["detections", "params", "pt_assigned", "spots_static", "region_dim"])
VIEWS["new_daily"] = (_refresh_daily_sql("acq_date >= lookback_start", "pri, event_id"),
                      ["detections", "params", "pt_assigned", "spots_static", "region_dim"])
VIEWS["replaced"] = ("""
SELECT * FROM (
  SELECT * FROM stored_daily WHERE date < (SELECT min(date) FROM new_daily)
  UNION ALL SELECT * FROM new_daily) u
WHERE date >= (SELECT period_start FROM params)""", ["stored_daily", "new_daily", "params"])


# ---------------------------------------------------------------- sources
@register("scan_tagged", sql(f"""
SELECT {DET_COLS}, CASE WHEN pri = 0 THEN 'SP' ELSE 'NRT' END AS data_quality, satellite AS source_satellite
FROM detections""", "detections"))
def q_scan_tagged(spark, sf):
    _, sources = landing.land_detection_feeds(spark, sf)
    df = src.read_detections(spark, sources, FEED_SCHEMA)
    return df.select(*TAGGED.split(", "))


@register("union_missing_col", sql("SELECT event_id, pri, type FROM detections", "detections"))
def q_union_missing_col(spark, sf):
    _, sources = landing.land_detection_feeds(spark, sf)
    # science feeds carry `type`, near-real-time feeds do not: read by their own headers, united by name
    return src.read_detections(spark, sources, FEED_SCHEMA).select("event_id", "pri", "type")


@register("project_common", sql("SELECT latitude, longitude, acq_date, type FROM detections", "detections"))
def q_project_common(spark, sf):
    path = scratch_path(spark, "detections-parquet")
    fx.detections(spark, sf).write.mode("overwrite").parquet(path)
    # only the four needed columns reach the scan (ReadSchema pruning)
    return spark.read.parquet(path).select("latitude", "longitude", "acq_date", "type")


@register("scan_glob", sql("""
SELECT lower(satellite) || '_' || CASE WHEN pri = 0 THEN 'sp' ELSE 'nrt' END AS source, event_id, pri, type, frp
FROM detections""", "detections"))
def q_scan_glob(spark, sf):
    root, _ = landing.land_detection_feeds(spark, sf)
    df = src.scan_glob(spark, f"{root}/*/feed=*", FEED_SCHEMA, source_regex=r"feed=([^/]+)/")
    return df.select("source", "event_id", "pri", "type", "frp")


@register("reject_bodies", sql(f"SELECT {DET_COLS} FROM detections", "detections"))
def q_reject_bodies(spark, sf):
    root = landing.land_bodies(spark, sf)
    bodies = src.read_bodies(spark, f"{root}/source=*/window=*/*")
    return src.parse_bodies(bodies, FEED_SCHEMA).select(*DET_COLS.split(", "))


@register("payload_to_rows", """
SELECT CAST(user_id % 25 AS INTEGER) AS wilaya_id, event_id, CAST(ts AS DATE) AS date, value FROM events""")
def q_payload_to_rows(spark, sf):
    root, req = landing.land_payloads(spark, sf)
    element = T.StructType([T.StructField("daily", T.StructType([
        T.StructField("time", T.ArrayType(T.StringType())),
        T.StructField("event_id", T.ArrayType(T.LongType())),
        T.StructField("value", T.ArrayType(T.DoubleType()))]))])
    rows = payload_to_rows(read_payloads(spark, root), req, element, ["event_id", "value"], skip_unreadable=True)
    return rows.select("wilaya_id", "event_id", F.to_date("time").alias("date"), "value")


@register("coverage_regions", sql("""
SELECT CAST(year(date) AS INTEGER) AS year, count(DISTINCT wilaya_id) AS n_covered,
       (SELECT count(*) FROM region) AS n_total
FROM weather_panel WHERE temp_max IS NOT NULL GROUP BY 1""", "weather_panel"))
def q_coverage_regions(spark, sf):
    path = scratch_path(spark, "weather-by-region")
    landed = fx.weather_panel(spark, sf).filter(F.col("temp_max").isNotNull())
    landed.write.mode("overwrite").partitionBy("wilaya_id").parquet(path)
    back = spark.read.parquet(path).withColumn("year", F.year("date"))
    return coverage(back, fx.table(spark, sf, "region").select(F.col("r_regionkey").alias("wilaya_id")),
                    "wilaya_id", ["year"])


@register("edges_from_polygons", sql("SELECT * FROM edges", "edges"))
def q_edges_from_polygons(spark, sf):
    root = landing.land_features(spark, sf)
    return read_edges(spark, root, collection=False)


@register("features_json", sql("""
SELECT e.wilaya_id, e.pos, CASE WHEN max(part) > 0 THEN 'MultiPolygon' ELSE 'Polygon' END AS kind,
       CAST(max(part) + 1 AS INTEGER) AS n_parts, CAST(count(DISTINCT part * 10 + ring) AS INTEGER) AS n_rings,
       CAST(count(*) + count(DISTINCT part * 10 + ring) AS INTEGER) AS n_vertices, min(x1) AS west, max(y1) AS north,
       any_value(r.wilaya_code) AS wilaya_code, any_value(r.wilaya_name) AS wilaya_name
FROM edges e JOIN region_dim r ON r.wilaya_id = e.wilaya_id GROUP BY e.wilaya_id, e.pos""", "edges", "region_dim"))
def q_features_json(spark, sf):
    """Features written as text, parsed back by their declared type and measured."""
    props = fx.region_dim(spark, sf).select("wilaya_id", "wilaya_code", "wilaya_name")
    root = write_features(edges_to_features(fx.edges(spark, sf), props=props), scratch_path(spark, "features"))
    text = spark.read.text(root)
    kind = F.get_json_object("value", "$.geometry.type")
    coords = F.get_json_object("value", "$.geometry.coordinates")
    parts = F.when(kind == "MultiPolygon", F.from_json(coords, MULTI_POLYGON_RINGS)).otherwise(F.array(F.from_json(coords, POLYGON_RINGS)))
    # the id must be a number in the text: a quoted one does not parse as this schema
    prop = F.from_json(F.get_json_object("value", "$.properties"), "wilaya_id long, wilaya_code string, wilaya_name string", {"mode": "FAILFAST"})
    vertices = F.flatten(F.flatten("parts"))
    return text.select(kind.alias("kind"), parts.alias("parts"), prop.alias("p")).select(
        "p.wilaya_id", F.col("p.wilaya_id").alias("pos"), "kind", F.size("parts").alias("n_parts"), F.size(F.flatten("parts")).alias("n_rings"),
        F.size(vertices).alias("n_vertices"), F.array_min(F.transform(vertices, lambda v: v[0])).alias("west"),
        F.array_max(F.transform(vertices, lambda v: v[1])).alias("north"), "p.wilaya_code", "p.wilaya_name")


# ---------------------------------------------------------------- sinks
@register("sink_roundtrip_csv", sql("SELECT * FROM weather_panel", "weather_panel"))
def q_sink_roundtrip_csv(spark, sf):
    path = sinks.write_csv(fx.weather_panel(spark, sf), scratch_path(spark, "weather-csv"))
    return sinks.read_csv(spark, path, WEATHER_SCHEMA)


@register("sink_roundtrip_parquet", sql("SELECT * FROM weather_panel", "weather_panel"))
def q_sink_roundtrip_parquet(spark, sf):
    path = sinks.write_parquet_by_year(fx.weather_panel(spark, sf), scratch_path(spark, "weather-parquet"))
    return sinks.read_parquet_table(spark, path)


@register("union_frozen_current", sql("SELECT * FROM weather_panel", "weather_panel"))
def q_union_frozen_current(spark, sf):
    wp = fx.weather_panel(spark, sf)
    cut = F.to_date(F.lit(FIX_FROZEN_END))
    frozen = sinks.write_parquet_by_year(wp.filter(F.col("date") < cut), scratch_path(spark, "frozen"))
    current = sinks.write_parquet_by_year(wp.filter(F.col("date") >= cut), scratch_path(spark, "current"))
    return sinks.union_frozen_current(sinks.read_parquet_table(spark, frozen),
                                      sinks.read_parquet_table(spark, current))


@register("panel_left_join_bucketed", sql("""
SELECT g.wilaya_id, g.date, d.nb_detections, d.frp_total, d.frp_max, d.fire_detected
FROM event_grid g LEFT JOIN daily d ON d.wilaya_id = g.wilaya_id AND d.date = g.date""",
    "event_grid", "daily"))
def q_panel_left_join_bucketed(spark, sf):
    """The dense grid and the daily table stored alike, then joined without a shuffle."""
    det, edges, dim = fx.detections(spark, sf), fx.edges(spark, sf), fx.region_dim(spark, sf)
    keys, buckets = ["wilaya_id", "date"], int(spark.conf.get("spark.sql.shuffle.partitions"))
    stored = {"grid": dense_grid(dim, "wilaya_id", det.select(F.col("acq_date").alias("date"))),
              "daily": detection_chain(det, edges, dim).daily.drop("wilaya_code")}
    for name, df in stored.items():
        path = scratch_path(spark, f"bucketed-{name}")
        stored[name] = sinks.write_bucketed(df, path.rpartition("/")[2].replace("-", "_"), path, keys, buckets)
    return sinks.join_bucketed(stored["grid"], stored["daily"], keys).select(
        "wilaya_id", "date", "nb_detections", "frp_total", "frp_max", "fire_detected")


# ---------------------------------------------------------------- geometry
@register("polygon_area", sql("SELECT wilaya_id, area_km2 FROM measures", "measures"))
def q_polygon_area(spark, sf):
    return polygon_measures(fx.edges(spark, sf)).select("wilaya_id", "area_km2")


@register("polygon_centroid", sql("SELECT wilaya_id, centroid_lat, centroid_lon FROM measures", "measures"))
def q_polygon_centroid(spark, sf):
    return polygon_measures(fx.edges(spark, sf)).select("wilaya_id", "centroid_lat", "centroid_lon")


# ---------------------------------------------------------------- stored spot list
def _stored_spots(spark, sf):
    """Spot list computed from all raw rows and stored, then read back."""
    path = scratch_path(spark, "recurring-spots")
    recurring_spot_table(fx.detections(spark, sf)).write.mode("overwrite").parquet(path)
    return spark.read.schema(RECURRING_SPOTS).parquet(path)


@register("recurring_spot_table", sql("SELECT * FROM spots_static", "spots_static"))
def q_recurring_spot_table(spark, sf):
    from hazardpanel.plans.rebuild import refresh_spot_list
    root, _ = landing.land_detection_feeds(spark, sf)
    return refresh_spot_list(spark, f"{root}/*/feed=*", scratch_path(spark, "spot-list"), schema=FEED_SCHEMA)


@register("spot_list_incremental", sql("""
SELECT s.step, lat_grid, lon_grid, count(DISTINCT acq_date) AS n_days_detected
FROM (SELECT *, """ + rd("latitude") + """ AS lat_grid, """ + rd("longitude") + """ AS lon_grid,
             2 * CASE satellite WHEN 'N' THEN 0 WHEN 'N20' THEN 1 ELSE 2 END + pri + 1 AS place FROM detections) d
JOIN (SELECT CAST(unnest(range(1, 7)) AS INTEGER) AS step) s ON d.place <= s.step
WHERE type = 0 OR type IS NULL
GROUP BY s.step, lat_grid, lon_grid HAVING count(DISTINCT acq_date) > 15""", "detections"))
def q_spot_list_incremental(spark, sf):
    """The list after each of the feeds, every feed read once."""
    from hazardpanel.plans.spots import read_spot_list, update_spot_list
    root, sources = landing.land_detection_feeds(spark, sf)
    store, after = scratch_path(spark, "spot-store"), []
    for step, (feed, _) in enumerate(sources[:6], 1):
        raw = src.scan_glob(spark, feed, FEED_SCHEMA, source_regex=r"feed=([^/]+)/")
        version = update_spot_list(spark, store, feed.rpartition("=")[2], raw)
        after.append(read_spot_list(spark, store, version).withColumn("step", F.lit(step)))
    out = after[0]
    for df in after[1:]:
        out = out.unionByName(df)
    return out


@register("spot_anti_join_static", sql(f"""
SELECT {DET_COLS}, wilaya_id, lat_grid, lon_grid FROM matched m
WHERE NOT EXISTS (SELECT 1 FROM spots_static s WHERE s.lat_grid = m.lat_grid AND s.lon_grid = m.lon_grid)""",
    "matched", "spots_static"))
def q_spot_anti_join_static(spark, sf):
    ch = detection_chain(fx.detections(spark, sf), fx.edges(spark, sf), fx.region_dim(spark, sf))
    return drop_recurring(ch.matched, _stored_spots(spark, sf)).select(
        *DET_COLS.split(", "), "wilaya_id", "lat_grid", "lon_grid")


# ---------------------------------------------------------------- refresh
def _refresh_inputs(spark, sf):
    det = fx.detections(spark, sf)
    edges = fx.edges(spark, sf)
    dim = fx.region_dim(spark, sf)
    as_of = det.agg(F.date_add(F.max("acq_date"), 1)).first()[0]
    return det, edges, dim, as_of


def _replaced(spark, sf):
    from hazardpanel.plans.refresh import daily_refresh, lookback_daily
    det, edges, dim, as_of = _refresh_inputs(spark, sf)
    # the frozen history: panel rows (region x day) before the cut
    weather = fx.weather(spark, sf)
    frozen = weather.filter(F.col("date") < F.lit(as_of - dt.timedelta(days=20)))
    spots = _stored_spots(spark, sf)
    # the stored current-year table of an earlier run: near-real-time copies only
    stored = lookback_daily(det.filter(F.col("pri") == 1), edges, dim, spots, ["event_id"])
    lookback = det.filter(F.col("acq_date") >= F.lit(as_of - dt.timedelta(days=14)))
    return daily_refresh(frozen, stored, lookback, weather, edges, dim, spots)


@register("window_replace", sql("SELECT * FROM replaced", "replaced"))
def q_window_replace(spark, sf):
    return _replaced(spark, sf).daily


@register("window_replace_atomic", sql("SELECT * FROM replaced", "replaced"))
def q_window_replace_atomic(spark, sf):
    """The same on a stored table: staged days and one commit."""
    from hazardpanel.plans.refresh import commit_window_replace, lookback_daily
    from hazardpanel.sources import committed
    det, edges, dim, as_of = _refresh_inputs(spark, sf)
    frozen = fx.weather(spark, sf).filter(F.col("date") < F.lit(as_of - dt.timedelta(days=20)))
    spots, path = _stored_spots(spark, sf), scratch_path(spark, "committed-daily")
    commit_window_replace(spark, path, lookback_daily(det.filter(F.col("pri") == 1), edges, dim, spots, ["event_id"]))
    new = lookback_daily(det.filter(F.col("acq_date") >= F.lit(as_of - dt.timedelta(days=14))), edges, dim, spots)
    commit_window_replace(spark, path, new, period_start=next_period_start(frozen).first()[0])
    return committed.read(spark, path)


@register("daily_refresh", sql(panel_sql("replaced", "true", "WHERE w.date >= (SELECT period_start FROM params)"),
                               "weather", "replaced", "region_dim", "params"))
def q_daily_refresh(spark, sf):
    return _replaced(spark, sf).panel


@register("current_panel", sql("""
SELECT * FROM panel WHERE date >= (SELECT period_start FROM params)""", "panel", "params"))
def q_current_panel(spark, sf):
    det, edges, dim, as_of = _refresh_inputs(spark, sf)
    weather = fx.weather(spark, sf)
    frozen = weather.filter(F.col("date") < F.lit(as_of - dt.timedelta(days=20)))
    period_start = next_period_start(frozen).first()[0]
    ch = detection_chain(det, edges, dim)
    return current_panel(weather.filter(F.col("date") >= F.lit(period_start)), ch.daily, dim)
