"""Stand-in inputs derived from the driver tables.

The real inputs (satellite CSV feeds, weather payloads, region polygons)
are not available, so each view below derives a deterministic stand-in
from the TPC-H-like tables with Spark.  Every view grows with its source
table.  The DuckDB twins of these views live in ``hazardpanel.oracle``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazardpanel.constants import STATIC_FEATURES, WEATHER_VARS
from hazardpanel.functions.scalar import zero_pad
from hazardpanel.operators.joins import dimension
from hazardpanel.operators.panel import dense_grid
from hazardpanel.operators.spatial import polygon_measures
from hazardpanel.session import materialize

# --- fixed values of the fixtures (our own choice, not published data) -----
FIXTURE_NON_FOREST = ["NATION_2", "NATION_3", "NATION_7", "NATION_11",
                      "NATION_13", "NATION_17", "NATION_19", "NATION_23"]
BOX_WIDTH_DEG = 4.5
BOX_HEIGHT_DEG = 3.9
# (part, ring, region id modulo 5 or -1 for all, box in fractions of the region's box)
FIXTURE_RINGS = [(0, 0, -1, (0.0, 0.0, 1.0, 1.0)), (0, 1, 1, (0.25, 0.25, 0.5, 0.75)), (1, 0, 2, (0.25, 1.125, 0.75, 1.25))]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def detections_from_events(ev: DataFrame) -> DataFrame:
    """Map event rows (with a ``pri`` column) onto the detection layout."""
    fixed = F.col("user_id") % 5 == 0
    lat = F.when(fixed, (F.lit(2000500) + (F.col("user_id") % 20) * 50000).cast("double") / F.lit(100000)) \
           .otherwise((F.lit(1896000) + (F.col("event_id") * 7919) % 1816000).cast("double") / F.lit(100000))
    lon = F.when(fixed, (F.lit(100500) + (F.col("user_id") % 20) * 30000).cast("double") / F.lit(100000)) \
           .otherwise((F.lit(-868000) + (F.col("event_id") * 104729) % 2067000).cast("double") / F.lit(100000))
    sat = (F.when(F.col("event_type") == "view", "N")
            .when(F.col("event_type") == "click", "N20").otherwise("N21"))
    typ = (F.when(F.col("pri") == 1, F.lit(None))
            .when(F.col("event_type") == "error", 2)
            .when(F.col("event_type") == "signup", 3).otherwise(0)).cast("int")
    return ev.select(
        "event_id", "pri",
        lat.alias("latitude"), lon.alias("longitude"),
        F.to_date("ts").alias("acq_date"),
        (F.hour("ts") * 100 + F.minute("ts")).cast("int").alias("acq_time"),
        sat.alias("satellite"), typ.alias("type"),
        F.col("value").alias("frp"),
    )


def has_copy():
    """Events that the near-real-time feed has, too."""
    return (F.col("event_id") % 7 == 0) | ((F.col("event_type") == "error") & (F.col("event_id") % 3 == 0))


def detections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Point detections: every event once with priority 0 (science feed);
    some again with priority 1 (near-real-time copy without ``type``).
    Users divisible by 5 sit on fixed spots (recurring sources)."""
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    # one scan: each event emits priority 0, and priority 1 as well when it has a copy
    both = ev.withColumn("pri", F.explode(F.when(has_copy(), F.array(F.lit(0), F.lit(1)))
                                           .otherwise(F.array(F.lit(0)))))
    return detections_from_events(both)


def edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One overlapping box per nation, 4 edges each; ``pos`` = region id.  Some
    boxes have a hole, some regions a second part."""
    nat = table(spark, sf_dir, "nation")
    k = F.col("n_nationkey")
    boxes = nat.select(
        k.alias("wilaya_id"),
        (F.lit(-8.7) + (k % 5) * F.lit(4.2)).alias("x0"),
        (F.lit(18.9) + (k - k % 5).cast("double") / F.lit(5) * F.lit(3.7)).alias("y0"),
    )
    rings = F.array(*[F.struct(F.lit(part).alias("part"), F.lit(ring).alias("ring"), F.lit(rest).alias("rest"), *[F.lit(v).alias(n) for n, v in zip(("ax", "ay", "bx", "by"), box)])
                      for part, ring, rest, box in FIXTURE_RINGS])
    boxes = boxes.withColumn("r", F.explode(F.filter(rings, lambda r: (r["rest"] < 0) | (r["rest"] == F.col("wilaya_id") % 5))))
    corners = F.array(*[F.struct(F.lit(i).alias("edge_no"), F.lit(a).alias("dx1"), F.lit(b).alias("dy1"),
                                 F.lit(c).alias("dx2"), F.lit(d).alias("dy2"))
                        for i, (a, b, c, d) in enumerate([(0, 0, 1, 0), (1, 0, 1, 1), (1, 1, 0, 1), (0, 1, 0, 0)])])
    e = boxes.withColumn("c", F.explode(corners))
    return e.select(
        "wilaya_id", F.col("wilaya_id").alias("pos"), F.col("r.part").alias("part"), F.col("r.ring").alias("ring"),
        F.col("c.edge_no").alias("edge_no"),
        *[(F.col(f"{axis}0") + (F.col(f"r.a{axis}") + F.col(f"c.d{axis}{end}") * (F.col(f"r.b{axis}") - F.col(f"r.a{axis}"))) * F.lit(size)).alias(f"{axis}{end}")
          for end in (1, 2) for axis, size in (("x", BOX_WIDTH_DEG), ("y", BOX_HEIGHT_DEG))],
    )


_DIMS: dict[tuple[str, str], DataFrame] = {}


def region_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The region dimension as the jobs have it: a stored table, made once."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _DIMS:
        _DIMS[key] = dimension(_region_dim(spark, sf_dir))
    return _DIMS[key]


def _region_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Region dimension: nation x region, code, forest flag, area, centroid."""
    nat = table(spark, sf_dir, "nation")
    reg = table(spark, sf_dir, "region")
    base = nat.join(reg, nat.n_regionkey == reg.r_regionkey, "inner").select(
        F.col("n_nationkey").alias("wilaya_id"),
        zero_pad(F.col("n_nationkey")).alias("wilaya_code"),
        F.col("n_name").alias("wilaya_name"),
        F.col("r_name").alias("zone_name"),
        (~F.col("n_name").isin(*FIXTURE_NON_FOREST)).alias("is_forest_zone"),
    )
    measures = polygon_measures(edges(spark, sf_dir))
    return base.join(measures, "wilaya_id", "left")


def weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dense weather table: every region on every day from the first to the last
    detection, all 13 variables; days without an event of the region have gaps."""
    ev = table(spark, sf_dir, "events")
    day = F.to_date("ts")
    bounds = ev.agg(F.min(day).alias("lo"), F.max(day).alias("hi")).first()
    calendar = F.sequence(F.lit(bounds["lo"]).cast("date"), F.lit(bounds["hi"]).cast("date"))
    grid = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("wilaya_id"), F.explode(calendar).alias("date"))
    obs = ev.groupBy((F.col("user_id") % 25).alias("wilaya_id"), day.alias("date")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("event_type") == "view").alias("v"), F.max("value").alias("hi"), F.min("value").alias("lo"))
    n, v, hi, lo = (F.col(c) for c in ("n", "v", "hi", "lo"))
    variables = {
        "temperature_2m_max": hi / 10, "temperature_2m_min": lo / 10, "temperature_2m_mean": (hi + lo) / 20,
        "relative_humidity_2m_mean": n * 7 % 101, "wind_speed_10m_max": n * 3 % 40, "wind_gusts_10m_max": n * 5 % 60,
        "wind_direction_10m_dominant": n * 37 % 360, "precipitation_sum": v / 2, "rain_sum": v / 4, "sunshine_duration": n * 600 % 43200,
        "shortwave_radiation_sum": hi / 20, "et0_fao_evapotranspiration": lo / 5, "surface_pressure_mean": n % 100 + 900,
    }
    return grid.join(obs, ["wilaya_id", "date"], "left").select(
        "wilaya_id", "date", *[variables[c].cast("double").alias(c) for c in WEATHER_VARS])


def weather_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """5 regions x all ship dates, with real gaps (nulls) in the measures."""
    li = table(spark, sf_dir, "lineitem")
    reg = table(spark, sf_dir, "region").select(F.col("r_regionkey").alias("wilaya_id"))
    dates = li.select(F.to_date("l_shipdate").alias("date"))
    grid = dense_grid(reg, "wilaya_id", dates)
    obs = (li.groupBy((F.col("l_suppkey") % 5).alias("wilaya_id"), F.to_date("l_shipdate").alias("date"))
             .agg((F.sum(F.when(F.col("l_returnflag") == "R", F.col("l_quantity").cast("decimal(28,8)"))
                       .otherwise(F.lit(0))).cast("double") / F.lit(10)).alias("precipitation"),
                  F.max("l_quantity").alias("temp_max"),
                  (F.min("l_quantity") / F.lit(10)).alias("et0")))
    return grid.join(obs, ["wilaya_id", "date"], "left").select(
        "wilaya_id", "date", "precipitation", "temp_max", "et0")


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Binary label with an integer score (ties included) and a probability."""
    lab = table(spark, sf_dir, "labels")
    doc = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    j = lab.join(doc, "doc_id").select("doc_id", F.col("quality").cast("int").alias("y"),
                                        F.col("n_chars").alias("score"))
    mx = j.agg(F.max("score")).first()[0]
    return j.withColumn("proba", F.col("score").cast("double") / F.lit(float(mx)))


def daily_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return ev.select("event_id", F.to_date("ts").alias("day"),
                     (F.col("event_type") == "purchase").cast("int").alias("y"),
                     F.col("value").alias("score"))


def forecast_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Issued forecasts; ``arrival`` orders re-issued copies (last wins)."""
    o = table(spark, sf_dir, "orders")
    issued = F.to_date("o_orderdate")
    return o.select(
        issued.alias("issued_date"),
        F.date_add(issued, (F.col("o_custkey") % 7).cast("int")).alias("target_date"),
        (F.col("o_custkey") % 25).cast("int").alias("wilaya_id"),
        F.col("o_totalprice").alias("temperature_2m_max"),
        F.col("o_orderkey").alias("arrival"),
    )


def model_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A labelled panel in the published layout: all regions on every day between
    the first and the last shipment, 13 variables from the day's line items, and a
    label that the day's heat and rain decide (one label in fifty is flipped)."""
    li = table(spark, sf_dir, "lineitem")
    day = F.to_date("l_shipdate")
    obs = li.groupBy((F.col("l_suppkey") % 25).alias("wilaya_id"), day.alias("date")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("l_returnflag") == "R").alias("v"), F.max("l_quantity").alias("hi"), F.min("l_quantity").alias("lo"))
    # the line items are read once: the calendar comes from their day totals
    obs = materialize(obs, "model-days")
    bounds = obs.agg(F.min("date").alias("lo"), F.max("date").alias("hi")).first()
    calendar = F.sequence(F.lit(bounds["lo"]).cast("date"), F.lit(bounds["hi"]).cast("date"))
    grid = region_dim(spark, sf_dir).select("wilaya_id", "centroid_lat", "centroid_lon", "area_km2", F.explode(calendar).alias("date"))
    n, v, hi, lo = (F.col(c) for c in ("n", "v", "hi", "lo"))
    variables = {
        "temperature_2m_max": hi, "temperature_2m_min": lo / 2, "temperature_2m_mean": (hi + lo) / 2,
        "relative_humidity_2m_mean": n * 7 % 101, "wind_speed_10m_max": hi * 3 % 40, "wind_gusts_10m_max": hi * 5 % 60,
        "wind_direction_10m_dominant": lo * 37 % 360, "precipitation_sum": v / 2, "rain_sum": v / 4, "sunshine_duration": hi * 600 % 43200,
        "shortwave_radiation_sum": hi / 2, "et0_fao_evapotranspiration": lo / 5, "surface_pressure_mean": n % 100 + 900,
    }
    days = F.datediff("date", F.lit("1990-01-01").cast("date"))
    flip = (days * 7919 + F.col("wilaya_id") * 104729) % 50 == 0
    hot = F.coalesce((hi >= 30) & (v == 0), F.lit(False))
    return grid.join(obs, ["wilaya_id", "date"], "left").select(
        "wilaya_id", "date", *[variables[c].cast("double").alias(c) for c in WEATHER_VARS], *STATIC_FEATURES,
        F.when(flip, ~hot).otherwise(hot).cast("int").alias("label"))


def labelled_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weather panel with a next-day label (precipitation >= 5 on the next row)."""
    from pyspark.sql import Window
    w = Window.partitionBy("wilaya_id").orderBy("date")
    wp = weather_panel(spark, sf_dir)
    return wp.withColumn("label", F.coalesce((F.lead("precipitation").over(w) >= 5).cast("int"), F.lit(0)))
