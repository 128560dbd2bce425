"""Declared schemas: every source is read with one of these, never inferred."""

from pyspark.sql import types as T

from hazardpanel.constants import WEATHER_VARS

# One satellite detection as landed by the fire service (CSV, header row).
# ``type`` is absent from near-real-time feeds; ``confidence`` mixes two
# instruments' encodings, so it is text.
DETECTION_CSV = T.StructType([
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("acq_date", T.DateType()),
    T.StructField("acq_time", T.IntegerType()),
    T.StructField("satellite", T.StringType()),
    T.StructField("instrument", T.StringType()),
    T.StructField("confidence", T.StringType()),
    T.StructField("version", T.StringType()),
    T.StructField("frp", T.DoubleType()),
    T.StructField("daynight", T.StringType()),
    T.StructField("type", T.IntegerType()),
])

# Detections per region and day.
DAILY_DETECTIONS = T.StructType([
    T.StructField("wilaya_id", T.IntegerType()),
    T.StructField("wilaya_code", T.StringType()),
    T.StructField("date", T.DateType()),
    T.StructField("nb_detections", T.LongType()),
    T.StructField("frp_total", T.DoubleType()),
    T.StructField("frp_max", T.DoubleType()),
    T.StructField("fire_detected", T.IntegerType()),
])

# Landed feeds of the registered queries: a row id and the feed's priority as well.
FEED_SCHEMA = T.StructType([*DETECTION_CSV.fields, T.StructField("event_id", T.LongType()), T.StructField("pri", T.IntegerType())])

RECURRING_SPOTS = T.StructType([
    T.StructField("lat_grid", T.DoubleType()),
    T.StructField("lon_grid", T.DoubleType()),
    T.StructField("n_days_detected", T.LongType()),
])

# GeoJSON FeatureCollection / feature-per-line.  Coordinates are kept as raw
# JSON text and parsed per geometry type (Polygon or MultiPolygon).
POLYGON_RINGS = T.ArrayType(T.ArrayType(T.ArrayType(T.DoubleType())))
MULTI_POLYGON_RINGS = T.ArrayType(POLYGON_RINGS)
POLYGON_FEATURE = T.StructType([
    T.StructField("type", T.StringType()),
    T.StructField("properties", T.MapType(T.StringType(), T.StringType())),
    T.StructField("geometry", T.StructType([
        T.StructField("type", T.StringType()),
        T.StructField("coordinates", T.StringType()),
    ])),
])
FEATURE_COLLECTION = T.StructType([
    T.StructField("type", T.StringType()),
    T.StructField("features", T.ArrayType(POLYGON_FEATURE)),
])


def weather_payload_schema(variables=None, time_type=T.StringType()):
    """Column-oriented daily payload: ``{"daily": {"time": [...], var: [...]}}``."""
    variables = list(variables or WEATHER_VARS)
    fields = [T.StructField("time", T.ArrayType(time_type))]
    fields += [T.StructField(v, T.ArrayType(T.DoubleType())) for v in variables]
    return T.StructType([
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("daily", T.StructType(fields)),
    ])
