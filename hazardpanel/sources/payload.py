"""Column-oriented daily payloads (``{"daily": {"time": [...], var: [...]}}``).

A landed request body is either one object or a list of objects; list
elements answer the requested regions *by position*.  Bodies are stored one
per line (JSON Lines) under ``batch=<k>/`` so the reader knows which region
list a body answers.  Unpacking is ``from_json`` → ``posexplode`` → join on
(batch, position) → ``arrays_zip`` + ``inline``: all built-ins.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hazardpanel.operators.joins import dimension


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    """Landed bodies: ``value`` (JSON text) and ``batch`` (from the folder name)."""
    return _read_with_batch(spark, path)


def _read_with_batch(spark: SparkSession, path: str) -> DataFrame:
    raw = spark.read.text(path)
    batch = F.regexp_extract(F.col("_metadata.file_path"), r"batch=(\d+)", 1).cast("int")
    return raw.select(F.col("value"), batch.alias("batch"))


def _items(element: T.StructType):
    """A body's objects; null where the body is no JSON of that form."""
    as_list = F.from_json(F.col("value"), T.ArrayType(element), {"mode": "PERMISSIVE"})
    as_obj = F.from_json(F.col("value"), element)
    return F.when(F.trim(F.col("value")).startswith("["), as_list).otherwise(F.array(as_obj))


def _unreadable(items):
    """Truncated bodies and error answers: nothing parsed, or an object without its day arrays."""
    return F.coalesce((F.size(items) < 1) | F.exists(items, lambda i: i.isNull() | i["daily"].isNull()), F.lit(True))


def payload_audit(bodies: DataFrame, element: T.StructType) -> DataFrame:
    """One row: bodies that can and that cannot be read."""
    bad = _unreadable(_items(element))
    return bodies.agg(F.count_if(~bad).alias("accepted"), F.count_if(bad).alias("rejected"))


def payload_to_rows(bodies: DataFrame, requests: DataFrame, element: T.StructType,
                    array_fields: Sequence[str], time_field: str = "time", skip_unreadable: bool = False) -> DataFrame:
    """Rows per (region, day) from payload bodies.

    A body that cannot be read stops the job with its text's beginning; with
    ``skip_unreadable`` it is left out (``payload_audit`` counts those).

    ``requests`` maps ``(batch, pos)`` to the region asked for at that list
    position.  ``element`` is the schema of one payload object; its ``daily``
    struct holds ``time_field`` and ``array_fields`` as parallel arrays.
    """
    parsed = bodies.select("batch", "value", _items(element).alias("items"))
    if skip_unreadable:
        items = F.when(~_unreadable(F.col("items")), F.col("items"))
    else:
        told = F.raise_error(F.concat(F.lit("payload body cannot be read: "), F.substring(F.coalesce("value", F.lit("NULL")), 1, 200)))
        items = F.when(_unreadable(F.col("items")), told).otherwise(F.col("items"))
    exploded = parsed.select("batch", F.posexplode(items).alias("pos", "item"))
    matched = exploded.join(dimension(requests), ["batch", "pos"], "inner")
    zipped = F.arrays_zip(*[F.col(f"item.daily.{f}").alias(f) for f in [time_field, *array_fields]])
    rows = matched.select(*[c for c in requests.columns if c not in ("batch", "pos")],
                          F.inline(zipped))
    return rows


def coverage(landed: DataFrame, dim: DataFrame, key: str, by: Sequence[str] = ()) -> DataFrame:
    """Regions present in a landed table versus the dimension: ``n_covered / n_total``."""
    total = dim.select(key).distinct().count()
    agg = landed.groupBy(*by).agg(F.countDistinct(key).alias("n_covered")) if by else \
        landed.agg(F.countDistinct(key).alias("n_covered"))
    return agg.withColumn("n_total", F.lit(total).cast("long"))


def requests_from_dim(dim: DataFrame, batch_size: int = 29, id_col: str = "wilaya_id") -> DataFrame:
    """Request layout: regions in id order, ``batch_size`` per request; a
    response list answers its batch by position."""
    from hazardpanel.operators.prefix import row_numbers
    return row_numbers(dim.select(id_col), id_col, "_rn").withColumn("_rn", F.col("_rn") - 1).select(
        id_col, (F.col("_rn") / batch_size).cast("int").alias("batch"),
        (F.col("_rn") % batch_size).cast("int").alias("pos"))


def weather_table(sources, dim: DataFrame, spark, batch_size: int = 29,
                  variables=None, id_col: str = "wilaya_id") -> DataFrame:
    """Weather rows (region, date, variables) from several landed payload sets.

    ``sources`` lists payload folders in priority order; every folder holds
    bodies under ``batch=<k>/`` answering ``requests_from_dim``.  Periods may
    overlap: rows are unioned and deduplicated on (region, date), first
    source wins (map-side combined ``min_by``).
    """
    from hazardpanel.constants import WEATHER_VARS
    from hazardpanel.operators.dedup import dedup_keep_first
    from hazardpanel.schemas import weather_payload_schema

    variables = list(variables or WEATHER_VARS)
    element = weather_payload_schema(variables)
    req = requests_from_dim(dim, batch_size, id_col)
    frames = []
    for prio, path in enumerate(sources):
        rows = payload_to_rows(read_payloads(spark, path), req, element, variables)
        frames.append(rows.select(id_col, F.to_date("time").alias("date"), *variables)
                      .withColumn("_src", F.lit(prio)))
    union = frames[0]
    for f in frames[1:]:
        union = union.unionByName(f)
    out = dedup_keep_first(union, [id_col, "date"], ["_src"]).drop("_src")
    return out.join(dim.select(id_col, "wilaya_code"), id_col, "left") \
        if "wilaya_code" in dim.columns else out


def weather_from_region_files(spark, paths, variables=None, id_col: str = "wilaya_id") -> DataFrame:
    """Weather rows from per-region CSV files (``time``, variables, region id
    and code), several folders in priority order; missing regions are simply
    absent (see ``coverage``), overlapping days keep the first folder's row."""
    from pyspark.sql import types as T

    from hazardpanel.constants import WEATHER_VARS
    from hazardpanel.operators.dedup import dedup_keep_first
    from hazardpanel.sources.detections import read_csv_by_header

    variables = list(variables or WEATHER_VARS)
    schema = T.StructType([T.StructField("time", T.DateType()), T.StructField(id_col, T.IntegerType()),
                           T.StructField("wilaya_code", T.StringType())]
                          + [T.StructField(v, T.DoubleType()) for v in variables])
    frames = []
    for prio, path in enumerate([paths] if isinstance(paths, str) else paths):
        rows = read_csv_by_header(spark, path, schema).withColumnRenamed("time", "date")
        frames.append(rows.withColumn("_src", F.lit(prio)))
    union = frames[0]
    for f in frames[1:]:
        union = union.unionByName(f)
    return dedup_keep_first(union, [id_col, "date"], ["_src"]).drop("_src")
