"""Region polygons as GeoJSON ↔ the edge table used by the spatial operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazardpanel.operators.prefix import row_numbers
from hazardpanel.schemas import FEATURE_COLLECTION, MULTI_POLYGON_RINGS, POLYGON_FEATURE, POLYGON_RINGS
from hazardpanel.session import materialize


def read_features(spark: SparkSession, path: str, collection: bool = True) -> DataFrame:
    """Features with their file position ``pos``.

    ``collection=True`` reads a FeatureCollection document (multi-line JSON);
    otherwise one feature per line, ordered by (file, line).
    """
    if collection:
        doc = spark.read.schema(FEATURE_COLLECTION).option("multiLine", True).json(path)
        return doc.select(F.posexplode("features").alias("pos", "f")).select("pos", "f.*")
    # file-wise line order (increasing within a file split), frozen before it is numbered
    lines = materialize(spark.read.text(path).select(
        F.struct(F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("line")).alias("_at"), "value"), "features")
    numbered = row_numbers(lines, "_at", "pos").select((F.col("pos") - 1).cast("int").alias("pos"), F.from_json("value", POLYGON_FEATURE).alias("f"))
    return numbered.select("pos", "f.*")


def _parts(geometry):
    """Polygon or MultiPolygon coordinates (raw JSON text) as an array of
    parts, each part a list of rings."""
    coords = geometry["coordinates"]
    return F.when(geometry["type"] == "MultiPolygon", F.from_json(coords, MULTI_POLYGON_RINGS)) \
            .otherwise(F.array(F.from_json(coords, POLYGON_RINGS)))


def features_to_edges(features: DataFrame, id_prop: str = "wilaya_id",
                      id_type: str = "int") -> DataFrame:
    """``region_id, pos, part, ring, edge_no, x1, y1, x2, y2`` from Polygon or
    MultiPolygon features (ring 0 of every part is its outer ring).

    Rings are closed in GeoJSON (first vertex repeated), so consecutive
    vertex pairs are the edges.
    """
    geometry = F.col("geometry")
    if dict(features.select("geometry.coordinates").dtypes)["coordinates"] == "string":
        parts = _parts(geometry)
    else:  # already parsed polygon rings
        parts = F.array(geometry["coordinates"])
    by_part = features.select(
        F.col("properties")[id_prop].cast(id_type).alias(id_prop), "pos",
        F.posexplode(parts).alias("part", "rings"))
    rings = by_part.select(id_prop, "pos", "part", F.posexplode("rings").alias("ring", "coords"))
    n = F.size("coords")
    pairs = F.arrays_zip(F.slice("coords", 1, n - 1).alias("a"), F.slice("coords", 2, n - 1).alias("b"))
    edges = rings.select(id_prop, "pos", "part", "ring", F.posexplode(pairs).alias("edge_no", "e"))
    return edges.select(id_prop, "pos", "part", "ring", "edge_no",
                        F.col("e.a")[0].alias("x1"), F.col("e.a")[1].alias("y1"),
                        F.col("e.b")[0].alias("x2"), F.col("e.b")[1].alias("y2"))


def read_edges(spark: SparkSession, path: str, collection: bool = True,
               id_prop: str = "wilaya_id") -> DataFrame:
    return features_to_edges(read_features(spark, path, collection), id_prop)


def edges_to_features(edges: DataFrame, id_col: str = "wilaya_id",
                      props: DataFrame | None = None) -> DataFrame:
    """One GeoJSON feature per region, as JSON text (feature per line).

    Ring vertices are rebuilt from ordered edges (each ring closed), rings are
    kept apart by part: one part is a ``Polygon``, several are a
    ``MultiPolygon``.  Properties keep their types.  One group holds one
    region's edges: bounded by geometry, not by data.
    """
    ring = (edges.groupBy(id_col, "pos", "part", "ring")
                 .agg(F.array_sort(F.collect_list(F.struct("edge_no", "x1", "y1", "x2", "y2"))).alias("es")))
    ring = ring.select(id_col, "pos", "part", "ring", F.concat(
        F.transform("es", lambda e: F.array(e["x1"], e["y1"])),
        F.array(F.array(F.element_at("es", -1)["x2"], F.element_at("es", -1)["y2"]))).alias("coords"))
    ordered = lambda name, value: F.transform(F.array_sort(F.collect_list(F.struct(name, value))), lambda r: r[value])
    part = ring.groupBy(id_col, "pos", "part").agg(ordered("ring", "coords").alias("rings"))
    poly = part.groupBy(id_col, "pos").agg(ordered("part", "rings").alias("parts"))
    if props is not None:
        poly = poly.join(props, id_col, "left")
    prop_cols = [c for c in poly.columns if c not in ("pos", "parts")]
    head = lambda kind, value: F.to_json(F.struct(
        F.lit("Feature").alias("type"), F.struct(*prop_cols).alias("properties"),
        F.struct(F.lit(kind).alias("type"), value.alias("coordinates")).alias("geometry")))
    several = F.size("parts") > 1
    return poly.select(id_col, "pos", F.when(several, head("MultiPolygon", F.col("parts"))).otherwise(head("Polygon", F.col("parts")[0])).alias("json"))


def write_features(features_json: DataFrame, path: str) -> str:
    """Newline-delimited GeoJSON features in file order (``pos``).

    ``orderBy`` range-partitions by ``pos``, so part files come out in order.
    """
    features_json.orderBy("pos").select("json").write.mode("overwrite").text(path)
    return path

