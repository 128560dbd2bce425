"""Region dimension from polygons: code mapping, measures, ids, forest flag."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazardpanel.constants import NON_FOREST_REGIONS
from hazardpanel.operators.dims import flag_not_in, map_or_fail, surrogate_id
from hazardpanel.operators.spatial import polygon_measures
from hazardpanel.sources.geojson import features_to_edges


def build_region_dim(features: DataFrame, mapping: DataFrame, name_prop: str = "NAME_1",
                     non_forest: Sequence[str] = tuple(NON_FOREST_REGIONS),
                     extra_props: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """(dimension, edges) from raw polygon features.

    * name → official code through ``mapping`` (``name``, ``code``); an
      unmapped name fails the job;
    * ``wilaya_id`` = 1..n in code order;
    * Web-Mercator area (km², 0.1) and area-weighted centroid;
    * ``is_forest_zone`` = name not in ``non_forest``.
    The edges come back keyed by the new id, in file order (``pos``).
    """
    props = features.select("pos", F.col("properties")[name_prop].alias("wilaya_name"),
                            *[F.col("properties")[p].alias(p) for p in extra_props])
    coded = map_or_fail(props, "wilaya_name", mapping, "name", "code", "wilaya_code")
    ided = surrogate_id(coded, "wilaya_code", "wilaya_id").withColumn("wilaya_id", F.col("wilaya_id").cast("int"))
    keyed = features.join(ided.select("pos", "wilaya_id"), "pos").withColumn(
        "properties", F.create_map(F.lit("wilaya_id"), F.col("wilaya_id").cast("string")))
    edges = features_to_edges(keyed, "wilaya_id")
    measures = polygon_measures(edges)
    dim = flag_not_in(ided.join(measures, "wilaya_id", "left"), "wilaya_name", list(non_forest))
    cols = ["wilaya_id", "wilaya_code", "wilaya_name", *extra_props,
            "area_km2", "centroid_lat", "centroid_lon", "is_forest_zone"]
    return dim.select(*cols), edges
