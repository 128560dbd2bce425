"""Point-in-polygon assignment and polygon measures over an edge table.

Edge table layout (one row per polygon edge, rings closed):
``region_id, pos, part, ring, x1, y1, x2, y2`` with x = longitude and
y = latitude in degrees; ``pos`` is the feature order in the source file
(first match wins on overlaps), ``ring`` 0 is the outer ring of a part.

Assignment plan (no shuffle of the points):

1. Each polygon's bounding box is cut into ``cell_deg`` cells; every cell
   keeps its candidate polygons with only the edges that matter inside the
   cell, and a candidate that covers the whole cell is marked interior and
   keeps no edges.  This table depends on the geometry only, never on the
   number of points.
2. Points compute their cell and look it up; the cell table is stored, so its
   bytes decide between a broadcast (no shuffle of the points) and, for very
   detailed geometry, a shuffle join with AQE skew splitting.
3. A higher-order even-odd ray test runs per non-interior candidate inside the row:
   crossings are counted with ``filter`` and a point lying on an edge is
   excluded (``within`` semantics: the boundary is not inside).  Holes and
   multi-part polygons fall out of the parity rule.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazardpanel.constants import MERCATOR_RADIUS_M
from hazardpanel.functions.scalar import round_half_even
from hazardpanel.operators.joins import dimension

DEFAULT_CELL_DEG = 0.25


def polygon_cells(edges: DataFrame, region_col: str = "wilaya_id",
                  cell_deg: float = DEFAULT_CELL_DEG) -> DataFrame:
    """Cell index: ``cx, cy, cands`` with ``cands = array<struct<pos, region, edges>>``.

    Each cell keeps, per candidate polygon, only the edges that can matter to
    a point inside the cell: the eastward ray of such a point stays inside the
    cell's latitude band, so edges outside that band (or entirely west of the
    cell) can neither be crossed nor contain the point.  A candidate whose
    clipped list is empty cannot contain any point of the cell and is dropped.
    A candidate that no edge comes near and whose cell centre is inside
    covers the whole cell: it is marked ``full`` and keeps no edges, so points
    in the interior of a region are placed without any edge test.
    """
    c = F.lit(float(cell_deg))
    poly = edges.groupBy(region_col, "pos").agg(
        F.collect_list(F.struct("x1", "y1", "x2", "y2")).alias("edges"),
        F.min(F.least("x1", "x2")).alias("xmin"), F.max(F.greatest("x1", "x2")).alias("xmax"),
        F.min(F.least("y1", "y2")).alias("ymin"), F.max(F.greatest("y1", "y2")).alias("ymax"),
    )
    cells = (poly
             .withColumn("cx", F.explode(F.sequence(F.floor(F.col("xmin") / c), F.floor(F.col("xmax") / c))))
             .withColumn("cy", F.explode(F.sequence(F.floor(F.col("ymin") / c), F.floor(F.col("ymax") / c)))))
    # cell bounds widened by one cell-width fraction to stay safe under rounding
    lo_x = F.col("cx") * c
    lo_y = F.col("cy") * c
    hi_y = (F.col("cy") + 1) * c
    eps = c * F.lit(1e-9)
    clipped = F.filter("edges", lambda e: (F.greatest(e["y1"], e["y2"]) >= lo_y - eps)
                       & (F.least(e["y1"], e["y2"]) <= hi_y + eps)
                       & (F.greatest(e["x1"], e["x2"]) >= lo_x - eps))
    cells = cells.withColumn("edges", clipped).filter(F.size("edges") > 0)
    # interior cells: no edge comes near the cell and its centre is inside, so
    # every point of the cell is inside; such candidates carry no edges at all
    hi_x = (F.col("cx") + 1) * c
    touches = F.exists("edges", lambda e: F.least(e["x1"], e["x2"]) <= hi_x + eps)
    centre_x, centre_y = (F.col("cx") + 0.5) * c, (F.col("cy") + 0.5) * c
    centre_in = (F.size(F.filter("edges", lambda e: _crosses(e, centre_x, centre_y))) % 2) == 1
    cells = (cells.withColumn("full", ~touches & centre_in)
                  .withColumn("edges", F.when(F.col("full"), F.array().cast(cells.schema["edges"].dataType))
                                        .otherwise(F.col("edges"))))
    return cells.groupBy("cx", "cy").agg(
        F.collect_list(F.struct(F.col("pos"), F.col(region_col).alias("region"), F.col("full"),
                                F.col("edges"))).alias("cands"))


def _crosses(e: Column, px: Column, py: Column) -> Column:
    # half-open rule on y, ray towards +x
    return ((e["y1"] > py) != (e["y2"] > py)) & (
        px < (e["x2"] - e["x1"]) * (py - e["y1"]) / (e["y2"] - e["y1"]) + e["x1"])


def _on_edge(e: Column, px: Column, py: Column) -> Column:
    cross = (e["x2"] - e["x1"]) * (py - e["y1"]) - (e["y2"] - e["y1"]) * (px - e["x1"])
    return ((cross == 0)
            & (px >= F.least(e["x1"], e["x2"])) & (px <= F.greatest(e["x1"], e["x2"]))
            & (py >= F.least(e["y1"], e["y2"])) & (py <= F.greatest(e["y1"], e["y2"])))


def _inside(p: Column, px: Column, py: Column) -> Column:
    crossings = F.size(F.filter(p["edges"], lambda e: _crosses(e, px, py)))
    return p["full"] | (((crossings % 2) == 1) & ~F.exists(p["edges"], lambda e: _on_edge(e, px, py)))


def cell_index(edges: DataFrame, region_col: str = "wilaya_id",
               cell_deg: float = DEFAULT_CELL_DEG) -> DataFrame:
    """The cell table, stored; pass it as ``cells=`` when placing many batches."""
    return dimension(polygon_cells(edges, region_col, cell_deg), "cell-index")


def _with_candidates(points: DataFrame, edges: DataFrame | None, lon: str, lat: str,
                     region_col: str, cell_deg: float, cells: DataFrame | None = None) -> DataFrame:
    if cells is None:
        cells = cell_index(edges, region_col, cell_deg)
    c = F.lit(float(cell_deg))
    keyed = (points.withColumn("_cx", F.floor(F.col(lon) / c))
                   .withColumn("_cy", F.floor(F.col(lat) / c)))
    joined = keyed.join(cells.select(F.col("cx").alias("_cx"), F.col("cy").alias("_cy"), "cands"),
                        on=["_cx", "_cy"], how="left")
    px, py = F.col(lon), F.col(lat)
    matched = F.filter(F.coalesce(F.col("cands"), F.array()), lambda p: _inside(p, px, py))
    return joined.withColumn("_matched", matched).drop("_cx", "_cy", "cands")


def assign_all_regions(points: DataFrame, edges: DataFrame, lon: str = "longitude",
                       lat: str = "latitude", region_col: str = "wilaya_id",
                       cell_deg: float = DEFAULT_CELL_DEG) -> DataFrame:
    """Inner spatial join: one row per (point, containing polygon)."""
    cand = _with_candidates(points, edges, lon, lat, region_col, cell_deg)
    out = cand.withColumn("_m", F.explode("_matched"))
    return (out.withColumn(region_col, F.col("_m.region"))
               .withColumn("region_pos", F.col("_m.pos"))
               .drop("_m", "_matched"))


def assign_region(points: DataFrame, edges: DataFrame | None, lon: str = "longitude",
                  lat: str = "latitude", region_col: str = "wilaya_id",
                  cell_deg: float = DEFAULT_CELL_DEG, cells: DataFrame | None = None) -> DataFrame:
    """Left spatial join keeping the first match in file order.

    Every input row comes out exactly once; ``region_col`` is null when the
    point lies in no polygon (or on a boundary only).
    """
    cand = _with_candidates(points, edges, lon, lat, region_col, cell_deg, cells)
    first = F.array_min(F.transform("_matched", lambda p: F.struct(p["pos"].alias("pos"),
                                                                   p["region"].alias("region"))))
    return (cand.withColumn("_first", first)
                .withColumn(region_col, F.col("_first.region"))
                .withColumn("n_matches", F.size("_matched"))
                .drop("_first", "_matched"))


# --------------------------------------------------------------------------
# Geometry measures in the Web-Mercator plane (shoelace over edges).
# --------------------------------------------------------------------------

def _merc_x(lon: Column, r: float) -> Column:
    return F.lit(r) * F.radians(lon)


def _merc_y(lat: Column, r: float) -> Column:
    return F.lit(r) * F.log(F.tan(F.lit(math.pi / 4) + F.radians(lat) / F.lit(2.0)))


def polygon_measures(edges: DataFrame, region_col: str = "wilaya_id",
                     radius: float = MERCATOR_RADIUS_M, area_digits: int = 1,
                     centroid_digits: int = 6) -> DataFrame:
    """Area (km²) and area-weighted centroid (degrees) per region.

    Outer rings add, holes subtract, whatever the ring orientation.  The
    projection is Web-Mercator, as in the published region table (its area
    grows with latitude; kept for parity).
    """
    xy = edges.select(
        region_col, "part", "ring",
        _merc_x(F.col("x1"), radius).alias("mx1"), _merc_y(F.col("y1"), radius).alias("my1"),
        _merc_x(F.col("x2"), radius).alias("mx2"), _merc_y(F.col("y2"), radius).alias("my2"),
    ).withColumn("cross", F.col("mx1") * F.col("my2") - F.col("mx2") * F.col("my1"))
    rings = xy.groupBy(region_col, "part", "ring").agg(
        (F.sum("cross") / F.lit(2.0)).alias("a"),
        (F.sum((F.col("mx1") + F.col("mx2")) * F.col("cross")) / F.lit(6.0)).alias("mx"),
        (F.sum((F.col("my1") + F.col("my2")) * F.col("cross")) / F.lit(6.0)).alias("my"),
    )
    w = F.when(F.col("ring") == 0, F.lit(1.0)).otherwise(F.lit(-1.0)) * F.signum("a")
    poly = rings.groupBy(region_col).agg(
        F.sum(w * F.col("a")).alias("area_m2"),
        F.sum(w * F.col("mx")).alias("sx"),
        F.sum(w * F.col("my")).alias("sy"),
    )
    cx = F.col("sx") / F.col("area_m2")
    cy = F.col("sy") / F.col("area_m2")
    lon = F.degrees(cx / F.lit(radius))
    lat = F.degrees(F.lit(2.0) * F.atan(F.exp(cy / F.lit(radius))) - F.lit(math.pi / 2))
    return poly.select(
        region_col,
        round_half_even(F.col("area_m2") / F.lit(1e6), area_digits).alias("area_km2"),
        round_half_even(lat, centroid_digits).alias("centroid_lat"),
        round_half_even(lon, centroid_digits).alias("centroid_lon"),
    )
