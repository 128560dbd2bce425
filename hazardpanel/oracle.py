"""DuckDB twins of the fixture views and of every registered query.

``sql(body, views)`` prefixes ``body`` with the CTEs it needs (resolved
transitively).  ``RD(x)`` of the fixtures is ``round_even(x*100,0)/100``.
"""

from __future__ import annotations

from hazardpanel.constants import WEATHER_VARS
from hazardpanel.fixtures import FIXTURE_NON_FOREST

_NON_FOREST = ", ".join(f"'{n}'" for n in FIXTURE_NON_FOREST)

def rd(x: str, digits: int = 2) -> str:
    scale = f"1e{digits}"
    return f"round_even(({x})*{scale}, 0)/{scale}"


def panel_sql(daily: str, coverage: str | None = "w.date >= DATE '2000-11-01'", where: str = "") -> str:
    """The published panel layout over the ``weather`` view and a daily view."""
    flag = f",\n       {coverage} AS fire_data_coverage" if coverage else ""
    return f"""
SELECT w.date, w.wilaya_id, r.wilaya_code, r.wilaya_name, {", ".join("w." + v for v in WEATHER_VARS)},
       r.area_km2, r.centroid_lat, r.centroid_lon, r.is_forest_zone,
       CAST(coalesce(d.nb_detections, 0) AS INTEGER) AS nb_detections,
       {rd('coalesce(d.frp_total, 0.0)')} AS frp_total,
       {rd('coalesce(d.frp_max, 0.0)')} AS frp_max,
       CAST(coalesce(d.fire_detected, 0) AS INTEGER) AS fire_detected{flag}
FROM weather w
LEFT JOIN {daily} d ON d.wilaya_id = w.wilaya_id AND d.date = w.date
LEFT JOIN region_dim r ON r.wilaya_id = w.wilaya_id {where}"""


_CROSS = ("((e.y1 > d.latitude) <> (e.y2 > d.latitude) AND "
          "d.longitude < (e.x2-e.x1)*(d.latitude-e.y1)/(e.y2-e.y1)+e.x1)")
_ONSEG = ("((e.x2-e.x1)*(d.latitude-e.y1) - (e.y2-e.y1)*(d.longitude-e.x1) = 0 "
          "AND d.longitude BETWEEN least(e.x1,e.x2) AND greatest(e.x1,e.x2) "
          "AND d.latitude BETWEEN least(e.y1,e.y2) AND greatest(e.y1,e.y2))")

# name -> (sql, dependencies)
VIEWS: dict[str, tuple[str, list[str]]] = {
    "detections": ("""
SELECT event_id, pri,
  CASE WHEN user_id%5=0 THEN CAST(2000500+(user_id%20)*50000 AS DOUBLE)/100000
       ELSE CAST(1896000+(event_id*7919)%1816000 AS DOUBLE)/100000 END AS latitude,
  CASE WHEN user_id%5=0 THEN CAST(100500+(user_id%20)*30000 AS DOUBLE)/100000
       ELSE CAST(-868000+(event_id*104729)%2067000 AS DOUBLE)/100000 END AS longitude,
  CAST(ts AS DATE) AS acq_date, CAST(hour(ts)*100+minute(ts) AS INTEGER) AS acq_time,
  CASE event_type WHEN 'view' THEN 'N' WHEN 'click' THEN 'N20' ELSE 'N21' END AS satellite,
  CAST(CASE WHEN pri=1 THEN NULL WHEN event_type='error' THEN 2 WHEN event_type='signup' THEN 3 ELSE 0 END AS INTEGER) AS type,
  value AS frp
FROM (SELECT *, 0 AS pri FROM events
      UNION ALL
      SELECT *, 1 AS pri FROM events WHERE event_id%7=0 OR (event_type='error' AND event_id%3=0)) ev
""", []),
    "edges": ("""
SELECT region_id AS wilaya_id, region_id AS pos, part, ring, edge_no,
       x0+(ax+dx1*(bx-ax))*4.5e0 AS x1, y0+(ay+dy1*(by_-ay))*3.9e0 AS y1, x0+(ax+dx2*(bx-ax))*4.5e0 AS x2, y0+(ay+dy2*(by_-ay))*3.9e0 AS y2
FROM (SELECT n_nationkey AS region_id, -8.7e0+(n_nationkey%5)*4.2e0 AS x0,
             18.9e0+CAST(n_nationkey-n_nationkey%5 AS DOUBLE)/5*3.7e0 AS y0 FROM nation) b
CROSS JOIN (SELECT 0 AS edge_no, 0 AS dx1, 0 AS dy1, 1 AS dx2, 0 AS dy2
            UNION ALL SELECT 1,1,0,1,1 UNION ALL SELECT 2,1,1,0,1 UNION ALL SELECT 3,0,1,0,0) c
CROSS JOIN (SELECT 0 AS part, 0 AS ring, -1 AS rest, 0e0 AS ax, 0e0 AS ay, 1e0 AS bx, 1e0 AS by_
            UNION ALL SELECT 0, 1, 1, 0.25e0, 0.25e0, 0.5e0, 0.75e0 UNION ALL SELECT 1, 0, 2, 0.25e0, 1.125e0, 0.75e0, 1.25e0) f
WHERE rest < 0 OR rest = region_id % 5
""", []),
    "measures": (f"""
SELECT wilaya_id,
  {rd('sum(w*a)/1e6', 1)} AS area_km2,
  {rd('degrees(2*atan(exp((sum(w*mx)/sum(w*a))/6378137.0)) - pi()/2)', 6)} AS centroid_lat,
  {rd('degrees((sum(w*mx_)/sum(w*a))/6378137.0)', 6)} AS centroid_lon
FROM (
  SELECT wilaya_id, part, ring,
         sum(cr)/2.0 AS a, sum((my1+my2)*cr)/6.0 AS mx, sum((mx1+mx2)*cr)/6.0 AS mx_,
         CASE WHEN ring=0 THEN 1.0 ELSE -1.0 END * sign(sum(cr)/2.0) AS w
  FROM (
    SELECT wilaya_id, part, ring, mx1, my1, mx2, my2, mx1*my2 - mx2*my1 AS cr
    FROM (SELECT wilaya_id, part, ring,
                 6378137.0*radians(x1) AS mx1, 6378137.0*ln(tan(pi()/4 + radians(y1)/2.0)) AS my1,
                 6378137.0*radians(x2) AS mx2, 6378137.0*ln(tan(pi()/4 + radians(y2)/2.0)) AS my2
          FROM edges) p) q
  GROUP BY wilaya_id, part, ring) r
GROUP BY wilaya_id
""", ["edges"]),
    "region_dim": (f"""
SELECT n.n_nationkey AS wilaya_id, lpad(CAST(n.n_nationkey AS VARCHAR), 2, '0') AS wilaya_code,
       n.n_name AS wilaya_name, r.r_name AS zone_name,
       n.n_name NOT IN ({_NON_FOREST}) AS is_forest_zone,
       m.area_km2, m.centroid_lat, m.centroid_lon
FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey
LEFT JOIN measures m ON m.wilaya_id = n.n_nationkey
""", ["measures"]),
    "ded": ("""
SELECT event_id, pri, latitude, longitude, acq_date, acq_time, satellite, type, frp FROM (
  SELECT *, row_number() OVER (PARTITION BY latitude, longitude, acq_date, acq_time, satellite
                               ORDER BY pri, event_id) AS rn FROM detections) t WHERE rn = 1
""", ["detections"]),
    "hits_all": (f"""
SELECT d.event_id, d.pri, e.wilaya_id, e.pos
FROM ded d JOIN edges e ON {_CROSS} OR {_ONSEG}
GROUP BY d.event_id, d.pri, e.wilaya_id, e.pos
HAVING sum(CASE WHEN {_CROSS} THEN 1 ELSE 0 END) % 2 = 1
   AND sum(CASE WHEN {_ONSEG} THEN 1 ELSE 0 END) = 0
""", ["ded", "edges"]),
    "first_hit": ("""
SELECT event_id, pri, arg_min(wilaya_id, pos) AS wilaya_id, count(*) AS n_matches
FROM hits_all GROUP BY event_id, pri
""", ["hits_all"]),
    "assigned": ("""
SELECT d.*, f.wilaya_id, coalesce(f.n_matches, 0) AS n_matches
FROM ded d LEFT JOIN first_hit f ON d.event_id = f.event_id AND d.pri = f.pri
""", ["ded", "first_hit"]),
    "matched": (f"""
SELECT event_id, pri, latitude, longitude, acq_date, acq_time, satellite, type, frp, wilaya_id,
       {rd('latitude')} AS lat_grid, {rd('longitude')} AS lon_grid
FROM assigned WHERE wilaya_id IS NOT NULL AND (type = 0 OR type IS NULL)
""", ["assigned"]),
    "matched_strict": (f"""
SELECT event_id, pri, latitude, longitude, acq_date, acq_time, satellite, type, frp, wilaya_id,
       {rd('latitude')} AS lat_grid, {rd('longitude')} AS lon_grid
FROM assigned WHERE wilaya_id IS NOT NULL AND type = 0
""", ["assigned"]),
    "spots": ("""
SELECT lat_grid, lon_grid, count(DISTINCT acq_date) AS n_days_detected
FROM matched GROUP BY lat_grid, lon_grid HAVING count(DISTINCT acq_date) > 15
""", ["matched"]),
    "kept": ("""
SELECT m.* FROM matched m
WHERE NOT EXISTS (SELECT 1 FROM spots s WHERE s.lat_grid = m.lat_grid AND s.lon_grid = m.lon_grid)
""", ["matched", "spots"]),
    "daily": ("""
SELECT k.wilaya_id, r.wilaya_code, k.acq_date AS date, count(k.frp) AS nb_detections,
       coalesce(round(sum(k.frp), 6), 0e0) AS frp_total, max(k.frp) AS frp_max,
       1 AS fire_detected
FROM kept k LEFT JOIN region_dim r ON r.wilaya_id = k.wilaya_id
GROUP BY k.wilaya_id, r.wilaya_code, k.acq_date
""", ["kept", "region_dim"]),
    "spots_strict": ("""
SELECT lat_grid, lon_grid, count(DISTINCT acq_date) AS n_days_detected
FROM matched_strict GROUP BY lat_grid, lon_grid HAVING count(DISTINCT acq_date) > 15
""", ["matched_strict"]),
    "daily_strict": ("""
SELECT k.wilaya_id, r.wilaya_code, k.acq_date AS date, count(k.frp) AS nb_detections,
       coalesce(round(sum(k.frp), 6), 0e0) AS frp_total, max(k.frp) AS frp_max,
       1 AS fire_detected
FROM matched_strict k LEFT JOIN region_dim r ON r.wilaya_id = k.wilaya_id
WHERE NOT EXISTS (SELECT 1 FROM spots_strict s WHERE s.lat_grid = k.lat_grid AND s.lon_grid = k.lon_grid)
GROUP BY k.wilaya_id, r.wilaya_code, k.acq_date
""", ["matched_strict", "spots_strict", "region_dim"]),
    "event_grid": ("""
SELECT d.date, r.wilaya_id FROM (SELECT DISTINCT acq_date AS date FROM detections) d
CROSS JOIN (SELECT wilaya_id FROM region_dim) r
""", ["detections", "region_dim"]),
    "weather": ("""
SELECT g.wilaya_id, g.date, hi/10 AS temperature_2m_max, lo/10 AS temperature_2m_min, (hi+lo)/20 AS temperature_2m_mean,
  CAST(n*7%101 AS DOUBLE) AS relative_humidity_2m_mean, CAST(n*3%40 AS DOUBLE) AS wind_speed_10m_max,
  CAST(n*5%60 AS DOUBLE) AS wind_gusts_10m_max, CAST(n*37%360 AS DOUBLE) AS wind_direction_10m_dominant,
  CAST(v AS DOUBLE)/2 AS precipitation_sum, CAST(v AS DOUBLE)/4 AS rain_sum, CAST(n*600%43200 AS DOUBLE) AS sunshine_duration,
  hi/20 AS shortwave_radiation_sum, lo/5 AS et0_fao_evapotranspiration, CAST(n%100+900 AS DOUBLE) AS surface_pressure_mean
FROM (SELECT n_nationkey AS wilaya_id, CAST(d.d AS DATE) AS date FROM nation CROSS JOIN (
        SELECT unnest(generate_series(min(CAST(ts AS DATE)), max(CAST(ts AS DATE)), INTERVAL 1 DAY)) AS d FROM events) d) g
LEFT JOIN (SELECT user_id%25 AS wilaya_id, CAST(ts AS DATE) AS date, count(*) AS n, count(*) FILTER (event_type = 'view') AS v,
                  max(value) AS hi, min(value) AS lo FROM events GROUP BY 1, 2) o ON o.wilaya_id = g.wilaya_id AND o.date = g.date
""", []),
    "panel": (panel_sql("daily"), ["weather", "daily", "region_dim"]),
    "weather_panel": ("""
SELECT c.wilaya_id, c.date, o.precipitation, o.temp_max, o.et0
FROM (SELECT r_regionkey AS wilaya_id, d.date FROM region
      CROSS JOIN (SELECT DISTINCT CAST(l_shipdate AS DATE) AS date FROM lineitem) d) c
LEFT JOIN (SELECT l_suppkey%5 AS wilaya_id, CAST(l_shipdate AS DATE) AS date,
   round(sum(CASE WHEN l_returnflag='R' THEN l_quantity ELSE 0 END), 6)/10 AS precipitation,
   max(l_quantity) AS temp_max, min(l_quantity)/10 AS et0
   FROM lineitem GROUP BY l_suppkey%5, CAST(l_shipdate AS DATE)) o
ON c.wilaya_id = o.wilaya_id AND c.date = o.date
""", []),
    "model_panel": ("""
SELECT *, CAST(CASE WHEN flip THEN NOT hot ELSE hot END AS INTEGER) AS label FROM (
  SELECT g.wilaya_id, g.date, CAST(hi AS DOUBLE) AS temperature_2m_max, lo/2 AS temperature_2m_min, (hi+lo)/2 AS temperature_2m_mean,
    CAST(n*7%101 AS DOUBLE) AS relative_humidity_2m_mean, hi*3%40 AS wind_speed_10m_max, hi*5%60 AS wind_gusts_10m_max,
    lo*37%360 AS wind_direction_10m_dominant, CAST(v AS DOUBLE)/2 AS precipitation_sum, CAST(v AS DOUBLE)/4 AS rain_sum,
    hi*600%43200 AS sunshine_duration, hi/2 AS shortwave_radiation_sum, lo/5 AS et0_fao_evapotranspiration,
    CAST(n%100+900 AS DOUBLE) AS surface_pressure_mean, g.centroid_lat, g.centroid_lon, g.area_km2,
    (date_diff('day', DATE '1990-01-01', g.date) * 7919 + g.wilaya_id * 104729) % 50 = 0 AS flip, coalesce(hi >= 30 AND v = 0, false) AS hot
  FROM (SELECT r.wilaya_id, r.centroid_lat, r.centroid_lon, r.area_km2, CAST(d.d AS DATE) AS date FROM region_dim r CROSS JOIN (
          SELECT unnest(generate_series(min(CAST(l_shipdate AS DATE)), max(CAST(l_shipdate AS DATE)), INTERVAL 1 DAY)) AS d FROM lineitem) d) g
  LEFT JOIN (SELECT l_suppkey%25 AS wilaya_id, CAST(l_shipdate AS DATE) AS date, count(*) AS n, count(*) FILTER (l_returnflag = 'R') AS v,
                    CAST(max(l_quantity) AS DOUBLE) AS hi, CAST(min(l_quantity) AS DOUBLE) AS lo FROM lineitem GROUP BY 1, 2) o
    ON o.wilaya_id = g.wilaya_id AND o.date = g.date) t
""", ["region_dim"]),
    "scored": ("""
SELECT l.doc_id, CAST(l.quality AS INTEGER) AS y, d.n_chars AS score,
       CAST(d.n_chars AS DOUBLE) / max(d.n_chars) OVER () AS proba
FROM labels l JOIN documents d ON l.doc_id = d.doc_id
""", []),
    "daily_scored": ("""
SELECT event_id, CAST(ts AS DATE) AS day, CAST(event_type = 'purchase' AS INTEGER) AS y, value AS score
FROM events
""", []),
    "forecast_log": ("""
SELECT CAST(o_orderdate AS DATE) AS issued_date,
       CAST(o_orderdate AS DATE) + CAST(o_custkey % 7 AS INTEGER) AS target_date,
       CAST(o_custkey % 25 AS INTEGER) AS wilaya_id,
       o_totalprice AS temperature_2m_max, o_orderkey AS arrival
FROM orders
""", []),
}


def _order(names: list[str]) -> list[str]:
    seen: list[str] = []

    def visit(n: str) -> None:
        if n in seen:
            return
        for dep in VIEWS[n][1]:
            visit(dep)
        seen.append(n)

    for n in names:
        visit(n)
    return seen


def sql(body: str, *views: str) -> str:
    """``WITH <views and their dependencies> <body>``."""
    names = _order(list(views))
    body = body.strip()
    if not names:
        return body
    ctes = ",\n".join(f"{n} AS ({VIEWS[n][0].strip()})" for n in names)
    if body[:5].upper() == "WITH ":
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"
