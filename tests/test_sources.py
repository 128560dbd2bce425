"""Sources: GeoJSON FeatureCollection, weather payloads (object or list), bodies."""

import json
import os

import pytest
from pyspark.sql import functions as F

from hazardpanel.constants import WEATHER_VARS
from hazardpanel.schemas import weather_payload_schema
from hazardpanel.session import scratch_path
from hazardpanel.sources.detections import body_audit, parse_bodies
from hazardpanel.sources.geojson import read_edges
from hazardpanel.sources.payload import payload_to_rows


def _local(path):
    return path[len("file:"):] if path.startswith("file:") else path


def test_feature_collection_with_hole(spark):
    root = _local(scratch_path(spark, "test-geojson"))
    os.makedirs(root, exist_ok=True)
    outer = [[0, 0], [4, 0], [4, 4], [0, 4], [0, 0]]
    hole = [[1, 1], [1, 3], [3, 3], [3, 1], [1, 1]]
    fc = {"type": "FeatureCollection", "features": [
        {"type": "Feature", "properties": {"wilaya_id": "7"},
         "geometry": {"type": "Polygon", "coordinates": [outer, hole]}},
        {"type": "Feature", "properties": {"wilaya_id": "3"},
         "geometry": {"type": "Polygon", "coordinates": [outer]}}]}
    with open(f"{root}/regions.geojson", "w") as f:
        json.dump(fc, f, indent=1)
    e = read_edges(spark, f"{root}/regions.geojson")
    rows = e.groupBy("wilaya_id", "pos", "ring").count().orderBy("pos", "ring").collect()
    assert [(r.wilaya_id, r.pos, r.ring, r["count"]) for r in rows] == [(7, 0, 0, 4), (7, 0, 1, 4), (3, 1, 0, 4)]


def test_weather_payload_object_or_list(spark):
    schema = weather_payload_schema()
    def obj(k):
        daily = {"time": ["2024-01-01", "2024-01-02"]}
        daily.update({v: [float(k), float(k) + 0.5] for v in WEATHER_VARS})
        return {"latitude": 36.0, "longitude": 3.0, "daily": daily}
    bodies = spark.createDataFrame([(json.dumps([obj(1), obj(2)]), 0), (json.dumps(obj(3)), 1)],
                                   "value string, batch int")
    requests = spark.createDataFrame([(0, 0, 11), (0, 1, 12), (1, 0, 13)], "batch int, pos int, wilaya_id int")
    rows = payload_to_rows(bodies, requests, schema, WEATHER_VARS)
    got = sorted((r.wilaya_id, r.time, r.temperature_2m_max) for r in rows.collect())
    assert got == [(11, "2024-01-01", 1.0), (11, "2024-01-02", 1.5), (12, "2024-01-01", 2.0),
                   (12, "2024-01-02", 2.5), (13, "2024-01-01", 3.0), (13, "2024-01-02", 3.5)]
    assert set(rows.columns) >= set(WEATHER_VARS)


def test_bodies_rejected_and_layouts_by_header(spark):
    bodies = spark.createDataFrame([
        ("latitude,longitude,acq_date,acq_time,satellite,frp,type\n36.1,3.2,2024-01-01,130,N,5.5,0\n\n", "a"),
        ("longitude,latitude,acq_date,acq_time,satellite,frp\r\n3.3,36.4,2024-01-02,140,N20,1.0\r\n", "b"),
        ("Invalid API call.", "c"),
        ("latitude,longitude\n\n", "d")], "value string, source string")
    rows = parse_bodies(bodies).orderBy("source").collect()
    assert [(r.source, r.latitude, r.longitude, r.type) for r in rows] == [("a", 36.1, 3.2, 0), ("b", 36.4, 3.3, None)]
    audit = body_audit(bodies).first()
    assert (audit.accepted, audit.rejected) == (2, 2)


def test_read_detections_by_header_name(spark):
    from hazardpanel.sources.detections import read_detections
    root = _local(scratch_path(spark, "test-feeds"))
    os.makedirs(f"{root}/viirs", exist_ok=True)
    os.makedirs(f"{root}/nrt", exist_ok=True)
    with open(f"{root}/viirs/part.csv", "w") as f:
        f.write("latitude,longitude,bright_ti4,scan,track,acq_date,acq_time,satellite,instrument,"
                "confidence,version,bright_ti5,frp,daynight,type\n"
                "36.5,4.1,330.2,0.4,0.4,2024-07-01,112,N,VIIRS,n,2.0NRT,290.1,7.5,D,0\n")
    with open(f"{root}/nrt/part.csv", "w") as f:   # no `type`, columns in another order
        f.write("acq_date,latitude,longitude,frp,satellite,acq_time,confidence\n"
                "2024-07-02,36.6,4.2,3.25,N21,1301,h\n")
    df = read_detections(spark, [(f"{root}/viirs", {"data_quality": "SP"}),
                                 (f"{root}/nrt", {"data_quality": "NRT"}),
                                 (f"{root}/missing", {"data_quality": "SP"})])
    rows = sorted(df.collect(), key=lambda r: r.acq_date)
    assert [(r.latitude, r.acq_time, r.confidence, r.type, r.frp, r.data_quality) for r in rows] == [
        (36.5, 112, "n", 0, 7.5, "SP"), (36.6, 1301, "h", None, 3.25, "NRT")]
    assert dict(df.dtypes)["acq_date"] == "date" and dict(df.dtypes)["type"] == "int"


def test_weather_table_priority_and_batches(spark):
    from hazardpanel.sources.payload import requests_from_dim, weather_table
    root = _local(scratch_path(spark, "test-weather"))
    dim = spark.createDataFrame([(i, f"{i:02d}") for i in range(1, 6)], "wilaya_id int, wilaya_code string")
    req = {(r.batch, r.pos): r.wilaya_id for r in requests_from_dim(dim, 2).collect()}
    assert req == {(0, 0): 1, (0, 1): 2, (1, 0): 3, (1, 1): 4, (2, 0): 5}

    def body(ids, days, base):
        objs = []
        for i in ids:
            daily = {"time": days}
            daily.update({v: [base + i] * len(days) for v in WEATHER_VARS})
            objs.append({"daily": daily})
        return json.dumps(objs if len(objs) > 1 else objs[0])

    for name, days, base in (("hist", ["2024-01-01", "2024-01-02"], 100.0), ("cur", ["2024-01-02", "2024-01-03"], 200.0)):
        for batch, ids in ((0, [1, 2]), (1, [3, 4]), (2, [5])):
            os.makedirs(f"{root}/{name}/batch={batch}", exist_ok=True)
            with open(f"{root}/{name}/batch={batch}/part.txt", "w") as f:
                f.write(body(ids, days, base) + "\n")
    t = weather_table([f"{root}/hist", f"{root}/cur"], dim, spark, batch_size=2)
    got = {(r.wilaya_id, r.date.isoformat()): r.rain_sum for r in t.collect()}
    assert len(got) == 15
    assert got[(3, "2024-01-02")] == 103.0       # overlap: the first source wins
    assert got[(5, "2024-01-03")] == 205.0


def test_multipolygon_feature(spark):
    from hazardpanel.operators.spatial import assign_region, polygon_measures
    root = _local(scratch_path(spark, "test-multipolygon"))
    os.makedirs(root, exist_ok=True)
    a = [[0, 0], [1, 0], [1, 1], [0, 1], [0, 0]]
    b = [[5, 5], [6, 5], [6, 6], [5, 6], [5, 5]]
    fc = {"type": "FeatureCollection", "features": [
        {"type": "Feature", "properties": {"wilaya_id": "1"},
         "geometry": {"type": "MultiPolygon", "coordinates": [[a], [b]]}},
        {"type": "Feature", "properties": {"wilaya_id": "2"},
         "geometry": {"type": "Polygon", "coordinates": [b]}}]}
    with open(f"{root}/mp.geojson", "w") as f:
        json.dump(fc, f)
    edges = read_edges(spark, f"{root}/mp.geojson")
    assert sorted({(r.wilaya_id, r.part) for r in edges.collect()}) == [(1, 0), (1, 1), (2, 0)]
    pts = spark.createDataFrame([(0, 0.5, 0.5), (1, 5.5, 5.5), (2, 3.0, 3.0)], "pid int, longitude double, latitude double")
    got = {r.pid: r.wilaya_id for r in assign_region(pts, edges).collect()}
    assert got == {0: 1, 1: 1, 2: None}                     # region 1 comes first in the file
    area = {r.wilaya_id: r.area_km2 for r in polygon_measures(edges).collect()}
    assert area[1] > area[2] > 0


def test_weather_from_region_files(spark):
    from hazardpanel.sources.payload import coverage, weather_from_region_files
    root = _local(scratch_path(spark, "test-region-files"))
    header = "time," + ",".join(WEATHER_VARS) + ",wilaya_id,wilaya_code\n"
    for folder, regions, value in (("old", (1, 2), 1.0), ("new", (2, 3), 2.0)):
        os.makedirs(f"{root}/{folder}", exist_ok=True)
        for rid in regions:
            with open(f"{root}/{folder}/wilaya_{rid:02d}.csv", "w") as f:
                f.write(header)
                for day in ("2024-01-01", "2024-01-02"):
                    f.write(day + "," + ",".join(str(value) for _ in WEATHER_VARS) + f",{rid},{rid:02d}\n")
    t = weather_from_region_files(spark, [f"{root}/old", f"{root}/new"])
    got = {(r.wilaya_id, r.date.isoformat()): r.rain_sum for r in t.collect()}
    assert got == {(1, "2024-01-01"): 1.0, (1, "2024-01-02"): 1.0, (2, "2024-01-01"): 1.0,
                   (2, "2024-01-02"): 1.0, (3, "2024-01-01"): 2.0, (3, "2024-01-02"): 2.0}
    dim = spark.createDataFrame([(i,) for i in range(1, 5)], "wilaya_id int")
    cov = coverage(t, dim, "wilaya_id").first()
    assert (cov.n_covered, cov.n_total) == (3, 4)


def _land(root, files):
    import os
    for name, text in files.items():
        os.makedirs(os.path.dirname(f"{root}/{name}"), exist_ok=True)
        with open(f"{root}/{name}", "w") as f:
            f.write(text)


def test_files_of_different_headers_are_read_by_name(spark, tmp_path):
    from hazardpanel.sources.detections import read_csv_by_header, scan_glob, unreadable
    head = "latitude,longitude,acq_date,acq_time,satellite"
    _land(tmp_path, {
        "sp/a.csv": f"{head},frp,type\n1.5,2.5,2024-01-01,10,N,7,2.0\n1.5,2.5,2024-01-02,10,N,8,0.0\n1.5,2.5,2024-01-03,10,N,9,\n1.5,2.5,2024-01-04,10,N,9,n.k.\n",
        "sp/b.csv": f"type,{head},frp\n3,4.5,5.5,2024-01-01,10,N,1\n",
        "nrt/c.csv": f"{head},bright,frp\n1.5,2.5,2024-01-01,10,N,300,7\n",
        "nrt/d.csv": f"frp,{head}\n11,9.5,8.5,2024-01-01,10,N\n",
        "nrt/empty.csv": ""})
    got = sorted(((r.source, r.latitude, r.acq_date.day, r.frp, r.type) for r in scan_glob(spark, f"{tmp_path}/*/*.csv").collect()), key=str)
    assert got == sorted([("sp", 1.5, 1, 7.0, 2), ("sp", 1.5, 2, 8.0, 0), ("sp", 1.5, 3, 9.0, None), ("sp", 1.5, 4, 9.0, -1), ("sp", 4.5, 1, 1.0, 3),
                          ("nrt", 1.5, 1, 7.0, None), ("nrt", 9.5, 1, 11.0, None)], key=str)
    assert unreadable(scan_glob(spark, f"{tmp_path}/*/*.csv"), ["source"]).filter("n_unreadable > 0").collect()[0].asDict() == {"source": "sp", "n_unreadable": 1}
    from hazardpanel.schemas import DETECTION_CSV
    assert read_csv_by_header(spark, f"{tmp_path}/nrt", DETECTION_CSV).filter("frp = 11").count() == 1


def test_bodies_with_short_and_quoted_lines(spark):
    head = "latitude,longitude,acq_date,acq_time,satellite,remark,frp"
    bodies = spark.createDataFrame([
        (f'{head}\n1.5,2.5,2024-01-01,10,N,"a, b",7\n1.5,2.5\n1.5,2.5,2024-01-02,10,N,x,8,9,10\n3.5,2.5,2024-01-03,11,N20,,\n', "s"),
        (f"frp,{head[:-4]}\r\n4,9.5,8.5,2024-01-01,12,N,q\r\n", "t"), ("Invalid API call.", "s"), (f"{head}\n", "s"), (None, "s")], "value string, source string")
    got = sorted((r.source, r.latitude, r.satellite, r.frp) for r in parse_bodies(bodies).fillna(-1.0).collect())
    assert got == [("s", 1.5, "N", 7.0), ("s", 3.5, "N20", -1.0), ("t", 9.5, "N", 4.0)]
    assert body_audit(bodies).first().asDict() == {"accepted": 2, "rejected": 3, "corrupt_lines": 2}


def test_unreadable_payloads_stop_the_job_or_are_counted(spark):
    from hazardpanel.schemas import weather_payload_schema
    from hazardpanel.sources.payload import payload_audit, payload_to_rows
    element = weather_payload_schema(["rain_sum"])
    good = '[{"daily":{"time":["2024-01-01"],"rain_sum":[1.5]}}]'
    requests = spark.createDataFrame([(7, 0, 0)], "wilaya_id int, batch int, pos int")
    for bad in (good[:-20], '{"error":true,"reason":"limit"}', "[]", "", None):
        bodies = spark.createDataFrame([(good, 0), (bad, 0)], "value string, batch int")
        with pytest.raises(Exception, match="payload body cannot be read"):
            payload_to_rows(bodies, requests, element, ["rain_sum"]).collect()
        assert [(r.wilaya_id, r.rain_sum) for r in payload_to_rows(bodies, requests, element, ["rain_sum"], skip_unreadable=True).collect()] == [(7, 1.5)]
        assert payload_audit(bodies, element).first().asDict() == {"accepted": 1, "rejected": 1}


def test_multipolygons_and_holes_survive_a_round_trip(spark, tmp_path):
    import json

    from hazardpanel.sources.geojson import edges_to_features, features_to_edges, read_features, write_features
    box = lambda part, ring, x, y, s: [(3, 0, part, ring, i, *a, *b) for i, (a, b) in enumerate(zip(
        [(x, y), (x + s, y), (x + s, y + s), (x, y + s)], [(x + s, y), (x + s, y + s), (x, y + s), (x, y)]))]
    rows = box(0, 0, 0.0, 0.0, 4.0) + box(0, 1, 1.0, 1.0, 1.0) + box(1, 0, 10.0, 0.0, 2.0) + [(4, 1, *r[2:]) for r in box(0, 0, 20.0, 20.0, 1.0)]
    edges = spark.createDataFrame(rows, "wilaya_id int, pos int, part int, ring int, edge_no int, x1 double, y1 double, x2 double, y2 double")
    write_features(edges_to_features(edges), f"{tmp_path}/f")
    texts = [json.loads(r.value) for r in spark.read.text(f"{tmp_path}/f").collect()]
    assert {t["properties"]["wilaya_id"]: t["geometry"]["type"] for t in texts} == {3: "MultiPolygon", 4: "Polygon"}
    assert [len(p) for t in texts if t["properties"]["wilaya_id"] == 3 for p in t["geometry"]["coordinates"]] == [2, 1]
    back = features_to_edges(read_features(spark, f"{tmp_path}/f", collection=False))
    assert sorted(map(tuple, back.select(edges.columns).collect())) == sorted(rows)
