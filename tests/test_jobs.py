"""End-to-end jobs over landed files (regions → rebuild → spots → refresh → train)."""

import json
import os

from pyspark.sql import functions as F

from hazardpanel import fixtures as fx
from hazardpanel import jobs, landing
from hazardpanel.constants import OFFICIAL_REGION_CODES, WEATHER_VARS
from hazardpanel.operators.panel import dense_grid
from hazardpanel.queries import q_fused_panel
from hazardpanel.session import scratch_path
from hazardpanel.sources.geojson import edges_to_features
from tests.conftest import SF_SMALL


def _local(path):
    return path[len("file:"):] if path.startswith("file:") else path


def _feature_collection(spark, path):
    feats = []
    for row in edges_to_features(fx.edges(spark, SF_SMALL)).orderBy("pos").collect():
        feature = json.loads(row.json)
        feature["properties"] = {"NAME_1": OFFICIAL_REGION_CODES[row.wilaya_id][0]}
        feats.append(feature)
    with open(path, "w") as f:
        json.dump({"type": "FeatureCollection", "features": feats}, f)


def test_jobs_end_to_end(spark):
    root = _local(scratch_path(spark, "test-jobs"))
    os.makedirs(root, exist_ok=True)
    _feature_collection(spark, f"{root}/regions.geojson")
    dim = jobs.job_regions(spark, f"{root}/regions.geojson", f"{root}/dim")
    assert dim.count() == 25
    assert [r.wilaya_code for r in dim.orderBy("wilaya_id").collect()][:3] == ["01", "02", "03"]

    feeds_root, sources = landing.land_detection_feeds(spark, SF_SMALL)
    feeds = [f"{p}={t['data_quality']}" for p, t in sources if "absent" not in p]
    feeds = [f for f in feeds if "/sp/" in f] + [f for f in feeds if "/nrt/" in f]   # science feeds first
    det = fx.detections(spark, SF_SMALL)
    days = det.select(F.col("acq_date").alias("date")).distinct()
    weather = (dense_grid(spark.read.parquet(f"{root}/dim/regions"), "wilaya_id", days)
               .select("wilaya_id", "date", *[(F.dayofmonth("date") / F.lit(3.0) + F.col("wilaya_id")).alias(v)
                                              for v in WEATHER_VARS]))
    weather.write.parquet(f"{root}/weather")
    panel = jobs.job_rebuild(spark, feeds, f"{root}/dim", f"{root}/weather", f"{root}/out")
    written = spark.read.parquet(f"{root}/out/panel")
    assert written.count() == 25 * days.count()
    want = q_fused_panel(spark, SF_SMALL).agg(F.sum("nb_detections")).first()[0]
    assert written.agg(F.sum("nb_detections")).first()[0] == want
    assert spark.read.parquet(f"{root}/out/forest_panel").select("wilaya_id").distinct().count() \
        == dim.filter("is_forest_zone").count()

    spots = jobs.job_spots(spark, f"{feeds_root}/*/feed=*", f"{root}/spots")
    assert spots.count() >= 1

    frozen = written.filter(F.col("date") < F.lit("2024-01-10"))
    frozen.write.parquet(f"{root}/frozen")
    stored = spark.createDataFrame([], "wilaya_id int, wilaya_code string, date date, nb_detections long, "
                                       "frp_total double, frp_max double, fire_detected int")
    stored.write.parquet(f"{root}/stored_daily")
    res = jobs.job_refresh(spark, f"{root}/frozen", f"{root}/stored_daily", feeds, f"{root}/weather",
                           f"{root}/dim", f"{root}/spots", f"{root}/refresh", as_of="2024-01-31")
    assert res.new_daily.agg(F.min("date")).first()[0] >= __import__("datetime").date(2024, 1, 17)     # 14 days back
    assert str(res.period_start) == "2024-01-10"
    cur = spark.read.parquet(f"{root}/refresh/current_panel")
    assert cur.agg(F.min("date")).first()[0].isoformat() == "2024-01-10"
    assert cur.filter(~F.col("fire_data_coverage")).count() == 0

    metrics = jobs.job_train(spark, f"{root}/out/panel", f"{root}/model", max_iter=3,
                             era_start="2024-01-01", train_end="2024-01-20", dryness=True,
                             importance_rows=500, repeats=2)
    assert sorted(r.variant for r in metrics.collect()) == ["A_ref", "B_dow", "C_balanced", "D_dow_balanced"]
    assert os.path.isdir(f"{root}/model/model/pipeline")
    assert spark.read.json(f"{root}/model/importance").count() > 0
    assert spark.read.json(f"{root}/model/calibration").count() > 0

    strict = jobs.job_rebuild(spark, feeds, f"{root}/dim", f"{root}/weather", f"{root}/strict",
                              strict=True, coverage=False, write_points=True)
    assert "fire_data_coverage" not in strict.columns
    assert spark.read.parquet(f"{root}/strict/detections_with_region").count() == \
        fx.detections(spark, SF_SMALL).dropDuplicates(["latitude", "longitude", "acq_date", "acq_time",
                                                        "satellite"]).count()
    assert spark.read.json(f"{root}/out/reports/summary").first()["n_rows"] == 25 * days.count()
    funnel = {r.stage: r.n_rows for r in spark.read.json(f"{root}/out/reports/funnel").collect()}
    assert funnel["raw"] == fx.detections(spark, SF_SMALL).count() >= funnel["dedup"] >= funnel["matched"] >= funnel["persistence_kept"] > 0
    assert spark.read.json(f"{root}/out/reports/uncovered_days").first()["uncovered_days"] == 0
    card = spark.read.json(f"{root}/model/model/metrics").first()
    assert len(card.features) == (27 if "dow" in card.variant else 24) and card.n_train + card.n_test == 25 * days.count() and 0 <= card.train_base_rate <= 1
    assert {r.metric for r in spark.read.json(f"{root}/model/delta").collect()} == {"roc_auc", "pr_auc", "brier"}
    features = spark.read.text(f"{root}/dim/features").collect()
    assert len(features) == 25 and json.loads(features[0].value)["properties"]["wilaya_id"] == 1


def test_refresh_in_place_replaces_only_the_window(spark):
    import datetime as dt

    from hazardpanel.plans.refresh import partition_days
    root = _local(scratch_path(spark, "test-in-place"))
    fx.region_dim(spark, SF_SMALL).write.parquet(f"{root}/dim/regions")
    fx.edges(spark, SF_SMALL).write.parquet(f"{root}/dim/edges")
    fx.weather(spark, SF_SMALL).write.parquet(f"{root}/weather")
    fx.weather(spark, SF_SMALL).filter("date < '2024-01-05'").write.parquet(f"{root}/frozen")
    spark.createDataFrame([], "lat_grid double, lon_grid double, n_days_detected long").write.parquet(f"{root}/spots")
    _, sources = landing.land_detection_feeds(spark, SF_SMALL)
    feeds = [f"{p}={t['data_quality']}" for p, t in sources if "absent" not in p]
    old = [(1, "01", dt.date(2024, 1, d), 99, 1.0, 1.0, 1) for d in (6, 7, 20, 31)]
    schema = "wilaya_id long, wilaya_code string, date date, nb_detections long, frp_total double, frp_max double, fire_detected int"
    spark.createDataFrame(old, schema).write.partitionBy("date").parquet(f"{root}/daily")
    res = jobs.job_refresh(spark, f"{root}/frozen", f"{root}/daily", feeds, f"{root}/weather", f"{root}/dim", f"{root}/spots", f"{root}/out",
                           as_of="2024-01-31", in_place=True)
    new_days = {r.date for r in res.new_daily.select("date").distinct().collect()}
    assert set(partition_days(spark, f"{root}/daily", "date")) == {dt.date(2024, 1, 6), dt.date(2024, 1, 7)} | new_days
    kept = spark.read.parquet(f"{root}/daily").filter("nb_detections = 99")
    assert {r.date.day for r in kept.collect()} == {6, 7}


def test_archive_job(spark):
    root = _local(scratch_path(spark, "test-archive-job"))
    dim = spark.createDataFrame([(1, "01"), (2, "02")], "wilaya_id int, wilaya_code string")
    dim.write.parquet(f"{root}/dim/regions")

    def land(name, issued, value):
        days = [(issued + __import__("datetime").timedelta(days=d)).isoformat() for d in range(7)]
        objs = []
        for _ in (1, 2):
            daily = {"time": days}
            daily.update({v: [value] * 7 for v in WEATHER_VARS})
            objs.append({"daily": daily})
        os.makedirs(f"{root}/{name}/batch=0", exist_ok=True)
        with open(f"{root}/{name}/batch=0/part.txt", "w") as f:
            f.write(json.dumps(objs) + "\n")

    import datetime as dt
    land("f1", dt.date(2024, 1, 1), 10.0)
    jobs.job_archive(spark, f"{root}/f1", f"{root}/dim", f"{root}/archive", "2024-01-01")
    land("f2", dt.date(2024, 3, 5), 20.0)
    jobs.job_archive(spark, f"{root}/f2", f"{root}/dim", f"{root}/archive", "2024-03-05")
    arch = spark.read.parquet(f"{root}/archive")
    assert arch.count() == 14                               # Jan issue expired, 2 regions x 7 days
    assert {r.temperature_2m_max for r in arch.collect()} == {20.0}


def test_cli_entry_points(spark):
    root = _local(scratch_path(spark, "test-cli"))
    os.makedirs(root, exist_ok=True)
    _feature_collection(spark, f"{root}/regions.geojson")
    jobs.main(["regions", "--polygons", f"{root}/regions.geojson", "--out", f"{root}/dim"])
    assert spark.read.parquet(f"{root}/dim/regions").count() == 25
    feeds_root, _ = landing.land_detection_feeds(spark, SF_SMALL)
    jobs.main(["spots", "--feeds-glob", f"{feeds_root}/*/feed=*", "--out", f"{root}/spots"])
    assert spark.read.parquet(f"{root}/spots").count() >= 1
