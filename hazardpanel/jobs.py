"""Job entry points (``spark-submit -m``-style): one per panel workflow.

    python -m hazardpanel.jobs regions  --polygons P.geojson --out DIR
    python -m hazardpanel.jobs weather  (--payloads DIR ... | --region-files DIR ...) --regions DIR --out DIR
    python -m hazardpanel.jobs rebuild  --feed PATH=QUALITY ... --regions DIR --weather DIR --out DIR
    python -m hazardpanel.jobs spots    --feeds-glob GLOB --out DIR
    python -m hazardpanel.jobs refresh  --frozen DIR --stored-daily DIR --feed PATH=QUALITY ...
                                        --weather DIR --regions DIR --spots DIR --out DIR
                                        [--as-of YYYY-MM-DD] [--in-place]
    python -m hazardpanel.jobs train    --panel DIR --out DIR [--max-iter N] [--dryness]
    python -m hazardpanel.jobs archive  --forecasts DIR --regions DIR --archive DIR --as-of YYYY-MM-DD

Every job reads declared schemas, writes Parquet below ``--out`` and keeps
all heavy work on the cluster; the session settings come from
``spark-submit`` (``session.get_session`` only adds the library defaults).
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazardpanel.constants import (COVERAGE_START, ERA_START, FORECAST_RETENTION_DAYS, PERSISTENCE_THRESHOLD_DAYS,
                                   STATIC_FEATURES, TRAIN_END, WEATHER_VARS)
from hazardpanel.operators.dims import official_code_mapping
from hazardpanel.plans.rebuild import forest_panel, refresh_spot_list
from hazardpanel.plans.refresh import daily_refresh
from hazardpanel.plans.regions import build_region_dim
from hazardpanel.sources import committed, sinks
from hazardpanel.sources.detections import read_detections
from hazardpanel.sources.geojson import read_features


def _feeds(spark: SparkSession, specs) -> DataFrame:
    """``PATH=QUALITY`` feeds, listed in priority order (first wins on duplicates)."""
    sources = []
    for i, spec in enumerate(specs):
        path, _, quality = spec.rpartition("=")
        sources.append((path, {"data_quality": quality or "SP", "pri": i}))
    det = read_detections(spark, sources)
    # which of several rows with one key is kept depends on their content only
    return det.withColumn("event_id", F.xxhash64(*[F.col(c) for c in det.columns]))


def job_weather(spark: SparkSession, payloads, regions: str, out: str, batch_size: int = 29,
                region_files=None) -> DataFrame:
    """Weather table from landed payload folders or per-region CSV folders
    (priority order), with the per-year coverage report (regions present /
    regions in the dimension)."""
    from hazardpanel.sources.payload import coverage, weather_from_region_files, weather_table
    dim = spark.read.parquet(f"{regions}/regions")
    if region_files:
        table = weather_from_region_files(spark, region_files)
    else:
        table = weather_table(payloads, dim, spark, batch_size)
    sinks.write_parquet_by_year(table, f"{out}/weather")
    landed = spark.read.parquet(f"{out}/weather")
    coverage(landed, dim, "wilaya_id", ["year"]).write.mode("overwrite").parquet(f"{out}/coverage")
    return table


def job_regions(spark: SparkSession, polygons: str, out: str, extra_props=()) -> DataFrame:
    """Region dimension (``extra_props``: more feature properties to carry, as names
    in other scripts), its edges, and the regions as a feature file with their
    ids, codes and names."""
    from hazardpanel.sources.geojson import edges_to_features, write_features
    dim, edges = build_region_dim(read_features(spark, polygons), official_code_mapping(spark), extra_props=tuple(extra_props))
    dim.write.mode("overwrite").parquet(f"{out}/regions")
    edges.write.mode("overwrite").parquet(f"{out}/edges")
    props = spark.read.parquet(f"{out}/regions").select("wilaya_id", "wilaya_code", "wilaya_name", *extra_props, "is_forest_zone")
    write_features(edges_to_features(spark.read.parquet(f"{out}/edges"), props=props), f"{out}/features")
    return dim


def job_rebuild(spark: SparkSession, feeds, regions: str, weather: str, out: str,
                threshold: int = PERSISTENCE_THRESHOLD_DAYS, strict: bool = False,
                coverage: bool = True, write_points: bool = False) -> DataFrame:
    """Daily detections, dense panel, forest panel and their reports: summary, top
    regions, days without coverage, rows after each stage
    (``strict``: type 0 only, the first-generation rule; ``coverage=False``:
    no coverage flag column; ``write_points``: also every deduplicated
    detection with its region, a full extra pass over the feeds)."""
    from hazardpanel.operators.panel import fixed_layout, fuse_panel, panel_summary, top_regions, uncovered_days
    from hazardpanel.operators.spatial import assign_region
    from hazardpanel.plans.rebuild import detection_chain, panel_layout
    det = _feeds(spark, feeds)
    dim = spark.read.parquet(f"{regions}/regions")
    edges = spark.read.parquet(f"{regions}/edges")
    base = spark.read.parquet(weather)
    if "year" in base.columns:
        base = base.drop("year")
    chain = detection_chain(det, edges, dim, strict_type=strict, threshold=threshold, report=True)
    chain.daily.write.mode("overwrite").parquet(f"{out}/daily")
    daily = spark.read.parquet(f"{out}/daily")
    panel = fixed_layout(fuse_panel(base, daily, dim, coverage_start=COVERAGE_START if coverage else None),
                         panel_layout(base.columns, coverage))
    sinks.write_parquet_by_year(panel, f"{out}/panel")
    written = spark.read.parquet(f"{out}/panel").drop("year")
    forest = forest_panel(written)
    sinks.write_parquet_by_year(forest, f"{out}/forest_panel")
    covered = forest.filter(F.col("fire_data_coverage")) if coverage else forest
    panel_summary(written).write.mode("overwrite").json(f"{out}/reports/summary")
    top_regions(covered, 15).write.mode("overwrite").json(f"{out}/reports/top_regions")
    chain.funnel.write.mode("overwrite").json(f"{out}/reports/funnel")
    if coverage:
        uncovered_days(written).write.mode("overwrite").json(f"{out}/reports/uncovered_days")
    if write_points:
        assign_region(chain.deduped, edges).write.mode("overwrite").parquet(f"{out}/detections_with_region")
    return panel


def job_spots(spark: SparkSession, feeds_glob: str, out: str) -> DataFrame:
    return refresh_spot_list(spark, feeds_glob, out, source_regex=r"([^/]+)/[^/]+$")


def job_add_feed(spark: SparkSession, store: str, feed: str, name: str) -> int:
    """Take one landed feed into the stored spot list below ``store``."""
    from hazardpanel.plans.spots import update_spot_list
    return update_spot_list(spark, store, name, _feeds(spark, [feed]))


def stored_table(spark: SparkSession, path: str):
    """A stored table, committed or plain Parquet."""
    return committed.read(spark, path) if committed.versions(spark, path) else spark.read.parquet(path)


def replace_in_place(spark: SparkSession, path: str, new) -> None:
    """Replace the stored days from the first new one on: one commit on a committed table."""
    from hazardpanel.plans.refresh import commit_window_replace, write_window_replace
    if committed.versions(spark, path):
        commit_window_replace(spark, path, new)
        committed.vacuum(spark, path)
    else:
        write_window_replace(spark, path, new)


def job_refresh(spark: SparkSession, frozen: str, stored_daily: str, feeds, weather: str,
                regions: str, spots: str, out: str, as_of: str | None = None, in_place: bool = False):
    """Refresh of the current period from the feeds' last ``LOOKBACK_DAYS`` days
    before ``as_of`` (default: today); older rows of the feeds are not used, so
    the replaced window never starts earlier.  Writes ``out``/daily and
    ``out``/current_panel, or with ``in_place`` rewrites the changed days of a
    ``stored_daily`` table: a committed one, or plain Parquet partitioned by date."""
    import datetime as dt

    from hazardpanel.functions.dates import lookback_starts
    today = F.to_date(F.lit(as_of or dt.date.today().isoformat()))
    det = _feeds(spark, feeds).filter((F.col("acq_date") >= F.array_min(lookback_starts(today))) & (F.col("acq_date") <= today))
    res = daily_refresh(spark.read.parquet(frozen), stored_table(spark, stored_daily), det,
                        spark.read.parquet(weather), spark.read.parquet(f"{regions}/edges"),
                        spark.read.parquet(f"{regions}/regions"), stored_table(spark, spots))
    sinks.write_parquet_by_year(res.panel, f"{out}/current_panel")
    if in_place:
        replace_in_place(spark, stored_daily, res.new_daily)
    else:
        # a new folder: the stored table is read lazily by the same job
        res.daily.write.mode("overwrite").parquet(f"{out}/daily")
    return res


def job_train(spark: SparkSession, panel: str, out: str, max_iter: int = 400,
              era_start: str = ERA_START, train_end: str = TRAIN_END, dryness: bool = False,
              importance_rows: int = 8000, repeats: int = 5, baseline: str | None = None):
    """Variant grid (± weekday, ± balanced weights) on the v1 features (or v2
    with ``dryness``), best variant by PR-AUC, its card (features, rows, base
    rates, train AUC, test metrics), differences to the reference variant and to an
    earlier model (``baseline``), its calibration table and permutation importance
    on a seeded test sample, all written below ``out``."""
    from hazardpanel.operators import metrics as M
    from hazardpanel.operators import model as ML
    from hazardpanel.plans.training import DRYNESS, SEASON_FEATURES, metric_delta, model_card, model_table, variant_grid
    p = spark.read.parquet(panel).withColumnRenamed("fire_detected", "label")
    if "year" in p.columns:
        p = p.drop("year")
    table = model_table(p, "precipitation_sum", "temperature_2m_max", "et0_fao_evapotranspiration",
                        era_start, train_end, coverage_col="fire_data_coverage")
    train, test = table.filter(F.col("split") == "train"), table.filter(F.col("split") == "test")
    feats = WEATHER_VARS + (DRYNESS if dryness else []) + STATIC_FEATURES + SEASON_FEATURES
    metrics, models = variant_grid(train, test, feats, max_iter=max_iter)
    metrics.write.mode("overwrite").json(f"{out}/variant_metrics")
    best = M.best_by(spark.read.json(f"{out}/variant_metrics"), "variant", "pr_auc").first()["best_variant"]
    model = models[best]
    ML.save(model, f"{out}/model", model_card(model, best, train, test))
    metric_delta(spark.read.json(f"{out}/variant_metrics"), "A_ref").write.mode("overwrite").json(f"{out}/delta")
    if baseline:        # metrics of an earlier model, as this job wrote them
        earlier = spark.read.json(f"{baseline}/variant_metrics").select(F.concat(F.lit("baseline "), "variant").alias("variant"), "roc_auc", "pr_auc", "brier")
        both = spark.read.json(f"{out}/variant_metrics").select("variant", "roc_auc", "pr_auc", "brier").unionByName(earlier)
        first = M.best_by(earlier, "variant", "pr_auc").first()["best_variant"]
        metric_delta(both, first).write.mode("overwrite").json(f"{out}/delta_to_baseline")
    scored = ML.score(model, test)
    M.calibration_table(scored.withColumnRenamed("label", "y"), "proba", "y").write.mode("overwrite") \
        .json(f"{out}/calibration")
    sample = ML.seeded_sample(test, importance_rows, ["wilaya_id", "date"])
    ML.permutation_importance(model, sample, repeats=repeats).write.mode("overwrite").json(f"{out}/importance")
    return metrics


def job_archive(spark: SparkSession, forecasts: str, regions: str, archive: str, as_of: str,
                batch_size: int = 29, retention_days: int = FORECAST_RETENTION_DAYS) -> str:
    """Append today's 7-day forecast payloads to the rolling archive (keep the
    last issue per key, drop issues older than the retention)."""
    import datetime as dt

    from hazardpanel.plans.refresh import write_rolling_archive
    from hazardpanel.sources.payload import weather_table
    issued = dt.date.fromisoformat(as_of)
    dim = spark.read.parquet(f"{regions}/regions").select("wilaya_id")
    rows = weather_table([forecasts], dim, spark, batch_size).withColumnRenamed("date", "target_date")
    new = rows.withColumn("issued_date", F.lit(issued)).withColumn("arrival", F.unix_micros(F.current_timestamp()))
    return write_rolling_archive(spark, archive, new, issued, retention_days)


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="hazardpanel.jobs")
    sub = ap.add_subparsers(dest="job", required=True)
    a = sub.add_parser("regions"); a.add_argument("--polygons", required=True); a.add_argument("--out", required=True)
    a.add_argument("--extra-prop", action="append", default=[])
    b = sub.add_parser("rebuild"); b.add_argument("--feed", action="append", required=True)
    b.add_argument("--regions", required=True); b.add_argument("--weather", required=True)
    b.add_argument("--out", required=True); b.add_argument("--threshold", type=int, default=PERSISTENCE_THRESHOLD_DAYS)
    b.add_argument("--strict", action="store_true"); b.add_argument("--no-coverage", action="store_true")
    b.add_argument("--write-points", action="store_true")
    w = sub.add_parser("weather"); w.add_argument("--payloads", action="append")
    w.add_argument("--region-files", action="append")
    w.add_argument("--regions", required=True); w.add_argument("--out", required=True)
    w.add_argument("--batch-size", type=int, default=29)
    c = sub.add_parser("spots"); c.add_argument("--feeds-glob", required=True); c.add_argument("--out", required=True)
    f = sub.add_parser("add-feed")
    for k in ("store", "feed", "name"):
        f.add_argument(f"--{k}", required=True)
    d = sub.add_parser("refresh")
    for k in ("frozen", "stored-daily", "weather", "regions", "spots", "out"):
        d.add_argument(f"--{k}", required=True)
    d.add_argument("--feed", action="append", required=True)
    d.add_argument("--as-of"); d.add_argument("--in-place", action="store_true")
    e = sub.add_parser("train"); e.add_argument("--panel", required=True); e.add_argument("--out", required=True)
    e.add_argument("--max-iter", type=int, default=400); e.add_argument("--dryness", action="store_true")
    e.add_argument("--baseline")
    h = sub.add_parser("archive"); h.add_argument("--forecasts", required=True)
    h.add_argument("--regions", required=True); h.add_argument("--archive", required=True)
    h.add_argument("--as-of", required=True)
    args = ap.parse_args(argv)

    from hazardpanel.session import get_session
    spark = get_session()
    if args.job == "regions":
        job_regions(spark, args.polygons, args.out, args.extra_prop)
    elif args.job == "rebuild":
        job_rebuild(spark, args.feed, args.regions, args.weather, args.out, args.threshold,
                    strict=args.strict, coverage=not args.no_coverage, write_points=args.write_points)
    elif args.job == "weather":
        job_weather(spark, args.payloads, args.regions, args.out, args.batch_size, args.region_files)
    elif args.job == "spots":
        job_spots(spark, args.feeds_glob, args.out)
    elif args.job == "add-feed":
        job_add_feed(spark, args.store, args.feed, args.name)
    elif args.job == "refresh":
        job_refresh(spark, args.frozen, args.stored_daily, args.feed, args.weather, args.regions,
                    args.spots, args.out, args.as_of, args.in_place)
    elif args.job == "train":
        job_train(spark, args.panel, args.out, args.max_iter, dryness=args.dryness, baseline=args.baseline)
    elif args.job == "archive":
        job_archive(spark, args.forecasts, args.regions, args.archive, args.as_of)


if __name__ == "__main__":
    main()
