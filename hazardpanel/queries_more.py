"""Further registered queries: dimensions, windows, archive, metrics."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from hazardpanel import fixtures as fx
from hazardpanel.fixtures import FIXTURE_NON_FOREST
from hazardpanel.functions.scalar import coverage_flag, round_half_even, source_name, zero_pad
from hazardpanel.operators import metrics as M
from hazardpanel.operators.blocks import dryness_in_blocks
from hazardpanel.operators.dedup import dedup_keep_last
from hazardpanel.operators.dims import flag_not_in, map_or_fail, semi_by_flag, surrogate_id
from hazardpanel.operators.features import temporal_split, with_month_cyclic, with_weekday_cyclic
from hazardpanel.operators.panel import fixed_layout, uncovered_days
from hazardpanel.operators.windows import (dryness_features, lag_prev_day, prior_mean, prior_sum,
                                           topk_per_group, with_days_since)
from hazardpanel.oracle import sql
from hazardpanel.queries import register

NF = ", ".join(f"'{n}'" for n in FIXTURE_NON_FOREST)
DIGITS = 9   # cross-engine stable digits for float metrics

# fixture parameters for the weather-panel dates (1995..2001)
FIX_COVERAGE_START = "1995-06-01"
FIX_ERA_START = "1996-01-01"
FIX_TRAIN_END = "1999-12-31"
FIX_FROZEN_END = "2000-01-01"

W = "WINDOW w AS (PARTITION BY wilaya_id ORDER BY date)"
W7 = "(PARTITION BY wilaya_id ORDER BY date ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)"
W30 = "(PARTITION BY wilaya_id ORDER BY date ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING)"


def _psum(col, w, m):
    return (f"CASE WHEN count({col}) OVER {w} >= {m} "
            f"THEN round(sum({col}) OVER {w}, 6) END")


def _pmean(col, w, m):
    return (f"CASE WHEN count({col}) OVER {w} >= {m} "
            f"THEN round(sum({col}) OVER {w}, 6) / count({col}) OVER {w} END")


DRYNESS_SQL = f"""
SELECT wilaya_id, date, precipitation, temp_max, et0,
  {_psum('precipitation', W7, 4)} AS precip_sum_7d,
  {_psum('precipitation', W30, 15)} AS precip_sum_30d,
  {_pmean('temp_max', W7, 4)} AS temp_max_mean_7d,
  {_psum('et0', W30, 15)} AS et0_sum_30d,
  CAST(least(rn - coalesce(max(CASE WHEN coalesce(prev >= 1.0, false) THEN rn END) OVER
        (PARTITION BY wilaya_id ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 1), 90)
       AS INTEGER) AS days_since_rain,
  sin(2*pi()*month(date)/12) AS month_sin, cos(2*pi()*month(date)/12) AS month_cos
FROM (SELECT *, row_number() OVER (PARTITION BY wilaya_id ORDER BY date) AS rn,
             lag(precipitation) OVER (PARTITION BY wilaya_id ORDER BY date) AS prev FROM weather_panel) t
"""


# ---------------------------------------------------------------- dimension
@register("dim_broadcast_join", sql("""
SELECT w.*, r.wilaya_name, r.area_km2, r.centroid_lat, r.centroid_lon, r.is_forest_zone
FROM weather_panel w LEFT JOIN region_dim r ON r.wilaya_id = w.wilaya_id""", "weather_panel", "region_dim"))
def q_dim_broadcast_join(spark, sf):
    dim = fx.region_dim(spark, sf).select("wilaya_id", "wilaya_name", "area_km2", "centroid_lat",
                                          "centroid_lon", "is_forest_zone")
    return fx.weather_panel(spark, sf).join(dim, "wilaya_id", "left")


@register("map_or_fail", """
SELECT s.s_suppkey, n.n_name AS wilaya_name, lpad(CAST(n.n_nationkey AS VARCHAR), 2, '0') AS wilaya_code
FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey""")
def q_map_or_fail(spark, sf):
    sup = fx.table(spark, sf, "supplier")
    nat = fx.table(spark, sf, "nation")
    names = sup.join(nat, sup.s_nationkey == nat.n_nationkey).select("s_suppkey", F.col("n_name").alias("wilaya_name"))
    mapping = nat.select("n_name", zero_pad("n_nationkey").alias("code"))
    return map_or_fail(names, "wilaya_name", mapping, "n_name", "code", "wilaya_code")


@register("flag_not_in", f"""
SELECT n_nationkey AS wilaya_id, n_name AS wilaya_name, coalesce(n_name NOT IN ({NF}), false) AS is_forest_zone
FROM nation""")
def q_flag_not_in(spark, sf):
    nat = fx.table(spark, sf, "nation").select(F.col("n_nationkey").alias("wilaya_id"),
                                                F.col("n_name").alias("wilaya_name"))
    return flag_not_in(nat, "wilaya_name", FIXTURE_NON_FOREST)


@register("filter_flag", sql("SELECT wilaya_id, wilaya_name FROM region_dim WHERE is_forest_zone", "region_dim"))
def q_filter_flag(spark, sf):
    return fx.region_dim(spark, sf).filter(F.col("is_forest_zone")).select("wilaya_id", "wilaya_name")


@register("forest_semi_join", sql("""
SELECT * FROM panel WHERE wilaya_id IN (SELECT wilaya_id FROM region_dim WHERE is_forest_zone)""",
    "panel", "region_dim"))
def q_forest_semi_join(spark, sf):
    from hazardpanel.queries import q_fused_panel
    return semi_by_flag(q_fused_panel(spark, sf), fx.region_dim(spark, sf), "wilaya_id", "is_forest_zone")


@register("inner_code_join", sql("""
SELECT r.wilaya_id, r.wilaya_code, r.wilaya_name, g.n_edges
FROM (SELECT lpad(CAST(wilaya_id AS VARCHAR), 2, '0') AS wilaya_code, count(*) AS n_edges
      FROM edges GROUP BY 1) g
JOIN region_dim r ON r.wilaya_code = g.wilaya_code""", "edges", "region_dim"))
def q_inner_code_join(spark, sf):
    geo = (fx.edges(spark, sf).groupBy(zero_pad("wilaya_id").alias("wilaya_code"))
           .agg(F.count(F.lit(1)).alias("n_edges")))
    dim = fx.region_dim(spark, sf).select("wilaya_id", "wilaya_code", "wilaya_name")
    return geo.join(dim, "wilaya_code", "inner").select("wilaya_id", "wilaya_code", "wilaya_name", "n_edges")


@register("surrogate_id", sql("""
SELECT wilaya_code, wilaya_name, row_number() OVER (ORDER BY wilaya_code) AS surrogate_id
FROM region_dim""", "region_dim"))
def q_surrogate_id(spark, sf):
    return surrogate_id(fx.region_dim(spark, sf).select("wilaya_code", "wilaya_name"), "wilaya_code")


@register("fixed_layout", sql("""
SELECT wilaya_id, wilaya_code, wilaya_name, zone_name AS wilaya_zone, area_km2, centroid_lat, centroid_lon
FROM region_dim""", "region_dim"))
def q_fixed_layout(spark, sf):
    d = fx.region_dim(spark, sf).withColumnRenamed("zone_name", "wilaya_zone").drop("is_forest_zone")
    return fixed_layout(d, ["wilaya_id", "wilaya_code", "wilaya_name", "wilaya_zone", "area_km2",
                            "centroid_lat", "centroid_lon"])


@register("text_helpers", """
SELECT n.n_nationkey AS wilaya_id, lower(trim(r.r_name)) AS source,
       lpad(CAST(n.n_nationkey AS VARCHAR), 2, '0') AS wilaya_code,
       string_split(n.n_name, '_')[2] AS name_suffix, CAST(len(string_split(n.n_name, '_')) AS INTEGER) AS n_tokens,
       trim('  ' || n.n_name || ' ') AS name_trimmed
FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey""")
def q_text_helpers(spark, sf):
    nat = fx.table(spark, sf, "nation")
    reg = fx.table(spark, sf, "region")
    j = nat.join(reg, nat.n_regionkey == reg.r_regionkey)
    parts = F.split(F.col("n_name"), "_")
    return j.select(F.col("n_nationkey").alias("wilaya_id"), source_name("r_name").alias("source"),
                    zero_pad("n_nationkey").alias("wilaya_code"), parts.getItem(1).alias("name_suffix"),
                    F.size(parts).alias("n_tokens"),
                    F.trim(F.concat(F.lit("  "), F.col("n_name"), F.lit(" "))).alias("name_trimmed"))


# ---------------------------------------------------------------- windows / time series
@register("lag_prev_day", sql("""
SELECT wilaya_id, date, precipitation, lag(precipitation) OVER w AS precipitation_prev
FROM weather_panel """ + W, "weather_panel"))
def q_lag_prev_day(spark, sf):
    wp = fx.weather_panel(spark, sf).select("wilaya_id", "date", "precipitation")
    return lag_prev_day(wp, "precipitation")


ROLLING_SQL = f"""
SELECT wilaya_id, date, {_psum('precipitation', W7, 4)} AS precip_sum_7d,
       {_psum('precipitation', W30, 15)} AS precip_sum_30d,
       {_pmean('temp_max', W7, 4)} AS temp_max_mean_7d, {_psum('et0', W30, 15)} AS et0_sum_30d
FROM weather_panel"""


@register("rolling_prior", sql(ROLLING_SQL, "weather_panel"))
def q_rolling_prior(spark, sf):
    wp = fx.weather_panel(spark, sf)
    return wp.select("wilaya_id", "date",
                     prior_sum("precipitation", 7, 4, "wilaya_id", "date").alias("precip_sum_7d"),
                     prior_sum("precipitation", 30, 15, "wilaya_id", "date").alias("precip_sum_30d"),
                     prior_mean("temp_max", 7, 4, "wilaya_id", "date").alias("temp_max_mean_7d"),
                     prior_sum("et0", 30, 15, "wilaya_id", "date").alias("et0_sum_30d"))


DAYS_SINCE_SQL = """
SELECT wilaya_id, date, CAST(least(rn - coalesce(max(CASE WHEN coalesce(prev >= 1.0, false) THEN rn END) OVER
        (PARTITION BY wilaya_id ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 1), 90)
       AS INTEGER) AS days_since_rain
FROM (SELECT *, row_number() OVER (PARTITION BY wilaya_id ORDER BY date) AS rn,
             lag(precipitation) OVER (PARTITION BY wilaya_id ORDER BY date) AS prev FROM weather_panel) t"""


@register("days_since_event", sql(DAYS_SINCE_SQL, "weather_panel"))
def q_days_since_event(spark, sf):
    wp = fx.weather_panel(spark, sf).select("wilaya_id", "date", "precipitation")
    prev = F.lag("precipitation", 1).over(Window.partitionBy("wilaya_id").orderBy("date"))
    flagged = wp.withColumn("_rained", prev >= F.lit(1.0))
    return with_days_since(flagged, "_rained", "days_since_rain").select(
        "wilaya_id", "date", F.col("days_since_rain").cast("int"))


BLOCKS_IN_QUERIES = 365     # rows: several blocks in each of the panel's series


@register("rolling_prior_blocked", sql(ROLLING_SQL, "weather_panel"))
def q_rolling_prior_blocked(spark, sf):
    out = dryness_in_blocks(fx.weather_panel(spark, sf), precip="precipitation", temp="temp_max", et0="et0",
                            block_rows=BLOCKS_IN_QUERIES)
    return out.select("wilaya_id", "date", "precip_sum_7d", "precip_sum_30d", "temp_max_mean_7d", "et0_sum_30d")


@register("days_since_blocked", sql(DAYS_SINCE_SQL, "weather_panel"))
def q_days_since_blocked(spark, sf):
    out = dryness_in_blocks(fx.weather_panel(spark, sf), precip="precipitation", temp="temp_max", et0="et0",
                            block_rows=BLOCKS_IN_QUERIES)
    return out.select("wilaya_id", "date", F.col("days_since_rain").cast("int"))


@register("dryness_features", sql(DRYNESS_SQL, "weather_panel"))
def q_dryness_features(spark, sf):
    wp = fx.weather_panel(spark, sf)
    out = dryness_features(wp, precip="precipitation", temp="temp_max", et0="et0")
    out = with_month_cyclic(out)
    return out.withColumn("days_since_rain", F.col("days_since_rain").cast("int"))


@register("month_cyclic", sql("""
SELECT wilaya_id, date, sin(2*pi()*month(date)/12) AS month_sin, cos(2*pi()*month(date)/12) AS month_cos
FROM weather_panel""", "weather_panel"))
def q_month_cyclic(spark, sf):
    return with_month_cyclic(fx.weather_panel(spark, sf).select("wilaya_id", "date"))


@register("weekday_cyclic", sql("""
SELECT wilaya_id, date, sin(2*pi()*(isodow(date)-1)/7) AS dow_sin, cos(2*pi()*(isodow(date)-1)/7) AS dow_cos,
       CAST((isodow(date)-1) IN (4, 5) AS INTEGER) AS is_weekend
FROM weather_panel""", "weather_panel"))
def q_weekday_cyclic(spark, sf):
    return with_weekday_cyclic(fx.weather_panel(spark, sf).select("wilaya_id", "date"))


@register("coverage_flag", sql(f"""
SELECT wilaya_id, date, date >= DATE '{FIX_COVERAGE_START}' AS fire_data_coverage, true AS daily_job_coverage
FROM weather_panel""", "weather_panel"))
def q_coverage_flag(spark, sf):
    wp = fx.weather_panel(spark, sf).select("wilaya_id", "date")
    return (wp.withColumn("fire_data_coverage", coverage_flag("date", FIX_COVERAGE_START))
              .withColumn("daily_job_coverage", F.lit(True)))


@register("uncovered_days", sql(f"""
SELECT CAST(count_if(NOT (date >= DATE '{FIX_COVERAGE_START}')) AS BIGINT) AS uncovered_rows,
       count(DISTINCT wilaya_id) AS n_regions,
       CAST(count_if(NOT (date >= DATE '{FIX_COVERAGE_START}')) // count(DISTINCT wilaya_id) AS BIGINT) AS uncovered_days
FROM weather_panel""", "weather_panel"))
def q_uncovered_days(spark, sf):
    wp = fx.weather_panel(spark, sf).withColumn("fire_data_coverage", coverage_flag("date", FIX_COVERAGE_START))
    return uncovered_days(wp)


@register("temporal_split", sql(f"""
SELECT wilaya_id, date, CASE WHEN date <= DATE '{FIX_TRAIN_END}' THEN 'train' ELSE 'test' END AS split
FROM weather_panel WHERE date >= DATE '{FIX_ERA_START}' AND date >= DATE '{FIX_COVERAGE_START}'""",
    "weather_panel"))
def q_temporal_split(spark, sf):
    wp = fx.weather_panel(spark, sf).select("wilaya_id", "date")
    wp = wp.withColumn("fire_data_coverage", coverage_flag("date", FIX_COVERAGE_START))
    return temporal_split(wp, FIX_ERA_START, FIX_TRAIN_END).select("wilaya_id", "date", "split")


@register("next_period_start", sql(f"""
SELECT max(date) + 1 AS period_start FROM weather_panel WHERE date < DATE '{FIX_FROZEN_END}'""",
    "weather_panel"))
def q_next_period_start(spark, sf):
    from hazardpanel.plans.refresh import next_period_start
    frozen = fx.weather_panel(spark, sf).filter(F.col("date") < F.to_date(F.lit(FIX_FROZEN_END)))
    return next_period_start(frozen)


@register("window_plan", sql("""
WITH b AS (SELECT satellite, min(acq_date) AS lo, max(acq_date) AS hi FROM detections GROUP BY satellite),
w AS (SELECT satellite, lo, CAST(unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 5 DAY)) AS DATE) AS window_start FROM b),
l AS (SELECT d.satellite, b.lo + CAST(5 * ((d.acq_date - b.lo) // 5) AS INTEGER) AS window_start, count(*) AS n_rows
      FROM detections d JOIN b ON b.satellite = d.satellite GROUP BY 1, 2)
SELECT w.satellite, w.window_start, coalesce(l.n_rows, 0) AS n_rows, l.n_rows IS NOT NULL AS landed
FROM w LEFT JOIN l ON l.satellite = w.satellite AND l.window_start = w.window_start""", "detections"))
def q_window_plan(spark, sf):
    from hazardpanel.functions.dates import window_plan
    det = fx.detections(spark, sf)
    bounds = det.groupBy("satellite").agg(F.min("acq_date").alias("lo"), F.max("acq_date").alias("hi"))
    return window_plan(bounds, det, "satellite", "acq_date", 5)


@register("sorted_panel", sql("SELECT * FROM weather_panel ORDER BY wilaya_id, date", "weather_panel"))
def q_sorted_panel(spark, sf):
    # no explicit partition count: AQE coalesces the range partitions to the advisory size
    return fx.weather_panel(spark, sf).repartitionByRange("wilaya_id", "date") \
        .sortWithinPartitions("wilaya_id", "date")


# ---------------------------------------------------------------- forecast archive
@register("dedup_keep_last", sql("""
SELECT issued_date, target_date, wilaya_id, temperature_2m_max, arrival FROM (
  SELECT *, row_number() OVER (PARTITION BY issued_date, target_date, wilaya_id ORDER BY arrival DESC) AS rn
  FROM forecast_log) t WHERE rn = 1""", "forecast_log"))
def q_dedup_keep_last(spark, sf):
    return dedup_keep_last(fx.forecast_log(spark, sf), ["issued_date", "target_date", "wilaya_id"], ["arrival"])


@register("rolling_archive", sql("""
SELECT issued_date, target_date, wilaya_id, temperature_2m_max, arrival FROM (
  SELECT *, row_number() OVER (PARTITION BY issued_date, target_date, wilaya_id ORDER BY arrival DESC) AS rn
  FROM forecast_log) t
WHERE rn = 1 AND issued_date >= (SELECT max(issued_date) FROM forecast_log) - 60""", "forecast_log"))
def q_rolling_archive(spark, sf):
    from hazardpanel.plans.refresh import rolling_archive
    log = fx.forecast_log(spark, sf)
    as_of = log.agg(F.max("issued_date")).first()[0]
    return rolling_archive(log, None, as_of)


# ---------------------------------------------------------------- metrics
@register("metric_roc_auc", sql("""
WITH g AS (SELECT score, sum(y) AS p, sum(1 - y) AS n FROM scored GROUP BY score),
r AS (SELECT *, sum(n) OVER (ORDER BY score DESC) AS cum_n FROM g)
SELECT CAST(2 * sum(n) * sum(p) - sum(p * (2 * cum_n - n)) AS DOUBLE) / CAST(2 * sum(p) * sum(n) AS DOUBLE) AS roc_auc
FROM r""", "scored"))
def q_metric_roc_auc(spark, sf):
    return M.roc_auc(fx.scored(spark, sf), "score", "y")


_AP_SQL = """
WITH g AS (SELECT {s} AS s, sum(y) AS p, sum(1 - y) AS n FROM scored GROUP BY 1),
r AS (SELECT *, sum(p) OVER (ORDER BY s DESC) AS cum_p, sum(n) OVER (ORDER BY s DESC) AS cum_n FROM g)
SELECT round_even((sum(p * (CAST(cum_p AS DOUBLE) / CAST(cum_p + cum_n AS DOUBLE))) / CAST(sum(p) AS DOUBLE)) * 1e9, 0) / 1e9
       AS avg_precision FROM r"""


@register("metric_avg_precision", sql(_AP_SQL.format(s="score"), "scored"))
def q_metric_avg_precision(spark, sf):
    return M.average_precision(fx.scored(spark, sf), "score", "y", digits=DIGITS)


@register("metric_brier", sql("""
SELECT round_even(avg(pow(proba - y, 2)) * 1e9, 0) / 1e9 AS brier FROM scored""", "scored"))
def q_metric_brier(spark, sf):
    return M.brier(fx.scored(spark, sf), "proba", "y", digits=DIGITS)


@register("metric_base", sql("""
SELECT count(*) AS n_rows, CAST(sum(y) AS BIGINT) AS n_positive, CAST(sum(y) AS DOUBLE) / count(*) AS base_rate
FROM scored""", "scored"))
def q_metric_base(spark, sf):
    return M.base_metrics(fx.scored(spark, sf), "y")


def _qbins(col):
    return f"""
WITH e AS (SELECT list_distinct(quantile_cont({col}, [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0])) AS edges
           FROM scored)
SELECT s.*, CASE WHEN len(e.edges) < 2 THEN NULL
                 ELSE CAST(greatest(len(list_filter(e.edges, lambda x: x < s.{col})) - 1, 0) AS INTEGER) END AS bin
FROM scored s, e"""


@register("quantile_bins", sql(f"SELECT doc_id, score, bin FROM ({_qbins('score')}) t", "scored"))
def q_quantile_bins(spark, sf):
    return M.quantile_bins(fx.scored(spark, sf), "score", 10).select("doc_id", "score", "bin")


@register("calibration_table", sql(f"""
SELECT bin AS decile, round_even(avg(proba) * 1e9, 0) / 1e9 AS proba_mean,
       round_even(avg(CAST(y AS DOUBLE)) * 1e9, 0) / 1e9 AS observed_rate, count(*) AS n
FROM ({_qbins('proba')}) t GROUP BY bin""", "scored"))
def q_calibration_table(spark, sf):
    return M.calibration_table(fx.scored(spark, sf), "proba", "y", 10, digits=DIGITS)


@register("balanced_weights", sql("""
SELECT doc_id, y, CAST(count(*) OVER () AS DOUBLE) / (2e0 * count(*) OVER (PARTITION BY y)) AS weight
FROM scored""", "scored"))
def q_balanced_weights(spark, sf):
    return M.balanced_weights(fx.scored(spark, sf).select("doc_id", "y"), "y")


VARIANTS_SQL = """
WITH v AS (
  SELECT 'A_length' AS variant, doc_id, y, proba AS s FROM scored
  UNION ALL SELECT 'B_inverse', doc_id, y, 1 - proba FROM scored
  UNION ALL SELECT 'C_coarse', doc_id, y, round_even(proba * 1e1, 0) / 1e1 FROM scored),
g AS (SELECT variant, s, sum(y) AS p, sum(1 - y) AS n FROM v GROUP BY variant, s),
r AS (SELECT *, sum(p) OVER (PARTITION BY variant ORDER BY s DESC) AS cum_p,
                sum(n) OVER (PARTITION BY variant ORDER BY s DESC) AS cum_n FROM g),
m AS (SELECT variant,
        CAST(2 * sum(n) * sum(p) - sum(p * (2 * cum_n - n)) AS DOUBLE) / CAST(2 * sum(p) * sum(n) AS DOUBLE) AS roc_auc,
        round_even((sum(p * (CAST(cum_p AS DOUBLE) / CAST(cum_p + cum_n AS DOUBLE))) / CAST(sum(p) AS DOUBLE)) * 1e9, 0) / 1e9 AS pr_auc
      FROM r GROUP BY variant),
b AS (SELECT variant, round_even(avg(pow(s - y, 2)) * 1e9, 0) / 1e9 AS brier FROM v GROUP BY variant)
SELECT m.variant, m.roc_auc, m.pr_auc, b.brier FROM m JOIN b ON m.variant = b.variant"""


def variant_metrics(spark, sf):
    from hazardpanel.plans.training import score_variants
    s = fx.scored(spark, sf)
    variants = {
        "A_length": s.select("doc_id", "y", F.col("proba").alias("s")),
        "B_inverse": s.select("doc_id", "y", (F.lit(1) - F.col("proba")).alias("s")),
        "C_coarse": s.select("doc_id", "y", round_half_even(F.col("proba"), 1).alias("s")),
    }
    return score_variants(variants, score="s", label="y", digits=DIGITS)


@register("best_variant", sql(
    "SELECT arg_max(variant, pr_auc) AS best_variant, max(pr_auc) AS best_pr_auc FROM (" + VARIANTS_SQL + ") t",
    "scored"))
def q_best_variant(spark, sf):
    return M.best_by(variant_metrics(spark, sf), "variant", "pr_auc")


@register("metric_delta", sql("""
WITH vm AS (""" + VARIANTS_SQL + """),
longf AS (SELECT variant, 'roc_auc' AS metric, roc_auc AS value FROM vm
          UNION ALL SELECT variant, 'pr_auc', pr_auc FROM vm
          UNION ALL SELECT variant, 'brier', brier FROM vm)
SELECT l.variant, l.metric, l.value, b.value AS baseline, l.value - b.value AS delta
FROM longf l JOIN (SELECT metric, value FROM longf WHERE variant = 'A_length') b ON b.metric = l.metric""",
    "scored"))
def q_metric_delta(spark, sf):
    from hazardpanel.plans.training import metric_delta
    return metric_delta(variant_metrics(spark, sf), baseline_variant="A_length")


@register("topk_per_day", sql("""
SELECT day, event_id, score, y, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY day ORDER BY score DESC, event_id) AS rank FROM daily_scored) t
WHERE rank <= 8""", "daily_scored"))
def q_topk_per_day(spark, sf):
    return topk_per_group(fx.daily_scored(spark, sf), "day", "score", 8, "event_id") \
        .select("day", "event_id", "score", "y", "rank")


@register("metric_at_budget", sql("""
WITH t AS (SELECT *, row_number() OVER (PARTITION BY day ORDER BY score DESC, event_id) AS rk FROM daily_scored),
d AS (SELECT day, sum(y) AS positives, sum(CASE WHEN rk <= 8 THEN y ELSE 0 END) AS hits,
             count_if(rk <= 8) AS n_alerts FROM t GROUP BY day)
SELECT round_even(avg(CASE WHEN positives > 0 THEN hits / positives END) * 1e9, 0) / 1e9 AS recall_at_8,
       round_even(avg(hits / n_alerts) * 1e9, 0) / 1e9 AS precision_at_8
FROM d""", "daily_scored"))
def q_metric_at_budget(spark, sf):
    return M.alert_budget(fx.daily_scored(spark, sf), "day", "y", "score", 8, "event_id", digits=DIGITS)

