"""Model evaluation harness: variant metrics, best variant, deltas."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazardpanel.functions.scalar import round_half_even
from hazardpanel.operators import metrics as M


def score_variants(variants: dict[str, DataFrame], score: str = "s", label: str = "y",
                   digits: int | None = 9) -> DataFrame:
    """One metrics row per scored variant: ROC-AUC, PR-AUC (AP), Brier."""
    rows = None
    for name, df in variants.items():
        one = M.rank_metrics(df, score, label, digits=digits).select(F.lit(name).alias("variant"), "*")
        rows = one if rows is None else rows.unionByName(one)
    return rows


def metric_delta(metrics: DataFrame, baseline_variant: str,
                 metric_cols=("roc_auc", "pr_auc", "brier")) -> DataFrame:
    """Long table of ``value - baseline`` per (variant, metric)."""
    stack = ", ".join(f"'{m}', {m}" for m in metric_cols)
    longf = metrics.selectExpr("variant", f"stack({len(metric_cols)}, {stack}) AS (metric, value)")
    base = longf.filter(F.col("variant") == baseline_variant).select("metric", F.col("value").alias("baseline"))
    return (longf.join(base, "metric")
                 .select("variant", "metric", "value", "baseline", (F.col("value") - F.col("baseline")).alias("delta")))


# --------------------------------------------------------------------------
# Model table and the variant grid (weekday features x class weights)
# --------------------------------------------------------------------------

from hazardpanel.constants import STATIC_FEATURES, WEATHER_VARS  # noqa: E402
from hazardpanel.operators import model as ML  # noqa: E402
from hazardpanel.operators.features import (temporal_split, with_month_cyclic,  # noqa: E402
                                            with_weekday_cyclic)
from hazardpanel.operators.windows import assert_dense, dryness_features  # noqa: E402

DOW_FEATURES = ["dow_sin", "dow_cos", "is_weekend"]
SEASON_FEATURES = ["month_sin", "month_cos"]
V1_FEATURES = WEATHER_VARS + STATIC_FEATURES + SEASON_FEATURES      # 18, and the region id: 19
DRYNESS = ["precip_sum_7d", "precip_sum_30d", "temp_max_mean_7d", "et0_sum_30d", "days_since_rain"]


def model_table(panel: DataFrame, precip: str, temp: str, et0: str, era_start: str, train_end: str,
                coverage_col: str | None = None, materialize: bool = True) -> DataFrame:
    """Dryness windows on the full history first, then era filter and split.

    With ``materialize`` the table is written once (Parquet in the shared
    folder): every fit and every scoring pass then reads it instead of
    re-running the window computation.
    """
    if materialize:
        from hazardpanel.session import materialize as write_table
        panel = write_table(panel, "panel")
    # rolling windows count rows: a gap in a series would shift them
    feats = dryness_features(assert_dense(panel), precip=precip, temp=temp, et0=et0)
    feats = with_weekday_cyclic(with_month_cyclic(feats))
    table = temporal_split(feats, era_start, train_end, coverage_col)
    if materialize:
        table = write_table(table, "model-table")
    return table


def evaluate(scored: DataFrame, label: str = "label", proba: str = "proba", day: str = "date",
             k: int = 8, tiebreak: str = "wilaya_id", digits: int = 4) -> DataFrame:
    """ROC-AUC, PR-AUC, Brier and the daily alert budget, one row."""
    s = scored.select(F.col(label).alias("y"), F.col(proba).alias("p"), day, tiebreak)
    ranked = M.rank_metrics(s, "p", "y", digits=digits)
    if digits is not None:
        ranked = ranked.withColumn("roc_auc", round_half_even("roc_auc", digits))
    bud = M.alert_budget(s, day, "y", "p", k, tiebreak, digits=digits)
    return M.side_by_side(ranked, bud)


def model_card(model, name: str, train: DataFrame, test: DataFrame, label: str = "label", **measure) -> DataFrame:
    """What a stored model is: its features, rows and base rates of both splits,
    train ROC-AUC and the test metrics, one row."""
    spark = train.sparkSession
    fact = spark.createDataFrame([(name, ML.feature_names(model))], "variant string, features array<string>")
    base = lambda df, side: M.base_metrics(df, label).toDF(f"n_{side}", f"n_{side}_positive", f"{side}_base_rate")
    fitted = M.roc_auc(ML.score(model, train), "proba", label, out="train_roc_auc")
    numbers = M.side_by_side(base(train, "train"), base(test, "test"), fitted, evaluate(ML.score(model, test), label, **measure))
    # two one-row frames
    return fact.withColumn("_k", F.lit(1)).join(numbers.withColumn("_k", F.lit(1)), "_k").drop("_k")


def variant_grid(train: DataFrame, test: DataFrame, base_features, label: str = "label",
                 max_iter: int = 400, k: int = 8, digits: int = 4):
    """Fit the four variants (± weekday features, ± balanced weights) with the
    same settings; return (metrics rows, fitted models by name)."""
    weighted = M.balanced_weights(train, label, "weight")
    specs = {
        "A_ref": (list(base_features), None),
        "B_dow": (list(base_features) + DOW_FEATURES, None),
        "C_balanced": (list(base_features), "weight"),
        "D_dow_balanced": (list(base_features) + DOW_FEATURES, "weight"),
    }
    rows, models = None, {}
    for name, (feats, wcol) in specs.items():
        model = ML.fit(weighted if wcol else train, feats, label=label, max_iter=max_iter, weight_col=wcol)
        models[name] = model
        m = evaluate(ML.score(model, test), label, k=k, digits=digits).withColumn("variant", F.lit(name))
        rows = m if rows is None else rows.unionByName(m)
    return rows, models
