"""Registered model queries (rows-only checks: trainer output is compared by
metric, not by row)."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from hazardpanel import fixtures as fx
from hazardpanel.operators import model as ML
from hazardpanel.functions.scalar import round_half_even
from hazardpanel.oracle import sql
from hazardpanel.plans.training import DRYNESS, V1_FEATURES, model_card, model_table, variant_grid
from hazardpanel.queries import register
from hazardpanel.session import scratch_path

SAMPLE_ROWS = 8000
V1 = V1_FEATURES
V2 = V1_FEATURES + DRYNESS
TRAIN_UNTIL = "1996-12-31"
_TABLES: dict = {}
_MODELS: dict = {}


def _split(spark, sf):
    """Train and test rows of the model table, written once per application."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _TABLES:
        _TABLES[key] = model_table(fx.model_panel(spark, sf), "precipitation_sum", "temperature_2m_max", "et0_fao_evapotranspiration",
                                   "1992-01-01", TRAIN_UNTIL)
    t = _TABLES[key]
    return t.filter(F.col("split") == "train"), t.filter(F.col("split") == "test")


def _model(spark, sf):
    """The reference variant at its full settings, fitted once per application."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _MODELS:
        _MODELS[key] = ML.fit(_split(spark, sf)[0], V1)
    return _MODELS[key]


def _feature_sql() -> str:
    known = ", ".join(f"avg({c}) AS {c}" for c in V1)
    filled = ", ".join(f"round_even(coalesce(t.{c}, m.{c}) * 1e6, 0) / 1e6 AS {c}" for c in V1)
    return f"""
WITH t AS (SELECT *, sin(2*pi()*month(date)/12) AS month_sin, cos(2*pi()*month(date)/12) AS month_cos,
                  CASE WHEN date <= DATE '{TRAIN_UNTIL}' THEN 'train' ELSE 'test' END AS split
           FROM model_panel WHERE date >= DATE '1992-01-01'),
m AS (SELECT {known} FROM t WHERE split = 'train'),
k AS (SELECT wilaya_id, CAST(row_number() OVER (ORDER BY CAST(wilaya_id AS VARCHAR)) - 1 AS DOUBLE) AS region_index
      FROM (SELECT DISTINCT wilaya_id FROM t))
SELECT t.wilaya_id, t.date, t.label, t.split, {filled}, k.region_index
FROM t CROSS JOIN m JOIN k ON k.wilaya_id = t.wilaya_id"""


@register("feature_vector", sql(_feature_sql(), "model_panel"))
def q_feature_vector(spark, sf):
    """The assembled vector, taken apart again (six places: a mean is a sum of doubles)."""
    train, test = _split(spark, sf)
    pm = Pipeline(stages=ML.feature_pipeline(V1)).fit(ML.prepare(train))
    x = pm.transform(ML.prepare(train.unionByName(test))).withColumn("x", vector_to_array("features"))
    return x.select("wilaya_id", "date", "label", "split", *[round_half_even(F.col("x")[i], 6).alias(c) for i, c in enumerate(V1)],
                    F.col("x")[len(V1)].alias("region_index"))


@register("gbt_train")
def q_gbt_train(spark, sf):
    return ML.feature_importances(_model(spark, sf), spark)


@register("gbt_score")
def q_gbt_score(spark, sf):
    return ML.score(_model(spark, sf), _split(spark, sf)[1]).select("wilaya_id", "date", "label", "proba")


@register("model_roundtrip")
def q_model_roundtrip(spark, sf):
    train, test = _split(spark, sf)
    root = scratch_path(spark, "model")
    ML.save(_model(spark, sf), root, model_card(_model(spark, sf), "A_ref", train, test))
    return ML.score(ML.load(root), test).select("wilaya_id", "date", "label", "proba")


# which rows are sampled depends on a hash that only Spark has; how many, and that they are test rows, does not
@register("seeded_sample", sql(f"""
SELECT least(count(*), {SAMPLE_ROWS}) AS n_rows, least(count(*), {SAMPLE_ROWS}) AS n_keys, least(count(*), {SAMPLE_ROWS}) AS n_test_rows
FROM model_panel WHERE date > DATE '{TRAIN_UNTIL}'""", "model_panel"))
def q_seeded_sample(spark, sf):
    _, test = _split(spark, sf)
    sample = ML.seeded_sample(test, SAMPLE_ROWS, ["wilaya_id", "date"])
    found = sample.join(test.select("wilaya_id", "date", F.lit(1).alias("hit")), ["wilaya_id", "date"], "left")
    return found.agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("wilaya_id", "date").alias("n_keys"), F.count("hit").alias("n_test_rows"))


@register("perm_importance")
def q_perm_importance(spark, sf):
    sample = ML.seeded_sample(_split(spark, sf)[1], SAMPLE_ROWS, ["wilaya_id", "date"])
    return ML.permutation_importance(_model(spark, sf), sample, repeats=5)


@register("variant_grid")
def q_variant_grid(spark, sf):
    """The four variants on the 24 features with dryness (27 with the weekday)."""
    train, test = _split(spark, sf)
    rows, _ = variant_grid(train, test, V2)
    return rows
