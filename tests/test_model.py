"""Model ops: fixed seed, probabilities in [0, 1], separable toy problem."""

import datetime as dt

import numpy as np
from pyspark.sql import functions as F

from hazardpanel.operators import metrics as M
from hazardpanel.operators import model as ML


def _toy(spark, n=1500):
    rng = np.random.default_rng(0)
    rows = []
    for i in range(n):
        t = float(rng.uniform(0, 40))
        rows.append((i % 4, dt.date(2020, 1, 1) + dt.timedelta(days=i // 4), t,
                     float(rng.uniform(0, 5)), int(t > 25)))
    return spark.createDataFrame(rows, "wilaya_id int, date date, temp double, noise double, label int")


def test_gbt_learns_separable_toy(spark):
    df = _toy(spark)
    model = ML.fit(df, ["temp", "noise"], max_iter=5)
    scored = ML.score(model, df)
    r = scored.agg(F.min("proba"), F.max("proba")).first()
    assert 0.0 <= r[0] <= r[1] <= 1.0
    auc = M.roc_auc(scored.select(F.col("proba").alias("score"), F.col("label").alias("y"))).first()[0]
    assert auc > 0.95


def test_seeded_sample_is_deterministic(spark):
    df = _toy(spark)
    a = [tuple(r) for r in ML.seeded_sample(df, 100, ["wilaya_id", "date"]).collect()]
    b = [tuple(r) for r in ML.seeded_sample(df, 100, ["wilaya_id", "date"]).collect()]
    assert len(a) == 100 and a == b


def test_permutation_importance_ranks_signal_first(spark):
    df = _toy(spark)
    model = ML.fit(df, ["temp", "noise"], max_iter=5)
    imp = ML.permutation_importance(model, ML.seeded_sample(df, 800, ["wilaya_id", "date"]), repeats=2)
    top = imp.first()
    assert top.feature == "temp" and top.importance > 0.2


def test_save_load_roundtrip(spark):
    from hazardpanel.session import scratch_path
    df = _toy(spark, 400)
    model = ML.fit(df, ["temp", "noise"], max_iter=3)
    path = scratch_path(spark, "test-model")
    ML.save(model, path, spark.createDataFrame([("roc_auc", 1.0)], "metric string, value double"))
    a = [r.proba for r in ML.score(model, df).orderBy("date", "wilaya_id").collect()]
    b = [r.proba for r in ML.score(ML.load(path), df).orderBy("date", "wilaya_id").collect()]
    assert a == b
    assert spark.read.json(f"{path}/metrics").count() == 1


def test_model_panel_reads_line_items_once(spark):
    """What is joined to the calendar are the stored day totals, not a second scan."""
    from hazardpanel import fixtures as fx
    from tests.conftest import SF_SMALL
    panel = fx.model_panel(spark, SF_SMALL)
    assert not [f for f in panel.inputFiles() if "lineitem" in f]
    assert panel.filter("surface_pressure_mean is not null").count() > 0
