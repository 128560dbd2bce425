"""Property tests: invariants that must hold for any input."""

import numpy as np
import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from hazardpanel import fixtures as fx
from hazardpanel.functions.scalar import round_half_even
from hazardpanel.operators import metrics as M
from hazardpanel.plans.rebuild import build_panel
from tests.conftest import SF_SMALL

SETTINGS = settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def test_panel_rows_independent_of_detections(spark):
    det = fx.detections(spark, SF_SMALL)
    edges, dim = fx.edges(spark, SF_SMALL), fx.region_dim(spark, SF_SMALL)
    full = build_panel(det, edges, None, dim)
    n_full = full.count()
    # keep one detection per day only: the dense panel keeps its shape
    keep = det.groupBy("acq_date").agg(F.min("event_id").alias("event_id"))
    thin = det.join(keep, ["acq_date", "event_id"], "left_semi")
    assert build_panel(thin, edges, None, dim).count() == n_full
    per = full.groupBy("wilaya_id", "date").count().filter("count > 1").count()
    assert per == 0


@SETTINGS
@given(st.lists(st.integers(min_value=-10**7, max_value=10**7), min_size=1, max_size=60))
def test_round_half_even_property(spark, ints):
    vals = [i / 1000 for i in ints] + [i / 1000 + 0.005 for i in ints]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = [r[0] for r in df.select(round_half_even("x", 2)).collect()]
    assert got == [float(np.round(v, 2)) for v in vals]


@SETTINGS
@given(st.lists(st.integers(min_value=0, max_value=30), min_size=12, max_size=300),
       st.sampled_from([4, 5, 10]))
def test_quantile_bins_property(spark, xs, q):
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(xs)], "id int, x double")
    got = M.quantile_bins(df, "x", q).orderBy("id").toPandas()["bin"].to_numpy(dtype=float, na_value=np.nan)
    want = pd.qcut(pd.Series(xs, dtype=float), q, labels=False, duplicates="drop").to_numpy(dtype=float)
    assert np.array_equal(got, want, equal_nan=True)


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 15), st.integers(0, 1)), min_size=2, max_size=200))
def test_roc_auc_property(spark, pairs):
    ys = np.array([p[1] for p in pairs])
    if ys.min() == ys.max():
        return
    s = np.array([p[0] for p in pairs], dtype=float)
    df = spark.createDataFrame([(float(a), int(b)) for a, b in zip(s, ys)], "score double, y int")
    pos, neg = s[ys == 1], s[ys == 0]
    want = ((pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()) / (len(pos) * len(neg))
    assert abs(M.roc_auc(df).first()[0] - want) < 1e-12
