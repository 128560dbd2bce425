"""Quantiles by bracket refinement against numpy."""

import numpy as np
import pytest

from hazardpanel.operators import quantiles as Q

PROBS = [0, 0.001, 0.1, 0.25, 0.333, 0.5, 0.9, 0.999, 1]


def _make(kind):
    rng = np.random.default_rng(4)
    if kind == "hot value":
        return np.concatenate((np.full(7000, 0.5), rng.random(13000)))
    if kind == "narrow":            # nearly all in a range that the first splitters cannot part
        return np.concatenate((1 + rng.random(12000) * 1e-12, [-1e300, 1e300, 5, 6]))
    if kind == "infinite":
        return np.concatenate((np.full(4000, np.inf), np.full(3000, -np.inf), rng.normal(size=9000)))
    if kind == "zeros":
        return np.concatenate((np.full(3000, -0.0), np.full(3000, 0.0), [-1.0, 1.0]))
    return rng.integers(0, 3, 5000).astype(float)


@pytest.mark.parametrize("kind", ["hot value", "narrow", "infinite", "zeros", "few values"])
def test_equal_numpy_in_several_rounds(spark, kind, monkeypatch):
    monkeypatch.setattr(Q, "SPLITTERS", 7)      # several rounds on small data
    x = _make(kind)
    df = spark.createDataFrame([(float(v),) for v in x] + [(None,), (float("nan"),)], "x double").repartition(4)
    got = Q.exact_quantiles(df, "x", PROBS, limit=20)
    v, want = np.sort(x), []
    for p in PROBS:
        at = (len(v) - 1) * p
        lo, hi = v[int(np.floor(at))], v[int(np.ceil(at))]
        want.append(lo if lo == hi else lo + (hi - lo) * (at - np.floor(at)))
    assert got == [float(w) for w in want]


def test_none_and_one(spark):
    df = spark.createDataFrame([(None,), (float("nan"),)], "x double")
    assert Q.exact_quantiles(df, "x", [0.5]) == []
    assert Q.exact_quantiles(spark.createDataFrame([(3,)], "x long"), "x", [0, 0.5, 1]) == [3.0, 3.0, 3.0]


def test_no_range_shuffle(spark):
    values = spark.range(1000).selectExpr("cast(id as double) AS x")
    plan = Q._placed(values, [1.0, 5.0]).groupBy("place").count()._jdf.queryExecution().toString()
    assert "rangepartitioning" not in plan and "Sort " not in plan
