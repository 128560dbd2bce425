"""Quality classifier: parts against plain versions, held-out accuracy."""

import numpy as np
from pyspark.sql import functions as F

from hazardpanel.llm import quality as Q
from hazardpanel.llm.common import id_remainder, table
from tests.conftest import SF_MID


def auc(score, label):
    order = np.argsort(score)
    rank = np.empty(len(score))
    rank[order] = np.arange(1, len(score) + 1)
    for v in np.unique(score):
        rank[score == v] = rank[score == v].mean()
    p = label.sum()
    return (rank[label == 1].sum() - p * (p + 1) / 2) / (p * (len(label) - p))


def test_isotonic_is_the_best_increasing_fit():
    at = np.arange(6.0)
    x, y = Q.isotonic(at, np.array([1, 1, 1, 1, 1, 2.0]), np.array([0, 1, 0, 1, 1, 1.0]))
    assert y.tolist() == [0, 0.5, 0.75] and np.allclose(x, [0, 1.5, 4.25])
    assert (np.diff(y) > 0).all()


def test_statistics(spark):
    rows = [(1, "AB cd cd 12!\n| x"), (2, None), (None, ""), (3, "é"), (4, "w " * 50000), (4, "w " * 50000)]
    docs = spark.createDataFrame([(a, b, 3.0) for a, b in rows], "doc_id long, text string, x double")
    got = {str(r.id): dict(zip(Q.STATISTICS, r.x)) for r in Q.statistics(docs).collect()}
    a = got["1"]
    assert a["upper"] == 2 / 16 and a["digit"] == 2 / 16 and a["blank"] == 4 / 16 and a["line_end"] == a["bang"] == a["bar"] == 1 / 16
    assert a["distinct"] == 5 / 6 and a["repeated"] == 1 / 6 and set(got["2"].values()) == set(got["None"].values()) == {0.0}
    assert got["3"]["wide"] == 1 and got["4"]["repeated"] == 49999 / 50000


def test_normal_equations_are_sums_over_all_rows(spark):
    rng = np.random.default_rng(0)
    d = len(Q.STATISTICS)
    x, y = rng.normal(size=(300, d)), rng.integers(0, 2, 300).astype(float)
    rows = spark.createDataFrame([(a.tolist(), float(b)) for a, b in zip(x, y)], "x array<double>, y double").repartition(7)
    m = Q.Model(np.zeros(d), np.ones(d), rng.normal(size=(d, 20)), rng.uniform(size=20))
    a, b = Q.normal_equations(rows, m)
    f = m.features(x)
    assert np.allclose(a, f.T @ f) and np.allclose(b, f.T @ y)


def test_held_out_accuracy(spark):
    docs, labels = table(spark, SF_MID, "documents"), table(spark, SF_MID, "labels")
    rem = id_remainder("id", 5)
    got = Q.classify(docs, labels, "quality", rem.isin(1, 2, 3), rem == 4)
    assert got.count() == docs.count()
    rows = got.filter(rem == 0).join(labels, F.col("id") == F.col("doc_id")).collect()
    s, y = np.array([r.score for r in rows]), np.array([r.quality for r in rows])
    assert len(y) > 50 and auc(s, y) > 0.95 and ((s >= 0).all() and (s <= 1).all())
    assert ((s >= Q.PREDICT_AT) == y).mean() > 0.93


def test_edges(spark):
    docs = spark.createDataFrame([(1, None), (2, "a"), (2, "a"), (None, "b")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, None)], "doc_id long, quality int")
    all_rows, none = F.lit(True), F.lit(False)
    assert [r.score for r in Q.classify(docs, labels, "quality", all_rows, none).collect()] == [0.5] * 4
    assert Q.classify(docs.limit(0), labels, "quality", all_rows, none).collect() == []
    assert [r.score for r in Q.classify(docs, labels.limit(0), "quality", all_rows, all_rows).collect()] == [0.5] * 4
    both = spark.createDataFrame([(1, 1), (2, 0), (2, 0)], "doc_id long, quality int")
    out = {r.id: r.score for r in Q.classify(docs, both, "quality", all_rows, all_rows).collect()}
    assert out[1] > out[2]
