"""Nearest neighbours against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from hazardpanel.llm import neighbours as N
from hazardpanel.llm.common import table
from tests.conftest import SF_MID


def brute(rows, k):
    out = {}
    for q, v in rows:
        if q % 20 == 0:
            s = sorted((-float(np.dot(np.float64(v), np.float64(w))), i) for i, w in rows if i != q)[:k]
            out[q] = [(i, -x) for x, i in s]
    return out


def collect(df):
    got = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(got[r.query_id])
    return got


def test_recall_on_the_table(spark):
    vectors = table(spark, SF_MID, "embeddings")
    rows = [(r.vec_id, r.embedding) for r in vectors.collect()]
    got, want = collect(N.search(vectors, F.col("id") % 20 == 0)), brute(rows, 20)
    assert got.keys() == want.keys()
    hit = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want) / sum(map(len, want.values()))
    assert hit >= 0.95, hit
    by = dict(rows)
    for q, near in got.items():
        assert all(abs(s - np.dot(np.float64(by[q]), np.float64(by[i]))) < 1e-12 for i, s in near)
        assert near == sorted(near, key=lambda x: (-x[1], x[0]))


@pytest.mark.parametrize("block", [5, 2048])
def test_all_leaves_are_exact_with_copies_and_ties(spark, block, monkeypatch):
    monkeypatch.setattr(N, "BLOCK", block)
    monkeypatch.setattr(N, "QUERIES", min(block, 256))
    monkeypatch.setattr(N, "ROWS_PER_LEAF", 20)
    monkeypatch.setattr(N, "LEAF", 5)
    rng = np.random.default_rng(1)
    base = rng.integers(-3, 4, (60, 6)).astype(float)
    base = base[(base != 0).any(1)]
    rows = [(int(i), base[i % 13 if i > 70 else i % len(base)].tolist()) for i in range(200)]
    odd = [(500, None), (501, [0.0] * 6), (502, [1.0, None] + [1.0] * 4), (503, [float("nan")] * 6), (504, [float("inf")] * 6), (505, []), (506, [1.0]), (None, [1.0] * 6), rows[0], rows[40]]
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows + odd], "vec_id long, embedding array<float>, label int, score string")
    got = collect(N.search(df, F.col("id") % 20 == 0, recall=1.0))
    want = brute(rows, 20)
    assert {q: [i for i, _ in v] for q, v in got.items()} == {q: [i for i, _ in v] for q, v in want.items()}


@pytest.mark.parametrize("copies", [2, 7])
def test_ids_that_several_vectors_carry(spark, copies, monkeypatch):
    """Every vector of a repeated id finds all of its k, in tasks of one meeting each."""
    monkeypatch.setattr(N, "BLOCK", 5)
    monkeypatch.setattr(N, "MEETINGS", 3)
    monkeypatch.setattr(N, "ROWS_PER_LEAF", 20)
    monkeypatch.setattr(N, "LEAF", 5)
    v = np.random.default_rng(8).integers(1, 50, (60, 4)).astype(float)
    rows = [(int(i), v[i].tolist()) for i in range(60)] + [(20, (v[20] + n).tolist()) for n in range(1, copies)] + [(33, (v[33] * n).tolist()) for n in range(2, copies + 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {}
    for r in N.search(df, F.col("id") % 20 == 0, k=5, recall=1.0).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    want = {}
    for q, a in rows:
        if q % 20 == 0:
            near = sorted((-float(np.dot(a, b)), i) for i, b in rows if i != q)[:5]
            want.setdefault(q, []).extend((n + 1, i, -s) for n, (s, i) in enumerate(near))
    assert {q: sorted(x) for q, x in got.items()} == {q: sorted(x) for q, x in want.items()}
    assert len(got[20]) == 5 * copies


def test_few_and_none(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [0.0, 1.0])], "vec_id long, embedding array<float>")
    assert collect(N.search(df, F.col("id") % 20 == 0)) == {0: [(1, 0.5), (2, 0.0)]}
    assert N.search(df.limit(0), F.col("id") % 20 == 0).collect() == []
    assert N.search(df.limit(1), F.col("id") % 20 == 0).collect() == []


def test_tree_files_every_row_and_visits_every_leaf():
    x = np.random.default_rng(5).normal(size=(3000, 8))
    t = N.grow(x, leaf=40)
    leaf = t.file(x)
    assert t.leaves > 60 and set(leaf) == set(range(t.leaves))
    order = t.visits(x[0], t.leaves)
    assert sorted(order) == list(range(t.leaves)) and t.visits(x[0], 5) == order[:5]
