"""K2-treap search against every document scored by definition."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from hazardpanel.llm import lexical as X

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k=20):
    held = [(i, Counter(terms(t))) for i, t in docs]
    held = [(i, c) for i, c in held if c]
    N, L = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    asked = {}
    for i, t in set(items):
        asked.setdefault(i, Counter()).update(terms(t))
    out = []
    for item, own in asked.items():
        found = []
        for i, c in held:
            n = sum(c.values())
            m = 100 - 25 + 25 * n * N // L
            score = sum(times * math.floor(1000 * math.log((2 * N + 2) / (2 * df[t] + 1))) * (1000000000 * c[t] // (1000 * c[t] + 12 * m))
                        for t, times in own.items() if c[t])
            if score > 0:
                found.append((-score, -math.inf if i is None else i, i))
        out += [(item, r + 1, i, -s) for r, (s, _, i) in enumerate(sorted(found, key=lambda f: f[:2])[:k])]
    return sorted(out, key=str)


def corpus(n, seed=3):
    r = random.Random(seed)
    vocab = ["".join(r.choice("abcé1") for _ in range(r.randint(1, 6))) for _ in range(400)]
    return [(i, " ".join(r.choice(vocab[:int(len(vocab) ** r.random()) + 1]) for _ in range(r.choice((0, 1, 3, 20, 200))))) for i in range(n)]


@pytest.mark.parametrize("points", [1, 2, 5, 300, 4000])
def test_quadtree_keeps_every_cell_and_its_maxima(points):
    r = np.random.default_rng(points)
    cells = np.unique(r.integers(0, 300, (points, 2)) + [[0, 40]], axis=0)
    values = r.integers(1, 1000, len(cells))
    for tree in (X.Quadtree.of(cells[:, 0], cells[:, 1], values), X.Quadtree.from_bytes(X.Quadtree.of(cells[:, 0], cells[:, 1], values).to_bytes())):
        assert len(tree.level) < 2 * len(cells)
        want = {tuple(c): v for c, v in zip(cells.tolist(), values.tolist())}
        for row, column in [*want, (0, 0), (299, 339), (5, 5)]:
            node, level = np.array([tree.root]), tree.side
            while level and node[0] >= 0:
                at = level - 1
                quarter = np.array([(row >> at & 1) << 1 | column >> at & 1])
                before, node, level = node, tree.down(node, np.array([level]), quarter), at
                assert node[0] < 0 or tree.top[node[0]] <= tree.top[before[0]]
            if row >> tree.side or column >> tree.side:
                continue
            assert (int(tree.top[node[0]]) if node[0] >= 0 else None) == want.get((row, column))
        inner = np.flatnonzero(tree.level)
        for node in inner.tolist():
            kids = range(tree.first[node], tree.first[node] + bin(tree.mask[node]).count("1"))
            assert len(kids) > 1 and tree.top[node] == max(tree.top[i] for i in kids)


def test_levels_of_large_keys():
    key = np.array([0, 1, 4, (1 << 60) - 1, 1 << 60, (1 << 60) + 64], np.int64)
    assert X.apart(key).tolist() == [255, 1, 2, 30, 31, 4]


def spark_docs(spark, docs):
    return spark.createDataFrame([(i, t, "x", 5) for i, t in docs], "doc_id long, text string, term string, score int")


@pytest.mark.parametrize("block", [X.BLOCK_DOCS, 7])
def test_against_brute_force(spark, monkeypatch, tmp_path, block):
    monkeypatch.setattr(X, "BLOCK_DOCS", block)
    monkeypatch.setattr(X, "WIDTH", 16)
    docs = [*corpus(300), (300, None), (301, ""), (302, "... --"), (303, "ÉCOLE École école"), (None, "abc é1 a"), (5, "abc a a"), (5, "abc a a")]
    r = random.Random(4)
    words = sorted({w for _, t in docs for w in terms(t)})
    items = [(f"i{k}", " ".join(r.choice(words) for _ in range(r.randint(1, 12)))) for k in range(25)]
    items += [("twice", "abc abc a"), ("twice", "é1"), ("twice", "é1"), ("none", "zzzzzzzzz"), ("void", None), ("void2", ""), ("case", "ÉCOLE, Abc"), (None, "a b c")]
    index = X.build(spark_docs(spark, docs).repartition(3), str(tmp_path / "index"))
    got = X.search(index, spark.createDataFrame([(i, t, 1) for i, t in items], "item_id string, text string, rank int"))
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, got.collect()), key=str) == brute(docs, items)


def test_batches_of_items(spark, monkeypatch, tmp_path):
    docs = corpus(120, 8)
    items = [(k, docs[k][1] or "a") for k in range(0, 120, 5)]
    monkeypatch.setattr(X, "BATCH_TERMS", 40)
    index = X.build(spark_docs(spark, docs), str(tmp_path / "index"))
    got = X.search(index, spark.createDataFrame(items, "item_id int, text string"), k=3)
    assert sorted(map(tuple, got.collect()), key=str) == brute(docs, items, 3)


def test_long_text_in_pieces(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(X, "PIECE_BYTES", 50)
    docs = [*corpus(40, 9), (77, "word " * 3000 + "é" * 400 + " a1 " + "b2c" * 100), (78, "x" * 500)]
    items = [("a", "word a1"), ("b", "é" * 400), ("c", "x" * 500 + " b2c")]
    index = X.build(spark_docs(spark, docs), str(tmp_path / "index"))
    got = X.search(index, spark.createDataFrame(items, "item_id string, text string"))
    assert sorted(map(tuple, got.collect()), key=str) == brute(docs, items)


def test_copies_and_ties(spark, tmp_path):
    docs = [(i, "same words here") for i in range(100, 0, -1)] + [(200, "other words")]
    index = X.build(spark_docs(spark, docs), str(tmp_path / "index"))
    items = [("a", "same here"), ("b", "words")]
    got = X.search(index, spark.createDataFrame(items, "item_id string, text string"))
    assert sorted(map(tuple, got.collect()), key=str) == brute(docs, items)


def test_empty_tables(spark, tmp_path):
    docs, none = spark_docs(spark, corpus(10)), spark_docs(spark, []).limit(0)
    items = spark.createDataFrame([("a", "abc")], "item_id string, text string")
    assert X.search(X.build(none, str(tmp_path / "a")), items).count() == 0
    assert X.search(X.build(docs, str(tmp_path / "b")), items.limit(0)).count() == 0
