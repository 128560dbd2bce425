"""SimHash against a brute-force version."""

import random

import numpy as np
import pytest
import xxhash

from hazardpanel.llm import simhash as S


def brute_fp(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    sh = [b" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [b" ".join(words)]
    hs = [xxhash.xxh64_intdigest(s, 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(rows):
    fps = [brute_fp(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i in range(len(rows)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= 3:
                parent[find(i)] = find(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[find(i)] = min(d, low.get(find(i), d))
    return [(d, fps[i], low.get(find(i))) for i, (d, _) in enumerate(rows)]


def make_rows():
    rng = random.Random(5)
    vocab = ["w%d" % i for i in range(300)]
    rows = [(0, None), (1, ""), (2, " \t\n"), (3, "one"), (4, "One"), (5, "two words"), (6, "É è É"), (7, "a b c d")]
    for i in range(8, 60):
        rows.append((i, " ".join(rng.choices(vocab, k=rng.randint(1, 400)))))
    for i in range(60, 90):
        words = rows[rng.randint(8, 59)][1].split()
        words[rng.randrange(len(words))] = "changed"
        rows.append((i, " ".join(words)))
    rows += [(90, rows[10][1]), (90, rows[10][1]), (None, rows[11][1]), (91, "long " * 70000)]
    return rows


@pytest.mark.parametrize("radius", [1, 2, 3, 5])
def test_sliced_links_connect_what_brute_force_connects(radius):
    rng = np.random.default_rng(radius)
    centres = rng.integers(0, 2**63, 12, dtype=np.uint64)
    flips = np.uint64(1) << rng.integers(0, 64, (300, 3)).astype(np.uint64)
    fp = centres[rng.integers(0, 12, 300)] ^ np.bitwise_or.reduce(flips, axis=1)
    run = np.sort(rng.integers(0, 5, 300))
    a, b = S.sliced_links(run, fp, radius, chunk=37)
    want, got = list(range(300)), list(range(300))

    def find(p, x):
        while p[x] != x:
            x = p[x]
        return x
    for i in range(300):
        for j in range(i):
            if run[i] == run[j] and bin(int(fp[i] ^ fp[j])).count("1") <= radius:
                want[find(want, i)] = find(want, j)
    for x, y in zip(a, b):
        got[find(got, x)] = find(got, y)
    pairs = lambda p: {(i, j) for i in range(300) for j in range(i) if find(p, i) == find(p, j)}
    assert pairs(got) == pairs(want)


@pytest.mark.parametrize("block", [2, 4096])
def test_components_match_brute_force(spark, block, monkeypatch):
    rows = make_rows()
    docs = spark.createDataFrame([(d, t, "x", 1) for d, t in rows], "doc_id long, text string, fp string, component_id int")
    whole = S.links
    monkeypatch.setattr(S, "links", lambda f, r: whole(f, r, block))
    got = sorted(((r.doc_id, r.fp & (2**64 - 1), r.component_id) for r in S.near_duplicates(docs).collect()), key=str)
    assert got == sorted(brute_components(rows), key=str)


def test_keep_one_keeps_the_smallest_id_of_each_group(spark):
    rows = make_rows()
    docs = spark.createDataFrame([(d, t, "x") for d, t in rows], "doc_id long, text string, fp string")
    got = [r.doc_id for r in S.keep_one(docs).collect()]
    assert sorted(got) == sorted({c for _, _, c in brute_components(rows)})


def test_groups_without_ids_keep_one_row_each(spark):
    rows = [(None, "alpha beta gamma delta"), (None, "alpha beta gamma delta"), (None, "one two three four five"), (7, "one two three four five"),
            (None, "un deux trois quatre"), (3, "x y z w"), (3, "p q r s t u")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted(((r.doc_id, r.text) for r in S.keep_one(docs).collect()), key=str)
    assert got == sorted([rows[0], rows[3], rows[4], rows[5], rows[6]], key=str)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert S.near_duplicates(docs).collect() == []
    assert S.keep_one(docs).collect() == []
