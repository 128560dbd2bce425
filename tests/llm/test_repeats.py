"""Repeats against brute force over all windows."""

import hashlib
import os
import random
import subprocess
import sys

import numpy as np
import pytest

from hazardpanel.llm import repeats as R


def brute(rows):
    """rows (id, text) with different ids or equal rows."""
    seen, out = set(), []
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        raw = (t or "").encode()
        gone = np.zeros(len(raw) + 1, bool)
        for p in range(len(raw) - 99):
            w = raw[p:p + 100]
            if w in seen:
                gone[p:p + 100] = True
            seen.add(w)
        spans = int((gone[:-1] & ~np.concatenate(([False], gone[:-2]))).sum()) if len(raw) else 0
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        out.append((i, len(raw), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def corpus(seed):
    rng = random.Random(seed)
    words = ["ab", "the", "été", "x", "long", "word", "ing", "\n", "zz", "q"]
    text = lambda n: " ".join(rng.choices(words, k=n))
    passages = [text(rng.randint(15, 120)) for _ in range(8)]
    rows = []
    for i in range(70):
        parts = [text(rng.randint(0, 60))]
        for _ in range(rng.randint(0, 4)):
            p = rng.choice(passages)
            a = rng.randint(0, len(p) // 2)
            parts += [p[a:a + rng.randint(60, 400)], text(rng.randint(0, 20))]
        rows.append((i, "".join(parts)))
    rows += [(100 + i, rows[i % 5][1]) for i in range(12)]
    rows += [(200, None), (201, ""), (202, "a" * 99), (203, "a" * 100), (204, "a" * 500), (205, "ab" * 300), (None, passages[0]), (206, "Ha " * 400), (207, "Ha " * 300),
             (5, rows[5][1]), (208, "\0" * 300), (209, "x" + "\0" * 250), (210, "é" * 200)]
    return rows


@pytest.mark.parametrize("seed,chunk", [(1, 8 << 20), (2, 3000), (3, 500)])
def test_removed_bytes_equal_brute_force(spark, seed, chunk, monkeypatch):
    rows = corpus(seed)
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, kept string").repartition(3)
    monkeypatch.setattr(R, "CHUNK", chunk)
    got = sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in R.remove_repeats(docs).collect()), key=str)
    assert got == brute(rows)


@pytest.mark.parametrize("seed,chunk,hot", [(1, 8 << 20, 0), (2, 3000, 0), (3, 500, 2), (4, 3000, 5)])
def test_frames_of_hot_grams_are_dealt_by_window(spark, seed, chunk, hot, monkeypatch):
    rows = corpus(seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    monkeypatch.setattr(R, "CHUNK", chunk)
    monkeypatch.setattr(R, "HOT", hot)
    got = sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in R.remove_repeats(docs).collect()), key=str)
    assert got == brute(rows)


def test_no_bucket_gets_all_frames_of_a_frequent_passage(spark, monkeypatch):
    rng = random.Random(9)
    some = lambda n: "".join(rng.choices("abcdefghijklmnop", k=n))
    passage = some(300)
    docs = spark.createDataFrame([(i, some(120) + passage + some(120)) for i in range(600)], "doc_id long, text string").repartition(3)
    monkeypatch.setattr(R, "HOT", 50, raising=False)
    chunks = R.pack(docs)
    most = 0
    for r in R._buckets(chunks, 8).filter("key >= 0 and key < 8").collect():
        most = max([most, *np.unique(R.load(r.data)[0], return_counts=True)[1].tolist()])
    assert most <= 50


def test_equal_ids_are_ordered_by_text_hash(spark):
    shared = "".join(random.Random(0).choices("abcdefgh", k=150))
    docs = spark.createDataFrame([(1, "A" + shared), (1, shared + "B"), (2, shared)], "doc_id long, text string")
    first = R.remove_repeats(docs).collect()
    again = R.remove_repeats(docs.repartition(3)).collect()
    assert sorted(map(str, first)) == sorted(map(str, again))
    assert sorted((r.doc_id, r.n_removed) for r in first) == [(1, 0), (1, 150), (2, 150)]


@pytest.mark.parametrize("step", [1 << 20, 700, 64])
def test_frames_hold_every_window_once(step, monkeypatch):
    monkeypatch.setattr(R, "STEP", step)
    raw = np.frombuffer("".join(random.Random(4).choices("abc", k=5000)).encode(), np.uint8)
    offsets = np.array([0, 50, 150, 249, 1500, 5000])
    f = R.frames(raw, offsets)
    windows = np.concatenate([np.arange(s, s + n - 99) for s, n in zip(f.start, f.size)])
    want = [p for a, b in zip(offsets, offsets[1:]) for p in range(a, b - 99)]
    assert sorted(windows.tolist()) == want
    by: dict[bytes, set] = {}
    for g, s, n in zip(f.gram, f.start, f.size):
        for p in range(s, s + n - 99):
            by.setdefault(raw[p:p + 100].tobytes(), set()).add(int(g))
    assert all(len(g) == 1 for g in by.values())
    one, two = R.content_hashes(raw, f.start, f.size)
    same = {}
    for a, b, s, n in zip(one, two, f.start, f.size):
        same.setdefault(raw[s:s + n].tobytes(), set()).add((int(a), int(b)))
    assert all(len(x) == 1 for x in same.values()) and len({y for x in same.values() for y in x}) == len(same)


def test_stack_scan_yields_left_diverse_intervals():
    rng = random.Random(8)
    for _ in range(60):
        text = "".join(rng.choices("ab", k=60))
        sa = sorted(range(len(text)), key=lambda i: text[i:])
        common = lambda a, b: next((k for k in range(60) if text[a + k:a + k + 1] != text[b + k:b + k + 1] or a + k >= 60 or b + k >= 60), 60)
        lcp = [0] + [common(a, b) for a, b in zip(sa, sa[1:])]
        lcp = [x if x >= 3 else 0 for x in lcp]
        left = [ord(text[i - 1]) if i else -1 for i in sa]
        got = sorted((d, tuple(sorted(sa[lo:hi + 1]))) for d, lo, hi in R.intervals(lcp, left, 3))
        want = set()
        for d in range(3, 60):
            for p in range(60 - d + 1):
                w = text[p:p + d]
                occ = [i for i in range(60 - d + 1) if text[i:i + d] == w]
                if len(occ) > 1 and len({text[i + d:i + d + 1] or f"end{i}" for i in occ}) > 1 and len({text[i - 1:i] or f"start{i}" for i in occ}) > 1:
                    want.add((d, tuple(occ)))
        assert got == sorted(want)


def test_groups_have_all_occurrences(spark):
    rng = random.Random(6)
    p = "".join(rng.choices("abcdefghijkl", k=220))
    other = lambda: "".join(rng.choices("mnopqrstuvwxyz", k=150))
    docs = spark.createDataFrame([(1, other() + p + other()), (2, p[:160]), (3, other() + p[40:])], "doc_id long, text string")
    rows = R.repeat_groups(docs).collect()
    found: dict[str, list] = {}
    for r in rows:
        found.setdefault(r.repeat_id, []).append((r.doc_id, r.start, r.n_bytes))
    text = {1: docs.collect()[0].text, 2: p[:160], 3: docs.collect()[2].text}
    for occ in found.values():
        assert len({text[d][s:s + n] for d, s, n in occ}) == 1 and len(occ) > 1 and occ[0][2] >= 100
    covered = {(d, x) for occ in found.values() for d, s, n in occ for x in range(s, s + n)}
    assert covered == {(1, x) for x in range(150, 370)} | {(2, x) for x in range(160)} | {(3, x) for x in range(150, 330)}


@pytest.mark.parametrize("parts", [1, 3])
def test_groups_have_the_copies_of_a_chunk(spark, parts):
    rng = random.Random(12)
    some = lambda n: "".join(rng.choices("abcdefghij", k=n))
    p, twin = some(260), some(400)
    texts = {1: twin, 2: twin, 3: "z" * 130, 20: some(90) + p[30:]}
    texts |= {i: some(80) + p + some(80) for i in range(4, 16)} | {i: p for i in range(16, 20)}
    docs = spark.createDataFrame(sorted(texts.items()), "doc_id long, text string").repartition(parts)
    found: dict[str, list] = {}
    for r in R.repeat_groups(docs).collect():
        found.setdefault(r.repeat_id, []).append((r.doc_id, r.start, r.n_bytes))
    strings = set()
    for occ in found.values():
        d, at, n = occ[0]
        s = texts[d][at:at + n]
        strings.add(s)
        assert sorted(occ) == sorted((i, x, n) for i, t in texts.items() for x in range(len(t) - n + 1) if t[x:x + n] == s) and len(occ) > 1
    assert len(strings) == len(found)
    places: dict[str, set] = {}
    for i, t in texts.items():
        for x in range(len(t) - 99):
            places.setdefault(t[x:x + 100], set()).add((i, x))
    want = {(i, x) for at in places.values() if len(at) > 1 for i, x in at}
    got = {(i, x) for occ in found.values() for i, at, n in occ for x in range(at, at + n - 99)}
    assert got == want


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert R.remove_repeats(docs).collect() == [] and R.repeat_groups(docs).collect() == []


def test_slices_of_suffixes_and_grams_change_nothing(monkeypatch):
    rng = np.random.default_rng(6)
    b = near_copies(rng, passages=12, variants=9)
    found = lambda: sorted((d, tuple(sorted(zip(m.tolist(), o.tolist())))) for d, m, o in R.groups(b, 100))
    whole = found()
    assert len(whole) > 50
    monkeypatch.setattr(R, "SUFFIXES", 5)
    assert found() == whole
    monkeypatch.setattr(R, "STEP", 2000)
    assert found() == whole


def near_copies(rng, passages, variants):
    """A bucket of frames: variants of passages around one anchor each, few bytes changed."""
    text, gram = [], []
    for p in range(passages):
        base = rng.integers(97, 123, 168).astype(np.uint8)
        for _ in range(variants):
            own = base.copy()
            at = rng.integers(0, 60, 2)
            own[at] = rng.integers(97, 123, 2)
            text.append(own)
            gram.append(p)
    n, size = len(gram), np.full(len(gram), 168, np.int64)
    return R.Bucket(np.array(gram, np.uint64), np.zeros(n, np.int64), np.arange(n), np.zeros(n, np.int64), size, np.arange(n), np.arange(n),
                    np.zeros(n, bool), np.concatenate(text), np.cumsum(size) - size)


def test_memory_of_a_bucket_of_near_copies():
    code = """
import resource, numpy as np
from tests.llm.test_repeats import R, near_copies
b = near_copies(np.random.default_rng(1), 1600, 30)
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
n = sum(1 for _ in R.groups(b, 100))
print(n, (resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) >> 10)
"""
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True, cwd=os.path.dirname(R.__file__) + "/../..").stdout.split()
    assert int(out[0]) > 1600 and int(out[1]) < 250
