"""Compression bands and base rules against a plain version."""

import random
import re
from collections import Counter

import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st

from hazardpanel.llm import compression as C
from hazardpanel.llm.queries import QUERIES
from tests.conftest import SF_SMALL

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    text = text or ""
    words = WORDS.findall(text)
    windows = list(zip(words, words[1:], words[2:]))
    times, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if times[w] > 1:
            covered |= {i, i + 1, i + 2}
    seen, dups = set(), 0
    for line in text.split("\n"):
        if WORDS.search(line):
            dups += line in seen
            seen.add(line)
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    raw = text.encode()

    def side(piece):
        if not piece:
            return 0
        low, high = [(lo, hi) for at, lo, hi in C.BANDS if at <= len(piece)][-1]
        ratio = len(piece) / len(zstandard.ZstdCompressor(level=3).compress(piece))
        return 1 if ratio > high else -1 if ratio < low else 0
    out = sum(len(raw[a:a + 4096]) for a in range(0, len(raw), 4096) if side(raw[a:a + 4096]))
    kept = not failed and side(raw) == 0 and out <= 0.5 * len(raw)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dups, len(covered), failed, kept


COLUMNS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]


def prose(words, seed=1):
    r = random.Random(seed)
    stems = ["".join(r.choice("aeinorst") for _ in range(r.randint(2, 9))) for _ in range(4000)]
    return " ".join(r.choice(stems) for _ in range(words))


def test_against_the_plain_version(spark):
    r = random.Random(2)
    noise = "".join(chr(r.randint(0x4E00, 0x9FFF)) + (" " if r.random() < .3 else "") for _ in range(4000))
    cases = [None, "", " ", "\n\n", "one", "a b c a b c", "x\nx\n x\nx\r\n\ny z", "a\x1cb c\x0bd", prose(49), prose(50), prose(3000), prose(400_000),
             "same words here again " * 300, prose(2000) + " again and again" * 5000, noise, "#*$%&|<> " * 60, "é　ü " * 80, "line of text\n" * 70,
             *[prose(k, k) + " " + prose(k // 3, k) for k in range(3, 200, 7)]]
    docs = spark.createDataFrame([(i, t, "x", True) for i, t in enumerate(cases)] + [(5, cases[5], "x", False)], "doc_id long, text string, id string, kept boolean")
    got = sorted(C.judge(docs).select("id", *COLUMNS).collect())
    assert [tuple(g) for g in got] == sorted((i, *plain(cases[i])) for i in [*range(len(cases)), 5])
    kept = {g.id for g in got if g.kept}
    assert {10, 11} <= kept and not {12, 13, 15} & kept
    rows = C.keep_in_band(docs)
    assert rows.schema == docs.schema and {row.doc_id for row in rows.collect()} == kept


@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 2)), max_size=60))
@settings(max_examples=150, deadline=None)
def test_repeated_words(pairs):
    import numpy as np
    pairs = sorted(pairs, key=lambda p: p[0])
    rows, codes = (np.array([p[i] for p in pairs], np.int64) for i in (0, 1))
    want = []
    for row in sorted(set(rows.tolist())):
        own = [str(c) for r, c in pairs if r == row]
        times = Counter(zip(own, own[1:], own[2:]))
        hit = {i + k for i in range(len(own) - 2) if times[tuple(own[i:i + 3])] > 1 for k in range(3)}
        want += [i in hit for i in range(len(own))]
    assert C.repeated_words(rows, codes, 3).tolist() == want


def test_query_on_every_document(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    got = QUERIES["op13_quality_rules"](spark, SF_SMALL).select("doc_id", *COLUMNS)
    assert sorted(map(tuple, got.collect())) == sorted((d.doc_id, *plain(d.text)) for d in docs)


def test_clean_documents_stay_and_repetitive_ones_go(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_SMALL}/labels.parquet").collect()}
    rows = QUERIES["op13_quality_rules"](spark, SF_SMALL).collect()
    assert all(r.kept or r.n_words < 50 for r in rows if labels.get(r.doc_id) == 1)
    assert any(not r.kept for r in rows if r.n_words >= 50)


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert C.judge(empty).count() == 0 and C.keep_in_band(empty).count() == 0
