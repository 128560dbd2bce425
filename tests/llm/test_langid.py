"""Language ID: cross-parsing against a brute-force version, held-out accuracy."""

import numpy as np

from hazardpanel.llm import langid as L
from hazardpanel.llm.common import id_remainder, table
from tests.conftest import SF_MID


def brute_phrases(seq, ref, segment):
    total = 0
    for at in range(0, len(seq), segment):
        part, i = seq[at:at + segment], 0
        while i < len(part):
            n = 1
            while i + n < len(part) and tuple(part[i:i + n + 1]) in ref:
                n += 1
            i += n
            total += 1
    return total


def test_phrases_are_longest_matches(monkeypatch):
    monkeypatch.setattr(L, "SEGMENT", 50)
    rng = np.random.default_rng(1)
    refs = [rng.integers(0, 4, 200).tolist(), rng.integers(0, 5, 150).tolist()]
    model = L.Model(["a", "b"], np.zeros(1, np.uint8), 6, [L.automaton(r, 6) for r in refs], [8.0, 8.0])
    streams = [rng.integers(0, 6, n).astype(np.uint8) for n in (0, 1, 3, 49, 50, 51, 130, 400)]
    got = L.phrases(streams, model)
    for j, r in enumerate(refs):
        grams = {tuple(r[i:k]) for i in range(len(r)) for k in range(i + 1, min(len(r), i + 52) + 1)}
        assert got[:, j].tolist() == [brute_phrases(s.tolist(), grams, 50) for s in streams]


def test_rare_symbols_parse_as_the_dense_ones():
    rng = np.random.default_rng(3)
    refs = [rng.integers(0, 9, 300).tolist(), rng.integers(0, 7, 200).tolist()]
    streams = [rng.integers(0, 11, n) for n in (0, 1, 40, 500)]
    dense = L.Model(["a", "b"], np.zeros(1, np.uint8), 11, [L.automaton(r, 11) for r in refs], [8.0, 8.0])
    mixed = L.Model(["a", "b"], np.zeros(1, np.int32), 4, [L.automaton(r, 4) for r in refs], [8.0, 8.0])
    want = L.phrases([s.astype(np.uint8) for s in streams], dense)
    assert (L.phrases([s.astype(np.int32) for s in streams], mixed) == want).all()


def test_scripts_of_many_letters_are_told_apart(spark):
    rng = np.random.default_rng(5)
    alphabets = {"el": (0x3B1, 17), "en": (0x61, 26), "ru": (0x430, 32), "x1": (0x4E00, 400), "x2": (0x5000, 400), "x3": (0x5200, 400)}
    words = {lang: ["".join(chr(first + int(k)) for k in rng.integers(0, n, 3)) for _ in range(300)] for lang, (first, n) in alphabets.items()}
    text = lambda lang, n: "".join(rng.choice(words[lang], n // 3))
    labelled = spark.createDataFrame([(text(lang, 390), lang) for lang in alphabets for _ in range(20)], "text string, lang string")
    model = L.fit(labelled)
    docs = spark.createDataFrame([(i, text(lang, 40), lang) for i, lang in enumerate(list(alphabets) * 5)], "doc_id long, text string, want string")
    got = {r.id: r.lang_pred for r in L.predict(docs, model).collect()}
    assert got == {r.doc_id: r.want for r in docs.collect()}


def test_held_out_accuracy(spark):
    docs = table(spark, SF_MID, "documents")
    rem = id_remainder("doc_id", 4)
    model = L.fit(docs.filter(rem != 2))
    assert model.languages == sorted(model.languages) and len(model.languages) == 4
    rows = L.predict(docs, model).join(docs.select("doc_id", "lang"), L.F.col("id") == L.F.col("doc_id")).filter(rem == 2).collect()
    right = sum(r.lang == r.lang_pred for r in rows) / len(rows)
    assert len(rows) > 150 and right > 0.97, right
    assert all(0 <= r.score <= 1 for r in rows)


def test_edges(spark):
    labelled = spark.createDataFrame([("the cat and the dog", "en"), ("der hund und die katze", "de"), (None, "en"), ("x", None)], "text string, lang string")
    model = L.fit(labelled)
    rows = [(1, None), (2, ""), (3, "123 !!! 😀"), (4, "the dog"), (4, "the dog"), (None, "die katze"), (6, "日本語"), (7, "the cat " * 40000)]
    docs = spark.createDataFrame([(d, t, "clash", 0.5) for d, t in rows], "doc_id long, text string, lang_pred string, score double")
    got = sorted(((r.id, r.lang_pred) for r in L.predict(docs, model).collect()), key=str)
    assert got == sorted([(1, "und"), (2, "und"), (3, "und"), (4, "en"), (4, "en"), (None, "de"), (6, "en"), (7, "en")], key=str)
    kept = L.keep_determined(docs, model)
    assert kept.columns == docs.columns and sorted(str(r.doc_id) for r in kept.collect()) == ["4", "4", "6", "7", "None"]
    none = L.fit(labelled.limit(0))
    assert {r.lang_pred for r in L.predict(docs, none).collect()} == {"und"}
    assert L.predict(docs.limit(0), model).collect() == [] and L.keep_determined(docs.limit(0), model).collect() == []


def test_stage_follows_the_operators_decision(spark, monkeypatch):
    labelled = spark.createDataFrame([("the cat and the dog", "en"), ("der hund und die katze", "de")], "text string, lang string")
    model = L.fit(labelled)
    docs = spark.createDataFrame([(1, "the dog"), (2, "die katze"), (3, "12"), (4, None)], "doc_id long, text string")
    own = L.identify
    monkeypatch.setattr(L, "identify", lambda found, m: ([L.UNDETERMINED if t == "die katze" else x for t, x in zip(found, own(found, m)[0])], *own(found, m)[1:]))
    told = sorted(r.id for r in L.predict(docs, model).collect() if r.lang_pred != "und")
    assert told == sorted(r.doc_id for r in L.keep_determined(docs, model).collect()) == [1]
