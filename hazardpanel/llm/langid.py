"""Language identification by cross-parsing.

``fit`` gathers a bounded sample of labelled text per language and builds its
suffix automaton.  ``predict`` parses every whole text against each automaton:
the text is cut greedily into the longest phrases that occur in the reference,
and the language whose normalised phrase count (phrases x log2 of the reference
length per symbol, an estimate of the cross entropy) is least wins.

Symbols are lower-cased letters, each letter of the sample its own; all other characters are one separator symbol,
runs of which count once.  The parse restarts every ``SEGMENT`` symbols, so one
text of any length is parsed as many lanes, all advanced in step by numpy.

Defined results: a null text or one without a letter gives ``und`` with score 0;
ties go to the first language in name order; without any labelled text every
prediction is ``und``.  ``score`` is the share of the winner when languages are
weighted by 2^-(code length), i.e. 1 for a clear decision, 1/languages for none.
Repeated rows are scored alike, an empty table gives an empty result, other
columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazardpanel.llm.common import releasing, slices, texts

#: Bound of the fit: rows sampled for each language, and characters taken from each of them.
SAMPLE_ROWS = 96
SAMPLE_CHARS = 400
#: Letters whose transitions are a dense table (the most frequent of the sample); those of others are looked up.
ALPHABET = 62
SEGMENT = 1024
UNDETERMINED = "und"


@dataclass
class Steps:
    """Transitions of an automaton.  States are multiplied by ``width``; -1 ends a phrase."""
    width: int
    dense: np.ndarray                   # state + symbol -> next state, for symbols below width
    keys: np.ndarray                    # symbol << 32 | state in ascending order, for the other symbols
    targets: np.ndarray                 # next state of each key
    alone: int                          # state without exits

    def take(self, state: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        if not symbol.dtype.itemsize > 1:               # the dense table has all
            return self.dense.take(state + symbol)
        rare = np.flatnonzero(symbol >= self.width)
        to = self.dense.take(state + np.where(symbol < self.width, symbol, 0).astype(np.int32))
        if len(rare):
            at = state[rare].astype(np.int64)
            found = np.where(at == 0, np.int32(self.alone), np.int32(-1))
            if len(self.keys):
                key = symbol[rare].astype(np.int64) << 32 | at
                place = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
                found = np.where(self.keys[place] == key, self.targets[place], found)
            to[rare] = found
        return to


@dataclass
class Model:
    languages: list[str]
    symbol: np.ndarray                  # code point -> symbol: 0 no letter, 1 letter not in the sample, 2.. learned letters
    width: int                          # symbols in the dense tables, the lowest
    steps: list[Steps]                  # per language
    bits: list[float]                   # per language: log2 of the reference length


def automaton(text: list[int], width: int) -> Steps:
    """Suffix automaton of a symbol string: one flat transition table of the symbols
    below ``width``, and the single transitions of the others.  A symbol that never occurs leads from the root to a state without exits, so
    that it is a phrase of its own."""
    nxt, link, length, last = [{}], [-1], [0], 0
    for c in text:
        cur = len(nxt)
        nxt.append({}), link.append(0), length.append(length[last] + 1)
        p = last
        while p != -1 and c not in nxt[p]:
            nxt[p][c] = cur
            p = link[p]
        if p != -1:
            q = nxt[p][c]
            if length[p] + 1 == length[q]:
                link[cur] = q
            else:
                clone = len(nxt)
                nxt.append(dict(nxt[q])), link.append(link[q]), length.append(length[p] + 1)
                while p != -1 and nxt[p].get(c) == q:
                    nxt[p][c] = clone
                    p = link[p]
                link[q] = link[cur] = clone
        last = cur
    table = np.full((len(nxt) + 1, width), -1, np.int32)
    rare = []
    for s, edges in enumerate(nxt):
        for c, t in edges.items():
            if c < width:
                table[s, c] = t * width
            else:
                rare.append((c << 32 | s * width, t * width))
    table[0, table[0] < 0] = len(nxt) * width
    rare.sort()
    return Steps(width, table.ravel(), np.array([k for k, _ in rare], np.int64), np.array([t for _, t in rare], np.int32), len(nxt) * width)


def symbols(points: np.ndarray, lut: np.ndarray) -> np.ndarray:
    """Symbols of code points, runs of separators once."""
    s = lut[points]
    keep = np.ones(len(s), bool)
    keep[1:] = (s[1:] != 0) | (s[:-1] != 0)
    return s[keep]


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def sample(labelled: DataFrame, text_col: str, lang_col: str, rows: int = SAMPLE_ROWS, chars: int = SAMPLE_CHARS) -> dict[str, list[str]]:
    """At most ``rows`` pieces of at most ``chars`` characters per language,
    chosen and placed by the hash of the text.  What reaches the driver is
    bounded by languages x rows x chars."""
    known = labelled.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).filter(
        "text is not null and lang is not null").withColumn("h", F.pmod(F.xxhash64("text"), F.lit(1 << 30)))
    counts = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.countDistinct("h").alias("n")).collect()}
    if not counts:
        return {}
    share = F.create_map(*[F.lit(x) for lang, n in sorted(counts.items()) for x in (lang, min(1.0, 4 * rows / n))])
    chosen = known.filter(F.col("h") < share[F.col("lang")] * (1 << 30))
    place = F.pmod(F.hash("text"), F.greatest(F.length("text") - chars + 1, F.lit(1))) + 1
    pieces = chosen.select("lang", "h", F.substring("text", place, F.lit(chars)).alias("piece")).distinct()
    best = pieces.groupBy("lang").agg(F.slice(F.sort_array(F.collect_list(F.struct("h", "piece"))), 1, rows).alias("p"))
    return {r["lang"]: [x["piece"] for x in r["p"]] for r in best.collect()}


def fit(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", rows: int = SAMPLE_ROWS,
        chars: int = SAMPLE_CHARS, alphabet: int = ALPHABET) -> Model:
    pieces = sample(labelled, text_col, lang_col, rows, chars)
    letters = Counter(c for p in pieces.values() for t in p for c in t.lower() if c.isalpha())
    rank = {c: i + 2 for i, (c, _) in enumerate(sorted(letters.items(), key=lambda x: (-x[1], x[0])))}
    width = min(len(rank), alphabet) + 2
    lut = np.zeros(0x110000, np.uint8 if len(rank) + 2 == width < 250 else np.int32)
    for point in range(0x110000):
        c = chr(point)
        if c.isalpha():
            lut[point] = rank.get(c.lower()[0], 1)
    model = Model([], lut, width, [], [])
    for lang in sorted(pieces):
        ref = np.concatenate([symbols(_points(t + " "), lut) for t in pieces[lang]]) if pieces[lang] else np.zeros(0, lut.dtype)
        if ref.any():
            model.languages.append(lang)
            model.steps.append(automaton(ref.tolist(), width))
            model.bits.append(float(np.log2(len(ref) + 1)))
    return model


def phrases(streams: list[np.ndarray], model: Model) -> np.ndarray:
    """Phrases of each symbol stream (rows) against each language (columns)."""
    cuts = [range(0, len(s), SEGMENT) for s in streams]
    owner = np.repeat(np.arange(len(streams)), [len(c) for c in cuts])
    result = np.zeros((len(streams), len(model.languages)), np.int64)
    if not len(owner):
        return result
    lanes = [s[a:a + SEGMENT] for s, c in zip(streams, cuts) for a in c]
    size = np.fromiter(map(len, lanes), np.int64, len(lanes))
    order = np.argsort(-size, kind="stable")
    grid = np.zeros((len(lanes), int(size.max())), model.symbol.dtype)
    for row, k in enumerate(order.tolist()):
        grid[row, :size[k]] = lanes[k]
    grid = np.ascontiguousarray(grid.T)
    active = np.searchsorted(-size[order], -np.arange(len(grid)), side="left")     # lanes longer than each step
    for j, step in enumerate(model.steps):
        state, count = np.zeros(len(lanes), np.int32), np.ones(len(lanes), np.int64)
        for t, n in enumerate(active.tolist()):
            c = grid[t, :n]
            to = step.take(state[:n], c)
            miss = np.flatnonzero(to < 0)
            count[miss] += 1
            to[miss] = step.take(np.zeros(len(miss), np.int32), c[miss])
            state[:n] = to
        result[:, j] = np.bincount(owner[order], weights=count, minlength=len(streams)).astype(np.int64)
    return result


def identify(found: list[str], m: Model) -> tuple[list[str], np.ndarray, list[float | None]]:
    """Language, score and entropy of each text: the one decision of operator and stage."""
    streams = [symbols(_points(t), m.symbol) for t in found]
    lang, score, entropy = [UNDETERMINED] * len(streams), np.zeros(len(streams)), [None] * len(streams)
    if m.languages:
        bits = phrases(streams, m) * np.array(m.bits)
        best = bits.argmin(1)
        weight = np.exp2(bits.min(1, keepdims=True) - bits)
        for i, s in enumerate(streams):
            if s.any():
                lang[i], score[i] = m.languages[best[i]], 1 / weight[i].sum()
                entropy[i] = bits[i, best[i]] / len(s)
    return lang, score, entropy


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score, entropy) for every row; ``entropy`` is the
    winner's bits per symbol (null for ``und``)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)       # bounded by the sample's parameters
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in slices(batches, "text", 4 << 20):
            lang, score, entropy = identify(texts(b, "text"), m)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(lang, pa.string()), pa.array(score), pa.array(entropy, pa.float64())],
                                             names=["id", "lang_pred", "score", "entropy"])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        releasing(run), f"id {kind}, lang_pred string, score double, entropy double")


def keep_determined(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """Rows of ``docs`` to which ``predict`` gives a language; the others are rejected.
    One pass: the decision rides along with the row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in slices(batches, text_col, 4 << 20):
            lang, _, _ = identify(texts(b, text_col), m)
            yield b.filter(pa.array([x != UNDETERMINED for x in lang], pa.bool_()))

    return docs.mapInArrow(releasing(run), docs.schema)
