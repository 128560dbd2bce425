"""Quality classifier: random Fourier features, ridge scores, isotonic calibration.

1. ``statistics``: one pass over the whole texts gives a vector of document
   statistics per row (shares of character classes, word lengths, repetition).
2. ``fit``: the standardised statistics x become cos(W x + b), features whose inner
   products approximate a Gaussian kernel.  Each partition sums its part of the
   normal equations; the sums are added in two steps, so what reaches the driver
   is ``FAN_IN`` matrices whatever the size of the input.  The ridge scores of
   rows kept out of the fit are calibrated by isotonic regression over score bins.
3. ``score``: features, ridge score and calibration of every row.

The fit uses every labelled row.  A null text counts as empty and is scored like
any other; a null label is no label; without labels of both kinds every score is
0.5; labels that repeat an id count each; rows that repeat an id are scored each;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazardpanel.llm.common import slices, text_buffers, texts
from hazardpanel.session import materialize

STATISTICS = ["log_bytes", "upper", "digit", "blank", "line_end", "stop", "bang", "bar", "symbol", "wide",
              "word_bytes", "distinct", "repeated", "line_words", "long_word"]
#: Parameters of the model: features, kernel width in standard deviations, ridge per row, seed, bins of the calibration.
FEATURES, WIDTH, RIDGE, SEED, BINS = 256, 4.0, 1e-3, 11, 1000
CLIP = 6.0
FAN_IN = 16
PREDICT_AT = 0.3

_CLASS = np.full(256, 8, np.uint8)      # byte -> class, in the order of STATISTICS[1:10]
_CLASS[ord("A"):ord("Z") + 1] = 1
_CLASS[ord("0"):ord("9") + 1] = 2
_CLASS[[9, 32]] = 3
_CLASS[[10, 13]] = 4
_CLASS[[ord(c) for c in ".,;:?'\"-()"]] = 5
_CLASS[ord("!")] = 6
_CLASS[ord("|")] = 7
_CLASS[128:] = 9
_CLASS[ord("a"):ord("z") + 1] = 0


def describe(raw: np.ndarray, offsets: np.ndarray, source: list[str]) -> np.ndarray:
    """Statistics of the texts of one batch."""
    n, size = len(source), np.diff(offsets)
    out = np.zeros((n, len(STATISTICS)))
    filled = np.flatnonzero(size)
    out[:, 0] = np.log1p(size)
    if len(filled):
        kind = _CLASS[raw]
        for k in range(1, 10):
            out[filled, k] = np.add.reduceat(kind == k, offsets[:-1][filled], dtype=np.int64) / size[filled]
    for i, t in enumerate(source):
        words = t.split()
        if words:
            m = len(words)
            out[i, 10] = np.log1p(size[i] / m)
            out[i, 11] = len(set(words)) / m
            out[i, 12] = sum(map(eq, words, words[1:])) / m
            out[i, 13] = np.log(m / (t.count("\n") + 1))
            out[i, 14] = np.log1p(max(map(len, words)))
    return out


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, x): the statistics of every row."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text", 8 << 20):
            raw, offsets = text_buffers(b.column(1))
            x = describe(raw, offsets, texts(b, "text"))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(list(x), pa.list_(pa.float64()))], names=["id", "x"])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, f"id {kind}, x array<double>")


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    w: np.ndarray
    b: np.ndarray
    beta: np.ndarray | None = None
    knots: tuple[np.ndarray, np.ndarray] | None = None

    def features(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -CLIP, CLIP)
        f = np.cos(z @ self.w + self.b) * np.sqrt(2 / self.w.shape[1])
        return np.concatenate((f, np.ones((len(x), 1))), 1)

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.features(x) @ self.beta

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.beta is None:
            return np.full(len(x), 0.5)
        raw = np.clip(self.raw(x), -0.5, 1.5)
        level = (raw + 0.5) / 2             # keeps the order inside the calibration's flat steps
        if self.knots is None:
            return level
        return np.clip(0.99 * np.interp(raw, *self.knots) + 0.01 * level, 0, 1)


def _matrix(column) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, len(STATISTICS)))


def isotonic(at: np.ndarray, total: np.ndarray, positive: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: knots (mean position, mean label) of the
    increasing fit to bins at positions ``at``."""
    blocks: list[list[float]] = []
    for x, n, p in zip(at, total, positive):
        blocks.append([x * n, n, p])
        while len(blocks) > 1 and blocks[-2][2] / blocks[-2][1] >= blocks[-1][2] / blocks[-1][1]:
            last = blocks.pop()
            blocks[-1] = [u + v for u, v in zip(blocks[-1], last)]
    return np.array([x / n for x, n, _ in blocks]), np.array([p / n for _, n, p in blocks])


def normal_equations(rows: DataFrame, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Sums of f f' and f y over ``rows`` (x, y)."""
    size = model.w.shape[1] + 1

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        total, any_row = np.zeros((size, size + 1)), False
        for b in batches:
            for at in range(0, b.num_rows, 4096):
                s = b.slice(at, 4096)
                f = model.features(_matrix(s.column(0)))
                total += f.T @ np.concatenate((f, s.column(1).to_numpy(zero_copy_only=False)[:, None]), 1)
                any_row = True
        if any_row:
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId() % FAN_IN], pa.int32()), pa.array([total.tobytes()], pa.binary())], names=["k", "s"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size * (size + 1))
        for b in batches:
            for s in b.column(1):
                total += np.frombuffer(s.as_buffer())
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["s"])

    sums = rows.select("x", "y").mapInArrow(part, "k int, s binary").repartition(FAN_IN, "k").mapInArrow(add, "s binary").collect()
    total = sum((np.frombuffer(r["s"]) for r in sums), np.zeros(size * (size + 1))).reshape(size, size + 1)
    return total[:, :size], total[:, size]


def fit(train: DataFrame, calibrate: DataFrame, features: int = FEATURES, width: float = WIDTH, ridge: float = RIDGE) -> Model:
    """Fit on ``train`` and calibrate on ``calibrate``: (x, y) with y 0.0 or 1.0."""
    d = len(STATISTICS)
    moments = train.agg(*[F.avg(F.col("x")[i]).alias(f"m{i}") for i in range(d)], *[F.stddev_pop(F.col("x")[i]).alias(f"s{i}") for i in range(d)],
                        F.count(F.lit(1)).alias("n"), F.sum("y").alias("p")).first()
    rng = np.random.default_rng(SEED)
    w, b = rng.normal(0, 1 / width, (d, features)), rng.uniform(0, 2 * np.pi, features)
    if not moments["n"] or moments["p"] in (0, moments["n"]):
        return Model(np.zeros(d), np.ones(d), w, b)
    spread = np.array([moments[f"s{i}"] for i in range(d)])
    model = Model(np.array([moments[f"m{i}"] for i in range(d)]), np.where(spread > 1e-9, spread, 1.0), w, b)
    left, right = normal_equations(train, model)
    # ridge on all but the constant, a part of it in proportion to the rows
    penalty = np.full(features + 1, 0.1 + ridge * moments["n"] / features)
    penalty[-1] = 1e-9
    model.beta = np.linalg.solve(left + np.diag(penalty), right)

    def bins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b_ in batches:
            if b_.num_rows:
                raw = np.clip(model.raw(_matrix(b_.column(0))), -0.5, 1.5)
                yield pa.RecordBatch.from_arrays([pa.array(np.rint(raw * BINS).astype(np.int32)), b_.column(1)], names=["bin", "y"])

    found = calibrate.select("x", "y").mapInArrow(bins, "bin int, y double").groupBy("bin").agg(
        F.count(F.lit(1)).alias("n"), F.sum("y").alias("p")).orderBy("bin").collect()        # at most 2 x BINS + 1 rows
    if found:
        model.knots = isotonic(np.array([r["bin"] / BINS for r in found]), np.array([r["n"] for r in found], float), np.array([r["p"] for r in found]))
    return model


def score(described: DataFrame, model: Model) -> DataFrame:
    """(id, score) of every row of ``statistics``."""
    kind = described.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(model.score(_matrix(b.column(1))))], names=["id", "score"])

    return described.select("id", "x").mapInArrow(run, f"id {kind}, score double")


def classify(docs: DataFrame, labels: DataFrame, label_col: str, fit_rows, calibrate_rows, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) of every row of ``docs``.  ``fit_rows`` and ``calibrate_rows``
    are conditions on a column ``id``; other labels are not read."""
    described = materialize(statistics(docs, id_col, text_col), "statistics")
    known = labels.select(F.col(id_col).alias("l"), F.col(label_col).cast("double").alias("y")).filter("y is not null and l is not null")
    rows = materialize(described.filter(fit_rows | calibrate_rows).join(known, F.col("id") == F.col("l")).select("id", "x", "y"), "labelled")
    return score(described, fit(rows.filter(fit_rows), rows.filter(calibrate_rows)))
