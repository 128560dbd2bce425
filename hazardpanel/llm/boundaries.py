"""Fill-in-middle transformation over sets of token boundaries.

A text is cut into tokens (runs of ASCII letters, and every other character by
itself).  The code point offsets at which tokens end form a set that is kept in
containers of 65 536 offsets each: a sorted array, a bitmap or runs, whichever is
smallest, with the cumulative cardinalities beside them.  A cut after k tokens is
the k-th member of the set: a search of the cumulative cardinalities finds the
container, a local select the member.

The place of both cuts and the form of the output come from a keyed digest of the
document's id, so a rerun or a lost task gives the same result.  Every document is
transformed by itself, in one pass without a shuffle; memory is a small multiple
of ``SLICE_BYTES`` or of the longest text.

Defined results: a null text is empty; an empty text, a text that holds one of the
marks and a document without an id stay plain; repeated rows give repeated
results; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazardpanel.llm.common import slices, texts

SLICE_BYTES = 4 << 20
#: Percentages: documents left plain, and transformed ones written suffix first.
PLAIN, SUFFIX_FIRST = 10, 20
SEED = "1"

# Marks of the three parts.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"

ARRAY, BITMAP, RUNS = 0, 1, 2
SPAN = 1 << 16
LETTER = np.zeros(128, bool)
LETTER[[*range(65, 91), *range(97, 123)]] = True
ONES = np.array([bin(i).count("1") for i in range(256)], np.int64)


def token_ends(text: str) -> np.ndarray:
    """Code point offsets at which the tokens of ``text`` end, ascending."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    letter = LETTER[np.minimum(points, 127)]
    inside = letter[:-1] & letter[1:]           # no token ends between two letters
    return np.append(np.flatnonzero(~inside) + 1, len(points)) if len(points) else np.zeros(0, np.int64)


@dataclass
class Container:
    kind: int
    size: int
    data: np.ndarray        # array: members; bitmap: 8192 bytes; runs: (first, length - 1) pairs

    @classmethod
    def of(cls, low: np.ndarray) -> Container:
        """The smallest form for ascending members below 65 536."""
        breaks = np.flatnonzero(np.diff(low) != 1) + 1
        first = np.concatenate(([0], breaks))
        if 4 * len(first) < min(2 * len(low), SPAN // 8):
            length = np.diff(np.append(first, len(low)))
            return cls(RUNS, len(low), np.stack((low[first], length - 1), 1).astype("<u2"))
        if 2 * len(low) <= SPAN // 8:
            return cls(ARRAY, len(low), low.astype("<u2"))
        flags = np.zeros(SPAN, bool)
        flags[low] = True
        return cls(BITMAP, len(low), np.packbits(flags, bitorder="little"))

    def select(self, k: int) -> int:
        """The member with ``k`` smaller ones."""
        if self.kind == ARRAY:
            return int(self.data[k])
        if self.kind == RUNS:
            before = np.cumsum(self.data[:, 1].astype(np.int64) + 1)
            run = int(np.searchsorted(before, k, side="right"))
            return int(self.data[run, 0]) + k - (int(before[run - 1]) if run else 0)
        before = np.cumsum(ONES[self.data])
        byte = int(np.searchsorted(before, k, side="right"))
        bits = np.flatnonzero(np.unpackbits(self.data[byte:byte + 1], bitorder="little"))
        return 8 * byte + int(bits[k - (int(before[byte - 1]) if byte else 0)])

    def members(self) -> np.ndarray:
        if self.kind == ARRAY:
            return self.data.astype(np.int64)
        if self.kind == RUNS:
            length = self.data[:, 1].astype(np.int64) + 1
            begin = np.cumsum(length) - length
            return np.arange(length.sum()) + np.repeat(self.data[:, 0] - begin, length)
        return np.flatnonzero(np.unpackbits(self.data, bitorder="little"))


class Boundaries:
    """An ascending set of offsets with rank order access."""

    def __init__(self, keys: np.ndarray, containers: list[Container]):
        self.keys, self.containers = keys, containers
        self.before = np.concatenate(([0], np.cumsum([c.size for c in containers], dtype=np.int64)))

    @classmethod
    def of(cls, offsets: np.ndarray) -> Boundaries:
        keys, first = np.unique(offsets >> 16, return_index=True)
        edge = [*first.tolist(), len(offsets)]
        return cls(keys, [Container.of(offsets[a:b] & SPAN - 1) for a, b in zip(edge, edge[1:])])

    def __len__(self) -> int:
        return int(self.before[-1])

    def select(self, k: int) -> int:
        """The offset with ``k`` smaller ones."""
        if not 0 <= k < len(self):
            raise IndexError(k)
        at = int(np.searchsorted(self.before, k, side="right")) - 1
        return (int(self.keys[at]) << 16) + self.containers[at].select(k - int(self.before[at]))

    def cut(self, tokens: int) -> int:
        """Offset after so many tokens."""
        return self.select(tokens - 1) if tokens else 0

    def offsets(self) -> np.ndarray:
        return np.concatenate([c.members() + (int(k) << 16) for k, c in zip(self.keys, self.containers)] or [np.zeros(0, np.int64)])

    def to_bytes(self) -> bytes:
        """Container count, then per container key, kind, cardinality, length of data, data."""
        parts = [struct.pack("<I", len(self.containers))]
        for k, c in zip(self.keys, self.containers):
            raw = c.data.tobytes()
            parts.append(struct.pack("<IBII", int(k), c.kind, c.size, len(raw)) + raw)
        return b"".join(parts)

    @classmethod
    def from_bytes(cls, blob: bytes) -> Boundaries:
        (n,), at, keys, found = struct.unpack_from("<I", blob), 4, [], []
        for _ in range(n):
            key, kind, size, length = struct.unpack_from("<IBII", blob, at)
            at += 13
            data = np.frombuffer(blob, np.uint8 if kind == BITMAP else "<u2", length if kind == BITMAP else length // 2, at)
            keys.append(key)
            found.append(Container(kind, size, data.reshape(-1, 2) if kind == RUNS else data))
            at += length
        return cls(np.array(keys, np.int64), found)


@dataclass
class Cut:
    n: int
    form: str
    prefix: int | None
    middle: int | None
    output: str


def transform_text(doc_id, text: str, ends: Boundaries, seed: str = SEED) -> Cut:
    """The output for one text whose token ends are given."""
    n = len(ends)
    if doc_id is None or not text or PREFIX in text or SUFFIX in text or MIDDLE in text:
        return Cut(n, "plain", None, None, text)
    digest = hashlib.sha256(f"{seed}:{doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * i:8 * i + 8], 16) for i in range(4))
    if h3 % 100 >= 100 - PLAIN:
        return Cut(n, "plain", None, None, text)
    first, second = sorted((ends.cut(h1 % (n + 1)), ends.cut(h2 % (n + 1))))
    prefix, middle, suffix = text[:first], text[first:second], text[second:]
    if h4 % 100 < SUFFIX_FIRST:
        return Cut(n, "spm", first, second - first, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}")
    return Cut(n, "psm", first, second - first, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}")


def _rows(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, str]:
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), f"id {docs.schema[id_col].dataType.simpleString()}"


def boundary_sets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n, ends): the number of tokens and the packed boundary set of every text."""
    rows, kind = _rows(docs, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text", SLICE_BYTES):
            sets = [Boundaries.of(token_ends(t)) for t in texts(b, "text")]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array([s.to_bytes() for s in sets], pa.binary())],
                                             names=["id", "n", "ends"])

    return rows.mapInArrow(run, f"{kind}, n long, ends binary")


def transform(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: str = SEED) -> DataFrame:
    """(id, n, form, prefix_chars, middle_chars, output) of every whole text."""
    rows, kind = _rows(docs, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text", SLICE_BYTES):
            cuts = [transform_text(i, t, Boundaries.of(token_ends(t)), seed) for i, t in zip(b.column(0).to_pylist(), texts(b, "text"))]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([c.n for c in cuts], pa.int64()), pa.array([c.form for c in cuts], pa.string()),
                 pa.array([c.prefix for c in cuts], pa.int64()), pa.array([c.middle for c in cuts], pa.int64()), pa.array([c.output for c in cuts], pa.string())],
                names=["id", "n", "form", "prefix_chars", "middle_chars", "output"])

    return rows.mapInArrow(run, f"{kind}, n long, form string, prefix_chars long, middle_chars long, output string")


def restore(transformed: DataFrame) -> DataFrame:
    """``transformed`` (as ``transform`` returns it) with the text that each
    output was made of, as ``restored``: expressions over output and form."""
    body, middle = F.split("output", MIDDLE, 2)[0], F.split("output", MIDDLE, 2)[1]

    def parts(head: str, second: str):
        split = F.split(F.substr(body, F.lit(len(head) + 1)), second, 2)
        return split[0], split[1]
    (p, s), (s2, p2) = parts(PREFIX, SUFFIX), parts(SUFFIX, PREFIX)
    return transformed.withColumn("restored", F.when(F.col("form") == "psm", F.concat(p, middle, s))
                                  .when(F.col("form") == "spm", F.concat(p2, middle, s2)).otherwise(F.col("output")))
