"""Quality rules by compression bands.

The zstandard ratio (bytes before / after) of a whole text and of its fixed
chunks tells text that repeats itself (ratio above its band) and text without
structure (ratio below it).  What is usual depends on the length, as a longer text
offers more to refer back to, so each limit holds for a range of lengths.  A
document is kept if its whole ratio lies in the band of its length and at most
half of its bytes stand in chunks outside the band of theirs.

Beside the verdict stand counts over words (runs of anything but ASCII white
space), and the base rules over them.  Every document is judged by itself, in one
pass without a shuffle; memory is a small multiple of ``SLICE_BYTES`` or of the
longest text.

Defined results: a null text is empty; an empty text has no words, fails the base
rules, has the ratio 1 and stands in no band; repeated rows give repeated results;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazardpanel.llm.common import per_text, slices, text_buffers, word_spans

LEVEL, CHUNK_BYTES, SLICE_BYTES = 3, 4096, 4 << 20
#: Share of a document's bytes that may stand in chunks outside their band.
OUTSIDE = 0.5
MIN_WORDS, MAX_REPEATED_PERCENT, WINDOW = 50, 50, 3

# Fixed values: (bytes from, lowest ratio, highest ratio).  Prose reaches 1.3 to 1.9 below
# 1 KB, 1.9 to 2.3 at 4 KB and about 3 at 100 KB; random letters stay near 1.2, and a frame's
# own header makes the ratio of very short texts meaningless from below.
BANDS = [
    (0, 0.0, 2.5),
    (256, 1.15, 3.0),
    (1024, 1.3, 3.5),
    (4096, 1.4, 4.0),
    (16384, 1.4, 4.5),
    (65536, 1.4, 5.0),
]
SYMBOLS = b"#*$%&|<>"

WORD = np.ones(256, bool)
WORD[[0x20, *range(0x09, 0x0E)]] = False
SYMBOL = np.zeros(256, bool)
SYMBOL[list(SYMBOLS)] = True


def band(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lowest and highest ratio for texts of these sizes."""
    start, low, high = (np.array(x) for x in zip(*BANDS))
    at = np.searchsorted(start, sizes, side="right") - 1
    return low[at], high[at]


def ratios(pieces: list[bytes], compress) -> np.ndarray:
    return np.array([len(p) / len(compress(p)) if p else 1.0 for p in pieces])


def shares(text: bytes, compress) -> tuple[float, float]:
    """Shares of the bytes in chunks above their band and below it."""
    chunks = [text[a:a + CHUNK_BYTES] for a in range(0, len(text), CHUNK_BYTES)]
    if not chunks:
        return 0.0, 0.0
    sizes = np.array([len(c) for c in chunks])
    found, (low, high) = ratios(chunks, compress), band(sizes)
    return float(sizes[found > high].sum() / len(text)), float(sizes[found < low].sum() / len(text))


def repeated_words(rows: np.ndarray, codes: np.ndarray, words: int) -> np.ndarray:
    """Whether each word stands in a window of three that its text has twice.
    ``codes`` tells words apart, ``rows`` the texts they are in."""
    covered = np.zeros(len(codes), bool)
    at = np.flatnonzero(rows[2:] == rows[:-2])
    if not len(at):
        return covered
    codes = codes.astype(np.int64)
    _, key = np.unique(codes[at] * words + codes[at + 1], return_inverse=True)
    for part, size in ((codes[at + 2], words), (rows[at], int(rows[-1]) + 1)):      # dense again after each, so no product overflows
        _, key, times = np.unique(key * size + part, return_inverse=True, return_counts=True)
    again = at[times[key] > 1]
    for k in range(WINDOW):
        covered[again + k] = True
    return covered


def duplicate_lines(text: bytes) -> int:
    """Lines that hold a word and equal an earlier line."""
    lines = [x for x in text.split(b"\n") if x.strip()]
    return len(lines) - len(set(lines))


def measure(batch: pa.RecordBatch, compress) -> dict[str, np.ndarray]:
    """Counts, ratios and verdict of the texts of a batch."""
    data, offsets = text_buffers(batch.column(batch.schema.get_field_index("text")))
    row, _, words = word_spans(data, offsets, WORD)
    coded = words.dictionary_encode()
    n_words = np.bincount(row, minlength=batch.num_rows)
    n_again = np.bincount(row[repeated_words(row, coded.indices.to_numpy(), len(coded.dictionary))], minlength=batch.num_rows)
    raw = data.tobytes()
    whole = [raw[x:y] for x, y in zip(offsets.tolist(), offsets[1:].tolist())]
    ratio, (low, high) = ratios(whole, compress), band(np.diff(offsets))
    above, below = np.array([shares(t, compress) for t in whole]).reshape(-1, 2).T
    failed = (n_words < MIN_WORDS) | (100 * n_again > MAX_REPEATED_PERCENT * n_words)
    return {
        "n_words": n_words,
        "word_chars": per_text(WORD[data] & ((data & 0xC0) != 0x80), offsets),
        "n_symbols": per_text(SYMBOL[data], offsets),
        "n_dup_lines": np.array([duplicate_lines(t) for t in whole], np.int64),
        "n_repeat_words": n_again,
        "base_failed": failed,
        "ratio": ratio,
        "repetitive": above,
        "incompressible": below,
        "kept": ~failed & (ratio >= low) & (ratio <= high) & (above + below <= OUTSIDE),
    }


SCHEMA = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean,"
          " ratio double, repetitive double, incompressible double, kept boolean")


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    ratio, repetitive, incompressible, kept) of every whole text of ``docs``; the two
    shares are of the bytes in chunks above and below their band."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compress = zstandard.ZstdCompressor(level=LEVEL).compress
        for b in slices(batches, "text", SLICE_BYTES):
            found = measure(b, compress)
            yield pa.RecordBatch.from_arrays([b.column(0), *map(pa.array, found.values())], names=["id", *found])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"id {docs.schema[id_col].dataType.simpleString()}, {SCHEMA}")


def keep_in_band(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that the rules keep, all columns as they were."""
    held = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(f"`{text_col}`").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compress = zstandard.ZstdCompressor(level=LEVEL).compress
        for b in slices(batches, "text", SLICE_BYTES):
            yield b.filter(pa.array(measure(b, compress)["kept"])).select(["row"])

    return held.mapInArrow(run, held.select("row").schema).select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
