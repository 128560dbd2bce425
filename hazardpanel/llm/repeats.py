"""Repeated substrings across a corpus: an enhanced suffix array, bucket by bucket.

A suffix array of a whole corpus fits no machine, so it is built piecewise over
*frames*.  Every window of ``length`` bytes picks an anchor, the k-gram of least
hash in it (leftmost among equals): equal windows pick the same k-gram at the same
place.  The run of windows of one anchor is a frame (at most ``2 length - k``
bytes); all places where a window occurs therefore lie in frames that meet in the
bucket of their k-gram.

1. ``pack``: texts are written once as chunks of a few MB.
2. Chunks report the k-gram hashes of their anchors and how many different frames
   each has to the hashes' buckets, which answer with two bits each: does another
   chunk have it, and do the chunks have more than ``HOT`` frames of it?
3. Frames of k-grams that occur again, equal ones of a chunk merged, go to the
   buckets.  There the suffixes at the frames' windows are sorted, neighbours'
   common prefixes (LCP) computed, and a stack scan yields the tree of common-
   prefix intervals of at least ``length`` bytes.  An interval whose occurrences
   all have the same byte on the left is part of a longer repeat; the others are
   maximal repeats (within their frames; a longer repeat is reported frame by
   frame), with all their occurrences.
4. In each group the earliest occurrence stays, the others are spans to remove;
   they go back to their chunks.

Equal frames merge chunk by chunk before they are sent: the inside of a frequent
passage costs its bucket one frame per chunk.  At its ends frames hold the context
of each document, too, and differ; such a k-gram soon has more than ``HOT`` frames.
To remove repeats, those are taken apart into windows: equal windows of a chunk
merge, and what is left is dealt by the hash of the window, one row per chunk and
window, so that no task gets all documents of a passage.

Positions are ordered by document id (null first), the hash of the text for equal
ids, and start.  A null text is empty; texts under ``length`` bytes have no
repeat; a row that repeats another row entirely loses all its bytes (from
``length`` on); an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazardpanel.llm.common import shuffle_width, slices, text_buffers
from hazardpanel.session import materialize

LENGTH = 100
GRAM = 32
CHUNK = 8 << 20             # bytes of text in a chunk; also what a bucket is sized by
STEP = 1 << 20              # windows handled at a time
SUFFIXES = 1 << 15          # suffixes compared at a time
HOT = 4096                  # frames of one k-gram that a bucket takes; those of others are dealt window by window
_RNG = np.random.default_rng(20240501)
_BYTE = _RNG.integers(0, 2**64, (3, 256), dtype=np.uint64)          # random value of each byte, for three hashes
_FOLD = _RNG.integers(0, 2**63, 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = _RNG.integers(0, 2**62, 2, dtype=np.uint64) * np.uint64(4) + np.uint64(3)
_MIX = np.uint64(0x9E3779B97F4A7C15)
_LOW, _HIGH = np.uint64(0xFFFFFFFF), np.uint64(0xFFFFFFFF00000000)


# ---------------------------------------------------------------- blobs

def dump(*arrays: np.ndarray, level: int = 5) -> bytes:
    """Arrays as one compressed blob."""
    head = np.array([len(arrays), *[x for a in arrays for x in (len(a), np.dtype(a.dtype).num)]], "<i8")
    return zstandard.ZstdCompressor(level=level).compress(head.tobytes() + b"".join(np.ascontiguousarray(a).tobytes() for a in arrays))


_TYPES = {np.dtype(t).num: np.dtype(t) for t in (np.uint8, np.int32, np.int64, np.uint64, bool)}


def load(blob: bytes) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    n = int(np.frombuffer(raw, "<i8", 1)[0])
    head = np.frombuffer(raw, "<i8", 2 * n, 8).reshape(n, 2)
    at, out = 8 + 16 * n, []
    for size, kind in head.tolist():
        t = _TYPES[kind]
        out.append(np.frombuffer(raw, t, size, at))
        at += size * t.itemsize
    return out


def gather(raw: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The bytes of many ranges, one after the other."""
    end = np.cumsum(size)
    return raw[np.arange(int(end[-1]) if len(end) else 0) + np.repeat(start - (end - size), size)]


# ---------------------------------------------------------------- hashes and frames

def content_hashes(raw: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit hashes of each range (ranges in ascending order of
    start are cheapest; each is hashed inside blocks of the buffer)."""
    out = [np.zeros(len(start), np.uint64) for _ in range(2)]
    if not len(start):
        return out[0], out[1]
    order = np.argsort(start, kind="stable")
    reach = int(size.max())
    for lo in range(0, len(raw), STEP):
        a, b = np.searchsorted(start[order], [lo, lo + STEP])
        if a == b:
            continue
        rows, part = order[a:b], raw[lo:lo + STEP + reach]
        for k in range(2):
            power, inverse = _powers(k, len(part) + 1)
            total = np.zeros(len(part) + 1, np.uint64)
            np.cumsum(_BYTE[k + 1][part] * power[:-1], out=total[1:])
            s = start[rows] - lo
            h = (total[s + size[rows]] - total[s]) * inverse[s] + size[rows].astype(np.uint64) * _MIX
            out[k][rows] = mix(h)
    return out[0], out[1]


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _MIX
    return h ^ (h >> np.uint64(29))


_POWER: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(k: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of a base and of its inverse modulo 2^64."""
    if k not in _POWER or len(_POWER[k][0]) < n:
        size = max(n, STEP + 4 * LENGTH)
        base = int(_BASE[k])
        both = []
        for b in (base, pow(base, -1, 1 << 64)):
            p = np.full(size, b, np.uint64)
            p[0] = 1
            both.append(np.multiply.accumulate(p))
        _POWER[k] = both[0], both[1]
    return _POWER[k][0][:n], _POWER[k][1][:n]


@dataclass
class Frames:
    """Runs of windows that share an anchor: hash of the k-gram, first byte, bytes."""
    gram: np.ndarray
    start: np.ndarray
    size: np.ndarray


def frames(raw: np.ndarray, offsets: np.ndarray, length: int = LENGTH, k: int = GRAM) -> Frames:
    """Frames of all texts in a buffer."""
    begin, end = offsets[:-1], offsets[1:]
    long = end - begin >= length
    step = np.zeros(len(raw) + 1, np.int32)
    np.add.at(step, begin[long], 1)
    np.add.at(step, end[long] - length + 1, -1)
    inside = np.cumsum(step[:-1]) > 0           # a window starts here and ends in the same text
    grams, starts, sizes = [], [], []
    width = length - k + 1
    for lo in range(0, len(raw), STEP):
        if not inside[lo:lo + STEP].any():
            continue
        h = _BYTE[0][raw[lo:lo + STEP + length - 1]]
        span, level = 1, 0
        while span < k:                         # hash of k bytes from those of the halves
            add = min(span, k - span)
            h = h[:-add] * _FOLD[level] + h[add:]
            span, level = span + add, level + 1
        h = mix(h)
        least = (h & _HIGH) | np.arange(len(h), dtype=np.uint64)
        span = 1
        while span < width:                     # least of ``width`` in a row: smallest hash, then leftmost
            add = min(span, width - span)
            least = np.minimum(least[:-add], least[add:])
            span += add
        at = np.flatnonzero(inside[lo:lo + STEP][:len(least)])
        anchor = (least[at] & _LOW).astype(np.int64)
        first = np.concatenate(([0], np.flatnonzero((np.diff(anchor) != 0) | (np.diff(at) != 1)) + 1))
        count = np.diff(np.concatenate((first, [len(at)])))
        grams.append(h[anchor[first]])
        starts.append(at[first] + lo)
        sizes.append(count + length - 1)
    if not grams:
        return Frames(np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64))
    return Frames(np.concatenate(grams), np.concatenate(starts), np.concatenate(sizes))


# ---------------------------------------------------------------- suffixes of a bucket

def intervals(lcp: list[int], left: list[int], least: int) -> Iterator[tuple[int, int, int]]:
    """Stack scan of an enhanced suffix array: (length, first, last) of every
    common-prefix interval of at least ``least`` whose suffixes differ in the byte
    on their left.  ``lcp[i]`` belongs to suffixes i - 1 and i; ``left`` has the
    byte before each suffix, negative where it is unknown (which differs from all)."""
    stack: list[list[int]] = []                 # length, first suffix, byte on the left or -1
    for i in range(1, len(lcp) + 1):
        depth, first = (lcp[i] if i < len(lcp) else 0), i - 1
        byte = left[i - 1]
        while stack and stack[-1][0] > depth:
            size, lo, own = stack.pop()
            own = own if own == byte else -1
            if own < 0:
                yield size, lo, i - 1
            first, byte = lo, own
        if depth >= least:
            if stack and stack[-1][0] == depth:
                stack[-1][2] = stack[-1][2] if stack[-1][2] == byte else -1
            else:
                stack.append([depth, first, byte])
        elif stack:
            raise AssertionError("the stack holds only intervals of at least the least length")


def _whole_keys(key: np.ndarray, weight: np.ndarray, most: int) -> Iterator[slice]:
    """Successive parts of rows sorted by ``key`` of at most ``most`` in weight, no
    key cut in two (one heavier key is a part of its own)."""
    end = np.flatnonzero(np.concatenate((key[1:] != key[:-1], [True]))) + 1
    total = np.concatenate((np.cumsum(weight), [0]))[end - 1]
    at = done = 0
    while at < len(key):
        k = max(int(np.searchsorted(total, done + most, side="right")) - 1, int(np.searchsorted(end, at, side="right")))
        yield slice(at, int(end[k]))
        at, done = int(end[k]), int(total[k])


def maximal_repeats(text: np.ndarray, begin: np.ndarray, size: np.ndarray, length: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, frame, offset in the frame) of the occurrences of each maximal
    repeat of different frames."""
    count = size - length + 1
    frame = np.repeat(np.arange(len(size), dtype=np.int32), count)
    offset = (np.arange(len(frame)) - np.repeat(np.cumsum(count) - count, count)).astype(np.int32)
    # a suffix whose first bytes occur once is in no interval, and only those of equal first bytes share one
    first, _ = content_hashes(text, begin[frame] + offset, np.full(len(frame), length))
    order = np.argsort(first, kind="stable")
    first = first[order]
    same = first[1:] == first[:-1]
    again = np.zeros(len(order), bool)
    again[1:] = same
    again[:-1] |= same
    order, first = order[again], first[again]
    padded = np.concatenate((text, np.zeros(int(size.max()) if len(size) else 0, np.uint8)))
    for part in _whole_keys(first, np.ones(len(first), np.int64), SUFFIXES):
        rows = order[part]
        yield from _repeats_of(padded, begin, size, frame[rows], offset[rows], length)


def _repeats_of(padded: np.ndarray, begin: np.ndarray, size: np.ndarray, frame: np.ndarray, offset: np.ndarray, length: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Maximal repeats among some suffixes: sorted, compared with their neighbours, scanned."""
    rest = size[frame] - offset
    wide = int(rest.max())
    reach = np.arange(wide)
    suffix = padded[(begin[frame] + offset)[:, None] + reach]
    suffix[reach >= rest[:, None]] = 0
    order = np.argsort(suffix.view(f"V{wide}").ravel(), kind="stable")
    suffix, rest, frame, offset = suffix[order], rest[order], frame[order], offset[order]
    differ = suffix[1:] != suffix[:-1]
    common = np.where(differ.any(1), differ.argmax(1), wide)
    lcp = np.concatenate(([0], np.minimum(common, np.minimum(rest[1:], rest[:-1]))))
    lcp[lcp < length] = 0
    left = np.where(offset > 0, padded[begin[frame] + offset - 1].astype(np.int64), -1)
    for depth, lo, hi in intervals(lcp.tolist(), left.tolist(), length):
        yield depth, frame[lo:hi + 1], offset[lo:hi + 1]


# ---------------------------------------------------------------- Spark stages

def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(chunk, n_bytes, data): the texts of a few MB with ids and text hashes.
    Written once, so a chunk and the places in it are the same for every stage."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part, number = TaskContext.get().partitionId(), 0
        for b in slices(batches, "text", CHUNK):
            raw, offsets = text_buffers(b.column(2))
            ids = b.column(0)
            data = dump(ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64), np.array(ids.is_null().to_numpy(zero_copy_only=False), bool),
                        b.column(1).to_numpy(zero_copy_only=False).astype(np.int64), offsets, raw)
            yield pa.RecordBatch.from_arrays([pa.array([part << 32 | number], pa.int64()), pa.array([len(raw)], pa.int64()), pa.array([data], pa.binary())], names=["chunk", "n_bytes", "data"])
            number += 1

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("hash"), F.col(text_col).alias("text"))
    return materialize(rows.mapInArrow(run, "chunk long, n_bytes long, data binary"), "repeats-chunks")


def _batch(schema: pa.Schema, rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
    for b in batches:
        columns = [c.to_pylist() if not pa.types.is_binary(c.type) else c for c in b.columns]
        for i in range(b.num_rows):
            yield [c[i].as_py() if isinstance(c, pa.Array) else c[i] for c in columns]


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[list]]]:
    """Rows of equal first column, which come one after the other."""
    key, held = None, []
    for row in _rows(batches):
        if held and row[0] != key:
            yield key, held
            held = []
        key = row[0]
        held.append(row)
    if held:
        yield key, held


_KEYED = pa.schema([("key", pa.int64()), ("source", pa.int64()), ("data", pa.binary())])
_ADDRESSED = "key long, source long, data binary"


def _frame_counts(found: Frames, raw: np.ndarray, distinct: np.ndarray) -> np.ndarray:
    """Different frames of each of the ``distinct`` k-grams in a chunk."""
    order = np.argsort(distinct, kind="stable")
    place = order[np.searchsorted(distinct[order], found.gram)]
    count = np.bincount(place, minlength=len(distinct))
    more = np.flatnonzero(count[place] > 1)                 # one frame is one
    one, two = content_hashes(raw, found.start[more], found.size[more])
    by = np.lexsort((two, one, place[more]))
    same = np.zeros(len(by), bool)
    same[1:] = (np.diff(place[more][by]) == 0) & (one[by][1:] == one[by][:-1]) & (two[by][1:] == two[by][:-1])
    return (count - np.bincount(place[more][by][same], minlength=len(distinct))).astype("<i4")


def _grams_of(chunk: list[np.ndarray], buckets: int) -> tuple[Frames, np.ndarray, np.ndarray, np.ndarray]:
    """Frames of a chunk, its distinct k-gram hashes by bucket, and where each bucket begins."""
    found = frames(chunk[4], chunk[3])
    distinct = np.unique(found.gram)
    bucket = (distinct % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    distinct, bucket = distinct[order], bucket[order]
    return found, distinct, bucket, np.searchsorted(bucket, np.arange(buckets + 1))


def recurring(chunks: DataFrame, buckets: int) -> DataFrame:
    """(key = chunk, source = bucket, data): two bits for each distinct k-gram hash
    of the chunk in the bucket: another chunk has it, too; the chunks have more than
    ``HOT`` different frames of it."""
    most = HOT

    def report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk, data in _rows(batches):
            held = load(data)
            found, distinct, _, edge = _grams_of(held, buckets)
            count = _frame_counts(found, held[4], distinct)
            rows = [(k, chunk, distinct[edge[k]:edge[k + 1]].tobytes() + count[edge[k]:edge[k + 1]].tobytes()) for k in np.flatnonzero(np.diff(edge)).tolist()]
            if rows:
                yield _batch(_KEYED, rows)

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, rows in _runs(batches):
            sizes = [len(r[2]) // 12 for r in rows]
            parts = [np.frombuffer(r[2], np.uint64, n) for r, n in zip(rows, sizes)]
            frames_of = np.concatenate([np.frombuffer(r[2], "<i4", n, 8 * n) for r, n in zip(rows, sizes)])
            value, inverse, count = np.unique(np.concatenate(parts), return_inverse=True, return_counts=True)
            bits = (count > 1)[inverse], (np.bincount(inverse, weights=frames_of, minlength=len(value)) > most)[inverse]
            edge = np.concatenate(([0], np.cumsum(sizes)))
            yield _batch(_KEYED, [(r[1], bucket, b"".join(np.packbits(x[a:b]).tobytes() for x in bits)) for r, a, b in zip(rows, edge, edge[1:])])

    asked = chunks.select("chunk", "data").mapInArrow(report, _ADDRESSED).repartition(max(buckets, 1), "key").sortWithinPartitions("key")
    return asked.mapInArrow(answer, _ADDRESSED)


def _rank(ids: np.ndarray, nulls: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Place of each text of a chunk in the order of positions."""
    rank = np.empty(len(ids), np.int64)
    rank[np.lexsort((np.arange(len(ids)), hashes, ids, ~nulls))] = np.arange(len(ids))
    return rank


def _kept_frames(found: Frames, chunk: list[np.ndarray], seen: np.ndarray, links: bool = False):
    """Of a chunk's frames: those to send, and places (text, start, size) that
    an equal earlier frame of the chunk covers.  ``seen``: k-gram occurs in another chunk.
    With ``links`` frames with copies are always sent and marked, and each copy
    (text, start) comes with the text and start of its kept frame."""
    ids, nulls, hashes, offsets, raw = chunk
    _, inverse, count = np.unique(found.gram, return_inverse=True, return_counts=True)
    use = np.flatnonzero(seen | (count[inverse] > 1))
    gram, start, size, seen = found.gram[use], found.start[use], found.size[use], seen[use]
    doc = np.searchsorted(offsets, start, side="right") - 1
    rank = _rank(ids, nulls, hashes)
    one, two = content_hashes(raw, start, size)
    order = np.lexsort((start, rank[doc], two, one))
    new = np.ones(len(order), bool)
    new[1:] = (one[order][1:] != one[order][:-1]) | (two[order][1:] != two[order][:-1])
    kept, copies = order[new], order[~new]
    # a k-gram that only this chunk has and that has one frame left meets nothing
    _, inverse, count = np.unique(gram[kept], return_inverse=True, return_counts=True)
    local = start - offsets[doc]
    if links:
        of = kept[(np.cumsum(new) - 1)[~new]]
        copied = np.isin(kept, of)
        sent = seen[kept] | (count[inverse] > 1) | copied
        kept = kept[sent]
        return (gram[kept], doc[kept], local[kept], size[kept], start[kept], copied[sent]), (doc[copies], local[copies], doc[of], local[of])
    kept = kept[seen[kept] | (count[inverse] > 1)]
    return (gram[kept], doc[kept], local[kept], size[kept], start[kept]), (doc[copies], local[copies], size[copies])


def _first_windows(chunk: list[np.ndarray], start: np.ndarray, size: np.ndarray):
    """Of the windows of some frames of a chunk: hashes, text and start in the chunk
    of the earliest of each content, and spans (text, start, size) of the others."""
    ids, nulls, hashes, offsets, raw = chunk
    count = size - LENGTH + 1
    at = np.sort(np.repeat(start - (np.cumsum(count) - count), count) + np.arange(int(count.sum())))
    doc = np.searchsorted(offsets, at, side="right") - 1
    one, two = content_hashes(raw, at, np.full(len(at), LENGTH))
    order = np.lexsort((at, _rank(ids, nulls, hashes)[doc], two, one))
    new = np.ones(len(order), bool)
    new[1:] = (one[order][1:] != one[order][:-1]) | (two[order][1:] != two[order][:-1])
    first, late = np.sort(order[new]), np.sort(order[~new])
    return (one[first], two[first], doc[first], at[first]), _joined(doc[late], at[late] - offsets[doc[late]])


def _joined(doc: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, start, size) of the spans of windows in ascending order, those of
    successive windows as one."""
    begins = np.ones(len(doc), bool)
    begins[1:] = (np.diff(doc) != 0) | (np.diff(start) != 1)
    edge = np.flatnonzero(np.concatenate((begins, [True])))
    return doc[edge[:-1]], start[edge[:-1]], np.diff(edge) + LENGTH - 1


def _send_windows(chunk: list[np.ndarray], number: int, one: np.ndarray, two: np.ndarray, doc: np.ndarray, at: np.ndarray, buckets: int) -> Iterator[pa.RecordBatch]:
    """Windows of a chunk, dealt by their hash."""
    ids, nulls, hashes, offsets, _ = chunk
    to = (one % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(to, kind="stable")
    edge = np.searchsorted(to[order], np.arange(buckets + 1))
    for k in np.flatnonzero(np.diff(edge)):
        r = order[edge[k]:edge[k + 1]]
        texts, inverse = np.unique(doc[r], return_inverse=True)
        yield _batch(_KEYED, [(buckets + int(k), number, dump(one[r], two[r], inverse.astype(np.int32), at[r] - offsets[doc[r]],
                                                              texts.astype(np.int32), ids[texts], nulls[texts], hashes[texts]))])


def _send(chunks: DataFrame, bits: DataFrame, buckets: int, links: bool = False) -> DataFrame:
    """(key, source, data): frames to buckets (0 <= key < buckets), windows of the
    frames of hot k-grams to theirs (key >= buckets), and spans that the chunk itself
    has found to chunks (key = -1 - chunk).  With ``links`` all frames go whole, and
    instead of spans (source = chunk) each copy's place and that of its kept frame."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        answers: dict[int, bytes] = {}
        for chunk, source, data in _rows(batches):      # a chunk comes after the answers to it
            if source >= 0:
                answers[source] = data
                continue
            held = load(data)
            found, distinct, bucket, edge = _grams_of(held, buckets)
            again, many = np.zeros(len(distinct), bool), np.zeros(len(distinct), bool)
            for k, packed in answers.items():
                n, both = int(edge[k + 1] - edge[k]), np.frombuffer(packed, np.uint8)
                again[edge[k]:edge[k + 1]] = np.unpackbits(both[:len(both) // 2])[:n]
                many[edge[k]:edge[k + 1]] = np.unpackbits(both[len(both) // 2:])[:n]
            answers = {}
            seen = np.isin(found.gram, distinct[again], kind="sort")
            if links:
                (gram, doc, local, size, start, copied), (copy, place, of, lead) = _kept_frames(found, held, seen, links)
                if len(copy):
                    yield _batch(_KEYED, [(-1 - chunk, chunk, dump(of.astype(np.int32), lead, held[0][copy], held[1][copy], place))])
            else:
                (gram, doc, local, size, start), copies = _kept_frames(found, held, seen)
                copied, hot = None, np.isin(gram, distinct[many], kind="sort")
            if not links and hot.any():
                (one, two, text, at), spans = _first_windows(held, start[hot], size[hot])
                copies = tuple(np.concatenate(x) for x in zip(copies, spans))
                yield from _send_windows(held, chunk, one, two, text, at, buckets)
                gram, doc, local, size, start = (x[~hot] for x in (gram, doc, local, size, start))
            if not links and len(copies[0]):
                yield _batch(_KEYED, [(-1 - chunk, -1, dump(copies[0].astype(np.int32), copies[1], copies[2].astype(np.int32)))])
            to = (gram % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(to, kind="stable")
            edge = np.searchsorted(to[order], np.arange(buckets + 1))
            for k in np.flatnonzero(np.diff(edge)):
                r = order[edge[k]:edge[k + 1]]
                yield _batch(_KEYED, [(int(k), chunk, dump(gram[r], doc[r].astype(np.int32), local[r], size[r].astype(np.int32),
                                                           held[0][doc[r]], held[1][doc[r]], held[2][doc[r]], gather(held[4], start[r], size[r]),
                                                           *([copied[r]] if links else [])))])

    rows = chunks.select(F.col("chunk").alias("key"), F.lit(-1).cast("long").alias("source"), "data").unionByName(bits)
    return rows.repartition("key").sortWithinPartitions("key", F.desc("source")).mapInArrow(run, _ADDRESSED)


@dataclass
class Bucket:
    """Frames that meet: k-gram, chunk, text in the chunk, start in the text, size, order, bytes;
    with links also which have copies in their chunk."""
    gram: np.ndarray
    chunk: np.ndarray
    doc: np.ndarray
    start: np.ndarray
    size: np.ndarray
    rank: np.ndarray
    ids: np.ndarray
    nulls: np.ndarray
    text: np.ndarray
    begin: np.ndarray
    copied: np.ndarray | None = None


def _bucket(rows: list[list]) -> Bucket:
    parts = [load(r[2]) for r in rows]
    gram, doc, start, size, ids, nulls, hashes, text = (np.concatenate(x) for x in list(zip(*parts))[:8])
    copied = np.concatenate([p[8] for p in parts]) if len(parts[0]) > 8 else None
    chunk = np.repeat([r[1] for r in rows], [len(p[0]) for p in parts])
    rank = np.empty(len(gram), np.int64)
    rank[np.lexsort((start, doc, chunk, hashes, ids, ~nulls))] = np.arange(len(gram))
    size = size.astype(np.int64)
    return Bucket(gram, chunk, doc, start, size, rank, ids, nulls, text, np.cumsum(size) - size, copied)


def groups(b: Bucket, length: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, frames, offsets) of the occurrences of every maximal repeat of a
    bucket.  Equal frames are one repeat of their whole size; the suffixes of
    different frames of a k-gram are compared in the suffix array."""
    one, two = content_hashes(b.text, b.begin, b.size)
    order = np.lexsort((b.rank, two, one, b.gram))
    gram = b.gram[order]
    new = np.ones(len(order), bool)
    new[1:] = (gram[1:] != gram[:-1]) | (one[order][1:] != one[order][:-1]) | (two[order][1:] != two[order][:-1])
    kind = np.cumsum(new) - 1
    first = np.flatnonzero(new)
    many = np.diff(np.concatenate((first, [len(order)])))
    whole = many > 1
    if b.copied is not None and len(first):
        whole |= np.logical_or.reduceat(b.copied[order], first)
    # representatives of the k-grams that have different frames
    lead = order[first]
    _, inverse, count = np.unique(b.gram[lead], return_inverse=True, return_counts=True)
    pick = np.flatnonzero(count[inverse] > 1)
    for part in _whole_keys(b.gram[lead[pick]], b.size[lead[pick]], STEP):
        kinds = pick[part]
        rows = lead[kinds]
        size = b.size[rows]
        text = gather(b.text, b.begin[rows], size)
        for depth, frame, offset in maximal_repeats(text, np.cumsum(size) - size, size, length):
            # the same string, and more places of it than the equal frames are
            whole[kinds[frame[(offset == 0) & (size[frame] == depth)]]] = False
            sizes = many[kinds[frame]]
            members = order[np.repeat(first[kinds[frame]], sizes) + np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)]
            yield depth, members, np.repeat(offset, sizes)
    for k in np.flatnonzero(whole):
        members = order[first[k]:first[k] + many[k]]
        yield int(b.size[members[0]]), members, np.zeros(len(members), np.int64)


def _late_windows(rows: list[list]) -> list[tuple]:
    """Of the windows that meet: spans of all but the earliest of each content, by chunk."""
    parts = [load(r[2]) for r in rows]
    one, two, start = (np.concatenate([p[k] for p in parts]) for k in (0, 1, 3))
    doc, ids, nulls, hashes = (np.concatenate([p[k][p[2]] for p in parts]) for k in (4, 5, 6, 7))
    chunk = np.repeat([r[1] for r in rows], [len(p[0]) for p in parts])
    order = np.lexsort((start, doc, chunk, hashes, ids, ~nulls, two, one))
    late = order[1:][(one[order][1:] == one[order][:-1]) & (two[order][1:] == two[order][:-1])]
    late = late[np.lexsort((start[late], doc[late], chunk[late]))]
    edge = np.flatnonzero(np.concatenate(([True], np.diff(chunk[late]) != 0, [True]))) if len(late) else []
    out = []
    for x, y in zip(edge, edge[1:]):
        text, at, size = _joined(doc[late[x:y]], start[late[x:y]])
        out.append((int(chunk[late[x]]), 0, dump(text.astype(np.int32), at, size.astype(np.int32))))
    return out


def _spans(buckets_of: DataFrame, buckets: int) -> DataFrame:
    """(key = chunk, source, data): all but the earliest occurrence of each group,
    and the spans that chunks found themselves."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, rows in _runs(batches):
            if key < 0:
                yield _batch(_KEYED, [(-1 - key, 0, r[2]) for r in rows])
                continue
            if key >= buckets:
                if spans := _late_windows(rows):
                    yield _batch(_KEYED, spans)
                continue
            b = _bucket(rows)
            who, where, size = [], [], []
            for depth, members, offset in groups(b, LENGTH):
                late = np.ones(len(members), bool)
                late[np.argmin(b.rank[members])] = False
                who.append(members[late]), where.append(offset[late]), size.append(np.full(int(late.sum()), depth))
            if not who:
                continue
            who, where, size = np.concatenate(who), np.concatenate(where), np.concatenate(size)
            order = np.argsort(b.chunk[who], kind="stable")
            who, where, size = who[order], where[order], size[order]
            edge = np.flatnonzero(np.concatenate(([True], np.diff(b.chunk[who]) != 0, [True])))
            yield _batch(_KEYED, [(int(b.chunk[who[x]]), 0, dump(b.doc[who[x:y]], b.start[who[x:y]] + where[x:y], size[x:y].astype(np.int32))) for x, y in zip(edge, edge[1:])])

    return buckets_of.mapInArrow(run, _ADDRESSED)


def _buckets(chunks: DataFrame, buckets: int) -> DataFrame:
    sent = _send(chunks, recurring(chunks, buckets), buckets)
    return sent.repartition(buckets, "key").sortWithinPartitions("key")


def bucket_count(chunks: DataFrame) -> int:
    """Buckets of about a chunk's size each; what a bucket holds does not grow with the corpus."""
    total = chunks.agg(F.sum("n_bytes")).first()[0] or 0
    return max(shuffle_width(chunks.sparkSession), -(-total // CHUNK))


def repeat_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(repeat_id, n_bytes, doc_id, start): every maximal repeat with all its
    occurrences.  Buckets find the repeats over one of the equal frames of a chunk;
    a join over the places of the frames adds those of their copies."""
    chunks = pack(docs, id_col, text_col)
    buckets = bucket_count(chunks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, rows in _runs(batches):
            b = _bucket(rows)
            for n, (depth, members, offset) in enumerate(groups(b, LENGTH)):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([f"{key}-{n}"] * len(members)), pa.array([depth] * len(members), pa.int64()), pa.array(b.chunk[members], pa.int64()),
                     pa.array(b.doc[members], pa.int32()), pa.array(b.start[members], pa.int64()), pa.array(offset, pa.int64()),
                     pa.array(b.ids[members], pa.int64(), mask=b.nulls[members])],
                    names=["repeat_id", "n_bytes", "chunk", "doc", "frame", "offset", "doc_id"])

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, chunk, data in _rows(batches):
            doc, frame, ids, nulls, start = load(data)
            yield pa.RecordBatch.from_arrays([pa.array([chunk] * len(doc), pa.int64()), pa.array(doc), pa.array(frame), pa.array(ids, mask=nulls), pa.array(start)],
                                             names=["chunk", "doc", "frame", "doc_id", "place"])

    sent = materialize(_send(chunks, recurring(chunks, buckets), buckets, links=True), "repeats-frames")
    met = sent.filter("key >= 0").repartition(buckets, "key").sortWithinPartitions("key")
    found = materialize(met.mapInArrow(run, "repeat_id string, n_bytes long, chunk long, doc int, frame long, offset long, doc_id long"), "repeats-groups")
    copies = sent.filter("key < 0").mapInArrow(places, "chunk long, doc int, frame long, doc_id long, place long")
    more = found.drop("doc_id").join(copies, ["chunk", "doc", "frame"])
    return found.select("repeat_id", "n_bytes", "doc_id", (F.col("frame") + F.col("offset")).alias("start")).unionByName(
        more.select("repeat_id", "n_bytes", "doc_id", (F.col("place") + F.col("offset")).alias("start")))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept): every text
    without the bytes that a string of ``LENGTH`` bytes covers which starts earlier."""
    chunks = pack(docs, id_col, text_col)
    buckets = bucket_count(chunks)
    spans = _spans(_buckets(chunks, buckets), buckets)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[bytes] = []
        for chunk, source, data in _rows(batches):      # a chunk comes after its spans
            if source >= 0:
                found.append(data)
                continue
            ids, nulls, _, offsets, raw = load(data)
            step = np.zeros(len(raw) + 1, np.int32)
            for doc, start, size in map(load, found):
                at = offsets[doc] + start
                np.add.at(step, at, 1)
                np.add.at(step, at + size, -1)
            found = []
            gone = np.cumsum(step[:-1]) > 0
            begins = gone.copy()
            begins[1:] &= ~gone[:-1]
            starts = offsets[:-1][np.diff(offsets) > 0]
            begins[starts] = gone[starts]               # a run ends with its text
            removed, spans_before = np.concatenate(([0], np.cumsum(gone))), np.concatenate(([0], np.cumsum(begins)))
            edge = offsets - removed[offsets]
            left = raw[~gone].tobytes()
            kept = [left[a:b] for a, b in zip(edge[:-1].tolist(), edge[1:].tolist())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64(), mask=nulls), pa.array(np.diff(offsets)), pa.array(np.diff(removed[offsets])), pa.array(np.diff(spans_before[offsets])),
                 pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string()), pa.array(kept, pa.binary())],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    rows = chunks.select(F.col("chunk").alias("key"), F.lit(-1).cast("long").alias("source"), "data").unionByName(spans)
    return rows.repartition("key").sortWithinPartitions("key", F.desc("source")).mapInArrow(
        run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
