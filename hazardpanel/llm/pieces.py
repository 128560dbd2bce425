"""SentencePiece encoding and decoding with byte offsets.

Ids come from the sentencepiece library.  Offsets are recorded by an own
normaliser: the longest prefix found in the model's compiled character map (a
double-array trie) is replaced, a character without an entry stays, and each
byte of the normalised text remembers where its source began.  A piece's span in
the source is then the projection of its span in the normalised text.

Defined results: a null text is empty; an empty text has no pieces, an empty
decoding and spans covering nothing; a long text is encoded in pieces cut where
the model cannot join pieces, or whole if the model allows no such cut (its ids,
spans and decoding are always held whole: about 20 bytes per byte of the longest
text).  Repeated rows encode alike, an empty table gives an empty result, other
columns are ignored.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2

from hazardpanel.llm.common import releasing, slices, texts
from hazardpanel.llm.wordcache import WordCache, flat

SPACE = "▁".encode()       # the mark that stands for a space in normalised text
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6     # piece types of the model format


class CharacterMap:
    """Longest-prefix lookup in a compiled character map."""

    def __init__(self, blob: bytes):
        size = struct.unpack("<I", blob[:4])[0] if blob else 0
        self.units = np.frombuffer(blob[4:4 + size], "<u4").tolist()
        self.strings = blob[4 + size:]

    def longest(self, text: bytes, at: int) -> tuple[bytes, int] | None:
        """Replacement and length of the longest entry that ``text`` has at ``at``."""
        if not self.units:
            return None
        units, found = self.units, None

        def step(unit: int) -> int:
            return (unit >> 10) << ((unit & (1 << 9)) >> 6)
        node = step(units[0])
        for i in range(at, len(text)):
            node ^= text[i]
            unit = units[node] if node < len(units) else 0
            if unit & 0x800000FF != text[i]:
                break
            node ^= step(unit)
            if unit >> 8 & 1:
                found = units[node] & 0x7FFFFFFF, i + 1 - at
        if found is None:
            return None
        return self.strings[found[0]:self.strings.index(b"\0", found[0])], found[1]


class Normaliser:
    """Normalised bytes of a text, and for each of them (and the end) the
    source byte at which what it came from begins."""

    def __init__(self, spec, suffix: bool = False, fixed: list[bytes] = ()):
        self.map = CharacterMap(spec.precompiled_charsmap)
        self.prefix, self.strip, self.escape = spec.add_dummy_prefix, spec.remove_extra_whitespaces, spec.escape_whitespaces
        self.suffix, self.fixed = suffix, sorted(fixed, key=len, reverse=True)
        self.plain = not self.map.units and not self.strip and not suffix and not fixed

    def _next(self, text: bytes, at: int) -> tuple[bytes, int]:
        for f in self.fixed:
            if text.startswith(f, at):
                return f, len(f)
        if (found := self.map.longest(text, at)) is not None:
            return found
        n = 1
        while at + n < len(text) and text[at + n] & 0xC0 == 0x80:
            n += 1
        return text[at:at + n], n

    def __call__(self, text: bytes) -> tuple[bytes, np.ndarray]:
        if not text:
            return b"", np.zeros(1, np.int64)
        if self.plain:
            return self._plain(text)
        space = SPACE if self.escape else b" "
        out, source, at = bytearray(), [], 0

        def put(piece: bytes, origin: int) -> None:
            out.extend(piece)
            source.extend([origin] * len(piece))
        if self.strip:
            while at < len(text):
                piece, n = self._next(text, at)
                if piece != b" ":
                    break
                at += n
            if at == len(text):
                return b"", np.zeros(1, np.int64)
        if self.prefix and not self.suffix:
            put(space, at)
        spaced = self.strip
        while at < len(text):
            piece, n = self._next(text, at)
            if spaced:
                piece = piece.lstrip(b" ")
            if piece:
                put(piece.replace(b" ", space), at)
                spaced = self.strip and piece.endswith(b" ")
            at += n
            if not self.strip:
                spaced = False
        end = at
        if self.strip:
            while out.endswith(space):
                end = source[len(out) - len(space)]
                del out[-len(space):], source[-len(space):]
        if self.prefix and self.suffix:
            put(space, end)
        return bytes(out), np.array([*source, end], np.int64)

    def _plain(self, text: bytes) -> tuple[bytes, np.ndarray]:
        """No map, nothing stripped: spaces grow to the mark, all else stays."""
        raw = np.frombuffer(text, np.uint8)
        begin = np.maximum.accumulate(np.where((raw & 0xC0) != 0x80, np.arange(len(raw)), 0))
        width = np.where(raw == 32, len(SPACE), 1) if self.escape else np.ones(len(raw), np.int64)
        space = SPACE if self.escape else b" "
        head = len(space) if self.prefix else 0
        source = np.concatenate((np.zeros(head, np.int64), np.repeat(begin, width), [len(raw)]))
        return (space if self.prefix else b"") + (text.replace(b" ", space)), source


class Codec:
    """Encoder and decoder of one model file, as workers use it."""

    def __init__(self, path: str):
        self.sp = sentencepiece.SentencePieceProcessor(model_file=path)
        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(self.sp.serialized_model_proto())
        spec, pieces = proto.normalizer_spec, proto.pieces
        self.normalise = Normaliser(spec, proto.trainer_spec.treat_whitespace_as_suffix,
                                    [p.piece.encode() for p in pieces if p.type == USER])
        self.size = np.array([1 if p.type == BYTE else len(p.piece.encode()) for p in pieces], np.int64)
        self.unknown = np.array([p.type == UNKNOWN for p in pieces])
        self.stands_for = np.array([1 if p.type == BYTE else len(p.piece.encode()) - (len(SPACE) - 1) * p.piece.count(SPACE.decode()) for p in pieces], np.int64)
        self.direct = self.normalise.plain and spec.add_dummy_prefix and spec.escape_whitespaces
        mark = SPACE.decode()
        self.cuts = (self.normalise.plain and spec.add_dummy_prefix and spec.escape_whitespaces
                     and not any(mark in p.piece.lstrip(mark) for p in pieces))
        # a part after a space is encoded like a text: the library puts the mark in front of both
        parts = lambda x: flat(self.sp.encode(x, num_threads=1) if x else [])
        self.words = WordCache(parts, parts, mark) if self.cuts else None

    def encode(self, batch: list[str]) -> list[np.ndarray]:
        if self.words:
            return self.words.encode(batch)
        return [np.array(x, np.int32) for x in self.sp.encode(batch, num_threads=1)]

    def spans(self, text: str, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Source byte span [begin, end) of each piece."""
        raw = text.encode()
        if self.direct and SPACE not in raw and not self.unknown[ids].any():
            return self._direct(np.frombuffer(raw, np.uint8), ids)
        _, source = self.normalise(raw)
        size = self.size[ids]
        if self.unknown[ids].any():     # an unknown piece is as long as what it stands for
            size = np.array([len(p.encode()) for p in self.sp.encode(text, out_type=str, num_threads=1)], np.int64)
        end = np.cumsum(size)
        return source[end - size], source[end]

    def _direct(self, raw: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Spans where the normalised text differs from the source only in its
        marks: each stands for one space, the first for nothing.  A byte piece
        inside a character projects to where the character begins."""
        end = np.maximum(np.cumsum(self.stands_for[ids]) - 1, 0)
        inside = (np.append(raw, np.uint8(0)) & 0xC0) == 0x80
        for _ in range(3):
            if not (back := inside[end]).any():
                break
            end -= back
        return np.concatenate(([0], end[:-1])) if len(end) else end, end

    def decode(self, batch: list[np.ndarray]) -> list[str]:
        return self.sp.decode([x.tolist() for x in batch], num_threads=1) if batch else []


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    return Codec(path)


def _documents(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, str]:
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), docs.schema[id_col].dataType.simpleString()


def encode(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids, begins, ends, decoded): the pieces of every whole text, the
    source byte span of each piece, and the text decoded from the ids."""
    rows, kind = _documents(docs, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(model_path)
        for b in slices(batches, "text", 1 << 20):
            source = texts(b, "text")
            ids = c.encode(source)
            spans = [c.spans(t, x) for t, x in zip(source, ids)]
            ints = pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(ids, ints), pa.array([s[0].astype(np.int32) for s in spans], ints),
                 pa.array([s[1].astype(np.int32) for s in spans], ints), pa.array(c.decode(ids), pa.string())],
                names=["id", "ids", "begins", "ends", "decoded"])

    return rows.mapInArrow(releasing(run), f"id {kind}, ids array<int>, begins array<int>, ends array<int>, decoded string")


def digests(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``encode`` reduced to (id, n_tokens, ids_sha256, decoded_sha256,
    n_bytes, spans_crc32) inside the same pass, so that ids and spans of a
    large corpus need not leave the workers."""
    rows, kind = _documents(docs, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zlib
        c = codec(model_path)
        decimal: list[str] = [str(i) for i in range(c.sp.get_piece_size())]
        for b in slices(batches, "text", 2 << 20):
            source = texts(b, "text")
            ids = c.encode(source)
            out = []
            for t, x, d in zip(source, ids, c.decode(ids)):
                begin, end = c.spans(t, x)
                out.append((len(x), hashlib.sha256(",".join(map(decimal.__getitem__, x.tolist())).encode()).hexdigest(),
                            hashlib.sha256(d.encode()).hexdigest(), int((end - begin).sum()), zlib.crc32(np.stack((begin, end), 1).astype("<u4").tobytes())))
            cols = list(zip(*out)) or [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.string()), pa.array(cols[2], pa.string()),
                 pa.array(cols[3], pa.int64()), pa.array(cols[4], pa.int64())],
                names=["id", "n_tokens", "ids_sha256", "decoded_sha256", "n_bytes", "spans_crc32"])

    return rows.mapInArrow(releasing(run), f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string, n_bytes long, spans_crc32 long")
