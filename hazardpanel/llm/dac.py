"""Token ids in files of directly addressable codes.

``write_tokens`` encodes whole texts, orders documents by id and writes shard
files; ``read_tokens`` reads them back.  Inside a shard an id is split into
byte-wide chunks: level 0 holds the lowest byte of every id, level k the k-th
byte of the ids that have one.  A level's continuation bitmap tells which of its
chunks go on, and its rank directory (ones before every 512 bits) tells where, so
that the id at any position is found by one rank query per level, without
decoding a block.

Layout of a shard (little endian)::

    magic "DAC1", part u32, number u32, levels u32, ids u64, documents u64
    document ids i64[documents], null flags u8[documents], ends u64[documents]
    per level: chunks u64, chunk bytes u8[chunks], bitmap u64[ceil(chunks / 64)],
               ranks u64[ceil(chunks / 512)]
    magic "1CAD"

Shards close after a document that fills ``SHARD_IDS`` ids; a shard's part (the
task that wrote it) and number give its place in the order.  ``FILE_SHARDS`` of
them stand one after the other in a file, each telling its own length.  They are
written and read by Spark's own file sources, in any store; a lost task is run
again and its files are committed once.

Defined results: a null text is empty; every document ends with the end id, so an
empty text has one id; null document ids come first; rows that repeat an id stand
in the order of their text's hash; an empty table writes no shard and reads back
empty; other columns are ignored.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hazardpanel.llm.common import releasing, slices, text_buffers
from hazardpanel.llm.wordcache import EDGE, Ids, WordCache, flat, gather
from hazardpanel.session import materialize

MAGIC, TRAILER = b"DAC1", b"1CAD"
SHARD_IDS, FILE_SHARDS = 1 << 20, 16
RANK = 512
SLICE_BYTES = 8 << 20


HEAD = struct.Struct("<4sIIIQQ")


def pack(ids: np.ndarray, doc_ids: list[int | None], ends: np.ndarray, part: int = 0, number: int = 0) -> bytes:
    """One shard without its trailer."""
    out, rest = [], np.asarray(ids, np.uint32)
    while True:
        more = rest > 255
        bits = np.packbits(more, bitorder="little")
        words = np.zeros(-(-len(rest) // 64), "<u8")
        words.view(np.uint8)[:len(bits)] = bits
        ones = np.add.reduceat(more, np.arange(0, len(rest), RANK), dtype=np.int64) if len(rest) else np.zeros(0, np.int64)
        ranks = (np.cumsum(ones) - ones).astype("<u8")
        out += [struct.pack("<Q", len(rest)), rest.astype(np.uint8).tobytes(), words.tobytes(), ranks.tobytes()]
        if not more.any():
            break
        rest = rest[more] >> np.uint32(8)
    head = HEAD.pack(MAGIC, part, number, len(out) // 4, len(ids), len(doc_ids))
    keys = np.array([d or 0 for d in doc_ids], "<i8").tobytes() + np.array([d is None for d in doc_ids], np.uint8).tobytes()
    return b"".join([head, keys, np.asarray(ends, "<u8").tobytes(), *out])


class Dac:
    """A shard, addressed in place."""

    def __init__(self, blob, at: int = 0):
        magic, self.part, self.number, levels, self.size, docs = HEAD.unpack_from(blob, at)
        if magic != MAGIC:
            raise ValueError("not a shard of directly addressable codes")
        at += HEAD.size
        self.doc_ids, at = np.frombuffer(blob, "<i8", docs, at), at + 8 * docs
        self.nulls, at = np.frombuffer(blob, np.uint8, docs, at) > 0, at + docs
        self.ends, at = np.frombuffer(blob, "<u8", docs, at).astype(np.int64), at + 8 * docs
        self.levels = []
        for _ in range(levels):
            (n,) = struct.unpack_from("<Q", blob, at)
            at += 8
            chunks, at = np.frombuffer(blob, np.uint8, n, at), at + n
            bitmap, at = np.frombuffer(blob, np.uint8, 8 * -(-n // 64), at), at + 8 * -(-n // 64)
            ranks, at = np.frombuffer(blob, "<u8", -(-n // RANK), at), at + 8 * -(-n // RANK)
            self.levels.append((chunks, bitmap, ranks))
        #: Where the shard ends in ``blob``, without its trailer.
        self.stop = at

    def _rank(self, level: int, at: int) -> int:
        """Ones of a level's bitmap before position ``at``."""
        chunks, bitmap, ranks = self.levels[level]
        if not len(ranks):
            return 0
        block = min(at // RANK, len(ranks) - 1)
        part = np.unpackbits(bitmap[block * RANK // 8:-(-at // 8)], bitorder="little")
        return int(ranks[block]) + int(part[:at - block * RANK].sum())

    def access(self, at: int) -> int:
        """The id at one position."""
        if not 0 <= at < self.size:
            raise IndexError(at)
        value, level = 0, 0
        while True:
            chunks, bitmap, _ = self.levels[level]
            value |= int(chunks[at]) << 8 * level
            if not bitmap[at // 8] >> at % 8 & 1:
                return value
            at, level = self._rank(level, at), level + 1

    def range(self, start: int, count: int, level: int = 0) -> np.ndarray:
        """The ids at ``count`` positions from ``start``."""
        chunks, bitmap, _ = self.levels[level]
        out = chunks[start:start + count].astype(np.uint32)
        more = np.unpackbits(bitmap[start // 8:-(-(start + count) // 8)], bitorder="little")[start % 8:start % 8 + count].astype(bool)
        if more.any():
            out[more] |= self.range(self._rank(level, start), int(more.sum()), level + 1) << np.uint32(8)
        return out

    def document(self, k: int) -> np.ndarray:
        start = int(self.ends[k - 1]) if k else 0
        return self.range(start, int(self.ends[k]) - start)


def write_tokens(docs: DataFrame, encoder: Callable[[], ByteLevel], path: str,
                 end_id: int = 0, id_col: str = "doc_id", text_col: str = "text", shard_ids: int = SHARD_IDS) -> None:
    """Encode and write all documents below ``path``.  ``encoder()`` gives, in a
    task, the encoder of buffers of texts.  One shuffle (by range of the id), then
    encoding and packing in the same stage."""

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part, number = encoder().encode_buffer, TaskContext.get().partitionId(), 0
        held, sizes, keys, size = [], [], [], 0         # ids, their number by document, document ids, ids in all

        def close() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([pack(np.concatenate(held), keys, np.cumsum(np.concatenate(sizes)), part, number)], pa.binary())], names=["blob"])
        for b in slices(batches, "text", SLICE_BYTES):
            ids, ends = encode(*text_buffers(b.column(1)))
            ids = np.insert(ids.astype(np.uint32), ends, np.uint32(end_id))
            ends, own, at = ends + np.arange(1, len(ends) + 1), b.column(0).to_pylist(), 0
            while at < len(own):
                before = int(ends[at - 1]) if at else 0
                stop = min(int(np.searchsorted(ends, before + shard_ids - size)) + 1, len(own))
                held.append(ids[before:ends[stop - 1]])
                sizes.append(np.diff(ends[at:stop], prepend=before))
                keys += own[at:stop]
                size, at = size + len(held[-1]), stop
                if size >= shard_ids:
                    yield close()
                    held, sizes, keys, size, number = [], [], [], 0, number + 1
        if held:
            yield close()

    order = F.xxhash64("text")
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    ranged = rows.repartitionByRange("id", order).sortWithinPartitions("id", order, "text")
    # the text writer puts a value's bytes as they are, and the trailer after each value
    ranged.mapInArrow(releasing(shards), "blob binary").select(F.col("blob").cast("string")).write.options(
        encoding="ISO-8859-1", lineSep=TRAILER.decode(), maxRecordsPerFile=FILE_SHARDS).mode("overwrite").text(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32, part, shard) of every document in the
    files: start counts the ids of all documents before it."""

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for content in b.column(0):
                blob, at = memoryview(content.as_buffer()), 0
                while at < len(blob):
                    d = Dac(blob, at)
                    at = d.stop + len(TRAILER)
                    n, size = len(d.ends), np.diff(d.ends, prepend=0)
                    ids = memoryview(d.range(0, d.size).astype("<u4").tobytes())       # the whole shard is wanted here
                    edge = (4 * np.concatenate(([0], d.ends))).tolist()
                    crc = [zlib.crc32(ids[x:y]) for x, y in zip(edge, edge[1:])]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([d.part] * n, pa.int32()), pa.array([d.number] * n, pa.int32()), pa.array(d.doc_ids, pa.int64(), mask=d.nulls), pa.array(d.ends - size),
                         pa.array(size), pa.array(crc, pa.int64())], names=["part", "shard", "doc_id", "local", "n_tokens", "ids_crc32"])

    files = spark.read.format("binaryFile").load(path).select("content")
    found = materialize(files.mapInArrow(releasing(documents), "part int, shard int, doc_id long, local long, n_tokens long, ids_crc32 long"), "tokens")
    # ids before a shard: shards of its part (few), and parts before it; there are as many parts as writing
    # tasks, so the window over all of them holds a row per task
    sized = found.groupBy("part", "shard").agg(F.sum("n_tokens").alias("n"))
    inside = Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    parts = sized.groupBy("part").agg(F.sum("n").alias("n")).select(
        "part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    bases = sized.withColumn("inside", F.coalesce(F.sum("n").over(inside), F.lit(0))).join(parts, "part").select("part", "shard", (F.col("before") + F.col("inside")).alias("base"))
    return found.join(bases, ["part", "shard"]).select("doc_id", (F.col("base") + F.col("local")).alias("start"), "n_tokens", "ids_crc32", "part", "shard")


class ByteLevel:
    """Whole-text encoder over a byte-level tokenizer file of the tokenizers library."""

    def __init__(self, path: str):
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"      # Spark's tasks are the parallelism
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        space = self.tokenizer.encode(" x", add_special_tokens=False).tokens[0][0]     # how the vocabulary writes a space
        vocab = self.tokenizer.get_vocab(with_added_tokens=True)
        self.opens = np.zeros(max(vocab.values()) + 1, bool)        # tokens that begin with a space
        self.opens[[i for t, i in vocab.items() if t[:1] == space]] = True
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.words = WordCache(self.whole, self.after_space, split_tails=True)

    def whole(self, texts: list[str]) -> Ids:
        return flat([e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)])

    def after_space(self, words: list[str], at_once: int = 200) -> Ids:
        """Ids of parts that follow a space.  Many are encoded at a time, told apart
        by the tokens with a space; a part with a space inside or white space at an
        end, or with a special token, is encoded by itself."""
        alone = np.fromiter((" " in w or w[:1] in EDGE or w[-1:] in EDGE for w in words), bool, len(words))
        everything = "\n".join(words)
        if any(s in everything for s in self.special):
            alone |= np.fromiter((any(s in w for s in self.special) for w in words), bool, len(words))
        plain = np.flatnonzero(~alone)
        groups = [plain[a:a + at_once] for a in range(0, len(plain), at_once)]
        joined, sizes = self.whole([" " + " ".join([words[i] for i in g.tolist()]) for g in groups])
        found, at = [], 0
        for g, n in zip(groups, sizes.tolist()):
            ids = joined[at:at + n]
            first = np.flatnonzero(self.opens[ids])
            if len(first) == len(g):
                found.append((g, ids, np.diff(first, append=n)))
            else:
                alone[g] = True
            at += n
        single = np.flatnonzero(alone)
        found.append((single, *self.whole([" " + words[i] for i in single.tolist()])))
        which, ids, size = (np.concatenate(x) for x in zip(*found))
        start = np.cumsum(size) - size
        back = np.empty(len(words), np.int64)
        back[which] = np.arange(len(which))
        return gather(ids, start[back], size[back]), size[back]

    def encode_buffer(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts of a buffer, one after the other, and where each text's end."""
        return self.words.encode_buffer(data, offsets)

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        return self.words.encode(texts)


@lru_cache(maxsize=2)
def _byte_level(path: str) -> ByteLevel:
    return ByteLevel(path)


def byte_level_encoder(tokenizer_path: str) -> Callable[[], ByteLevel]:
    """Encoder over a byte-level tokenizer file; one per worker, kept between tasks."""
    return lambda: _byte_level(tokenizer_path)
