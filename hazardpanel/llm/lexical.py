"""Ranked lexical search in K2-treaps over blocks of the term-document grid.

``build`` cuts the documents into blocks as their partitions deliver them.  A block
is a grid: a row for each of its terms (frequent ones first), a column for each of
its documents (short ones first), the impact of the term in the document in the
cell.  The grid is kept as a compressed quadtree in Z order: only cells with two or
more occupied quarters are nodes, a node's children stand side by side, and every
node knows the largest impact inside its cell.

``search`` sends a bounded set of items at a time to all blocks.  A state of the
search is a range of documents with, for each of the item's terms, the smallest
node on the row's path that covers the range.  The weighted sum of their maxima
bounds every score in the range.  States are taken best first and halved, all rows
descending together; a range of one document has its exact score.  Only states whose
bound falls below the item's k-th score so far are left out, so the result is exact.

Terms are runs of ASCII letters and digits and of characters outside ASCII, only
A-Z lower-cased.  With N documents that hold a term, L of their terms in all, n
terms in a document, df documents that hold a term and tf its occurrences::

    weight = floor(1000 ln((2 N + 2) / (2 df + 1)))
    impact = 1000000000 tf div (1000 tf + 12 (75 + 25 n N div L))
    score  = sum of weight x impact over the item's terms, repeats included

Texts are read twice, once to count N and L, and are never shuffled.  What moves
is the k best of each task and item.  Blocks end at ``BLOCK_DOCS`` documents or
``BLOCK_BYTES`` of text, so a worker's memory does not depend on the corpus; a
longer text is a block of its own, read in pieces.

Defined results: a null or empty text holds no term and is never found; rows that
repeat a document are documents of their own; a null doc_id is a value like others
and comes first among equal scores; rows that repeat an item's id are one item with
the terms of their distinct texts; an item without a known term has no row; an
empty table on either side gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hazardpanel.llm.common import per_text, release_memory, releasing, text_buffers, word_spans
from hazardpanel.session import materialize, scratch_path

K = 20
BLOCK_DOCS, BLOCK_BYTES, PIECE_BYTES = 1 << 13, 8 << 20, 2 << 20
#: Term entries of the items that search all blocks together.
BATCH_TERMS = 200_000
#: States halved together.
WIDTH = 512

TERM = np.zeros(256, bool)
TERM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20
#: Children of a node before one of its four quarters, by occupied quarters.
BEFORE = np.array([[bin(mask & (1 << q) - 1).count("1") for q in range(4)] for mask in range(16)], np.int32)


def starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many terms each text of a buffer has."""
    within = TERM[data]
    begin = within.copy()
    begin[1:] &= ~within[:-1]
    heads = offsets[:-1][np.diff(offsets) > 0]
    begin[heads] = within[heads]
    return per_text(begin, offsets)


def pieces(data: np.ndarray, offsets: np.ndarray, size: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, bool]]:
    """Cut a buffer of texts into pieces of about ``size`` bytes: (first row, bytes,
    offsets, whether the last text of the piece ends there).  A longer text is cut
    between terms."""
    row, rows = 0, len(offsets) - 1
    while row < rows:
        end = int(np.searchsorted(offsets, offsets[row] + size, side="right")) - 1
        if end > row:
            yield row, data[offsets[row]:offsets[end]], offsets[row:end + 1] - offsets[row], True
            row = end
            continue
        at, stop = int(offsets[row]), int(offsets[row + 1])
        while at < stop:
            cut = min(at + size, stop)
            while cut < stop and TERM[data[cut - 1]] and TERM[data[cut]]:
                cut += 1
            yield row, data[at:cut], np.array([0, cut - at]), cut == stop
            at = cut
        row += 1


class Quadtree:
    """Compressed quadtree over cells (row, column) with a value each.

    ``first`` and ``mask`` give a node's children, ``level`` the side of its cell
    (2 ** level), ``key`` the Z-order place of its first cell, ``top`` the largest
    value.  The root is the last node."""

    FIELDS = (("level", np.uint8), ("mask", np.uint8), ("first", np.int32), ("top", np.int32), ("key", np.int64))

    def __init__(self, level, mask, first, top, key):
        self.level, self.mask, self.first, self.top, self.key = level, mask, first, top, key
        self.root = len(level) - 1
        #: Level of the smallest cell at the origin that holds everything.
        self.side = max(int(level[-1]), (int(key[-1]).bit_length() + 1) // 2)

    @classmethod
    def of(cls, rows: np.ndarray, columns: np.ndarray, values: np.ndarray) -> Quadtree:
        """Cells must be distinct; values positive."""
        key = spread(rows) << 1 | spread(columns)
        order = np.argsort(key, kind="stable")
        key, top = key[order], values[order].astype(np.int32)
        level, mask, first = np.zeros(len(key), np.uint8), np.zeros(len(key), np.uint8), np.zeros(len(key), np.int32)
        gap = apart(key)            # level of the smallest cell that holds a node and the one before it
        done: list[tuple[np.ndarray, ...]] = []
        placed = 0
        for j in range(1, int(gap[1:].max(initial=0)) + 1):
            joins = gap == j
            if not joins.any():
                continue
            edge = np.flatnonzero(~joins)
            size = np.diff(np.append(edge, len(key)))
            merged = size > 1
            moved = np.repeat(merged, size)         # nodes that get their place beside their siblings now
            done.append((level[moved], mask[moved], first[moved], top[moved], key[moved]))
            quarter = np.left_shift(np.uint8(1), (key >> 2 * (j - 1) & 3).astype(np.uint8))
            best, quarters = np.maximum.reduceat(top, edge), np.bitwise_or.reduceat(quarter, edge)
            begin = placed + np.cumsum(np.where(merged, size, 0)) - np.where(merged, size, 0)
            placed += int(size[merged].sum())
            level, mask = np.where(merged, j, level[edge]).astype(np.uint8), np.where(merged, quarters, mask[edge]).astype(np.uint8)
            first, top, key, gap = np.where(merged, begin, first[edge]).astype(np.int32), best, key[edge], gap[edge]
        done.append((level, mask, first, top, key))
        return cls(*(np.concatenate(x) for x in zip(*done)))

    def to_bytes(self) -> bytes:
        """Each field's byte planes one after the other, compressed."""
        compress = zstandard.ZstdCompressor(level=1).compress
        parts = [compress(np.ascontiguousarray(getattr(self, name).astype(kind).reshape(-1, 1).view(np.uint8).T).tobytes()) for name, kind in self.FIELDS]
        return struct.pack("<I", len(self.level)) + b"".join(struct.pack("<I", len(p)) + p for p in parts)

    @classmethod
    def from_bytes(cls, blob: bytes) -> Quadtree:
        (n,), at, fields = struct.unpack_from("<I", blob), 4, []
        unpack = zstandard.ZstdDecompressor().decompress
        for _, kind in cls.FIELDS:
            (size,) = struct.unpack_from("<I", blob, at)
            planes = np.frombuffer(unpack(blob[at + 4:at + 4 + size]), np.uint8).reshape(-1, n)
            fields.append(np.ascontiguousarray(planes.T).view(kind).reshape(-1))
            at += 4 + size
        return cls(*fields)

    def down(self, node: np.ndarray, level: np.ndarray, quarter: np.ndarray) -> np.ndarray:
        """The smallest nodes that cover what ``node`` has in one quarter of a
        cell of this level (-1: nothing).  ``node`` covers all it has in the cell."""
        own = self.level[node]
        mask = self.mask[node]
        split = np.where(mask >> quarter & 1, self.first[node] + BEFORE[mask, quarter], -1)
        same = self.key[node] >> 2 * (level - 1).astype(np.int64) & 3
        return np.where(own == level, split, np.where(same == quarter, node, -1))


def spread(x: np.ndarray) -> np.ndarray:
    """A zero bit before every bit of 31-bit numbers."""
    x = x.astype(np.int64)
    for shift, keep in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
        x = (x | x << shift) & keep
    return x


def apart(key: np.ndarray) -> np.ndarray:
    """Level of the smallest cell that holds each key and the one before it; 255 for the first."""
    differ = key[1:] ^ key[:-1]
    bits = np.frexp(differ.astype(np.float64))[1]
    # keys of more than 53 bits may round up to the next power of two
    bits -= (differ >> np.maximum(bits - 1, 0).astype(np.int64)) == 0
    return np.concatenate(([255], (bits + 1) // 2)).astype(np.uint8)


class Block:
    """Documents of one block while they are gathered."""

    def __init__(self):
        self.ids: list = []
        self.terms: list[int] = []          # terms of each document
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]] = []
        self.bytes = 0

    def add(self, ids: list, data: np.ndarray, offsets: np.ndarray, opens: bool) -> None:
        """Texts of a piece; ``opens`` is false if the first goes on from the last piece."""
        row, _, runs = word_spans(LOWER[data], offsets, TERM)
        coded = runs.dictionary_encode()
        base = len(self.ids) - (0 if opens else 1)
        if opens:
            self.ids += ids
            self.terms += [0] * len(ids)
        for i, n in enumerate(np.bincount(row, minlength=len(offsets) - 1).tolist()):
            self.terms[base + i] += n
        pair, times = np.unique(row.astype(np.int64) * max(len(coded.dictionary), 1) + coded.indices.to_numpy(), return_counts=True)
        self.parts.append((base + pair // max(len(coded.dictionary), 1), pair % max(len(coded.dictionary), 1), times, coded.dictionary))
        self.bytes += len(data)

    def close(self, count: int, total: int) -> dict | None:
        """The finished block: ids by column, dictionary and grid (None without a term)."""
        words = pa.concat_arrays([p[3] for p in self.parts]).dictionary_encode()
        if not len(words):
            return None
        number, at = words.indices.to_numpy(), 0
        terms = []
        for _, term, _, dictionary in self.parts:
            terms.append(number[at + term])
            at += len(dictionary)
        pair = np.concatenate([p[0] for p in self.parts]) * len(words.dictionary) + np.concatenate(terms)
        pair, inverse = np.unique(pair, return_inverse=True)
        tf = np.bincount(inverse, np.concatenate([p[2] for p in self.parts])).astype(np.int64)
        doc, term = pair // len(words.dictionary), pair % len(words.dictionary)
        n = np.array(self.terms, np.int64)
        m = 75 + 25 * n * count // total
        impact = 1_000_000_000 * tf // (1000 * tf + 12 * m[doc])
        df = np.bincount(term, minlength=len(words.dictionary))
        by_df, by_n = np.argsort(-df, kind="stable"), np.argsort(n, kind="stable")
        row, column = np.empty_like(by_df), np.empty_like(by_n)
        row[by_df], column[by_n] = np.arange(len(by_df)), np.arange(len(by_n))
        return {"ids": [self.ids[i] for i in by_n.tolist()], "terms": pack_terms(words.dictionary.take(pa.array(by_df)), df[by_df]),
                "grid": Quadtree.of(row[term], column[doc], impact).to_bytes()}


def pack_terms(terms: pa.Array, df: np.ndarray) -> bytes:
    """A block's terms in the order of their rows, with their document frequencies."""
    terms = pa.concat_arrays([terms])
    _, off, data = terms.buffers()
    edge = np.frombuffer(off, np.int32, len(terms) + 1, 4 * terms.offset)
    raw = zstandard.ZstdCompressor(level=1).compress(np.diff(edge).astype("<i4").tobytes() + df.astype("<i4").tobytes() + data.to_pybytes()[edge[0]:edge[-1]])
    return struct.pack("<I", len(terms)) + raw


def unpack_terms(blob: bytes) -> tuple[pa.Array, np.ndarray]:
    (n,) = struct.unpack_from("<I", blob)
    raw = zstandard.ZstdDecompressor().decompress(blob[4:])
    size, df = np.frombuffer(raw, "<i4", n), np.frombuffer(raw, "<i4", n, 4 * n)
    edge = np.concatenate(([0], np.cumsum(size))).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(edge), pa.py_buffer(raw[8 * n:])]), df


def _rows(table: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return table.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))


def corpus_size(docs: DataFrame, text_col: str = "text") -> tuple[int, int]:
    """N, the documents that hold a term, and L, their terms."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = starts(*text_buffers(b.column(0)))
            yield pa.RecordBatch.from_arrays([pa.array([int((n > 0).sum())], pa.int64()), pa.array([int(n.sum())], pa.int64())], names=["holders", "terms"])

    found = docs.select(F.col(text_col).alias("text")).mapInArrow(releasing(run), "holders long, terms long").agg(F.sum("holders"), F.sum("terms")).first()
    return found[0] or 0, found[1] or 0


class Index:
    """Blocks (ids, terms, grid) in a table, with the sizes N and L of the corpus."""

    def __init__(self, blocks: DataFrame, documents: int, terms: int):
        self.blocks, self.documents, self.terms = blocks, documents, terms


def build(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> Index:
    """Write the index of all documents below ``path``."""
    count, total = corpus_size(docs, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = Block()

        def close() -> Iterator[pa.RecordBatch]:
            if block.parts and (done := block.close(count, total)):
                yield pa.RecordBatch.from_arrays([pa.array([done["ids"]], pa.list_(pa.int64())), pa.array([done["terms"]], pa.binary()), pa.array([done["grid"]], pa.binary())],
                                                 names=["ids", "terms", "grid"])
        for b in batches:
            ids, (data, offsets) = b.column(0).to_pylist(), text_buffers(b.column(1))
            opens = True
            for row, part, edge, ends in pieces(data, offsets, PIECE_BYTES):
                if opens and (len(block.ids) + len(edge) - 1 > BLOCK_DOCS or block.bytes + len(part) > BLOCK_BYTES):
                    yield from close()
                    block = Block()
                    release_memory()
                block.add(ids[row:row + len(edge) - 1], part, edge, opens)
                opens = ends
        yield from close()

    schema = "ids array<long>, terms binary, grid binary"
    _rows(docs, id_col, text_col).mapInArrow(releasing(run), schema).write.mode("overwrite").parquet(path)
    return Index(docs.sparkSession.read.schema(schema).parquet(path), count, total)


def item_terms(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(item, term, times) of every item."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offsets = text_buffers(b.column(1))
            row, _, runs = word_spans(LOWER[data], offsets, TERM)
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(row)), runs.cast(pa.string())], names=["item", "term"])

    kind = items.schema[id_col].dataType.simpleString()
    rows = items.select(F.col(id_col).alias("item"), F.col(text_col).alias("text")).distinct()
    return rows.mapInArrow(run, f"item {kind}, term string").groupBy("item", "term").agg(F.count(F.lit(1)).alias("times"))


class Best:
    """The k best (score, id) of one item."""

    def __init__(self, k: int):
        self.k, self.found = k, []

    def add(self, scores: list[int], ids: list) -> None:
        low = [-math.inf if i is None else i for i in ids]
        self.found = sorted([*self.found, *zip((-s for s in scores), low)])[:self.k]

    @property
    def least(self) -> int:
        """Smallest score that can still enter."""
        return -self.found[-1][0] if len(self.found) == self.k else 1


def descend(tree: Quadtree, ids: list, rows: np.ndarray, weights: np.ndarray, best: Best) -> None:
    """Add the documents of one block that belong to the k best of an item with
    these rows and weights."""
    if not len(rows):
        return
    side, rows = tree.side, rows.astype(np.int64)
    # a state is a range of columns; its rows' nodes stand in a list of their own, one entry per row that has any
    level, column = np.array([side], np.int64), np.zeros(1, np.int64)
    size, node, row = np.array([len(rows)]), np.full(len(rows), tree.root, np.int64), np.arange(len(rows))
    bound = np.array([int((tree.top[node].astype(np.int64) * weights).sum())])
    while len(level):
        ends = level == 0
        if ends.any():
            good = ends & (bound >= best.least)
            best.add(bound[good].tolist(), [ids[c] for c in column[good].tolist()])
        stay = ~ends & (bound >= best.least)
        entry = np.repeat(stay, size)
        level, column, size, node, row, bound = level[stay], column[stay], size[stay], node[entry], row[entry], bound[stay]
        take = np.ones(len(level), bool)
        if len(level) > WIDTH:
            take[np.argpartition(-bound, WIDTH)[WIDTH:]] = False
        entry = np.repeat(take, size)
        fresh = _halve(tree, rows, level[take], column[take], size[take], node[entry], row[entry], weights)
        kept = [(level[~take], column[~take], size[~take], node[~entry], row[~entry], bound[~take]), fresh]
        level, column, size, node, row, bound = (np.concatenate(x) for x in zip(*kept))


def _halve(tree: Quadtree, rows, level, column, size, node, row, weights):
    """Both halves of the states' ranges, without empty ones."""
    of = np.repeat(np.arange(len(level)), size)
    down = level[of]
    upper = rows[row] >> down - 1 & 1
    out = []
    for half in (0, 1):
        child = tree.down(node, down, upper << 1 | half)
        alive = child >= 0
        child, own, state = child[alive], row[alive], of[alive]
        count = np.bincount(state, minlength=len(level))
        some = count > 0
        count = count[some]
        part = tree.top[child].astype(np.int64) * weights[own]
        total = np.add.reduceat(part, np.cumsum(count) - count) if len(part) else part
        out.append((level[some] - 1, column[some] << 1 | half, count, child, own, total))
    return tuple(np.concatenate(x) for x in zip(*out))


def search(index: Index, items: DataFrame, k: int = K, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best documents of every item."""
    spark = items.sparkSession
    kind = items.schema[id_col].dataType.simpleString()
    asked = materialize(item_terms(items, id_col, text_col), "lexical-items")
    batches = max(1, -(-asked.count() // BATCH_TERMS))
    # items by number, so that what tasks return is small and any type of id will do
    numbered = asked.withColumn("batch", F.pmod(F.xxhash64("item"), F.lit(batches)))
    found = [_search(index, numbered.filter(F.col("batch") == b), k, kind) for b in range(batches)]
    every = found[0]
    for f in found[1:]:
        every = every.unionByName(f)
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_first("doc_id"))
    return every.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(F.col("item").alias("item_id"), "rank", "doc_id", "score")


def _search(index: Index, asked: DataFrame, k: int, kind: str) -> DataFrame:
    """(item, doc_id, score): best of each task for one bounded set of items."""
    spark = asked.sparkSession
    rows = asked.orderBy("item", "term").select("item", "term", "times").collect()
    names = sorted({r["term"] for r in rows})
    number = {t: i for i, t in enumerate(names)}
    wanted = spark.sparkContext.broadcast(pa.array([t.encode() for t in names], pa.binary()))       # bounded by BATCH_TERMS

    def held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(wanted.value), np.int64)
        for b in batches:
            for blob in b.column(0):
                terms, df = unpack_terms(blob.as_py())
                at = pc.index_in(wanted.value, value_set=terms)
                some = np.flatnonzero(at.is_valid().to_numpy(zero_copy_only=False))
                total[some] += df[at.drop_null().to_numpy()]
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(total[some], pa.int64())], names=["n", "df"])

    df = {r["n"]: r["df"] for r in index.blocks.select("terms").mapInArrow(releasing(held), "n long, df long").groupBy("n").agg(F.sum("df").alias("df")).collect()}
    weight = {n: math.floor(1000 * math.log((2 * index.documents + 2) / (2 * d + 1))) for n, d in df.items()}
    queries: dict = {}
    for r in rows:
        if weight.get(number[r["term"]], 0) > 0:
            queries.setdefault(r["item"], []).append((number[r["term"]], weight[number[r["term"]]] * r["times"]))
    keys = list(queries)
    shared = spark.sparkContext.broadcast([np.array(queries[q], np.int64) for q in keys])

    def best_of_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(k) for _ in shared.value]
        for b in batches:
            for i in range(b.num_rows):
                terms, _ = unpack_terms(b.column(1)[i].as_py())
                tree, ids = Quadtree.from_bytes(b.column(2)[i].as_py()), b.column(0)[i].as_py()
                row = pc.index_in(wanted.value, value_set=terms).fill_null(-1).to_numpy()
                for q, own in zip(shared.value, best):
                    at = row[q[:, 0]]
                    descend(tree, ids, at[at >= 0], q[at >= 0, 1], own)
        entries = [(q, None if i == -math.inf else i, -s) for q, own in enumerate(best) for s, i in own.found]
        q, doc, score = zip(*entries) if entries else ((), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(q, pa.int64()), pa.array(doc, pa.int64()), pa.array(score, pa.int64())], names=["n", "doc_id", "score"])

    part = materialize(index.blocks.mapInArrow(releasing(best_of_blocks), "n long, doc_id long, score long"), "lexical-found")
    wanted.unpersist()
    shared.unpersist()
    named = spark.createDataFrame(list(enumerate(keys)), f"n long, item {kind}")
    return part.join(named, "n").select("item", "doc_id", "score")


def ranked(spark: SparkSession, docs: DataFrame, items: DataFrame, k: int = K) -> DataFrame:
    """Index ``docs`` in the shared folder and search it for ``items``."""
    return search(build(docs, scratch_path(spark, "lexical-index")), items, k)
