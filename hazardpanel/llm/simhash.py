"""SimHash near-duplicates by bit-sliced comparison.

1. ``fingerprints``: 64-bit SimHash of word shingles (one pass, no shuffle).
2. ``links``: distinct fingerprints are filed under every pair of equal bit
   blocks (the 64 bits are cut into ``radius + 2`` blocks, so two fingerprints
   within ``radius`` bits agree on at least two of them: no pair is lost).
   Inside a file the fingerprints stand *vertically*, 64 to a machine word, one
   word per bit plane.  A query XORs plane after plane into carry-save counters
   that hold the distances of 64 candidates at once; a word is abandoned as soon
   as all its 64 candidates exceed the radius.
3. ``components``: large-star / small-star over the links (DataFrames only).

Files longer than ``BLOCK`` fingerprints are dealt as pairs of sub-blocks, so
one very frequent bit pattern becomes many tasks.  A task returns a spanning
forest of the links it found, never all pairs of a dense group.

Nulls and edges: a null or word-free text has fingerprint zero and links like
any other; a text with fewer words than a shingle is one shingle; repeated rows
share their fingerprint; an empty table gives an empty result; other columns of
the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazardpanel.llm.common import releasing, shuffle_width, slices
from hazardpanel.session import materialize

SEED = 42
WORDS = 3
RADIUS = 3
BLOCK = 4096
_ONE = np.uint64(1)
_FULL = np.uint64(0xFFFFFFFFFFFFFFFF)


def simhash(text: bytes, words: int = WORDS) -> int:
    """Fingerprint of one UTF-8 text; bits set in over half of the hashes."""
    w = text.lower().split()          # bytes: lowers A-Z only, splits at 0x20 and 0x09-0x0D
    if not w:
        return 0
    joined, n = b" ".join(w), len(w)
    ends = np.cumsum(np.fromiter(map(len, w), np.int64, n) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    if n > words:
        ends, starts = ends[words - 1:], starts[:n - words + 1]
    else:
        ends, starts = ends[-1:], starts[:1]
    digest = xxhash.xxh64_intdigest
    count, total = np.zeros(64, np.int64), len(starts)
    for at in range(0, total, 1 << 15):
        h = np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts[at:at + (1 << 15)].tolist(), ends[at:at + (1 << 15)].tolist())), np.uint64)
        count += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * count > total, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS) -> DataFrame:
    """(doc_id, h, fp): the hash of the text, and the unsigned fingerprint stored in
    a signed long."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text", 8 << 20):
            fps = np.fromiter((simhash(t.encode("utf-8") if t else b"", words) for t in b.column(1).to_pylist()), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(fps.view(np.int64))], names=["doc_id", "h", "fp"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("h"))
    return rows.mapInArrow(releasing(run), f"doc_id {kind}, h long, fp long")


def _masks(radius: int) -> list[int]:
    blocks = radius + 2
    cuts = [64 * i // blocks for i in range(blocks + 1)]
    part = [((1 << (b - a)) - 1) << a for a, b in zip(cuts, cuts[1:])]
    signed = lambda m: m - (1 << 64) if m >> 63 else m
    return [signed(part[i] | part[j]) for i, j in combinations(range(blocks), 2)]


def _forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest member index of each node's component under edges a-b."""
    label = np.arange(n)
    while True:
        before = label.copy()
        low = np.minimum(label[a], label[b])
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        label = label[label]
        if np.array_equal(before, label):
            return label


def sliced_links(run: np.ndarray, fp: np.ndarray, radius: int = RADIUS, chunk: int = 1 << 18) -> tuple[np.ndarray, np.ndarray]:
    """Links inside files: ``run`` is the file number of each fingerprint
    (ascending).  Returns index pairs of a spanning forest of all pairs of one
    file that differ in at most ``radius`` bits."""
    n = len(fp)
    first = np.concatenate(([True], run[1:] != run[:-1]))
    start = np.flatnonzero(first)
    size = np.diff(np.concatenate((start, [n])))
    words = (size + 63) // 64
    base = np.concatenate(([0], np.cumsum(words)))
    file_of = np.cumsum(first) - 1
    rank = np.arange(n) - start[file_of]
    word = base[file_of] + rank // 64
    lane = (rank % 64).astype(np.uint64)
    edge = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
    valid = np.bitwise_or.reduceat(_ONE << lane, edge)
    planes = [np.bitwise_or.reduceat(((fp >> np.uint64(b)) & _ONE) << lane, edge) for b in range(64)]
    head = np.empty(len(edge), np.int64)        # first member of each word
    head[word[edge]] = edge
    depth = radius.bit_length()
    over_at = [bool((radius + 1) >> i & 1) for i in range(depth + 1)]
    left, right = [], []
    # a query meets the words of its file from its own on; lanes before it were queries themselves
    todo = base[file_of + 1] - word
    cum = np.concatenate(([0], np.cumsum(todo)))
    lo = 0
    while lo < n:
        hi = max(int(np.searchsorted(cum, cum[lo] + chunk, side="right")) - 1, lo + 1)
        q = np.repeat(np.arange(lo, hi), todo[lo:hi])
        w = word[q] + (np.arange(len(q)) - np.repeat(cum[lo:hi] - cum[lo], todo[lo:hi]))
        counter = [np.zeros(len(q), np.uint64) for _ in range(depth)]
        over = ~valid[w]
        for b in range(64):
            carry = planes[b][w] ^ np.where((fp[q] >> np.uint64(b)) & _ONE, _FULL, np.uint64(0))
            for i in range(depth):              # carry-save addition of one bit per lane
                counter[i], carry = counter[i] ^ carry, counter[i] & carry
            over |= carry
            if not (radius + 1) & radius == 0:  # radius + 1 is no power of two: compare the counters
                at = _FULL
                for i in range(depth):
                    at = at & (counter[i] if over_at[i] else ~counter[i])
                over |= at
            if b % 4 == 3:                      # abandon words whose lanes all exceed the radius
                live = over != _FULL
                if not live.all():
                    q, w, over = q[live], w[live], over[live]
                    counter = [c[live] for c in counter]
                    if not len(q):
                        break
        for bit in range(64):
            hit = np.flatnonzero((~over >> np.uint64(bit)) & _ONE) if len(q) else np.zeros(0, np.int64)
            other = head[w[hit]] + bit if len(hit) else hit
            keep = other > q[hit] if len(hit) else np.zeros(0, bool)
            left.append(q[hit][keep] if len(hit) else hit)
            right.append(other[keep] if len(hit) else hit)
        lo = hi
        if sum(map(len, left)) > 4 * n + (1 << 20):   # keep only a forest of what was found so far
            label = _forest(n, np.concatenate(left), np.concatenate(right))
            node = np.flatnonzero(label != np.arange(n))
            left, right = [node], [label[node]]
    a, b = np.concatenate(left or [np.zeros(0, np.int64)]), np.concatenate(right or [np.zeros(0, np.int64)])
    label = _forest(n, a, b)
    node = np.flatnonzero(label != np.arange(n))
    return node, label[node]


def _file_links(radius: int):
    """mapInArrow function over rows (t, k, i, j, fp) sorted by (t, k, i, j)."""

    def emit(keys: np.ndarray, fp: np.ndarray) -> pa.RecordBatch | None:
        change = np.concatenate(([True], (keys[1:] != keys[:-1]).any(1)))
        run = np.cumsum(change) - 1
        many = np.bincount(run)[run] > 1
        run, fp = run[many], fp[many]
        if not len(fp):
            return None
        a, b = sliced_links(run, fp.view(np.uint64), radius)
        if not len(a):
            return None
        x, y = fp[a], fp[b]
        return pa.RecordBatch.from_arrays([pa.array(np.maximum(x, y)), pa.array(np.minimum(x, y))], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, fps = np.zeros((0, 4), np.int64), np.zeros(0, np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.concatenate((keys, np.stack([batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(4)], 1)))
            fps = np.concatenate((fps, batch.column(4).to_numpy(zero_copy_only=False)))
            last = np.flatnonzero((keys != keys[-1]).any(1))     # the last file may go on in the next batch
            cut = int(last[-1]) + 1 if len(last) else 0
            if cut:
                if (out := emit(keys[:cut], fps[:cut])) is not None:
                    yield out
                keys, fps = keys[cut:], fps[cut:]
        if len(fps) and (out := emit(keys, fps)) is not None:
            yield out

    return run


def links(fps: DataFrame, radius: int = RADIUS, block: int = BLOCK) -> DataFrame:
    """(a, b) with a > b: links between different fingerprints at most
    ``radius`` bits apart, as forests whose union connects exactly the
    fingerprints that all links connect.  ``fps`` has distinct ``fp``."""
    spark = fps.sparkSession
    filed = fps.select("fp", F.explode(F.array(*[
        F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(m)).alias("k")) for t, m in enumerate(_masks(radius))])).alias("f")).select("f.t", "f.k", "fp")
    large = materialize(filed.groupBy("t", "k").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > block), "simhash-files")
    parts = F.ceil(F.col("n") / block).cast("int")
    dealt = filed.join(large, ["t", "k"], "left").withColumn("parts", F.coalesce(parts, F.lit(1))).withColumn(
        "own", F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int"))
    paired = dealt.select("t", "k", "fp", "own", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("with")).select(
        "t", "k", F.least("own", "with").alias("i"), F.greatest("own", "with").alias("j"), "fp")
    files = paired.repartition(shuffle_width(spark), "t", "k", "i", "j").sortWithinPartitions("t", "k", "i", "j")
    return files.mapInArrow(_file_links(radius), "a long, b long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b), root = the smallest
    node reachable.  Large-star and small-star alternate until the edges no
    longer change; each round is written to the shared folder."""
    def state(e: DataFrame):
        r = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        return r[0], r[1]

    def star(pairs: DataFrame) -> DataFrame:
        least = pairs.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
        return pairs.join(least, "u")

    edges = materialize(edges, "components")
    seen = state(edges)
    while seen[0]:
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
        large = star(both).filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        down = large.select(F.col("a").alias("u"), F.col("b").alias("v"))
        small = star(down)
        small = small.select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(small.select(F.col("u").alias("a"), F.col("m").alias("b"))).filter("a > b").distinct()
        edges = materialize(small, "components")
        now = state(edges)
        if now == seen:
            break
        seen = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))


def _grouped(docs: DataFrame, id_col: str, text_col: str, words: int, radius: int) -> tuple[DataFrame, DataFrame]:
    """Every row as (doc_id, h, fp) with h the hash of its text, and (fp, rep, root)
    of every fingerprint with the smallest id and the component's root."""
    fps = materialize(fingerprints(docs, id_col, text_col, words), "simhash")
    reps = materialize(fps.groupBy("fp").agg(F.min("doc_id").alias("rep")), "simhash-distinct")
    roots = components(links(reps.select("fp"), radius))
    rooted = reps.join(roots.select(F.col("node").alias("fp"), "root"), "fp", "left").select("fp", "rep", F.coalesce("root", "fp").alias("root"))
    return fps, materialize(rooted, "simhash-roots")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, radius: int = RADIUS) -> DataFrame:
    """One row per input row: (doc_id, fp, component_id), component_id the
    smallest id whose fingerprint is reachable over links."""
    fps, rooted = _grouped(docs, id_col, text_col, words, radius)
    first = rooted.groupBy("root").agg(F.min("rep").alias("component_id"))
    classes = rooted.join(first, "root").select("fp", "component_id")
    return fps.join(classes, "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The row of ``docs`` with the smallest id of each group (of equal ids that
    with the smallest hash of its text; a group without any id keeps one row as
    well).  Texts are shuffled once, to meet the kept (id, hash) pairs."""
    fps, rooted = _grouped(docs, id_col, text_col, WORDS, RADIUS)
    key = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "h")
    # a fingerprint's first row, then a component's: a group of copies is one row per task after the first step
    first = fps.groupBy("fp").agg(F.min(key).alias("first")).join(rooted, "fp").groupBy("root").agg(F.min("first").alias("first"))
    kept = first.select(F.col("first.h").alias("_h"), F.xxhash64("first.doc_id", "first.h").alias("_key"))
    # the row travels as one struct, so that no name of its columns can clash
    marked = docs.select(F.xxhash64(text_col).alias("_h"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.xxhash64(id_col, F.xxhash64(text_col)).alias("_key"))
    one = marked.join(kept, ["_h", "_key"], "left_semi").dropDuplicates(["_h", "_key"])
    return one.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
