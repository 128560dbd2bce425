"""Approximate nearest neighbours: hierarchical k-means tree, best bin first.

1. Equal vectors are one candidate (with the smallest ids that any query can ask
   for, which is exact), so a very frequent vector costs one.
2. A tree of k-means splits is fitted on a bounded sample of the distinct vectors
   and every one of them is filed under the leaf it descends to.
3. ``calibrate`` searches a bounded set of vectors exactly and ranks, for each of
   their true neighbours, its leaf in the order in which best-bin-first traversal
   (a priority queue over the inner products with the nodes' centres) visits
   leaves.  The number of visits is widened until the wanted recall is reached; if
   the sample says that this takes all leaves, all are visited.
4. Candidates stand in blocks of about ``BLOCK`` of one leaf, queries in blocks of
   about ``QUERIES``.  A query block meets the candidate blocks that any of its
   queries visits, ``MEETINGS`` of them (about) in one task; each meeting is a matrix
   product in double precision, and the task keeps only the best found so far of
   each query.  The tasks' partial bests are ranked by query at the end.

Nearness is the largest inner product.  Vectors (or ids) that are null, zero,
empty, of another length than most, or hold a null or non-finite component take
no part; a row that repeats another's id and vector counts once; rows with the
query's id are its own.  An id that several vectors carry is a candidate with each
of them, and each of them is a query with a rank series of its own that holds
none of the others.  Fewer candidates than asked for are all returned; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections import Counter
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hazardpanel.llm.common import shuffle_width
from hazardpanel.session import materialize

K = 20
#: Bounds of the fit: vectors in the sample, exact searches, and what recall they ask for.
SAMPLE, EXACT, RECALL = 20_000, 200, 0.97
BRANCH, ROUNDS, SEED = 4, 8, 3
#: Rows that a leaf is to hold, and the fewest sample rows that a leaf is cut from.
ROWS_PER_LEAF, LEAF = 256, 40
#: Candidates of a block (about), queries of a block (about).
BLOCK, QUERIES = 2048, 256
#: Candidate blocks (about) that a query block meets in one task.
MEETINGS = 128
#: Rows (candidate blocks, of up to a MB) handed to a worker at a time.
PAIRS_AT_ONCE = 8


@dataclass
class Tree:
    """Nodes in order of creation: centres, first child (-1: a leaf) and number of children."""
    centre: np.ndarray
    child: np.ndarray
    children: np.ndarray
    leaf: np.ndarray            # leaf number of a node, -1 for inner nodes

    @property
    def leaves(self) -> int:
        return int(self.leaf.max()) + 1

    def file(self, x: np.ndarray) -> np.ndarray:
        """Leaf of each row: the nearest centre at every level."""
        at, going = np.zeros(len(x), np.int64), np.arange(len(x))
        while len(going):
            going = going[self.child[at[going]] >= 0]
            for node in np.unique(at[going]):
                rows = going[at[going] == node]
                first, n = self.child[node], self.children[node]
                at[rows] = first + nearest(x[rows], self.centre[first:first + n])
        return self.leaf[at]

    def visits(self, q: np.ndarray, most: int) -> list[int]:
        """The first ``most`` leaves in best-bin-first order."""
        queue, found = [(0.0, 0)], []
        while queue and len(found) < most:
            _, node = heapq.heappop(queue)
            if self.child[node] < 0:
                found.append(int(self.leaf[node]))
                continue
            first, n = int(self.child[node]), int(self.children[node])
            for k, s in enumerate((self.centre[first:first + n] @ q).tolist()):
                heapq.heappush(queue, (-s, first + k))
        return found


def nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres**2).sum(1) - 2 * x @ centres.T).argmin(1)


def grow(x: np.ndarray, branch: int = BRANCH, leaf: int = LEAF) -> Tree:
    """Hierarchical k-means of a sample."""
    rng = np.random.default_rng(SEED)
    centre, child, children = [x.mean(0) if len(x) else np.zeros(x.shape[1])], [-1], [0]
    todo = [(0, np.arange(len(x)))]
    while todo:
        node, rows = todo.pop(0)
        if len(rows) <= leaf:
            continue
        own = x[rows]
        c = own[rng.choice(len(own), min(branch, len(own)), replace=False)]
        for _ in range(ROUNDS):
            label = nearest(own, c)
            c = np.stack([own[label == k].mean(0) for k in np.unique(label)])
        label = nearest(own, c)
        used = np.unique(label)
        if len(used) < 2:
            continue
        child[node], children[node] = len(centre), len(used)
        for k in used:
            todo.append((len(centre), rows[label == k]))
            centre.append(c[k]), child.append(-1), children.append(0)
    ends = np.array(child) < 0
    return Tree(np.stack(centre), np.array(child), np.array(children), np.where(ends, np.cumsum(ends) - 1, -1))


def _matrix(column) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def clean(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, v, k) of the rows that take part; k is a digest of the vector."""
    v, size = F.col(vector_col), F.size(vector_col)
    fine = vectors.filter(F.col(id_col).isNotNull() & v.isNotNull() & (size > 0)).filter(
        ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists(v, lambda x: x != 0))
    sizes = fine.groupBy(size.alias("n")).count().orderBy(F.desc("count"), "n").first()
    return fine.filter(size == (sizes["n"] if sizes else 0)).select(
        F.col(id_col).cast("long").alias("id"), v.alias("v"), F.substring(F.sha2(F.array_join(v.cast("array<string>"), ",").cast("binary"), 256), 1, 32).alias("k")).distinct()


def distinct(rows: DataFrame, keep: int) -> DataFrame:
    """(k, v, ids): each vector once with its ``keep`` smallest ids."""
    best = rows.withColumn("r", F.row_number().over(Window.partitionBy("k").orderBy("id"))).filter(F.col("r") <= keep)
    return best.groupBy("k").agg(F.first("v").alias("v"), F.sort_array(F.collect_list("id")).alias("ids"))


def _best(scores: np.ndarray, ids: list[list], k: int, each: int | None = None) -> tuple[list, list[float]]:
    """The k best (id, score) of one query, ties to the smaller id; of one id at
    most ``each``."""
    if each is None and len(scores) > k:
        cut = np.partition(scores, len(scores) - k)[len(scores) - k]
        rows = np.flatnonzero(scores >= cut)
    else:
        rows = np.arange(len(scores))
    pairs = sorted((-s, i) for r, s in zip(rows.tolist(), scores[rows].tolist()) for i in ids[r])
    if each is not None:
        held, kept = Counter(), []
        for pair in pairs:
            held[pair[1]] += 1
            if held[pair[1]] <= each:
                kept.append(pair)
        pairs = kept
    return [i for _, i in pairs[:k]], [-s for s, _ in pairs[:k]]


def exact(filed: DataFrame, queries: np.ndarray, k: int) -> list[tuple[int, int]]:
    """(query, leaf) of the k best rows of ``filed`` (leaf, v, ids) for each of a
    few queries: best of each partition, then best of those."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            s = queries @ _matrix(b.column(1)).T
            placed = [[(i, leaf) for i in ids] for leaf, ids in zip(b.column(0).to_pylist(), b.column(2).to_pylist())]
            found = [(q, i, leaf, x) for q in range(len(queries)) for (i, leaf), x in zip(*_best(s[q], placed, k))]
            q, i, leaf, x = zip(*found)
            yield pa.RecordBatch.from_arrays([pa.array(q, pa.int64()), pa.array(i, pa.int64()), pa.array(leaf, pa.int64()), pa.array(x, pa.float64())], names=["q", "id", "leaf", "score"])

    part = filed.select("leaf", "v", "ids").mapInArrow(run, "q long, id long, leaf long, score double")
    rank = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "id"))
    return [(r["q"], r["leaf"]) for r in part.withColumn("r", rank).filter(F.col("r") <= k).collect()]


def calibrate(filed: DataFrame, tree: Tree, probes: np.ndarray, k: int, recall: float) -> int:
    """Leaves to visit so that ``probes`` find ``recall`` of their neighbours."""
    place = [{leaf: n for n, leaf in enumerate(tree.visits(q, tree.leaves))} for q in probes]
    ranks = [place[q][leaf] for q, leaf in exact(filed, probes, k)]
    found = np.cumsum(np.bincount(ranks, minlength=tree.leaves)) / len(ranks)
    return int(np.searchsorted(found, recall)) + 1


@contextmanager
def rows_at_once(spark, n: int):
    """Rows per Arrow batch of the jobs run inside (their rows are large)."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    old = spark.conf.get(key, None)
    spark.conf.set(key, str(n))
    try:
        yield
    finally:
        if old is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, old)


def search(vectors: DataFrame, is_query: Column, k: int = K, recall: float = RECALL, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found for every row of
    ``vectors`` with ``is_query`` (a condition on a column ``id``)."""
    spark = vectors.sparkSession
    rows = materialize(clean(vectors, id_col, vector_col), "vectors")
    every = materialize(distinct(rows, k + 1), "vectors-distinct")
    schema = "query_id long, rank int, vec_id long, score double"
    n = every.count()
    if not n:
        return spark.createDataFrame([], schema)
    # a query drops the rows of its own id: of its k + own best none that it needs is missing,
    # own being the most vectors of an id, or k where an id's best k are all that is kept of it
    most = rows.groupBy("id").count().agg(F.max("count")).first()[0]
    keep, each = k + min(k, most), k if most > k else None
    pick = F.pmod(F.xxhash64("k"), F.lit(1 << 30))
    some = every.filter(pick < int(min(1.0, 1.3 * SAMPLE / n) * (1 << 30))).orderBy(pick).limit(SAMPLE).select("v").collect()
    sample = np.array([r["v"] for r in some], float)
    tree = grow(sample, leaf=max(LEAF, len(sample) * ROWS_PER_LEAF // n))
    shared = spark.sparkContext.broadcast(tree)         # bounded by the sample

    def file(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                leaf = shared.value.file(_matrix(b.column(0)))
                yield pa.RecordBatch.from_arrays([pa.array(leaf, pa.int64()), b.column(0), b.column(1)], names=["leaf", "v", "ids"])

    def traverse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                at = {name: b.column(b.schema.get_field_index(name)) for name in ("block", "place", "v")}
                leaves = pa.array([shared.value.visits(q, visits) for q in _matrix(at["v"])], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([at["block"], at["place"], leaves], names=["block", "place", "leaves"])

    kind = f"array<{every.schema['v'].dataType.elementType.simpleString()}>"
    filed = materialize(every.select("v", "ids").mapInArrow(file, f"leaf long, v {kind}, ids array<long>"), "vectors-filed")
    visits = calibrate(filed, tree, sample[:EXACT], k + 1, recall)
    members = rows.filter(is_query).select("id", "k")
    asked = rows.filter(is_query).select("k", "v").dropDuplicates(["k"])
    # queries in blocks, each with its place; a block's queries that visit a leaf are a list of places
    blocks = -(-asked.count() // QUERIES)
    placed = asked.withColumn("block", F.pmod(F.xxhash64("k"), F.lit(max(blocks, 1))))
    placed = materialize(placed.withColumn("place", F.row_number().over(Window.partitionBy("block").orderBy("k")) - 1), "queries")
    sent = (placed.mapInArrow(traverse, "block long, place int, leaves array<long>").select("block", "place", F.explode("leaves").alias("leaf"))
            .groupBy("block", "leaf").agg(F.sort_array(F.collect_list("place")).alias("places")))
    matrix = placed.groupBy("block").agg(F.sort_array(F.collect_list(F.struct("place", "k", "v"))).alias("q"))
    sized = filed.groupBy("leaf").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("parts"))
    candidates = (filed.join(sized, "leaf").withColumn("part", F.pmod(F.xxhash64("ids"), F.col("parts")))
                  .groupBy("leaf", "part").agg(F.collect_list(F.struct("v", "ids")).alias("c")))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A block's queries come first, then the candidate blocks of one slot that some of them visit."""
        keys, vectors, best, at = [], None, [], None

        def result() -> pa.RecordBatch:
            held = [len(ids) for ids, _ in best]
            ids, scores = [i for ids, _ in best for i in ids], [x for _, scores in best for x in scores]
            return pa.RecordBatch.from_arrays([pa.array(keys, pa.string()).take(pa.array(np.repeat(np.arange(len(keys)), held))), pa.array(scores, pa.float64()), pa.array(ids, pa.int64())], names=["k", "score", "id"])
        for b in batches:
            for i in range(b.num_rows):
                if (b.column(0)[i].as_py(), b.column(1)[i].as_py()) != at:
                    if keys:
                        yield result()
                    at, q = (b.column(0)[i].as_py(), b.column(1)[i].as_py()), b.column(2).slice(i, 1).flatten()
                    keys, vectors, best = q.field("k").to_pylist(), _matrix(q.field("v")), [([], [])] * len(q)
                    continue
                c, places = b.column(3).slice(i, 1).flatten(), b.column(4)[i].as_py()
                ids = c.field("ids").to_pylist()
                scores = vectors[places] @ _matrix(c.field("v")).T
                for p, own in zip(places, scores):
                    old_ids, old = best[p]
                    rows = np.flatnonzero(own >= old[-1]) if len(old) >= keep else np.arange(len(own))
                    if len(rows):
                        best[p] = _best(np.concatenate((own[rows], old)), [*[ids[r] for r in rows.tolist()], *[[x] for x in old_ids]], keep, each)
        if keys:
            yield result()

    # a block's meetings are dealt over slots by candidate block, its queries go to each of them
    slots = -(-int(sized.agg(F.sum("parts")).first()[0]) // MEETINGS)
    slot = F.pmod(F.xxhash64("leaf", "part"), F.lit(slots))
    pairs = sent.join(candidates, "leaf").select("block", slot.alias("slot"), F.lit(None).cast(matrix.schema["q"].dataType).alias("q"), "c", "places", "leaf")
    heads = matrix.select("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(slots - 1).cast("long"))).alias("slot"), "q", F.lit(None).cast(candidates.schema["c"].dataType).alias("c"),
                          F.lit(None).cast("array<int>").alias("places"), F.lit(-1).cast("long").alias("leaf"))
    dealt = heads.unionByName(pairs).repartition(shuffle_width(spark), "block", "slot").sortWithinPartitions("block", "slot", "leaf").drop("leaf")
    with rows_at_once(spark, PAIRS_AT_ONCE):
        found = materialize(dealt.mapInArrow(merge, "k string, score double, id long"), "vectors-near")
    nearest_first = lambda *key: F.row_number().over(Window.partitionBy(*key).orderBy(F.desc("score"), "id"))
    if each is not None:
        found = found.withColumn("r", nearest_first("k", "id")).filter(F.col("r") <= each).drop("r")
    top = (found.withColumn("r", nearest_first("k")).filter(F.col("r") <= keep)
           .groupBy("k").agg(F.transform(F.sort_array(F.collect_list(F.struct("r", "score", "id"))), lambda e: F.struct(e["score"].alias("score"), e["id"].alias("id"))).alias("near")))
    own = members.join(top, "k").select(F.col("id").alias("query_id"), F.slice(F.filter("near", lambda e: e["id"] != F.col("id")), 1, k).alias("near"))
    return own.select("query_id", F.posexplode("near").alias("pos", "e")).select(
        "query_id", (F.col("pos") + 1).cast("int").alias("rank"), F.col("e.id").alias("vec_id"), F.col("e.score").alias("score"))
