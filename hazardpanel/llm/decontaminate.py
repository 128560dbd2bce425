"""Benchmark decontamination by size-partitioned MinHash containment search.

Short test items are searched inside long documents, where Jaccard similarity
says nothing; what counts is containment, the share of an item's five-word
shingles that a document holds.

Items are partitioned by their number of distinct shingles (powers of two).  In
a partition of at most u shingles an item is represented by the MinHash sketch
of its floor((1 - t) u) + 1 smallest shingle hashes.  A document that contains
the share t of an item misses at most floor((1 - t) n) of its n shingles, so at
least one hash of the sketch is found in it: the search loses nothing.  Found
pairs are verified by exact containment of the shingles' strings.

Everything is DataFrame expressions.  The sketches are written to the shared
folder first, so that the optimizer knows their size: a small benchmark is
broadcast under the session's threshold, a large one is joined by hash.

Words are runs of letters, marks and digits of the lower-cased text; in scripts
written without spaces (``UNSPACED``) each character is a word.  An item under
five words is one shingle, its whole sequence, and is looked up among the
documents' word sequences of that length; the lengths that the items have (four
at most) decide which of them documents are cut into.  Texts and items without
any word take no part; repeated rows give one pair for the id; an empty table on
either side gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazardpanel.session import materialize

WORDS = 5
THRESHOLD = 0.8


# fixed values: Unicode scripts written without spaces between words
UNSPACED = ["Han", "Hiragana", "Katakana", "Thai", "Lao", "Khmer", "Myanmar"]


def words(text):
    # all of these scripts begin at U+0E00: one comparison settles most characters
    unspaced = r"([[^\x{0}-\x{DFF}]&&[" + "".join(rf"\p{{Is{s}}}" for s in UNSPACED) + "]])"
    apart = F.regexp_replace(F.lower(text), unspaced, " $1 ")
    return F.regexp_extract_all(apart, F.lit(r"[\p{L}\p{M}\p{N}]+"), F.lit(0))


def _shingled(w: str, n: int, build) -> F.Column:
    """Array of ``build`` applied to each n successive words of column ``w``, empty for fewer words."""
    at = F.when(F.size(w) >= n, F.sequence(F.lit(0), F.size(w) - n)).otherwise(F.array().cast("array<int>"))
    return F.transform(at, lambda i: build([F.get(F.col(w), i + k) for k in range(n)]))


def hashes(w: str, n: int = WORDS):
    return _shingled(w, n, lambda x: F.xxhash64(*x))


def shingles(w: str, n: int = WORDS):
    return F.array_distinct(_shingled(w, n, lambda x: F.concat_ws(" ", *x)))


def _whole_if_short(w: str, cut) -> F.Column:
    """``cut`` (hashes or shingles) of an item: one of its whole sequence under five words."""
    out = cut(w)
    for n in range(1, WORDS):
        out = F.when(F.size(w) == n, cut(w, n)).otherwise(out)
    return out


def _of_lengths(w: str, cut, lengths: list[int]) -> F.Column:
    return F.concat(*[cut(w, n) for n in lengths])


def sketch(items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(item_id, h): per item the smallest hashes that its partition asks for."""
    sized = items.withColumn("n", F.size("shingles")).withColumn("upper", F.pow(F.lit(2), F.floor(F.log2("n")) + 1) - 1)
    kept = F.floor(F.lit(1 - threshold) * F.col("upper") + 1e-9).cast("int") + 1
    low = F.slice(F.array_sort(F.array_distinct("hashes")), F.lit(1), kept)
    return sized.select("item_id", F.explode(low).alias("h"))


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_id: str = "item_id", item_text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, text_hash, item_id, n_shingles, n_shared, containment) of every document
    that holds at least ``threshold`` of an item's shingles."""
    items = materialize(
        benchmark.select(F.col(item_id).alias("item_id"), words(F.col(item_text)).alias("w")).filter(F.size("w") > 0)
        .select("item_id", F.least(F.size("w"), F.lit(WORDS)).alias("length"), _whole_if_short("w", hashes).alias("hashes"), _whole_if_short("w", shingles).alias("shingles")), "benchmark-items")
    lengths = sorted({WORDS, *(r[0] for r in items.select("length").distinct().collect())})     # five values at most
    sketches = materialize(sketch(items, threshold), "benchmark-sketches")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.xxhash64(F.col(text_col)).alias("text_hash"))
    found = (rows.select("doc_id", "text_hash", words(F.col("text")).alias("w"))
             .select("doc_id", "text_hash", F.explode(_of_lengths("w", hashes, lengths)).alias("h")).join(sketches, "h")
             .select("doc_id", "text_hash", "item_id").distinct())
    pairs = materialize(found, "benchmark-candidates")
    asked = pairs.select(F.col("doc_id").alias("d"), F.col("text_hash").alias("t")).distinct()
    texts = (rows.join(asked, rows["doc_id"].eqNullSafe(asked["d"]) & (rows["text_hash"] == asked["t"]), "left_semi")
             .select("doc_id", "text_hash", words(F.col("text")).alias("w"))
             .select("doc_id", "text_hash", _of_lengths("w", shingles, lengths).alias("held")).dropDuplicates(["doc_id", "text_hash"]))
    joined = (pairs.withColumnsRenamed({"doc_id": "d", "text_hash": "t"})
              .join(texts, F.col("d").eqNullSafe(F.col("doc_id")) & (F.col("t") == F.col("text_hash")))
              .join(items.select(F.col("item_id").alias("i"), "shingles"), F.col("item_id").eqNullSafe(F.col("i"))))
    n, shared = F.size("shingles"), F.size(F.array_intersect("shingles", "held"))
    return (joined.select("doc_id", "text_hash", "item_id", n.alias("n_shingles"), shared.alias("n_shared"))
            .withColumn("containment", F.col("n_shared") / F.col("n_shingles")).filter(F.col("containment") >= threshold))


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that hold a benchmark item."""
    bad = materialize(contaminated(docs, benchmark, id_col, text_col).select(
        F.col("doc_id").alias("_bad"), F.col("text_hash").alias("_hash")).distinct(), "contaminated")
    return docs.join(bad, docs[id_col].eqNullSafe(bad["_bad"]) & (F.xxhash64(docs[text_col]) == bad["_hash"]), "left_anti")
