"""Registered queries of the operators in this subpackage."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazardpanel.llm import boundaries, compression, dac, decontaminate, langid, lexical, neighbours, pieces, pii, quality, repeats, simhash, warc
from hazardpanel.llm.common import id_remainder, table
from hazardpanel.session import scratch_path

TOKENIZERS = "public_tokenizers"     # module that names the vocabulary files
PSEUDONYM_KEY = "pseudonym-key"      # of the test tables; a corpus has a secret one of its own
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def vocabulary(name: str) -> str:
    """Path of a public tokenizer's file."""
    return import_module(TOKENIZERS).path(name)


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


@query
def op1_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document, written to shard files and read back."""
    path = scratch_path(spark, "token-ids")
    dac.write_tokens(table(spark, sf_dir, "documents"), dac.byte_level_encoder(vocabulary("byte_bpe_50k.json")), path)
    return dac.read_tokens(spark, path)


@query
def op2_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the 100-byte strings that start earlier."""
    return repeats.remove_repeats(table(spark, sf_dir, "documents")).drop("kept")


@query
def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with pseudonyms in its text and the number of values replaced."""
    return pii.pseudonymise(table(spark, sf_dir, "documents").select("doc_id", "text"), key=PSEUDONYM_KEY)


@query
def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, with the item and its containment."""
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).select(
        "doc_id", "item_id", "n_shingles", "n_shared", "containment")


ORACLE["op4_decontaminate"] = r"""
WITH texts AS (SELECT doc_id, NULL AS item_id, text FROM documents UNION ALL SELECT NULL, item_id, text FROM benchmark),
words AS (
  SELECT doc_id, item_id, regexp_extract_all(regexp_replace(lower(text),
         '([\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}])', ' \1 ', 'g'), '[\p{L}\p{M}\p{N}]+') AS w FROM texts),
lengths AS (SELECT DISTINCT least(len(w), 5) AS n FROM words WHERE doc_id IS NULL AND len(w) > 0),
places AS (
  SELECT doc_id, item_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM words JOIN lengths ON len(w) >= n
  WHERE doc_id IS NOT NULL OR n = least(len(w), 5)),
shingles AS (SELECT DISTINCT doc_id, item_id, array_to_string(w[i:i + n - 1], ' ') AS s FROM places),
items AS (SELECT item_id, s, count(*) OVER (PARTITION BY item_id) AS n_shingles FROM shingles WHERE doc_id IS NULL),
shared AS (
  SELECT d.doc_id, i.item_id, i.n_shingles, count(*) AS n_shared
  FROM shingles d JOIN items i ON d.s = i.s WHERE d.doc_id IS NOT NULL GROUP BY ALL)
SELECT doc_id, item_id, CAST(n_shingles AS INTEGER) AS n_shingles, CAST(n_shared AS INTEGER) AS n_shared,
       CAST(n_shared AS DOUBLE) / n_shingles AS containment
FROM shared WHERE CAST(n_shared AS DOUBLE) / n_shingles >= 0.8
"""


@query
def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document; ids with remainder 0 are held out, those
    with remainder 4 calibrate."""
    docs, labels, rem = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), id_remainder("id", 5)
    return quality.classify(docs, labels, "quality", rem.isin(1, 2, 3), rem == 4).select(
        F.col("id").alias("doc_id"), F.coalesce(rem == 0, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= quality.PREDICT_AT).cast("int").alias("predicted"))


@query
def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op7_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors found for every vec_id divisible by 20."""
    return neighbours.search(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0)


@query
def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document; fitted on ids whose remainder is not 2."""
    docs, held_out = table(spark, sf_dir, "documents"), id_remainder("doc_id", 4) == 2
    model = langid.fit(docs.filter(~held_out))
    return langid.predict(docs, model).withColumnRenamed("id", "doc_id").select(
        "doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "lang_pred", "score", "entropy")


@query
def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A WARC record of every page, normalised to a member per record and read back by the index."""
    path = scratch_path(spark, "warc")
    warc.write_monolithic(table(spark, sf_dir, "pages"), f"{path}/monolithic")
    warc.normalise(spark, f"{path}/monolithic", f"{path}/normal", drop_source=True)
    return warc.read_records(spark, f"{path}/normal").select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE["op9_warc"] = """
WITH payloads AS (
  SELECT page_id, coalesce(html, '') AS p, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes,
         sha256(coalesce(html, '')) AS payload_digest FROM pages),
firsts AS (SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY p) END AS f FROM payloads)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN f IS NOT NULL AND f IS DISTINCT FROM page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN f IS NOT NULL AND f IS DISTINCT FROM page_id THEN f END AS refers_to
FROM firsts
"""


@query
def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids, spans and decoding of every document, as digests."""
    return pieces.digests(table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model")).withColumnRenamed("id", "doc_id")


@query
def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best documents for every benchmark item, from an index of all documents."""
    return lexical.ranked(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLE["op11_lexical_search"] = r"""
WITH words AS (
  SELECT doc_id, NULL AS item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents
  UNION ALL
  SELECT NULL, item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) FROM benchmark),
counted AS (SELECT doc_id, term, count(*) AS tf FROM words WHERE item_id IS NULL GROUP BY ALL),
sized AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM counted GROUP BY doc_id),
corpus AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS total FROM sized),
weighed AS (
  SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM counted, corpus GROUP BY term, docs),
asked AS (SELECT item_id, term, count(*) AS times FROM words WHERE item_id IS NOT NULL GROUP BY ALL),
scored AS (
  SELECT a.item_id, c.doc_id, CAST(sum(a.times * g.w * ((1000000000 * c.tf) // (1000 * c.tf + 12 * (75 + (25 * s.n * docs) // total)))) AS BIGINT) AS score
  FROM asked a JOIN weighed g USING (term) JOIN counted c USING (term) JOIN sized s ON s.doc_id = c.doc_id, corpus
  GROUP BY a.item_id, c.doc_id),
placed AS (SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM placed WHERE rank <= 20
"""


@query
def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document transformed for fill-in-middle and restored from the output."""
    done = boundaries.restore(boundaries.transform(table(spark, sf_dir, "documents")))
    digest = lambda c: F.sha2(F.col(c).cast("binary"), 256)
    return done.select(F.col("id").alias("doc_id"), "n", "form", "prefix_chars", "middle_chars",
                       digest("output").alias("output_sha256"), digest("restored").alias("restored_sha256"))


ORACLE["op12_fill_in_middle"] = r"""
WITH cut AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS w,
         sha256('1:' || CAST(doc_id AS VARCHAR)) AS h FROM documents),
drawn AS (
  SELECT doc_id, t, w, CAST(len(w) AS BIGINT) AS n,
         CAST(('0x' || h[1:8]) AS BIGINT) % (len(w) + 1) AS a, CAST(('0x' || h[9:16]) AS BIGINT) % (len(w) + 1) AS b,
         CASE WHEN t = '' OR h IS NULL OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>')
                OR CAST(('0x' || h[17:24]) AS BIGINT) % 100 >= 90 THEN 'plain'
              WHEN CAST(('0x' || h[25:32]) AS BIGINT) % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM cut),
parts AS (
  SELECT doc_id, n, form, t, array_to_string(w[1:least(a, b)], '') AS p,
         array_to_string(w[least(a, b) + 1:greatest(a, b)], '') AS m, array_to_string(w[greatest(a, b) + 1:], '') AS s
  FROM drawn)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM parts
"""


@query
def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word counts, base rules and the verdict of the compression bands for every document."""
    return compression.judge(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")
