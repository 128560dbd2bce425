"""Corpus pipeline: stages over ``documents``.

Each stage is (name, function); a function takes (spark, docs, sf_dir), works
on all rows that its predecessor kept and returns a DataFrame, which is written
as Parquet in the shared folder and read again as the next stage's ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from hazardpanel.llm import decontaminate, langid, pieces, pii, simhash
from hazardpanel.llm.common import id_remainder, table
from hazardpanel.llm.queries import PSEUDONYM_KEY, vocabulary
from hazardpanel.session import materialize


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language ID: texts that no language can be told for go.  The reference
    texts come from the stage's own labelled rows."""
    model = langid.fit(docs.filter(id_remainder("doc_id", 4) != 2))
    return langid.keep_determined(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SimHash near-duplicates: one document of each group stays."""
    return simhash.keep_one(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination: documents that hold a test item go."""
    return decontaminate.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data get pseudonyms; the length follows the text."""
    count = "_replaced"
    while count in docs.columns:
        count += "_"
    out = pii.pseudonymise(docs, count_col=count, key=PSEUDONYM_KEY)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(F.col(count) > 0, F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return out.drop(count)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids, source byte spans and decoding of every remaining text."""
    return pieces.encode(docs, vocabulary("piece_bpe_32k.model")).withColumnRenamed("id", "doc_id")


STAGES = [("language", language), ("near_duplicates", near_duplicates), ("benchmark", benchmark), ("private", private), ("encode", encode)]

#: Language models, fingerprints over UTF-8 and tokenizers have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every intermediate is written and reread."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
