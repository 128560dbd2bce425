"""Registered queries against DuckDB or an independent version, and the pipeline."""

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from hazardpanel.llm.queries import ORACLE, QUERIES
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("documents", "benchmark", "pages", "labels", "embeddings"):
        c.execute(f"create view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_oracle(spark, con, name):
    got = QUERIES[name](spark, SF_SMALL)
    rel = con.sql(ORACLE[name])
    columns = sorted(got.columns)
    assert columns == sorted(rel.columns)
    assert sorted(map(tuple, got.select(columns).collect()), key=str) == sorted(rel.select(*columns).fetchall(), key=str)


def test_pipeline_keeps_clean_documents(spark, con):
    out = corpus_pipeline.run(spark, SF_SMALL).select("doc_id", "decoded").collect()
    ids = [r.doc_id for r in out]
    assert len(ids) == len(set(ids)) and 100 < len(ids) < 200
    bad = {r[0] for r in con.sql(ORACLE["op4_decontaminate"]).select("doc_id").fetchall()}
    assert bad and not bad & set(ids)


def test_pipeline_stages_return_the_columns_of_documents(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    schema = docs.schema
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF_SMALL)
        assert docs.schema.simpleString() == schema.simpleString()


def test_pipeline_of_an_empty_table(spark, tmp_path):
    for t in ("documents", "benchmark"):
        spark.read.parquet(f"{SF_SMALL}/{t}.parquet").limit(0).coalesce(1).write.parquet(f"{tmp_path}/{t}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_stages_keep_columns_with_the_names_they_use_themselves(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(60)
    for name in ("_h", "_key", "_replaced", "_replaced_", "id", "h", "row", "fp", "_text", "_bad", "item_id", "text_hash"):
        docs = docs.withColumn(name, F.concat(F.lit(f"{name} "), F.col("doc_id")))
    own = [c for c in docs.columns if c not in ("text", "n_chars", "lang", "source", "doc_id")]
    docs = docs.checkpoint()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF_SMALL)
        assert out.schema.simpleString() == docs.schema.simpleString(), name
        rows = out.collect()
        assert rows and all(r[c] == f"{c} {r.doc_id}" for r in rows for c in own), name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF_SMALL).count() == 60
