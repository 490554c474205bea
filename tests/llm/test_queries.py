"""The registered queries: oracle SQL, pipeline stages, edge tables and independence."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__
import corpus_pipeline
import public_tokenizers
from careflow.llm import bpe, fill_middle, nbest, packing, queries, secret_scan, toxicity

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, score string, kept int"


def test_every_operator_is_registered():
    names = set(__spark_entry__.queries())
    assert {f"op{n}_" for n in range(1, 14)} == {x.split("_")[0] + "_" for x in names if x.startswith("op")}
    assert "pipeline" in names


def test_oracle_sql_equals_the_query(spark):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    for name, sql in queries.oracle_sql().items():
        df = queries.queries()[name](spark, SF)
        want = con.sql(sql)
        assert sorted(df.columns) == sorted(want.columns)
        assert sorted(map(tuple, df.select(want.columns).collect()), key=repr) == sorted(want.fetchall(), key=repr)


def test_pipeline_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = corpus_pipeline.run(spark, SF).collect()
    assert {r["doc_id"] for r in rows} <= {r["doc_id"] for r in docs.select("doc_id").collect()}
    assert max(r["offset"] + r["length"] for r in rows) <= 2048


@pytest.mark.parametrize("data", [
    [],
    [(1, None, "en", None, None, "x", 1), (None, "here words in both rows of this", None, "s", 3, "x", 1), (2, "", None, None, 0, "x", 1),
     (3, "same words in both rows of this id", "en", "s", 3, "x", 1), (3, "same words in both rows of this id", "en", "s", 3, "x", 1),
     (4, "secret = abcdefghijklmnop in both rows of the other", "de", "s", 3, "x", 1)]])
def test_pipeline_stages_of_odd_tables(spark, data):
    docs = spark.createDataFrame(data, DOCS)
    for name, step in corpus_pipeline.STAGES:
        columns, docs = docs.columns, step(spark, docs, SF)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
    assert {r["doc_id"] for r in docs.collect()} == ({None, 3, 4} if data else set())
    assert docs.count() == len({r["doc_id"] for r in docs.collect()})


def test_language_stage_drops_a_tie(spark):
    """A text that every learned language compresses to the same size could be in any of them."""
    data = [(1, "same words in both rows of this id", "en", "s", 3, "x", 1), (None, "only words here and more", None, "s", 3, "x", 1),
            (2, "secret = abcdefghijklmnop in both rows of the other", "de", "s", 3, "x", 1)]
    kept = corpus_pipeline.language_stage(spark, spark.createDataFrame(data, DOCS), SF)
    assert {r["doc_id"] for r in kept.collect()} == {1, 2}


BIG = 2**53 + 1


def test_big_numbers_beside_nulls(spark):
    """Longs that no double holds stay as they are in a batch with a NULL."""
    data = [(BIG, "token = abcdefghijklmnop", "en", "s", None, "x", 1), (None, "no secret", "en", "s", BIG, "x", 1),
            (BIG + 2, "plain words", None, None, BIG + 2, None, None)]
    docs = spark.createDataFrame(data, DOCS).coalesce(1)
    ids = {BIG, None, BIG + 2}
    path = public_tokenizers.path("byte_bpe_50k.json")
    for out in (bpe.token_counts(docs, path, 1024), secret_scan.scan(docs), packing.pack(docs, path),
                nbest.n_best(docs, public_tokenizers.path("piece_bpe_32k.model")), fill_middle.transform(docs)):
        assert {r["doc_id"] for r in out.collect()} == ids
    masked = {r["doc_id"]: r for r in secret_scan.mask(docs).collect()}
    assert set(masked) == ids and masked[BIG]["text"] == "<assign>"
    assert (masked[BIG]["n_chars"], masked[None]["n_chars"], masked[BIG + 2]["n_chars"]) == (8, BIG, BIG + 2)
    kept = corpus_pipeline.secrets_stage(spark, docs, SF)
    assert {r["doc_id"] for r in corpus_pipeline.packing_stage(spark, kept, SF).collect()} == ids


def test_toxicity_stage_keeps_no_predicted_row(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    docs = docs.join(labels.select("doc_id"), "doc_id", "left_semi").select(docs.columns)
    kept = {r["doc_id"] for r in corpus_pipeline.toxicity_stage(spark, docs, sf).select("doc_id").collect()}
    scored = toxicity.score(docs, toxicity.learn(docs, labels, held=-1)).select("doc_id", "predicted").collect()
    assert kept == {r["doc_id"] for r in scored if r["predicted"] == 0}
    assert len(kept) < len(scored)
