"""Every registered query against its SQL, and the end-to-end tables."""

import pytest
from compare import compare, database

from __spark_entry__ import oracle_sql, queries
from corpusvec.operators import subwords
from corpusvec.operators.training import TrainingOptions
from corpusvec.plans import jobs
from corpusvec.operators.subwords import learn_vocabulary
from corpusvec.operators.word_count import word_count
from corpusvec.sources import read_documents

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    return database(SF)


def test_every_oracle_belongs_to_a_query():
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, db, name):
    ok, message = compare(spark, db, SF, name)
    assert ok, message


def test_embeddings_with_and_without_a_token_table(spark):
    docs = read_documents(spark, f"{SF}/documents.parquet").where("doc_id < 30")
    vocabulary = learn_vocabulary(word_count(docs), merges=8, merges_per_round=8)
    options = TrainingOptions(dim=6, epochs=2, learning_rate=0.1)

    def vectors(df):
        return {r.token_id: [round(x, 9) for x in r.embedding] for r in df.collect()}

    by_table = vectors(
        jobs.token_embeddings(jobs.ordered_tokens(docs, vocabulary), vocabulary, 300, options)
    )
    assert by_table == vectors(jobs.corpus_embeddings(docs, vocabulary, 300, options))


def test_slices_with_a_vocabulary_beyond_the_bound(spark, monkeypatch):
    rows = [(0, 0, ["ab", "b"]), (0, 2, ["abab"])]
    df = spark.createDataFrame(rows, "shard_id long, row_index long, words array<string>")
    known = subwords.vocabulary_from(spark, {"6162": 256})
    want = [(0, 0, [256, 98]), (0, 2, [256, 256])]
    assert sorted(tuple(r) for r in subwords.encode_slices(df, known).collect()) == want
    monkeypatch.setattr(subwords, "BROADCAST_TOKENS", 100)
    assert sorted(tuple(r) for r in subwords.encode_slices(df, known).collect()) == want


def test_tables_of_a_run(spark, tmp_path):
    docs = read_documents(spark, f"{SF}/documents.parquet").where("doc_id < 40")
    vocabulary = learn_vocabulary(word_count(docs), merges=8, merges_per_round=8)
    out = str(tmp_path / "run")
    options = TrainingOptions(dim=8, epochs=2)
    for _ in range(2):
        jobs.run_corpus(docs, out, vocabulary, n=3, rows_per_shard=500, options=options)
    counts, tokens, embeddings, similar = (
        spark.read.parquet(f"{out}/{t}")
        for t in ["word_counts", "ordered_tokens", "embeddings", "similar_words"]
    )
    assert counts.count() == word_count(docs).count()
    assert embeddings.count() == tokens.selectExpr("explode(token_ids) t").distinct().count()
    rows = similar.collect()
    assert len(rows) == embeddings.select("word").distinct().count()
    assert all(len(r.neighbours) == 3 for r in rows)
