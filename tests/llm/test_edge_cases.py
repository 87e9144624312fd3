"""Nulls, empty and long texts, repeated rows, empty tables and clashing names."""

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from corpusvec.llm.decontamination import find_contamination, with_contamination
from corpusvec.llm.html_text import extract_text
from corpusvec.llm.language import identify_language, labelled_samples, with_language
from corpusvec.llm.lattice import score_texts
from corpusvec.llm.minhash import near_duplicates
from corpusvec.llm.packing import pack_documents
from corpusvec.llm.pii import find_personal_data, sanitise
from corpusvec.llm.queries import piece_vocabulary, word_tokenizer
from corpusvec.llm.repeats import remove_repeats
from corpusvec.llm.token_counts import token_counts
from corpusvec.llm.vectors import near_vectors

LONG = "ab cd ef " * 20_000
ROWS = [
    (1, "one two three four five six", "en"), (1, "one two three four five six", "en"), (2, None, "en"), (3, "", None),
    (None, "one two three four five six", "en"), (4, LONG, "de"), (5, " \n\t ", "de"), (6, "a@b.cd +1 234 567 8901", None),
]
SCHEMA = "doc_id long, text string, lang string, score int, unit string, n int, a int, b int, base int, terms int, item_ids int, component_id int, rank int, bucket int, text_hash int"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*r, *([7] + ["x"] + [7] * 10)) for r in ROWS], SCHEMA)


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([(1, "one two three four five six"), (2, None), (None, "ab"), (3, "")], "item_id long, text string")


OPERATORS = {
    "pii": lambda d, i: find_personal_data(d),
    "lm": lambda d, i: score_texts(d, F.col("doc_id") > 1, piece_vocabulary()),
    "packing": lambda d, i: pack_documents(d, word_tokenizer(), 64),
    "minhash": lambda d, i: near_duplicates(d),
    "tokens": lambda d, i: token_counts(d, word_tokenizer()),
    "repeats": lambda d, i: remove_repeats(d, 400),
    "contamination": find_contamination,
    "language": lambda d, i: identify_language(d, d),
}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_rows_of_any_kind(docs, items, name):
    rows = OPERATORS[name](docs, items).collect()
    if name == "packing":
        assert sum(r.piece == 0 for r in rows) == len(ROWS)
    else:
        assert len(rows) == len(ROWS)
        assert sorted((r.doc_id for r in rows), key=str) == sorted((r[0] for r in ROWS), key=str)


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_empty_table(docs, items, name):
    assert OPERATORS[name](docs.limit(0), items).count() == 0


def test_values_of_odd_texts(docs, items):
    def by_id(df):
        return {r.doc_id: r for r in df.collect()}

    tokens = by_id(token_counts(docs, word_tokenizer()))
    assert [tokens[k].n_tokens for k in (2, 3, 5)] == [0, 0, 0] and tokens[5].n_bytes == 4
    near = by_id(near_duplicates(docs))
    assert [(near[k].n_shingles, near[k].component_id, near[k].kept) for k in (2, 3, 5)] == [(0, k, True) for k in (2, 3, 5)]
    # The row without an id is a copy of a row with one.
    assert (near[None].component_id, near[None].kept) == (1, False)
    assert near[4].n_shingles == 3
    found = by_id(identify_language(docs, docs))
    assert [found[k].lang_pred for k in (2, 3, 5)] == ["und"] * 3
    assert found[4].lang_pred == "de" and found[1].lang_pred == "en"
    assert [by_id(find_contamination(docs, items))[k].item_ids for k in (1, 2, 3, None)] == [[1], [], [], [1]]
    scores = by_id(score_texts(docs, F.col("doc_id") > 1, piece_vocabulary()))
    assert scores[2].n_tokens == scores[3].n_tokens == 1 and scores[2].score == scores[3].score < 0
    repeats = by_id(remove_repeats(docs, 400, keep_first=False))
    assert repeats[4].kept == b"" and len(repeats[4].spans) == 1 and repeats[2].kept == b""


def test_columns_pass_through(docs, items):
    clean = sanitise(docs)
    assert clean.columns == docs.columns and clean.count() == len(ROWS)
    texts = {r.doc_id: r.text for r in clean.collect()}
    assert texts[6] == "<EMAIL> <PHONE>" and texts[2] is None and texts[4] == LONG
    assert with_contamination(docs, items).where("doc_id = 4").first().rank == 7
    assert set(with_language(docs, docs).columns) == {*docs.columns, "lang_pred"}


def test_nothing_to_learn_from(spark, docs):
    unlabelled = docs.where("false")
    assert {r.lang_pred for r in identify_language(docs, unlabelled).collect()} == {"und"}
    rows = score_texts(docs, F.lit(False), piece_vocabulary()).collect()
    assert all(r.base_score == 0 and r.train_tokens == 0 for r in rows)
    assert find_contamination(docs, docs.selectExpr("doc_id item_id", "text").limit(0)).where("size(item_ids) > 0").count() == 0


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], 2), (4, [1.0, 0.0], None), (5, None, 1), (6, [0.0, 0.0], 1),
        (7, [nan, 1.0], 1), (8, [inf, 1.0], 1), (9, [1.0, None], 1), (10, [], 1), (11, [1.0], 1), (12, [1.0, 0.0], 1), (13, [1e-30, 0.0], 1),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("size", F.lit(1)).withColumn("unit", F.lit(2))
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in near_vectors(df).collect()}
    linked = {1, 2, 12, 13}
    assert {k: v for k, v in got.items() if k in linked} == {k: (3, 1, k == 1) for k in linked}
    assert {k: v for k, v in got.items() if k not in linked} == {k: (0, k, True) for k in range(1, 14) if k not in linked}
    assert near_vectors(df.limit(0)).count() == 0


def test_odd_pages(spark):
    page = "<body><nav>menu</nav><article><p>Text &amp; more</p></article>"
    rows = [(1, "http://h/1", page), (1, "http://h/1", page), (2, None, page), (3, "no url", None), (4, "http://h/4", ""), (5, "http://h/5", "<p>" * 30_000 + "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit(1)).withColumn("host", F.lit(2))
    got = sorted((r.page_id, r.text, r.n_chars) for r in extract_text(df).collect())
    assert got == [(1, "Text & more", 11)] * 2 + [(2, "Text & more", 11), (3, "", 0), (4, "", 0), (5, "x", 1)]
    assert extract_text(df.limit(0)).count() == 0


TEXT = "the quick brown fox jumps over the lazy dog near a quiet river bank while seven small birds sing in old trees today"


def near_to(text, n):
    """The text with one word more, told apart by ``n``."""
    return f"{text} again{n}"


def test_texts_of_one_id_have_their_own_links(spark):
    a, b = TEXT, " ".join(reversed(TEXT.split()))
    for rows in ([(1, a), (1, b)], [(1, b), (1, a)]):
        df = spark.createDataFrame([*rows, (2, near_to(a, 2)), (3, near_to(b, 3))], "doc_id long, text string")
        found = near_duplicates(df).collect()
        assert {(r.doc_id, r.component_id) for r in found} == {(1, 1), (2, 1), (3, 1)}
        assert sum(r.leads for r in found) == 2


def test_texts_without_id_are_linked(spark):
    df = spark.createDataFrame([(None, TEXT), (None, near_to(TEXT, 1)), (None, ""), (None, None)], "doc_id long, text string")
    found = near_duplicates(df).collect()
    assert [r.component_id for r in found] == [None] * 4
    assert sorted((r.n_shingles > 0, r.leads) for r in found) == [(False, True), (False, True), (True, False), (True, True)]


def test_sample_windows_lie_all_over_the_text(spark):
    text = "".join(chr(0x4E00 + i) for i in range(8000))
    df = spark.createDataFrame([(i, text, "x") for i in range(20)] + [(7, text, "x")] * 50, "doc_id long, text string, lang string")
    sample = labelled_samples(df, rows=8, chars=8 * 40)
    parts = [part for part in sample["x"].split("\n") if part]
    assert len(parts) == 8 * 4 and all(len(p) == 10 and p in text for p in parts)
    quarters = [text.index(p) // 2000 for p in parts]
    assert quarters == [0, 1, 2, 3] * 8
    assert labelled_samples(df.limit(0), 8, 320) == {}


def test_texts_in_no_known_language(spark):
    rows = [(i, TEXT + " and so on", "en") for i in range(4)] + [(9, "\u4f60\u597d\u4e16\u754c", None), (10, "1 2 3", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = {r.doc_id: r.lang_pred for r in with_language(df, df, least_phrase=1.5).collect()}
    assert found == {0: "en", 1: "en", 2: "en", 3: "en", 9: "und", 10: "und"}
    assert {r.doc_id: r.lang_pred for r in with_language(df, df).collect()}[9] == "en"


def test_equal_rows_change_no_terms(spark):
    rows = [(1, "Li writes to li7@corp.com on Monday"), (2, "ask Li or li7@corp.com on Sunday")]
    rows += [(i, f"we meet on Monday or Sunday to writes ask {i}") for i in range(3, 40)]
    df = spark.createDataFrame(rows, "doc_id long, text string")

    def terms(df):
        return {(r.doc_id, tuple(t.value for t in r.terms)) for r in find_personal_data(df).collect()}

    assert terms(df) == terms(df.union(df)) == terms(df.union(df.where("doc_id = 1")))
    assert {(1, ("li",)), (2, ("li",))} <= terms(df)


def test_names_of_inner_columns_pass_through(spark):
    names = ["_place", "_bucket", "_bits", "_byte", "_id", "_hash", "_spans", "_leads"]
    df = spark.createDataFrame([(1, "mail a@b.cd now", *range(8)), (2, None, *range(8))], "doc_id long, text string, " + ", ".join(f"{n} int" for n in names))
    found = sorted(sanitise(df).collect())
    assert [tuple(r)[2:] for r in found] == [tuple(range(8))] * 2
    assert [r.text for r in found] == ["mail <EMAIL> now", None]
    near = corpus_pipeline.near_dedup(spark, df.union(df), "")
    assert near.columns == df.columns and sorted(r.doc_id for r in near.collect()) == [1, 2, 2]


def test_copies_of_an_id_or_without_one(spark):
    rows = [(1, TEXT)] * 3 + [(None, near_to(TEXT, 9))] * 2 + [(5, "other words that are like no text here")] + [(None, "a b c d e f g")] * 2 + [(7, "")] * 2
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = corpus_pipeline.near_dedup(spark, df, "").collect()
    assert sorted((r.doc_id or 0, r.text) for r in found) == sorted(
        [(1, TEXT), (5, rows[5][1]), (0, "a b c d e f g"), (7, ""), (7, "")]
    )


@pytest.mark.parametrize("stage", ["language", "near_dedup", "pii"])
def test_stages_on_rows_of_any_kind(spark, docs, stage):
    run = dict(corpus_pipeline.STAGES)[stage]
    assert run(spark, docs, "").columns == docs.columns
    run(spark, docs, "").collect()
    assert run(spark, docs.limit(0), "").count() == 0
