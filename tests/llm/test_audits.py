"""Periodic runs, source divergence and quality rules against plain versions, and rows of any kind."""

import re
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpusvec.llm import quality, source_divergence as divergence
from corpusvec.llm.periodic_runs import collapse_runs, find_runs
from corpusvec.llm.quality import fit_prior, judge_documents, text_counts
from corpusvec.llm.source_divergence import source_divergence

# --- periodic runs ----------------------------------------------------------


def plain_runs(words, least, times):
    """Every lag in turn, and every smaller period of what it gives."""
    out, n = [], len(words)
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            length = i - start + q
            if i > start and length >= max(least, times * q):
                part = words[start : start + length]
                if not any(part[p:] == part[:-p] for p in range(1, q)):
                    out.append((start, length, q))
            i += 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain_collapse(words, runs):
    gone = {i for start, length, q in runs for i in range(start + q, start + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


pieces = st.lists(st.tuples(st.lists(st.sampled_from("abc"), min_size=1, max_size=7), st.integers(1, 7)), max_size=6)
text_words = pieces.map(lambda parts: [w for block, times in parts for w in block * times])


@settings(max_examples=300, deadline=None)
@given(st.lists(text_words, max_size=4), st.integers(3, 5), st.integers(1, 9))
def test_runs_of_several_texts(texts, times, least):
    found, runs = find_runs([" ".join(t).encode() for t in texts], least, times)
    got = defaultdict(list)
    for start, length, period in runs.T.tolist():
        k = found.text[start]
        got[k].append((start - int(found.starts[k]), length, period))
    for k, words in enumerate(texts):
        assert got[k] == plain_runs(words, least, times)


def test_collapsed_texts(spark):
    texts = {
        1: "x a b a b a b a b y", 2: "a a a a a", 3: "a  a\ta\na a a z", 4: None, 5: " \n ", 6: "a b c " * 3 + "a",
        7: "A a " * 4, 8: "é é é é é é é é é é é é",
    }
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    rows = {r.doc_id: r for r in collapse_runs(df).collect()}
    for k, text in texts.items():
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        runs = plain_runs(words, 6, 4)
        assert (rows[k].n_words, [tuple(r) for r in rows[k].runs]) == (len(words), runs)
        assert rows[k].text == plain_collapse(words, runs)
    assert rows[1].text == "x a b y" and rows[2].runs == [] and rows[3].text == "a z" and rows[8].text == "é é"


def test_runs_need_three_periods(spark):
    with pytest.raises(ValueError):
        collapse_runs(spark.createDataFrame([(1, "a")], "doc_id long, text string"), times=2)


def test_a_long_text_of_few_words_is_not_quadratic():
    words = ("a b a a b " * 200_000).encode()
    _, runs = find_runs([words], 6, 4)
    assert runs.T.tolist() == [[0, 1_000_000, 5]]


# --- source divergence ------------------------------------------------------


def plain_divergence(rows, least, top):
    """``rows`` of (doc_id, text, lang, source); the contract, step by step."""
    docs = [(k if i is None else ("id", i), t or "", lang or "", s or "") for k, (i, t, lang, s) in enumerate(rows)]
    terms = [re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t)) for _, t, _, _ in docs]
    holders = defaultdict(set)
    for (key, _, lang, _), own in zip(docs, terms):
        for term in own:
            holders[lang, term].add(key)
    kept = defaultdict(list)
    for (lang, term), keys in holders.items():
        if len(keys) >= least:
            kept[lang].append(term)
    counts = defaultdict(Counter)
    for (_, _, lang, source), own in zip(docs, terms):
        for group in ((lang, source), (lang,)):
            counts[group].update(t for t in own if t in kept[lang])

    def shares(group):
        total = sum(counts[group].values()) + 2 * len(kept[group[0]])
        return {t: 1 + 10**9 * (counts[group][t] + 2) // total for t in kept[group[0]]}

    def f(p, q):
        return (p - q) ** 2 // (p + q)

    out = []
    for group in [g for g in counts if len(g) == 2]:
        lang, source = group
        p, q = shares(group), shares((lang,))
        parts = {
            "pair": [(-sum(f(p[t], o[t]) for t in p), s) for lg, s in [g for g in counts if len(g) == 2]
                     if lg == lang and s != source for o in [shares((lg, s))]],
            "term": [(-f(p[t], q[t]), t) for t in p if counts[group][t] and p[t] > q[t]],
        }
        for part, items in parts.items():
            for rank, (value, item) in enumerate(sorted(items, key=lambda x: (x[0], x[1].encode())), 1):
                if part == "pair" or rank <= top:
                    out.append((lang, source, part, item, -value, rank))
    return sorted(out)


VOCABULARY = ["the", "them", "theme", "then", "a", "ab", "Été", "été", "中文字", "中文", "internationalisation", "internationalisations"]


def sample_rows():
    rows = []
    for i in range(120):
        own = [VOCABULARY[(i * 7 + j * j) % len(VOCABULARY)] for j in range(i % 9)]
        rows.append((i, f" 1{'_'.join(own)}? " if i % 5 else None, ["en", "fr", None][i % 3], [f"s{i % 4}", "", None][i % 11 % 3]))
    rows += [(3, "zorb theme", "en", "s1")] * 4 + [(None, "zorb", "en", "s2")] * 3 + [(5, "zorb", "en", "s2"), (5, "zorb", "xx", "s2")]
    return rows + [(900, "... 12", "void", "only"), (901, None, "void", "other"), (902, "lone", "lone", "one")]


@pytest.mark.parametrize(("least", "top"), [(5, 3), (1, 2), (10, 10), (1000, 10)])
def test_divergence(spark, least, top):
    rows = sample_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = sorted(tuple(r) for r in source_divergence(df, least, top).collect())
    assert got == plain_divergence(rows, least, top)


def test_divergence_in_tiles_and_buckets(spark, monkeypatch):
    monkeypatch.setattr(divergence, "TILE", 2)
    monkeypatch.setattr(divergence, "CELLS", 6)
    monkeypatch.setattr(divergence, "FLUSH", 3)
    rows = sample_rows() + [(1000 + i, "the them", "en", f"t{i}") for i in range(7)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    assert sorted(tuple(r) for r in source_divergence(df, 5, 3).collect()) == plain_divergence(rows, 5, 3)


def test_a_group_is_the_same_in_any_order_of_rows():
    rows = pa.table({
        "source": ["c", "a", "b", "a", "c"], "term": [None, None, None, "x", "y"], "p": [10, 20, 30, 400, 700],
        "tile": [0] * 5, "n_terms": [3, 3, 3, 0, 0],
    })
    key = [pa.scalar(v) for v in ("en", 0, 0, 0)]
    results = {
        tuple(sorted(tuple(r.values()) for r in divergence.compare_group(key, rows.take(list(order))).to_pylist()))
        for order in permutations(range(5))
    }
    assert len(results) == 1
    assert [(a, b) for _, a, b, _ in results.pop()] == [("a", "b"), ("a", "c"), ("b", "c")]


def test_prefixes_that_share_a_bit_do_no_harm(spark, monkeypatch):
    monkeypatch.setattr(divergence, "places", lambda langs, lang, prefixes: np.full(len(prefixes), 7))
    monkeypatch.setattr(divergence, "place", lambda lang, prefix: F.lit(7))
    rows = sample_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    assert sorted(tuple(r) for r in source_divergence(df, 5, 3).collect()) == plain_divergence(rows, 5, 3)


def test_levels_discard_rare_prefixes(spark):
    """A level's rows hold only what the level before kept."""
    rows = [(i, "common" + ("" if i else " rarest"), "en", "s") for i in range(10)]
    texts = divergence.with_groups(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"))
    first = divergence.prefix_documents(texts, 2, None, False).groupBy("lang", "prefix").agg(F.sum("n_docs").alias("n"))
    assert {(bytes(r.prefix), r.n) for r in first.collect()} == {(b"co", 10), (b"ra", 1)}
    bits = divergence.bits_of(first.where("n >= 10"))
    second = divergence.prefix_documents(texts, 4, bits, False).collect()
    assert {bytes(r.prefix) for r in second} == {b"comm"}
    assert [bytes(r.prefix) for r in divergence.frequent_terms(texts, 10).collect()] == [b"common\0"]


# --- quality rules ----------------------------------------------------------


def plain_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    often = Counter(windows)
    covered = {j for i, w in enumerate(windows) if often[w] > 1 for j in range(i, i + 5)}
    return [
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines), len(lines) - len(set(lines)), len(covered),
    ]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["a", "b", "é", "#x", "\n", "a b a b a b", " ", "中|", "\r\n", " "]), max_size=40), max_size=4))
def test_counts(parts):
    texts = [" ".join(p) for p in parts]
    got = text_counts([t.encode() for t in texts])
    assert [[int(c[k]) for c in got] for k in range(len(texts))] == [plain_counts(t) for t in texts]


GOOD = "a clean text of more than ten words that says each of them only once"
BAD = "too short"


def hosted(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


@pytest.mark.parametrize("sent", [1 << 17, 0])
def test_host_verdicts(spark, monkeypatch, sent):
    monkeypatch.setattr(quality, "SENT_HOSTS", sent)
    rows = [(i, GOOD, f"good{i % 20}") for i in range(400)]
    rows += [(1000 + i, BAD if i % 10 else GOOD, "bad") for i in range(100)]
    rows += [(2000, GOOD, "small"), (2001, BAD, "small"), (2002, BAD, "tiny"), (3000, GOOD, None), (3001, None, None)]
    got = {r.doc_id: r for r in judge_documents(hosted(spark, rows)).collect()}
    assert len(got) == len(rows)
    for doc_id, text, host in rows:
        assert got[doc_id].base_failed == (text != GOOD)
        assert got[doc_id].host_failed == (host == "bad")
        assert got[doc_id].kept == (text == GOOD and host != "bad")


def test_priors():
    alike = fit_prior(10, 1000.0, 100000.0, 100.0, 10.0)
    assert alike.mean == 0.1 and alike.strength == quality.STRONGEST
    # Half the hosts fail always, half never: rates say all there is to say.
    unlike = fit_prior(10, 1000.0, 100000.0, 500.0, 500.0)
    assert unlike.mean == 0.5 and unlike.strength == quality.WEAKEST
    assert fit_prior(0, 0.0, 0.0, 0.0, 0.0).mean == 0.0
    assert fit_prior(1, 5.0, 25.0, 5.0, 5.0) == quality.Prior(1.0, quality.STRONGEST)


# --- rows of any kind -------------------------------------------------------

LONG = "ab cd ef " * 20_000
ROWS = [
    (1, "one two three", "en", "s"), (1, "one two three", "en", "s"), (1, "another text", "en", "s"), (2, None, None, None),
    (None, "one two three", "en", "s"), (None, "one two three", "en", None), (3, "", "", ""), (4, LONG, "de", "t"), (5, " \n\t ", "de", "s"),
]
EXTRA = "host int, n_words int, kept string, part int, term int, rank int, bucket int, _place int, runs int, prefix int, salt int, n int"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*r, *[7] * 2, "x", *[7] * 9) for r in ROWS], f"doc_id long, text string, lang string, source string, {EXTRA}")


OPERATORS = {"runs": collapse_runs, "quality": judge_documents, "divergence": lambda d: source_divergence(d, least=2)}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_rows_of_any_kind(docs, name):
    rows = OPERATORS[name](docs).collect()
    if name == "divergence":
        assert sorted(tuple(r) for r in rows) == plain_divergence([tuple(r) for r in ROWS], 2, 10)
    else:
        assert sorted((r.doc_id for r in rows), key=str) == sorted((r[0] for r in ROWS), key=str)
        assert {r.n_words for r in rows if r.doc_id in (2, 3, 5)} == {0} and [r.n_words for r in rows if r.doc_id == 4] == [60_000]


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_empty_table(docs, name):
    assert OPERATORS[name](docs.limit(0)).count() == 0


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_order_of_rows_does_not_matter(docs, name):
    def values(df):
        return sorted((tuple(map(str, r)) for r in OPERATORS[name](df).collect()))

    assert values(docs) == values(docs.orderBy(F.desc("text"), "lang").coalesce(1))
