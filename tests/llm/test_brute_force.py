"""Each operator against a plain version of its rule, on whole small tables."""

import hashlib
import html
import math
import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from corpusvec.llm import decontamination, lattice, packing, pii, repeats
from corpusvec.llm.language import Languages, identify_language, symbols
from corpusvec.llm.minhash import near_duplicates
from corpusvec.llm.queries import QUERIES, piece_vocabulary, word_tokenizer
from corpusvec.llm.vectors import near_vectors

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def texts():
    return dict(duckdb.sql(f"select doc_id, coalesce(text, '') from '{SF}/documents.parquet'").fetchall())


def rows_of(spark, name):
    return QUERIES[name](spark, SF).collect()


def words(text):
    return text.encode().lower().split()


class Groups(dict):
    def find(self, x):
        while self.setdefault(x, x) != x:
            x = self[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self[max(a, b)] = min(a, b)


# --- near duplicates ------------------------------------------------------


def shingles(text):
    w = words(text)
    k = min(5, len(w))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if w else set()


def check_near(rows, texts, least):
    sets = {k: shingles(t) for k, t in texts.items()}
    groups = Groups()
    for a, b in combinations(sets, 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= least * len(sets[a] | sets[b]):
            groups.join(a, b)
    for r in rows:
        assert (r.n_shingles, r.component_id) == (len(sets[r.doc_id]), groups.find(r.doc_id))
        assert r.kept == (r.component_id == r.doc_id)


def test_near_duplicates(spark, texts):
    check_near(rows_of(spark, "op6_minhash_near_dedup"), texts, 85)


def test_near_duplicates_of_crowds_and_chains(spark):
    """A star of copies that differ from each other, a chain, and short texts."""
    rng = random.Random(3)
    base = [f"w{rng.randrange(10**6)}" for _ in range(120)]
    texts, chain = {}, list(base[::-1])
    for k in range(60):
        text = list(base)
        text[rng.randrange(120)] = f"x{k}"
        texts[1000 - k] = " ".join(text)
        chain[2 * k] = f"y{k}"
        texts[k] = " ".join(chain)
    texts |= {2000 + k: " ".join(base[:k]) for k in range(8)} | {2100 + k: " ".join(base[:k]).upper() for k in range(8)}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(7)
    check_near(near_duplicates(df).collect(), texts, 85)


@pytest.mark.parametrize("base_id", [0, 150, None])
def test_near_duplicates_of_a_star(spark, base_id):
    """Copies that are like one text but not like each other, with and without it."""
    rng = random.Random(4)
    base = [f"w{rng.randrange(10**6)}" for _ in range(140)]
    texts = {}
    for k in range(300):
        text = list(base)
        for _ in range(2):
            text[rng.randrange(140)] = f"x{rng.random()}"
        texts[k] = " ".join(text)
    if base_id is not None:
        texts[base_id] = " ".join(base)
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(5)
    check_near(near_duplicates(df).collect(), texts, 85)


def test_near_vectors(spark):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(12, 24))
    rows = []
    for i in range(600):
        v = centres[rng.integers(12)] + rng.normal(size=24) * rng.choice([0.02, 0.12, 0.2, 1])
        rows.append((i, [float(np.float32(x)) for x in v * rng.choice([1, 3])], int(rng.integers(3))))
    rows += [(600 + i, *rows[i][1:]) for i in range(20)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    groups, links = Groups(), Counter()
    unit = {i: np.array(v) / np.linalg.norm(v) for i, v, _ in rows}
    for (a, _, x), (b, _, y) in combinations(rows, 2):
        if x == y and unit[a] @ unit[b] >= 0.98:
            groups.join(a, b)
            links.update((a, b))
    assert sum(links.values()) > 500
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in near_vectors(df).collect()}
    assert got == {i: (links[i], groups.find(i), groups.find(i) == i) for i, _, _ in rows}


# --- personal data --------------------------------------------------------


def luhn(number):
    twice = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(number))]
    return sum(x - 9 * (x > 9) for x in twice) % 10 == 0


def base_spans(text):
    found = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        found.append((m.start(), 0, m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if max(map(int, m[0].split("."))) <= 255:
            found.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        number = re.sub("[ -]", "", m[0])
        if 12 <= len(number) <= 19 and luhn(number):
            found.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            found.append((m.start(), 3, m.end()))
    return ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in sorted(found))


ODD = [
    "a@b.c_d@e.f.g x@y é@z.com q@@r.de", "1.2.3.4.5.6.7.8 0255.001.2.3 256.1.1.1 1.1.1.1x",
    "4111 1111 1111 1111 x4111-1111-1111-1112 4111  1111", "+1 (171) 555-2028) +12345678 +1234567890123456 ++49 30 12345678",
    "\U0001f600 a@b.co +1 222 333 4444", "5500005555555559@mail.com", "", "1-2-3-4-5-6-7-8-9-0-1-2",
]


def test_personal_data(spark, texts):
    every = texts | {10**6 + i: t for i, t in enumerate(ODD)}
    df = spark.createDataFrame(list(every.items()), "doc_id long, text string")
    got = {r.doc_id: r.s for r in pii.find_personal_data(df).select("doc_id", pii.shown(F.col("base")).alias("s")).collect()}
    assert got == {k: base_spans(t) for k, t in every.items()}


def test_personal_data_query(spark, texts):
    for r in rows_of(spark, "op2_pii_sanitisation"):
        spans = base_spans(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(spans.encode()).hexdigest()
        assert set(spans.split(",")) - {""} <= set(r.spans.split(","))
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [len(re.findall(k, spans)) for k in pii.KINDS[:4]]


def test_patterns_on_very_long_runs(spark):
    runs = ["a" * 50_000 + "@" + "b." * 20_000 + "c", "1" * 50_000, "1 " * 50_000, "1." * 50_000, "+1" + "()" * 30_000, "+1" * 30_000]
    df = spark.createDataFrame(list(enumerate(runs)), "doc_id long, text string")
    sizes = [r.n for r in pii.find_personal_data(df).orderBy("doc_id").selectExpr("size(base) n").collect()]
    assert sizes[:4] == [1, 0, 0, 12_500]


def test_terms_that_give_a_value_away(spark):
    rows = [(i, f"plain words {i} here and there with mail about nothing else") for i in range(40)]
    rows += [(100 + i, f"{w} with Zorbex mail z@corp.com about {w}") for i, w in enumerate(["alpha", "beta", "gamma"])]
    # One context in many copies supports nothing.
    rows += [(200 + i, "call Quuxly at c@corp.com now") for i in range(5)]
    found = pii.find_personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    terms = {r.doc_id: {t.value for t in r.terms} for r in found}
    assert all("zorbex" in terms[100 + i] for i in range(3))
    assert not any(terms[i] for i in range(40)) and not any(terms[200 + i] for i in range(5))
    clean = pii.sanitise(spark.createDataFrame(rows, "doc_id long, text string")).where("doc_id = 100").first().text
    assert "Zorbex" not in clean and "z@corp.com" not in clean and clean.startswith("alpha with <TERM>")


def test_a_line_of_many_texts_supports_its_terms(spark):
    rows = [(i, f"plain words {i} about nothing") for i in range(40)]
    line = "please do all of you contact Jane Zorbex at z@corp.com today or any other day before noon"
    rows += [(100 + i, f"{w} {w} {line} {w}") for i, w in enumerate(["alpha", "beta", "gamma"])]
    found = pii.find_personal_data(spark.createDataFrame(rows, "doc_id long, text string")).where("doc_id >= 100").collect()
    assert len(found) == 3 and all("zorbex" in {t.value for t in r.terms} for r in found)


def test_telling_terms_go_everywhere_in_the_text(spark):
    filler = "one two three four five six seven eight nine ten eleven twelve " * 20
    rows = [(i, filler + f"words {i}") for i in range(40)]
    # Beside the value, far from it, and never within reach of it.
    rows += [(100 + i, f"Zorbex z@corp.com {filler} zorbex {filler} Quuxly{' ' * 200}{w}") for i, w in enumerate(["alpha", "beta", "gamma"])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r.terms for r in pii.find_personal_data(df).collect()}
    for doc_id, text in rows:
        want = [(m.start(), m.end()) for m in re.finditer("(?i)zorbex|quuxly", text)]
        assert [(t.start, t.end) for t in found[doc_id]] == want
    clean = pii.sanitise(df).where("doc_id = 101").first().text
    assert not re.search("(?i)zorbex|quuxly|corp", clean) and clean.endswith("beta")


# --- scores and tokens ----------------------------------------------------


def test_scores(spark, texts):
    counts = Counter()
    for k, t in texts.items():
        if zlib.crc32(str(k).encode()) % 10:
            counts.update([*words(t), None])
    n, v = sum(counts.values()), len(counts)
    for r in rows_of(spark, "op3_lm_scoring"):
        tokens = [*words(texts[r.doc_id]), None]
        want = sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in tokens)
        assert math.isclose(r.base_score, want, rel_tol=1e-9)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(tokens), sum(counts[w] > 0 for w in tokens), n)
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 10 == 0) and r.score < 0


def segmentations(text, model):
    """Summed probability of all ways to cut a text, one by one."""
    if not text:
        return 1.0
    total = sum(math.exp(model.log[text[:k]]) * segmentations(text[k:], model) for k in range(1, len(text) + 1) if text[:k] in model.log)
    if text[0] not in model.log:
        total += math.exp(model.byte * len(text[0].encode())) * segmentations(text[1:], model)
    return total


def test_lattice_sums_all_segmentations():
    model = lattice.Lattice(lattice.vocabulary_weights(piece_vocabulary()))
    for word in ["a", "the", "token", "naïve", "\U0001f9ff!", "zzzz", "ñandú"]:
        assert math.isclose(model.log_marginal(word), math.log(segmentations("▁" + word, model)), rel_tol=1e-9)


def test_expected_pieces_spell_the_word():
    model = lattice.Lattice(lattice.vocabulary_weights(piece_vocabulary()))
    for word in ["the", "tokenise", "a" * 200]:
        found = {}
        model.expect(word, found)
        assert math.isclose(sum(len(p) * n for p, n in found.items()), len(word) + 1, rel_tol=1e-6)


def test_expected_pieces_of_very_unlikely_words():
    model = lattice.Lattice(lattice.vocabulary_weights(piece_vocabulary()))
    letter = next(c for c in map(chr, range(0x1200, 0x1380)) if c not in model.log)
    found = {}
    model.expect("the" + letter * 200 + "house", found)
    assert math.isclose(sum(len(p) * n for p, n in found.items()), len("▁thehouse"), rel_tol=1e-6)
    # One word, whatever its length: pieces across its 32nd character count.
    long, logs = {}, {}
    model.expect("x" * 30 + "house", long)
    model.expect_in_logs("▁" + "x" * 30 + "house", logs)
    assert long.keys() == logs.keys() and all(math.isclose(long[p], logs[p], rel_tol=1e-6, abs_tol=1e-12) for p in long)
    assert long["house"] > 0.1


def test_weights_learned_from_words_fit_them_better(spark):
    own = lattice.vocabulary_weights(piece_vocabulary())
    counts = spark.createDataFrame([(w.encode(), 1, 1) for w in ("banana", "bandana", "panama")], "unit binary, n long, n_train long")
    learned = lattice.Lattice(lattice.learned_weights(counts, piece_vocabulary(), 1))
    assert learned.log_marginal("banana") > lattice.Lattice(own).log_marginal("banana")


def test_token_counts_and_packing(spark, texts):
    tokenizer = Tokenizer.from_file(word_tokenizer())
    ids = {k: tokenizer.encode(t, add_special_tokens=False).ids for k, t in texts.items()}
    for r in rows_of(spark, "op7_token_counts"):
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(texts[r.doc_id].encode()), len(ids[r.doc_id]), len(ids[r.doc_id]) > 2048)
    want, placed = {}, defaultdict(list)
    for k, own in ids.items():
        own = [*own, 0]
        for p, s in enumerate(range(0, len(own), 2048)):
            part = own[s : s + 2048]
            want[k, p] = (s, len(part), zlib.crc32(b"".join(i.to_bytes(4, "little") for i in part)))
    rows = rows_of(spark, "op4_best_fit_packing")
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in rows} == want
    for r in rows:
        placed[r.sequence_id].append((r.offset, r.length))
    for parts in placed.values():
        parts.sort()
        assert [o for o, _ in parts] == [sum(n for _, n in parts[:i]) for i in range(len(parts))]
        assert sum(n for _, n in parts) <= 2048
    assert len(placed) <= math.ceil(sum(n for _, n, _ in want.values()) / 2048) + 1


def test_odd_texts_have_the_tokenizers_ids(spark):
    odd = ["It's we'll DON'T", "x<|endoftext|>y <|startoftext|>", "naïve ÀÉ ÿß İ ŉ", "é ﬁ ² ½", "a b c\x1fd", "12,345.6 #!?...", "日本語 🎉", "_under_ 'quoted'"]
    tokenizer = Tokenizer.from_file(word_tokenizer())
    df = spark.createDataFrame(list(enumerate(odd)), "doc_id long, text string")
    got = {r.doc_id: r.ids_crc32 for r in packing.encoded_pieces(df, word_tokenizer(), 2048).collect()}
    for k, t in enumerate(odd):
        ids = [*tokenizer.encode(t, add_special_tokens=False).ids, 0]
        assert got[k] == zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids)), t


@pytest.mark.parametrize("seed", range(4))
def test_plans_hold_every_piece(seed):
    rng = np.random.default_rng(seed)
    sizes = np.minimum(512, 1 + rng.lognormal(4, 1.5, 3000).astype(int))
    histogram = {int(n): int(k) for n, k in zip(*np.unique(sizes, return_counts=True))}
    packed = packing.pack(histogram, 512)
    held = Counter()
    for bins in packed:
        assert sum(bins.lengths) + bins.room == 512 and bins.room >= 0
        held.update({n: k * bins.count for n, k in Counter(bins.lengths).items()})
    assert held == histogram
    assert sum(b.count for b in packed) <= 1.01 * math.ceil(sizes.sum() / 512) + 1


def test_knapsack_finds_the_best():
    rng = np.random.default_rng(1)
    lengths, worth = np.array([3, 5, 7, 11]), rng.random(4)
    config = packing.best_configuration(worth, lengths, 23)
    got = sum(worth[list(lengths).index(n)] * k for n, k in config.items())
    best = [0.0] * 24
    for room in range(1, 24):
        best[room] = max([best[room - 1], *(worth[i] + best[room - n] for i, n in enumerate(lengths) if n <= room)])
    assert math.isclose(got, best[23])


# --- repeats, leaks, languages, pages -------------------------------------


def check_repeats(cleaned, texts, span, keep_first):
    seen = defaultdict(list)
    for k in sorted(texts):
        data = texts[k].encode()
        for i in range(len(data) - span + 1):
            seen[data[i : i + span]].append((k, i))
    for r in cleaned:
        data = texts[r.doc_id].encode()
        covered = np.zeros(len(data), dtype=bool)
        for i in range(len(data) - span + 1):
            places = seen[data[i : i + span]]
            if len(places) > 1 and not (keep_first and places[0] == (r.doc_id, i)):
                covered[i : i + span] = True
        assert r.kept == np.frombuffer(data, dtype=np.uint8)[~covered].tobytes()
        assert [(s.start, s.end - 1) for s in r.spans] == repeats.runs_of(covered)


@pytest.mark.parametrize("keep_first", [True, False])
@pytest.mark.parametrize("crowd", [1, 1 << 13])
def test_repeats(spark, texts, monkeypatch, crowd, keep_first):
    monkeypatch.setattr(repeats, "SORTED_SEGMENTS", crowd)
    some = dict(list(texts.items())[:60])
    shared = "".join(random.Random(2).choices("abcé \n", k=900))
    some |= {10**6 + i: f"{i}{shared[i : 500 + 3 * i]}{i * 7}{shared[:430]}" for i in range(12)}
    some[10**7] = "ab" * 700
    df = spark.createDataFrame(list(some.items()), "doc_id long, text string")
    if keep_first:
        # Rows come in the order of ids; hashes break no ties here.
        check_repeats(repeats.remove_repeats(df, 400, True).collect(), some, 400, True)
    else:
        check_repeats(repeats.remove_repeats(df, 400, False).collect(), some, 400, False)


def test_suffix_order_over_long_parts(monkeypatch):
    monkeypatch.setattr(repeats, "CHUNK", 1000)
    data = bytes(random.Random(1).choices(b"abcd", k=5000)) * 2
    cut = list(repeats.anchors(data, 400))
    assert [a for _, a, _ in cut] == [0, *(b + 1 for _, _, b in cut[:-1])] and cut[-1][2] == len(data) - 400
    where = {i: h for h, a, b in cut for i in range(a, b + 1)}
    assert all(where[i] == where[i + 5000] for i in range(5000 - 400))


def test_leaks(spark, texts):
    items = dict(duckdb.sql(f"select item_id, text from '{SF}/benchmark.parquet'").fetchall())

    def runs(text):
        w = text.lower().encode().split()
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}

    want = {k: sorted(i for i, t in items.items() if len(runs(t) & runs(x)) >= 0.8 * len(runs(t))) for k, x in texts.items()}
    rows = rows_of(spark, "op9_decontamination")
    assert {r.doc_id: r.item_ids for r in rows} == want and any(want.values())


def test_search_finds_all_above_the_threshold():
    rng = random.Random(7)
    vocabulary = [f"w{int(rng.paretovariate(0.6))}" for _ in range(400)]
    index = decontamination.Index([decontamination.Item(i, " ".join(rng.choices(vocabulary, k=rng.randrange(3, 40))), None) for i in range(90)])
    for _ in range(60):
        words_ = [w.encode() for w in rng.choices(vocabulary, k=2 * index.stride)]
        for item in rng.sample(index.items, 2):
            words_[: len(item.words)] = item.words
        terms = np.array([index.term.get(w, -1) for w in words_])
        own = set(terms.tolist()) - {-1}
        score = Counter()
        for t in own:
            score.update(dict(index.postings[t]))
        want = sorted(i for i, s in score.items() if s >= 0.6)
        blocks = index.hopeful(terms[: 2 * index.stride], 0.6).get(0, set())
        assert sorted(index.search(own, blocks, 0.6)) == want


def test_several_indexes_give_the_same(spark, monkeypatch, texts):
    docs, items = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    want = {r.doc_id: r.item_ids for r in decontamination.find_contamination(docs, items).collect()}
    monkeypatch.setattr(decontamination, "INDEX_ITEMS", 9)
    assert {r.doc_id: r.item_ids for r in decontamination.find_contamination(docs, items).collect()} == want


def test_languages_of_held_out_texts(spark):
    lang = dict(duckdb.sql(f"select doc_id, lang from '{SF}/documents.parquet'").fetchall())
    held = [r for r in rows_of(spark, "op10_language_id") if r.held_out]
    assert all(0 <= r.score <= 1 for r in held)
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.95 * len(held)


def test_fewest_phrases(spark):
    """Cross-parsing by hand: longest phrases of a text that occur in a sample."""
    sample = {"x": "abcabd", "y": "bbbbaa"}
    labelled = spark.createDataFrame([(i, t, k) for i, (k, t) in enumerate(sample.items())], "doc_id long, text string, lang string")
    tests = ["abcabd", "bbbb", "abdabc", "aabb", "cabdd"]

    def cost(text, own):
        n = at = 0
        while at < len(text):
            end = at + 1
            while end < len(text) and text[at : end + 1] in own:
                end += 1
            n, at = n + 1, end
        return n * math.log2(len(own) + 2)

    docs = spark.createDataFrame(list(enumerate(tests)), "doc_id long, text string")
    for r in identify_language(docs, labelled).collect():
        costs = {k: cost(tests[r.doc_id], t) for k, t in sample.items()}
        assert r.lang_pred == min(sorted(costs), key=costs.get)


def test_every_letter_keeps_its_identity():
    """Samples of many more letters than the table of transitions has columns."""
    rng = random.Random(5)
    latin, cyrillic = "abcdefghijklmnopqrstuvwxyz", "".join(map(chr, range(0x430, 0x450)))

    def sample(first, extra):
        letters = [chr(first + i) for i in range(400)]
        return "".join(rng.choice(letters) if rng.random() < 0.8 else rng.choice(extra) for _ in range(3000))

    # Tests come from both: a tie would go to "a".
    samples = {"a": sample(0xAC00, latin), "b": sample(0xB000, cyrillic), "c": sample(0x4E00, latin), "d": sample(0x6000, latin)}
    model = Languages(samples)
    texts = {k: t[100:200] for k, t in samples.items()}
    assert {k: model.predict([t])[0][0] for k, t in texts.items()} == {k: k for k in samples}
    mixed = [samples["a"][50:60] + samples["b"][9:30] + "\u3042\u3044z" + samples["c"][7:40], samples["d"][0:30] + samples["c"][5:9]]

    def phrases(text, own):
        n = at = 0
        while at < len(text):
            end = at + 1
            while end < len(text) and text[at : end + 1] in own:
                end += 1
            n, at = n + 1, end
        return n

    got = model.phrases([symbols(t, model.table) for t in mixed])
    assert got.tolist() == [[phrases(t, samples[k]) for k in sorted(samples)] for t in mixed]


def test_pages(spark):
    pages = dict(duckdb.sql(f"select page_id, html from '{SF}/pages.parquet'").fetchall())
    for r in rows_of(spark, "op5_html_extraction"):
        body = re.search(r"<article>(.*?)(</article>|\Z)", pages[r.page_id], re.DOTALL)
        parts = re.split(r"<(?:/?(?:p|h1|br)\b)[^>]*>", re.sub(r"<[^>]*\Z", "", body[1]) if body else "")
        blocks = (" ".join(html.unescape(re.sub(r"<[^>]*>", "", p)).split()) for p in parts)
        assert r.text == " ".join(b for b in blocks if b) and r.n_chars == len(r.text)


def test_templates_of_a_site_go(spark):
    from corpusvec.llm.html_text import extract_text

    def page(i):
        return f"<body><div><p>Welcome to our shop</p><ul><li>One<li>Two</ul></div><div><p>Story {i} of its own.</p><p>More {i * i} text here.</p></div><div>Call us</div>"

    rows = [(i, f"http://a.com/{i}", page(i)) for i in range(8)] + [(100, "http://b.com/", page(0))]
    got = {r.page_id: r.text for r in extract_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(got[i] == f"Story {i} of its own. More {i * i} text here." for i in range(8))
    assert got[100].startswith("Welcome to our shop One Two Story 0")


# --- the pipeline ---------------------------------------------------------


def test_pipeline(spark, texts):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = []
    for name, stage in corpus_pipeline.STAGES:
        out = corpus_pipeline.stored(stage(spark, docs, SF), f"test-{name}")
        if name != "packing":
            assert out.columns == docs.columns
            kept.append({r.doc_id: r.text for r in out.collect()})
        docs = out
    spoken, apart, clean, private = kept
    assert set(spoken) == {k for k, t in texts.items() if any(c.isalpha() for c in t)}
    sets = {k: shingles(t) for k, t in spoken.items()}
    groups = Groups()
    for a, b in combinations(sets, 2):
        if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
            groups.join(a, b)
    assert set(apart) == {groups.find(k) for k in sets}
    assert set(private) == set(clean) < set(apart)
    assert all(not base_spans(t) for t in private.values())
    assert {r.doc_id for r in docs.select("doc_id").collect()} == set(private)
