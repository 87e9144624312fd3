import random
from collections import Counter

import numpy as np
import pytest

from corpusvec.operators import merges, subwords


def table(spark, tokens):
    return subwords.vocabulary_from(spark, {t.hex(): i for i, t in enumerate(tokens, 256)})


def encode_by_hand(piece, ranks):
    if piece in ranks:
        return [ranks[piece]]
    parts = [piece[i : i + 1] for i in range(len(piece))]
    while True:
        offers = [
            (ranks[parts[i] + parts[i + 1]], i)
            for i in range(len(parts) - 1)
            if parts[i] + parts[i + 1] in ranks
        ]
        if not offers:
            return [ranks[p] for p in parts]
        _, i = min(offers)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]


@pytest.fixture(scope="module")
def ranks():
    rng = random.Random(4)
    tokens = [bytes([b]) for b in range(256)]
    for _ in range(120):
        a, b = rng.choice([*tokens[97:101], *tokens[256:]]), rng.choice([*tokens[97:101], *tokens[256:]])
        if a + b not in tokens:
            tokens.append(a + b)
    return {t: i for i, t in enumerate(tokens)}


def test_merging_matches_plain_rule(ranks):
    rng = random.Random(8)
    for n in [1, 2, 3, 5, 8, 30, 200]:
        for _ in range(60):
            piece = bytes(rng.choice(b"abcdx") for _ in range(n))
            assert subwords._merge_piece(piece, ranks) == encode_by_hand(piece, ranks)


def test_long_piece_is_not_quadratic(ranks):
    piece = b"abcd" * 100_000
    ids = subwords._merge_piece(piece, ranks)
    text = {i: t for t, i in ranks.items()}
    assert b"".join(text[i] for i in ids) == piece


def test_join_path_gives_the_same(spark, ranks):
    rng = random.Random(6)
    words = ["".join(rng.choice("abcd_1é") for _ in range(rng.randrange(1, 12))) for _ in range(200)]
    df = spark.createDataFrame([(w,) for w in words * 3], "word string")
    known = table(spark, [t for t, i in sorted(ranks.items(), key=lambda e: e[1]) if i >= 256])
    here = Counter((r.word, tuple(r.token_ids)) for r in subwords.encode_words(df, known).collect())
    joined = Counter((r.word, tuple(r.token_ids)) for r in subwords.encode_words_by_join(df, known).collect())
    assert here == joined
    assert here.total() == 600


def test_vocabulary_beyond_the_bound_is_joined(spark, monkeypatch):
    df = spark.createDataFrame([("abab",)], "word string")
    known = table(spark, [b"ab"])
    monkeypatch.setattr(subwords, "BROADCAST_TOKENS", 100)
    assert subwords.encode_words(df, known).first().token_ids == [256, 256]


TEXTS = [
    "Good morning, all of you.", "[~^] {<=>} 50% #1 a|b; c\\d", "marigold", "naïve 東京 😀", " lead  two\n\nlines 12345",
    "it's we'll", "a_b __c", "\u2028",
]


@pytest.mark.parametrize("tokens", [[], [b"he", b"hel", b"wo", b"\xc3\xaf", b"__"]])
def test_round_trip(spark, tokens):
    df = spark.createDataFrame([(t,) for t in TEXTS], "word string")
    known = table(spark, tokens)
    back = subwords.decode_sequences(subwords.encode_words(df, known), known, "word")
    assert {r.word: r.text for r in back.collect()} == {t: t for t in TEXTS}


def test_pieces(spark):
    df = spark.createDataFrame([("a_b12345__c it's",)], "t string")
    got = df.select(subwords.pieces_of(df.t).alias("p")).first().p
    assert got == ["a", "_b", "123", "45", "__", "c", " it", "'s"]


def test_part_of_a_character_decodes_to_a_mark(spark):
    known = table(spark, [])
    df = spark.createDataFrame([(0xC3,), (0x61,)], "token_id int")
    got = {r.token_id: r.word for r in subwords.decode_tokens(df, known).collect()}
    assert got == {0xC3: "\ufffd", 0x61: "a"}


def learn_by_hand(counts, merges):
    state = {tuple(bytes([b]) for b in w.encode()): n for w, n in counts.items()}
    found = []
    for _ in range(merges):
        pairs = Counter()
        for parts, n in state.items():
            for pair in zip(parts, parts[1:]):
                pairs[pair] += n
        if not pairs:
            break
        a, b = min(pairs, key=lambda p: (-pairs[p], p[0].hex(), p[1].hex()))
        found.append(a + b)
        merged = Counter()
        for parts, n in state.items():
            out, i = [], 0
            while i < len(parts):
                if parts[i : i + 2] == (a, b):
                    out.append(a + b)
                    i += 2
                else:
                    out.append(parts[i])
                    i += 1
            merged[tuple(out)] += n
        state = merged
    return found


def test_learning_matches_plain_rule(spark):
    rng = random.Random(11)
    counts = {"".join(rng.choice("aabbcd") for _ in range(rng.randrange(1, 9))): rng.randrange(1, 50) for _ in range(80)}
    df = spark.createDataFrame(list(counts.items()), "word string, frequency long")
    got = subwords.learn_vocabulary(df, merges=6).orderBy("token_id").collect()
    assert [bytes(r.token_bytes) for r in got][:256] == [bytes([b]) for b in range(256)]
    by_hand = list(dict.fromkeys(learn_by_hand(counts, 6)))
    assert [bytes(r.token_bytes) for r in got][256:] == by_hand


def test_learning_ends_when_nothing_is_left(spark):
    df = spark.createDataFrame([("ab", 3)], "word string, frequency long")
    got = subwords.learn_vocabulary(df, merges=10, merges_per_round=4)
    assert got.count() == 257


def test_pairs_of_a_round_do_not_overlap(spark):
    """(a,b) and (b,c) overlap in abc; only the better is merged first."""
    df = spark.createDataFrame([("abc", 5), ("ab", 2), ("xy", 6), ("xz", 1)], "word string, frequency long")
    got = subwords.learn_vocabulary(df, merges=2, merges_per_round=2).where("token_id >= 256")
    assert [bytes(r.token_bytes) for r in got.orderBy("token_id").collect()] == [b"ab", b"xy"]


@pytest.mark.parametrize("per_round", [1, 3, 64])
def test_rounds_never_change_the_vocabulary(spark, per_round):
    rng = random.Random(5)
    parts = ["th", "he", "the", "in", "ing", "er", "re", "an", "aa", "x"]
    counts = {"".join(rng.choices(parts, k=rng.randrange(1, 6))): rng.randrange(1, 40) for _ in range(300)}
    df = spark.createDataFrame(list(counts.items()), "word string, frequency long")
    got = subwords.learn_vocabulary(df, 30, per_round).where("token_id >= 256").orderBy("token_id").collect()
    assert [bytes(r.token_bytes) for r in got] == list(dict.fromkeys(learn_by_hand(counts, 30)))


def test_batches_equal_single_merges_on_a_corpus(spark):
    from corpusvec.operators.word_count import word_count

    counts = word_count(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))
    pieces = counts.select(subwords.F.explode(subwords.pieces_of(counts.word)).alias("p"), "frequency")
    by_hand = learn_by_hand({r.p: r.n for r in pieces.groupBy("p").agg(subwords.F.sum("frequency").alias("n")).collect()}, 200)
    got = subwords.learn_vocabulary(counts, 200, 16).where("token_id >= 256").orderBy("token_id").collect()
    assert [bytes(r.token_bytes) for r in got] == list(dict.fromkeys(by_hand))


@pytest.mark.parametrize(("per_round", "pieces"), [(8, 0), (16, 2000), (32, 1 << 18)])
def test_a_thousand_merges_in_rounds_of_any_kind(spark, monkeypatch, per_round, pieces):
    """Guessing, fetching and both in turn, with the merges written out on the way."""
    monkeypatch.setattr(subwords, "REPLAYED", 300)
    rng = random.Random(7)
    stems = ["".join(rng.choice("etaoinshrdlu") for _ in range(rng.randrange(1, 5))) for _ in range(150)]
    counts = {"".join(rng.choices(stems, k=rng.randrange(1, 4))): rng.randrange(1, 9) for _ in range(2500)}
    times = 250 if pieces == 0 else 1000
    df = spark.createDataFrame(list(counts.items()), "word string, frequency long")
    got = subwords.learn_vocabulary(df, times, per_round, pieces).where("token_id >= 256").orderBy("token_id").collect()
    assert [bytes(r.token_bytes) for r in got] == list(dict.fromkeys(learn_by_hand(counts, times)))


def test_merging_flat_pieces():
    symbols, piece = np.array([1, 1, 1, 2, 1, 1, 1, 1, 1], np.int32), np.array([0, 0, 0, 0, 0, 1, 1, 1, 1])
    after, pieces, touched = merges.merge(symbols, piece, (1, 1), 9)
    assert (after.tolist(), pieces.tolist(), touched.tolist()) == ([9, 1, 2, 1, 9, 9], [0, 0, 0, 0, 1, 1], [0, 1])
    *_, (left, right, n, places) = merges.merge_with_changes(symbols, piece, np.array([5, 1 << 60]), (1, 1), 9)
    changes = dict(zip(zip(left.tolist(), right.tolist()), zip(n.tolist(), places.tolist())))
    assert changes == {(1, 1): (-2 * 5 - 3 * (1 << 60), -5), (9, 1): (5, 1), (9, 9): (1 << 60, 1)}


def test_the_queue_skips_what_no_longer_holds():
    queue = merges.PairQueue(["b", "a"])
    queue.change(*(np.array(c) for c in ([0, 1, 1], [0, 0, 1], [7, 7, 3], [1, 1, 1])))
    assert queue.best() == (1, 0) and queue.best_of(9, 99) == [(1, 0), (0, 0), (1, 1)] and queue.best_of(9, 2) == [(1, 0), (0, 0)]
    queue.change(*(np.array(c) for c in ([1, 0], [0, 0], [-7, -5], [-1, 0])))
    assert queue.best() == (1, 1) and queue.best_of(9, 0) == [(1, 1)] and queue.best_of(9, 9) == [(1, 1), (0, 0)]


def test_both_encoders_give_the_same_rows(spark):
    words = ["ab", "", None, "b", "é", "ab" * 10_000, "a b", "xaby", "ab"]
    df = spark.createDataFrame([(w,) for w in words], "word string")
    known = table(spark, [b"ab", b"abab", b"aba", b"\xc3\xa9", b"bab"])

    def rows(coded):
        return sorted(((r.word, r.token_ids) for r in coded.collect()), key=repr)

    here = rows(subwords.encode_words(df, known))
    assert here == rows(subwords.encode_words_by_join(df, known)) and len(here) == len(words)


def test_both_encoders_fail_without_a_byte(spark):
    known = table(spark, []).where("token_id <> 98")
    df = spark.createDataFrame([("ab",)], "word string")
    for encode in (subwords.encode_words, subwords.encode_words_by_join):
        with pytest.raises(Exception, match="KeyError"):
            encode(df, known).collect()


def test_tokens_that_a_piece_holds(spark):
    """Found level by level, whatever their length, and nothing else."""
    rng = random.Random(3)
    names = {"".join(rng.choice("ab") for _ in range(rng.choice([3, 4, 5, 8, 9, 16, 17, 33]))).encode() for _ in range(150)}
    tokens = spark.createDataFrame([(bytearray(t), i) for i, t in enumerate(sorted(names))], "token_bytes binary, token_id int")
    texts = [b"", b"a", b"ab", b"aba"] + ["".join(rng.choice("ab") for _ in range(60)).encode() for _ in range(20)]
    pieces = spark.createDataFrame([(i, bytearray(t)) for i, t in enumerate(texts)], "id long, piece binary")
    got = sorted((r.id, bytes(r.token_bytes)) for r in subwords.tokens_held(pieces, tokens).collect())
    assert got == sorted((i, n) for i, t in enumerate(texts) for n in names if n in t)
    assert subwords.tokens_held(pieces, tokens.where("octet_length(token_bytes) < 3")).count() == 0


def test_decoding_keeps_every_key(spark):
    known = table(spark, [b"ab"])
    df = spark.createDataFrame([(1, []), (2, [256, 97]), (3, None)], "k int, token_ids array<int>")
    assert {r.k: r.text for r in subwords.decode_sequences(df, known, "k").collect()} == {1: "", 2: "aba", 3: ""}
    unknown = spark.createDataFrame([(1, [999])], "k int, token_ids array<int>")
    with pytest.raises(Exception, match="no such token"):
        subwords.decode_sequences(unknown, known, "k").collect()
    with pytest.raises(Exception, match="no such token"):
        subwords.decode_tokens(spark.createDataFrame([(999,)], "token_id int"), known).collect()


@pytest.mark.parametrize("times", [1, 2, 9, 40])
def test_the_driver_holds_no_more_pieces_than_a_round_may_fetch(spark, monkeypatch, times):
    # The best pair is in nearly all pieces.
    counts = {f"ab{a}{b}": 50 + k for k, (a, b) in enumerate((a, b) for a in "cdefgh" for b in "ijklmn")} | {"xy": 3, "uv": 2, "uvw": 1}
    held = []

    def merge(symbols, piece, frequency, *step):
        held.append(len(frequency))
        return merge_with_changes(symbols, piece, frequency, *step)

    merge_with_changes = merges.merge_with_changes
    monkeypatch.setattr(merges, "merge_with_changes", merge)
    df = spark.createDataFrame(list(counts.items()), "word string, frequency long")
    got = subwords.learn_vocabulary(df, times, 4, 7).where("token_id >= 256").orderBy("token_id").collect()
    assert [bytes(r.token_bytes) for r in got] == learn_by_hand(counts, times)
    assert max(held, default=0) <= 7


@pytest.mark.parametrize("dense", [1024, 0])
def test_many_pieces_are_merged_at_once(ranks, monkeypatch, dense):
    """Any vocabulary, also one whose merges come before their parts; a heap is for long pieces."""
    rng = random.Random(9)
    shuffled = dict(zip(ranks, rng.sample(range(1000), len(ranks))))
    pieces = ["".join(rng.choice("abcdx") for _ in range(rng.randrange(1, 40))) for _ in range(500)]
    pieces = [*dict.fromkeys(pieces), "", "é東", "ab" * 32, "ab" * 33 + "x"]
    monkeypatch.setattr(subwords, "DENSE_TOKENS", dense)
    for known in (ranks, shuffled):
        want = [encode_by_hand(p.encode(), known) if p else [] for p in pieces]
        alone = []
        monkeypatch.setattr(subwords, "_merge_piece", lambda p, r: alone.append(p) or want[pieces.index(p.decode())])
        memo = subwords._Memo(known)
        assert [t.tolist() for t in memo.tokens(pieces)] == want
        assert len(alone) < 4 if dense else len(alone) > 400
        again = memo.tokens(pieces[::-1])
        assert [t.tolist() for t in again] == want[::-1]
