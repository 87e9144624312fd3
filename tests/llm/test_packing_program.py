"""The configuration program: its bound, its gap and the share it places."""

import math

import numpy as np
import pyarrow as pa
import pytest
from corpusvec.llm import packing, tokens
from corpusvec.llm.queries import SEQUENCE, op4_best_fit_packing, word_tokenizer

SF_DIR = "/root/testdata/sf0.001"


def lognormal(seed, rows=3000, size=512):
    sizes = np.minimum(size, 1 + np.random.default_rng(seed).lognormal(4, 1.5, rows).astype(int))
    return {int(n): int(k) for n, k in zip(*np.unique(sizes, return_counts=True))}


def check_cover(cover, need, size):
    lengths = np.array(sorted(need))
    assert (cover.configurations @ lengths <= size).all()
    assert (cover.amounts @ cover.configurations >= np.array([need[n] for n in lengths]) * (1 - 1e-9)).all()
    assert cover.bound * (1 - 1e-9) <= cover.amounts.sum() <= (1 + packing.GAP) * cover.bound * (1 + 1e-9)


@pytest.mark.parametrize(
    "need, size, least",
    [
        ({51: 40}, 100, 40),  # one a sequence
        ({3: 60}, 7, 30),  # two a sequence
        ({4: 25, 3: 25}, 7, 25),  # one of each
        ({6: 10, 5: 10, 4: 20}, 10, 20),  # ten of 6+4, five of 5+5, five of 4+4
        ({1: 1}, 1, 1),
        ({5: 30, 7: 1}, 20, 7.875),  # half of 7+7+5, the rest four a sequence
    ],
)
def test_covers_are_within_the_gap_of_the_optimum(need, size, least):
    cover = packing.fractional(need, size)
    check_cover(cover, need, size)
    assert cover.bound <= least * (1 + 1e-9) and cover.amounts.sum() <= (1 + packing.GAP) * least * (1 + 1e-9)


@pytest.mark.parametrize("seed", range(3))
def test_covers_of_many_lengths(seed):
    need = {n: k for n, k in lognormal(seed).items() if n < 512}
    check_cover(packing.fractional(need, 512), need, 512)


@pytest.mark.parametrize("times", [1, 100])
@pytest.mark.parametrize("seed", range(3))
def test_the_program_places_most_pieces(seed, times):
    histogram = {n: times * k for n, k in lognormal(seed).items()}
    short = sum(k for n, k in histogram.items() if n < 512)
    assert sum(b.planned * b.count for b in packing.pack(histogram, 512)) > 0.5 * short


def test_the_program_beats_best_fit_where_that_goes_wrong():
    # Longest first ends 10s at 3+3 and leaves 4s and 2s apart; 4+3+3 fills all.
    histogram = {4: 600, 3: 1200}
    packed = packing.pack(histogram, 10)
    alone = packing.best_fit([], dict(histogram), 10)
    assert sum(b.count for b in packed) == 600 < sum(b.count for b in alone)
    assert sum(b.planned * b.count for b in packed) == 1800


def test_the_query_says_what_the_program_placed(spark):
    rows = op4_best_fit_packing(spark, SF_DIR).where(f"length < {SEQUENCE}").groupBy("by_program").count().collect()
    n = {r.by_program: r["count"] for r in rows}
    assert n[True] > n.get(False, 0)


def test_odd_histograms():
    assert packing.pack({}, 8) == []
    assert sum(b.count for b in packing.pack({8: 5}, 8)) == 5
    assert sum(b.count for b in packing.pack({1: 17}, 8)) == math.ceil(17 / 8)


def test_a_worker_remembers_bounded_bytes(monkeypatch):
    monkeypatch.setattr(tokens, "MEMO_BYTES", 20_000)
    memo, whole = tokens.Memo(word_tokenizer()), tokens.load(word_tokenizer())
    texts = [f"word{'abcdefghij'[k % 10] * (k % 23)}x{k} plain{'qrstuvwxyz'[k // 60 % 10] * (k % 60)}, the end." for k in range(600)] + ["", " "]
    each = 50
    for start in range(0, len(texts), each):
        some = texts[start : start + each]
        ids, before = memo.ids(pa.array(some))
        for k, text in enumerate(some):
            assert ids[before[k] : before[k + 1]].tolist() == whole.encode(text, add_special_tokens=False).ids
        for known in (memo.parts, memo.words):
            # Two generations, each over its bound by what one call adds at most.
            assert len(known.young) + len(known.older) <= 2 * (20_000 // tokens.MEMO_ENTRY + 2 * each + 20)
    assert "the" in memo.parts.young | memo.parts.older and "wordx0" not in memo.words.young | memo.words.older
    assert 50 < len(memo.words.older) and len(texts) > len(memo.words.young) + len(memo.words.older)


def test_the_model_is_held_once():
    memo = tokens.Memo(word_tokenizer())
    assert memo.plain.get_vocab(with_added_tokens=False) == memo.whole.get_vocab(with_added_tokens=False)
    assert memo.plain.get_added_tokens_decoder() == {} and len(memo.whole.get_added_tokens_decoder()) == 2
