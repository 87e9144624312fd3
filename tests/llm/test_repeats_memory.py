"""What a worker holds while it sorts segments (op8)."""

import random
import tracemalloc

import numpy as np
import pytest
from corpusvec.llm import repeats


def some_segments(count, span):
    rng = random.Random(5)
    text = rng.randbytes(20000)
    for k in range(count):
        at = rng.randrange(18000)
        part = bytearray(text[at : at + rng.randrange(span, 2 * span - 63)])
        part[rng.randrange(len(part))] = k % 256
        yield bytes(part)


def test_a_sort_takes_little_more_than_its_keys():
    parts = list(some_segments(900, 400))
    repeats.earlier_and_later(parts[:2], 400)
    tracemalloc.start()
    offsets, before, after = repeats.earlier_and_later(parts, 400)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 40 * sum(map(len, parts))
    strings = [p[i : i + 400] for p in parts for i in range(len(p) - 399)]
    first, last = {}, {}
    for i, s in enumerate(strings):
        first.setdefault(s, i)
        last[s] = i
    assert offsets[-1] == len(strings) and before.any()
    assert (before == np.array([first[s] < i for i, s in enumerate(strings)])).all()
    assert (after == np.array([last[s] > i for i, s in enumerate(strings)])).all()


@pytest.mark.parametrize("span", [64, 100, 512, 1000])
def test_strings_of_other_lengths(span):
    parts = list(some_segments(60, span))
    _, before, _ = repeats.earlier_and_later(parts, span)
    strings = [p[i : i + span] for p in parts for i in range(len(p) - span + 1)]
    first = {s: -i for i, s in reversed(list(enumerate(strings)))}
    assert (before == np.array([-first[s] < i for i, s in enumerate(strings)])).all()


def test_sorts_hold_bounded_bytes_or_one_anchor():
    rng = random.Random(3)
    rows = [(anchor, bytes(rng.randrange(1, 90))) for anchor in range(300) for _ in range(rng.choice([1, 2, 3, 40]))]
    together = list(repeats.whole_anchors(iter(rows), 500))
    assert [r for part in together for r in part] == rows and list(repeats.whole_anchors(iter([]), 500)) == []
    for part in together:
        assert len({r[0] for r in part}) == 1 or sum(len(r[1]) for r in part) <= 500
    for part, following in zip(together, together[1:]):
        assert part[-1][0] != following[0][0]


def test_an_anchor_of_many_bytes_is_not_sorted_at_once(spark, monkeypatch):
    monkeypatch.setattr(repeats, "ANCHOR_BYTES", 3000)
    crowded, plain = [], repeats.by_strings
    monkeypatch.setattr(repeats, "by_strings", lambda found, *rest: crowded.append(found.count()) or plain(found, *rest))
    shared = "".join(random.Random(2).choices("abcé \n", k=900))
    texts = {i: f"{i}{shared[i : 500 + 3 * i]}{i * 7}{shared[:430]}" for i in range(12)}
    seen = {}
    for k, text in texts.items():
        data = text.encode()
        for i in range(len(data) - 399):
            seen.setdefault(data[i : i + 400], []).append((k, i))
    found = repeats.remove_repeats(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), 400, False).collect()
    assert crowded[0] > 0 and len(found) == len(texts)
    for r in found:
        covered = np.zeros(r.n_bytes, dtype=bool)
        for places in seen.values():
            for k, i in places if len(places) > 1 else ():
                if k == r.doc_id:
                    covered[i : i + 400] = True
        assert [(s.start, s.end - 1) for s in r.spans] == repeats.runs_of(covered)
