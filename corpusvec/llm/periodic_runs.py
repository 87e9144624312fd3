"""Periodic runs of words: stretches that say the same few words over and over."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from corpusvec.llm.common import texts_of
from corpusvec.llm.word_blocks import Blocks, joined, single_words, text_slices, words_in

RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
SCHEMA = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, text string"


def ended_diagonals(blocks: Blocks) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(first word, length, period)`` of the diagonals that this block size decides.

    Goes along the words: where a block's last occurrence lies as many words
    back as that of the block one word before, the active lag grows by one
    match; otherwise the diagonal has ended. Its stretch is its matches, the
    block's other words before the first of them, and the lag itself.
    """
    held = (blocks.lag > blocks.size // 2) & (blocks.lag <= blocks.size)
    place, lag = blocks.place[held], blocks.lag[held]
    opens = np.ones(len(place), bool)
    opens[1:] = (place[1:] != place[:-1] + 1) | (lag[1:] != lag[:-1])
    first = np.flatnonzero(opens)
    matches = np.diff(np.append(first, len(place)))
    return place[first] - lag[first] - blocks.size + 1, matches + lag[first] + blocks.size - 1, lag[first]


def find_runs(texts: list[bytes], least: int, times: int):
    """The words of ``texts`` and their runs as ``(place of first word, length, period)``, in order.

    A word's earlier occurrences open lags, and a match one word on lengthens
    an open lag. All occurrences of frequent words would be quadratic in a
    text. But in a run of smallest period q the last occurrence of any block of
    q or more words is exactly q words back: one nearer would give a smaller
    period. So it is enough to follow, for blocks of 1, 2, 4, ... words, the
    last occurrence where it is between half a block and a block back, which
    is one lag a word and block size, for as long as blocks repeat at all.
    """
    found = words_in(texts)
    total = len(found.words)
    longest = int(np.diff(found.starts).max(initial=0))
    runs = []
    blocks = single_words(found)
    # A run holds its period `times` times, which is more than half a block. As
    # it has three periods or more, it has room for a block and its lag.
    while len(blocks.place) and blocks.size * times < 2 * longest:
        start, length, period = ended_diagonals(blocks)
        long = (length >= least) & (length >= times * period)
        runs.append(np.stack([start[long], length[long], period[long]]))
        blocks = joined(blocks, blocks, total)
    every = np.concatenate(runs, axis=1) if runs else np.zeros((3, 0), np.int64)
    return found, every[:, np.lexsort((every[2], every[0]))]


def collapse_runs(docs: DataFrame, least: int = 6, times: int = 4) -> DataFrame:
    """``doc_id, n_words, runs, text`` of every row of ``docs``.

    ``runs`` are all stretches of words with a smallest period q that hold at
    least ``least`` words and ``times`` times q, each as long as it goes, by
    first word and period. ``text`` has the words of none of them but those of
    its first period, joined by one space. ``times`` has to be 3 or more.

    A null or empty text, or one of white space, has no words and no runs. Rows
    that share an id, or have none, each give a row; an empty table gives none.
    Other columns aren't looked at. A row is worked on by itself, in time that
    grows with n log n and memory with n, however often its words recur.
    """
    if times < 3 or least < 1:
        raise ValueError("a run holds its period three times at least, and one word at least")

    def collapse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_slices(batches):
            found, (start, length, period) = find_runs(texts, least, times)
            # Words after a run's first period, counted as a sum of steps.
            steps = np.zeros(len(found.words) + 1, np.int64)
            np.add.at(steps, start + period, 1)
            np.add.at(steps, start + length, -1)
            keep = np.cumsum(steps)[:-1] == 0
            of = found.text[start] if len(start) else np.zeros(0, np.int64)
            ends = np.searchsorted(of, np.arange(len(texts) + 1))
            out = [
                b" ".join(compress(found.words[a:b], keep[a:b]) if n else found.words[a:b])
                for a, b, n in zip(found.starts[:-1], found.starts[1:], np.diff(ends))
            ]
            values = pa.StructArray.from_arrays(
                [pa.array(start - found.starts[of]), pa.array(length), pa.array(period)], fields=list(RUN)
            )
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(part.schema.get_field_index("doc_id")), pa.array(np.diff(found.starts)),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values), pa.array(out, pa.binary()).cast(pa.string()),
                ],
                names=["doc_id", "n_words", "runs", "text"],
            )

    return texts_of(docs).mapInArrow(collapse, SCHEMA)
