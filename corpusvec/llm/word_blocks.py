"""Words of many texts in arrays, and blocks of words that a text holds more than once."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from corpusvec.llm.common import slices_of


@dataclass
class Words:
    """The words of a slice of texts, one text after the other."""

    words: list[bytes]
    #: Where each text's words begin; one more entry than texts.
    starts: np.ndarray
    #: The text of each word.
    text: np.ndarray


def text_slices(batches: Iterator[pa.RecordBatch], limit: int = 1 << 21) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of Arrow batches with their texts as UTF-8 bytes, about ``limit`` bytes each."""
    for part in slices_of(batches, "text", limit):
        yield part, part.column(part.schema.get_field_index("text")).cast(pa.binary()).to_pylist()


def words_in(texts: list[bytes]) -> Words:
    """Split at ASCII white space, which is what ``bytes.split`` knows as such."""
    words: list[bytes] = []
    sizes = np.zeros(len(texts) + 1, np.int64)
    for k, text in enumerate(texts):
        own = text.split()
        sizes[k + 1] = len(own)
        words += own
    return Words(words, np.cumsum(sizes), np.repeat(np.arange(len(texts)), sizes[1:]))


def ranked(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each key a number that equal keys share, and the place of the last equal one before it (-1: none)."""
    order = np.argsort(keys, kind="stable")
    in_order = keys[order]
    same = np.zeros(len(keys), bool)
    same[1:] = in_order[1:] == in_order[:-1]
    rank = np.empty(len(keys), np.int64)
    rank[order] = np.cumsum(~same) - 1
    before = np.full(len(keys), -1, np.int64)
    later = np.flatnonzero(same)
    before[order[later]] = order[later - 1]
    return rank, before


@dataclass
class Blocks:
    """Blocks of ``size`` words that their text holds at least twice, by the place of their last word."""

    size: int
    place: np.ndarray
    #: Equal numbers for equal blocks of one text.
    rank: np.ndarray
    #: Words back to the last occurrence before; 0 where this is the first.
    lag: np.ndarray


def repeated(size: int, place: np.ndarray, keys: np.ndarray) -> Blocks:
    rank, before = ranked(keys)
    has = before >= 0
    lag = np.where(has, place - place[before], 0)
    again = has.copy()
    again[before[has]] = True
    return Blocks(size, place[again], rank[again], lag[again])


def single_words(found: Words) -> Blocks:
    codes = pa.array(found.words, pa.binary()).dictionary_encode().indices.to_numpy(zero_copy_only=False)
    keys = found.text * (codes.max(initial=0) + 1) + codes
    return repeated(1, np.arange(len(keys)), keys)


def joined(left: Blocks, right: Blocks, total: int, overlap: int = 0) -> Blocks:
    """Blocks made of one of ``left`` and one of ``right`` that follow each other.

    ``overlap`` is by how many words the two may cover each other. Only blocks
    whose parts both repeat can repeat, so each step looks at fewer places. As
    ranks differ from text to text, equal keys lie in one text.
    """
    step = right.size - overlap
    at = np.full(total, -1, np.int64)
    at[left.place] = left.rank
    first = np.where(right.place >= step, at[np.maximum(right.place - step, 0)], -1)
    whole = first >= 0
    keys = first[whole] * (right.rank.max(initial=0) + 1) + right.rank[whole]
    return repeated(left.size + step, right.place[whole], keys)
