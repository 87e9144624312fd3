"""Texts to token ids and counts with a published tokenizer file."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterable
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from corpusvec.llm.common import held

#: Bytes of odd words, and of parts of words, that a Python worker remembers in
#: each of two generations, and what a string takes besides itself and its ids.
MEMO_BYTES, MEMO_ENTRY = 1 << 24, 160


def spaced(text: str) -> list[str]:
    """The pieces of a text between spaces and line feeds, empty ones too.

    The tokenizer drops white space and never joins what it separates, so the
    tokens of a text are those of these pieces in order.
    """
    return text.replace("\n", " ").split(" ")


def spaced_words(texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
    """The pieces of all texts as by `spaced`, and how many come before each text and after the last."""
    split = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
    return split.flatten().dictionary_encode(), split.offsets.to_numpy() - split.offsets[0].as_py()


def load(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def plain_tokenizer(whole):
    """The same model, held once, for pre-tokens in their normal form that spaces separate."""
    from tokenizers import Tokenizer, pre_tokenizers

    tokenizer = Tokenizer(whole.model)
    tokenizer.pre_tokenizer = pre_tokenizers.Sequence(
        [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
    )
    return tokenizer


#: Letters that lower case and normal form leave as one, then punctuation: two
#: pre-tokens. Apostrophes are left out, since they can start a pre-token.
SIMPLE = r"^(?P<letters>[A-Za-z\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{ff}]*)(?P<marks>[!-&(-/:-@\[-`{-~]*)$"


def strings(column: pa.Array) -> tuple[np.ndarray, list[str]]:
    """The number of each string among the distinct ones, and these."""
    coded = column.dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary.to_pylist()


class Runs:
    """Id sequences end to end: where each starts, and how many ids it has."""

    def __init__(self, each: list[bytes]) -> None:
        self.sizes = np.fromiter(map(len, each), dtype=np.int64, count=len(each)) // 4
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.ids = np.frombuffer(b"".join(each), dtype="<u4")


def gathered(ids: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """``ids[start : start + size]`` of all pairs, end to end."""
    before = np.cumsum(sizes) - sizes
    return ids[np.repeat(starts - before, sizes) + np.arange(int(sizes.sum()))]


class Known:
    """Ids of the strings that a worker met lately, of about twice `MEMO_BYTES` at most.

    A full generation becomes the older one, from which strings that are met
    again come back; the older one before it is forgotten.
    """

    def __init__(self, encode: Callable[[list[str]], Iterable[bytes]]) -> None:
        self.encode, self.size = encode, 0
        self.young: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def ids(self, strings: list[str]) -> list[bytes]:
        if self.size > MEMO_BYTES:
            self.young, self.older, self.size = {}, self.young, 0
        young, older = self.young, self.older
        missing = [s for s in strings if s not in young]
        young.update((s, older[s]) for s in missing if s in older)
        new = [s for s in missing if s not in young]
        for start in range(0, len(new), 4096):
            some = new[start : start + 4096]
            young.update(zip(some, self.encode(some), strict=True))
        self.size += sum(MEMO_ENTRY + len(s) + len(young[s]) for s in missing)
        return [young[s] for s in strings]


class Memo:
    """Ids of the parts of words as little-endian unsigned 32-bit numbers, remembered by a worker.

    The tokenizer's own splitting is its dearest part. A word of plain letters
    and closing punctuation is split by Arrow, and only its parts are looked up;
    any other word goes through the whole tokenizer.
    """

    def __init__(self, path: str) -> None:
        self.whole = load(path)
        self.plain = plain_tokenizer(self.whole)
        vocabulary = self.plain.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        for token, i in vocabulary.items():
            self.ends[i] = token.endswith("</w>")
        self.words, self.parts = Known(self.encoded_words), Known(self.encoded_parts)

    def encoded_parts(self, parts: list[str]) -> list[bytes]:
        ids = np.array(self.plain.encode_batch_fast([" ".join(parts)], add_special_tokens=False)[0].ids, dtype="<u4")
        # The last token of each part says that it is the last; an empty part has none.
        cuts = [0, *(4 * (np.nonzero(self.ends[ids])[0] + 1)).tolist()]
        raw = ids.tobytes()
        coded = dict(zip(filter(None, parts), (raw[i:j] for i, j in pairwise(cuts)), strict=True))
        return [coded.get(p, b"") for p in parts]

    def encoded_words(self, words: list[str]) -> list[bytes]:
        return [np.array(c.ids, dtype="<u4").tobytes() for c in self.whole.encode_batch_fast(words, add_special_tokens=False)]

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts end to end, and the number of ids before each text and after the last."""
        words, ends = spaced_words(texts)
        word, distinct = words.indices.to_numpy(zero_copy_only=False), words.dictionary
        split = pc.extract_regex(distinct, SIMPLE)
        odd = np.nonzero(split.is_null().to_numpy(zero_copy_only=False))[0]
        letters, own_letters = strings(pc.utf8_lower(pc.struct_field(split, "letters").fill_null("")))
        marks, own_marks = strings(pc.struct_field(split, "marks").fill_null(""))
        letters[odd] = len(own_letters) + len(own_marks) + np.arange(len(odd))
        marks += len(own_letters)
        runs = Runs(self.parts.ids(own_letters) + self.parts.ids(own_marks) + self.words.ids(distinct.take(pa.array(odd)).to_pylist()))
        # Each word is its letters, then its marks; an odd word has no marks.
        parts = np.stack((letters[word], marks[word]), axis=1)
        sizes = runs.sizes[parts]
        before = np.concatenate(([0], np.cumsum(sizes.sum(axis=1))))
        return gathered(runs.ids, runs.starts[parts].ravel(), sizes.ravel()), before[ends]


def memo(path: str) -> Memo:
    return held("token-ids", path, lambda: Memo(path))
