"""Language identification by cross-parsing against labelled text."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusvec.llm.common import appended, held, slices_of, texts_of

UNKNOWN = "und"
#: A phrase ends at the latest with its block of so many symbols:
#: long texts are parsed block by block, side by side with others.
BLOCK = 1024
SPACE, OTHER = 0, 1
#: Most letters that have a column of their own in the table of transitions; all
#: others are looked up among the transitions there are. It bounds the table to
#: some 256 bytes for each letter of a sample, whatever the script.
COLUMNS = 62
#: Windows that a document of a sample gives, spread over its whole text.
WINDOWS = 4


def symbol_table(letters: str) -> np.ndarray:
    """A symbol for every code point: 0 no letter, 1 a letter not in ``letters``, or one of its own."""
    table = np.zeros(0x110000, dtype=np.int32)
    alphabetic = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000 and chr(c).isalpha()]
    table[alphabetic] = OTHER
    for i, letter in enumerate(letters):
        table[ord(letter)] = i + 2
    return table


def symbols(text: str, table: np.ndarray) -> np.ndarray:
    """Letters of a text in lower case as symbols, with one 0 for all between two words."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype="<u4")
    found = table[points]
    after_space = np.concatenate(([True], found[:-1] == SPACE))
    return found[~((found == SPACE) & after_space)]


def automaton(sequence: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Transitions of the suffix automaton of ``sequence``; -1 where there is none.

    Symbols below ``width`` are columns of the first array; those of the others
    are keys, ``state << 21 | symbol``, in order and the states they lead to.

    A walk from state 0 stays inside the automaton as long as what it has read
    occurs in the sequence.
    """
    moves: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in sequence.tolist():
        here = len(moves)
        moves.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in moves[p]:
            moves[p][c] = here
            p = link[p]
        if p >= 0:
            q = moves[p][c]
            if length[q] == length[p] + 1:
                link[here] = q
            else:
                twin = len(moves)
                moves.append(dict(moves[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and moves[p].get(c) == q:
                    moves[p][c] = twin
                    p = link[p]
                link[q] = link[here] = twin
        last = here
    table = np.full((len(moves), width), -1, dtype=np.int32)
    edges = []
    for state, out in enumerate(moves):
        for c, to in out.items():
            if c < width:
                table[state, c] = to
            else:
                edges.append((state << 21 | c, to))
    keys = np.array(sorted(edges), dtype=np.int64).reshape(-1, 2)
    return table, keys[:, 0].copy(), keys[:, 1].copy()


def follow(keys: np.ndarray, to: np.ndarray, state: np.ndarray, symbol: np.ndarray) -> np.ndarray:
    """Where transitions that have no column lead; -1 where there is none."""
    if not len(keys):
        return np.full(len(state), -1, dtype=np.int64)
    wanted = state.astype(np.int64) << 21 | symbol
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, to[at], -1)


def parser(table: np.ndarray) -> np.ndarray:
    """The automaton with restarts: ``4 * next state + phrases that end here``.

    Where a phrase can't go on, it ends and the symbol starts the next one; a
    symbol that never occurs is a phrase of its own.
    """
    states = np.arange(len(table))[:, None]
    from_start = table[0][None, :]
    ended = np.where(table >= 0, 0, (states > 0).astype(np.int32) + (from_start < 0)).astype(np.int32)
    to = np.where(table >= 0, table, np.maximum(from_start, 0))
    return (4 * to + ended).astype(np.int32)


class Languages:
    """Parsers of all languages, made once a worker from their sample texts."""

    def __init__(self, samples: dict[str, str]) -> None:
        self.names = sorted(samples)
        seen = Counter(c for text in samples.values() for c in text.lower() if c.isalpha())
        letters = sorted(seen, key=lambda c: (-seen[c], c))
        self.table = symbol_table("".join(letters))
        self.width = min(len(letters), COLUMNS) + 2
        self.moves: list[np.ndarray] = []
        self.edges: list[tuple[np.ndarray, np.ndarray]] = []
        self.bits = np.zeros(len(self.names))
        # One at a time: what making an automaton takes is not held for all.
        for k, name in enumerate(self.names):
            coded = symbols(samples[name], self.table)
            table, keys, to = automaton(coded, self.width)
            self.moves.append(parser(table).ravel())
            self.edges.append((keys, to))
            self.bits[k] = np.log2(len(coded) + 2)

    def phrases(self, coded: list[np.ndarray]) -> np.ndarray:
        """Phrases of each text (rows) in each language (columns)."""
        owner, blocks = [], []
        for i, c in enumerate(coded):
            for at in range(0, len(c), BLOCK):
                owner.append(i)
                blocks.append(c[at : at + BLOCK])
        counts = np.zeros((len(coded), len(self.names)))
        if not blocks:
            return counts
        sizes = np.array([len(b) for b in blocks])
        order = np.argsort(-sizes, kind="stable")
        sizes = sizes[order]
        lanes = np.zeros((sizes[0], len(blocks)), dtype=np.int32)
        for lane, at in enumerate(order):
            lanes[: len(blocks[at]), lane] = blocks[at]
        active = len(blocks) - np.searchsorted(sizes[::-1], np.arange(sizes[0]), side="right")
        owners = np.array(owner)[order]
        rare = (lanes >= self.width).any(axis=1)
        for k, moves in enumerate(self.moves):
            state = np.zeros(len(blocks), dtype=np.int32)
            ended = np.zeros(len(blocks), dtype=np.int32)
            for step, n in enumerate(active):
                symbol = lanes[step, :n]
                if rare[step]:
                    step_to = self.step(k, state[:n], symbol)
                else:
                    step_to = moves[state[:n] * self.width + symbol]
                state[:n] = step_to >> 2
                ended[:n] += step_to & 3
            ended += state > 0
            counts[:, k] = np.bincount(owners, weights=ended, minlength=len(coded))
        return counts

    def step(self, k: int, state: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        """One step of `parser` where some symbols have no column."""
        has_column = symbol < self.width
        out = self.moves[k][state * self.width + np.where(has_column, symbol, 0)]
        at = np.flatnonzero(~has_column)
        from_, c = state[at], symbol[at]
        to = follow(*self.edges[k], from_, c)
        start = follow(*self.edges[k], np.zeros_like(from_), c)
        ended = np.where(to >= 0, 0, (from_ > 0).astype(np.int64) + (start < 0))
        out[at] = 4 * np.where(to >= 0, to, np.maximum(start, 0)) + ended
        return out

    def predict(self, texts: list[str], least_phrase: float = 0.0) -> list[tuple[str, float]]:
        coded = [symbols(t, self.table) for t in texts]
        phrases = self.phrases(coded)
        cost = phrases * self.bits
        out = []
        for c, row, n in zip(coded, cost, phrases, strict=True):
            order = np.argsort(row, kind="stable")
            if not c.any() or len(c) < least_phrase * n[order[0]]:
                out.append((UNKNOWN, 0.0))
                continue
            best = row[order[0]]
            second = row[order[1]] if len(row) > 1 else np.inf
            out.append((self.names[order[0]], 1.0 if np.isinf(second) else float(second / (best + second))))
        return out


def languages(samples: tuple[tuple[str, str], ...]) -> Languages:
    return held("languages", samples, lambda: Languages(dict(samples)))


def windows(text: Column, key: Column, size: int) -> Column:
    """`WINDOWS` windows of ``size`` characters, or the whole of a text no longer than all of them.

    Each lies in its own equal part of the text, at a place that a hash chooses.
    """
    part = F.floor(F.char_length(text) / WINDOWS).cast("int")
    places = [
        F.lit(k) * part + F.pmod(F.xxhash64(key, F.lit(k)), F.greatest(part - size, F.lit(0)) + 1).cast("int")
        for k in range(WINDOWS)
    ]
    cut = F.concat_ws("\n", *(F.substring(text, at + 1, F.lit(size)) for at in places))
    return F.when(F.char_length(text) <= WINDOWS * size, text).otherwise(cut)


def labelled_samples(labelled: DataFrame, rows: int, chars: int) -> dict[str, str]:
    """A bounded sample of labelled text for each language.

    At most ``rows`` different documents of each language, chosen by a hash of
    id and text, give ``chars // rows`` characters each, from all over the text.
    """
    keyed = labelled.withColumn("key", F.xxhash64("doc_id", "text"))
    # Different ones are counted, so that copies make no sample smaller.
    counts = {r["lang"]: r["n"] for r in keyed.groupBy("lang").agg(F.approx_count_distinct("key").alias("n")).collect()}
    if not counts:
        return {}
    rates = keyed.sparkSession.createDataFrame([(k, min(1.0, 2 * rows / n)) for k, n in counts.items()], "lang string, rate double")
    # Twice the rows that are wanted, so that there are hardly ever too few.
    spread = F.pmod(F.xxhash64("key"), F.lit(1 << 30)) / float(1 << 30)
    some = keyed.join(F.broadcast(rates), "lang").where(spread <= F.col("rate"))
    size = max(1, chars // (WINDOWS * rows))
    some = some.select("lang", "key", windows(F.col("text"), F.col("key"), size).alias("part")).dropDuplicates(["lang", "key"])
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("key"), "key"))
    chosen = some.withColumn("rank", rank).where(F.col("rank") <= rows).collect()
    texts: dict[str, list[str]] = {}
    for r in sorted(chosen, key=lambda r: (r["lang"], r["rank"])):
        texts.setdefault(r["lang"], []).append(r["part"])
    return {lang: "\n".join(parts) for lang, parts in texts.items()}


def with_language(
    docs: DataFrame, labelled: DataFrame, sample_rows: int = 128, sample_chars: int = 1 << 15, least_phrase: float = 0.0
) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, which take the place of columns so named.

    ``labelled`` holds ``doc_id, text, lang``; rows without text or language
    are passed over. From it comes a sample of at most ``sample_rows`` documents
    and ``sample_chars`` characters a language, taken in windows from all over
    the documents' texts. Each language gets the
    suffix automaton of its sample; a text is cut greedily into the longest
    phrases that occur in it, block by block of `BLOCK` symbols, and the
    language needing the fewest phrases, each weighed by the bits of a place in
    the sample, wins; ties go to the first name. ``score`` is the second's cost
    over the sum of both: 0.5 for a tie, 1 without a second.

    A text whose phrases in the winning language hold fewer than
    ``least_phrase`` letters and spaces on average is in none of the languages
    and is ``und`` with score 0; the default rejects nothing.

    A null or empty text, or one without a letter, is ``und`` with score 0, as
    is every text if nothing is labelled. Rows with equal ids each get a row;
    an empty table gives none.
    """
    known = labelled.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text"), F.col("lang")
    ).where("text is not null and lang is not null")
    samples = tuple(sorted(labelled_samples(known, sample_rows, sample_chars).items()))
    sent = docs.sparkSession.sparkContext.broadcast(samples)
    own, schema = appended(docs, {"lang_pred": "string", "score": "double"})

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = languages(sent.value) if sent.value else None
        for part in slices_of(batches, limit=1 << 21):
            texts = [t or "" for t in part.column("text").to_pylist()]
            found = model.predict(texts, least_phrase) if model else [(UNKNOWN, 0.0)] * len(texts)
            yield pa.RecordBatch.from_arrays(
                [*part.columns, pa.array([lang for lang, _ in found], pa.string()), pa.array([score for _, score in found], pa.float64())],
                names=[*part.schema.names, "lang_pred", "score"],
            )

    return own.mapInArrow(predict, schema)


def identify_language(docs: DataFrame, labelled: DataFrame, **options: float) -> DataFrame:
    """Only ``doc_id, lang_pred, score`` of `with_language`."""
    return with_language(texts_of(docs), labelled, **options).select("doc_id", "lang_pred", "score")
