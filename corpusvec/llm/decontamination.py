"""Documents that hold benchmark items, by a BM25 index with block maxima."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusvec.llm.common import appended, slices_of, texts_of

#: Items, and bytes of their text, that one index holds; more items make more indexes.
INDEX_ITEMS, INDEX_BYTES = 1 << 16, 1 << 25
#: Items of one block of a posting list.
BLOCK = 4
K1, B = 1.2, 0.75
#: Share of an item's own score that common terms may add up to.
COMMON = 0.1


def words_of(text: str) -> list[bytes]:
    """Words in lower case, also beyond ASCII: a leak may be in capitals."""
    return text.lower().encode("utf-8", "surrogatepass").split()


def runs(words: list[bytes], width: int) -> list[tuple[bytes, ...]]:
    return [tuple(words[i : i + width]) for i in range(len(words) - width + 1)]


class Item:
    """An item's runs of five words (all words if fewer), question first."""

    def __init__(self, item_id: int, question: str, answer: str | None) -> None:
        self.item_id = item_id
        asked, told = words_of(question), words_of(answer or "")
        self.words = asked + told
        self.width = min(5, len(self.words))
        if not self.words:
            self.question, self.answer = set(), set()
        elif asked and told:
            self.question = set(runs(asked, min(self.width, len(asked))))
            self.answer = set(runs(told, min(self.width, len(told))))
        else:
            every = runs(self.words, self.width)
            half = len(every) // 2
            self.question, self.answer = set(every[:half]), set(every[half:])

    def overlap(self, words: list[bytes]) -> tuple[float, float]:
        """Of all its runs and of its worse half, the share that the words hold."""
        sets: dict[int, set] = {}

        def share(wanted: set) -> tuple[int, int]:
            found = 0
            for run in wanted:
                if len(run) not in sets:
                    sets[len(run)] = set(runs(words, len(run)))
                found += run in sets[len(run)]
            return found, len(wanted)

        asked, told = share(self.question), share(self.answer)
        halves = [f / n for f, n in (asked, told) if n]
        return (asked[0] + told[0]) / (asked[1] + told[1]), min(halves)


class Index:
    """An inverted index of items whose BM25 weights are shares of the item's own score."""

    def __init__(self, items: list[Item]) -> None:
        self.items = [i for i in items if i.words]
        n = len(self.items)
        df = Counter(w for i in self.items for w in set(i.words))
        mean = sum(len(i.words) for i in self.items) / max(1, n)
        lists: dict[bytes, list[tuple[int, float]]] = {w: [] for w in df}
        for at, item in enumerate(self.items):
            norm = K1 * (1 - B + B * len(item.words) / mean)
            weight = {
                w: math.log1p((n - df[w] + 0.5) / (df[w] + 0.5)) * tf * (K1 + 1) / (tf + norm)
                for w, tf in Counter(item.words).items()
            }
            total = sum(weight.values())
            for w, x in weight.items():
                lists[w].append((at, x / total))
        # Commonest first, a term is left out of the first bound as long as no
        # item has more than COMMON of its score in such terms.
        spent = np.zeros(n)
        common = set()
        for w in sorted(df, key=lambda w: (-df[w], w)):
            after = spent.copy()
            for at, x in lists[w]:
                after[at] += x
            if after.max() > COMMON:
                break
            spent = after
            common.add(w)
        self.term = {w: t for t, w in enumerate(sorted(df, key=lambda w: (w in common, w)))}
        self.essential = len(df) - len(common)
        self.postings: list[list[tuple[int, float]]] = [lists[w] for w in self.term]
        self.top = [max(x for _, x in p) for p in self.postings]
        self.block_top: list[dict[int, float]] = []
        for p in self.postings:
            tops: dict[int, float] = {}
            for at, x in p:
                tops[at // BLOCK] = max(x, tops.get(at // BLOCK, 0.0))
            self.block_top.append(tops)
        self.blocks = (n + BLOCK - 1) // BLOCK
        # Block maxima of essential terms, flat, with each term's first place.
        rare = self.block_top[: self.essential]
        self.starts = np.cumsum([0, *map(len, rare)])
        self.flat_block = np.array([b for t in rare for b in t], dtype=np.int64)
        self.flat_top = np.array([x for t in rare for x in t.values()])
        self.stride = max((len(i.words) for i in self.items), default=1)

    def hopeful(self, terms: np.ndarray, least: float) -> dict[int, set[int]]:
        """Blocks of items that a passage could reach ``least`` in, by passage.

        ``terms`` has a term number or -1 for each word. Passage p is the
        ``2 * stride`` words from ``p * stride``, so that every run of
        ``stride`` words lies inside one.
        """
        places = np.nonzero((terms >= 0) & (terms < self.essential))[0]
        found, passage = terms[places], places // self.stride
        both = np.concatenate([passage, passage[passage > 0] - 1])
        found = np.concatenate([found, found[passage > 0]])
        pairs = np.unique(both * self.essential + found)
        both, found = pairs // self.essential, pairs % self.essential
        sizes = self.starts[found + 1] - self.starts[found]
        at = np.repeat(self.starts[found], sizes) + np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        key = np.repeat(both, sizes) * self.blocks + self.flat_block[at]
        keys, inverse = np.unique(key, return_inverse=True)
        bound = np.bincount(inverse, weights=self.flat_top[at], minlength=len(keys))
        hopes: dict[int, set[int]] = {}
        for k in keys[bound >= least - COMMON - 1e-9]:
            hopes.setdefault(int(k // self.blocks), set()).add(int(k % self.blocks))
        return hopes

    def search(self, terms: set[int], blocks: set[int], least: float) -> list[int]:
        """All items in ``blocks`` that score ``least`` or more, by block-max WAND.

        Cursors stand on the first item of each list; the pivot is the first
        item that the maxima of the lists up to it can lift to ``least``, and is
        scored only if the maxima of its block can, too.
        """
        lists = [
            (t, p) for t in terms if (p := [(at, x) for at, x in self.postings[t] if at // BLOCK in blocks])
        ]
        cursors = [[p[0][0], 0, t, p] for t, p in lists]
        least -= 1e-9
        found = []

        def forward(cursor: list, item: int) -> None:
            at, p = cursor[1], cursor[3]
            while at < len(p) and p[at][0] < item:
                at += 1
            cursor[1] = at
            cursor[0] = p[at][0] if at < len(p) else -1

        while cursors:
            cursors.sort(key=lambda c: c[0])
            reach, last = 0.0, -1
            for k, cursor in enumerate(cursors):
                reach += self.top[cursor[2]]
                if reach >= least:
                    last = k
                    break
            if last < 0:
                break
            pivot = cursors[last][0]
            while last + 1 < len(cursors) and cursors[last + 1][0] == pivot:
                last += 1
            block = pivot // BLOCK
            bound = sum(self.block_top[c[2]].get(block, 0.0) for c in cursors[: last + 1])
            if bound < least:
                after = (block + 1) * BLOCK
                if last + 1 < len(cursors):
                    after = min(after, cursors[last + 1][0])
                for cursor in cursors[: last + 1]:
                    forward(cursor, after)
            elif cursors[0][0] == pivot:
                score = sum(c[3][c[1]][1] for c in cursors[: last + 1])
                if score >= least:
                    found.append(pivot)
                for cursor in cursors[: last + 1]:
                    forward(cursor, pivot + 1)
            else:
                for cursor in cursors[: last + 1]:
                    if cursor[0] < pivot:
                        forward(cursor, pivot)
            cursors = [c for c in cursors if c[0] >= 0]
        return found

    def matches(self, documents: list[list[bytes]], least: float, overlap: float) -> list[dict[int, float]]:
        """Confirmed items of each document with their overlap."""
        get, out = self.term.get, []
        for words in documents:
            confirmed: dict[int, float] = {}
            out.append(confirmed)
            if not self.items or not words:
                continue
            terms = np.fromiter((get(w, -1) for w in words), dtype=np.int64, count=len(words))
            for passage, blocks in self.hopeful(terms, least).items():
                start, end = passage * self.stride, (passage + 2) * self.stride
                own = set(terms[start:end].tolist()) - {-1}
                for at in self.search(own, blocks, least):
                    item = self.items[at]
                    every, worse = item.overlap(words[start:end])
                    if every >= overlap and worse >= 0.5:
                        confirmed[item.item_id] = max(every, confirmed.get(item.item_id, 0.0))
        return out


def with_contamination(
    docs: DataFrame, benchmark: DataFrame, least: float = 0.6, overlap: float = 0.8
) -> DataFrame:
    """``docs`` with ``item_ids`` and ``best_overlap``, which take the place of columns so named.

    Every passage of every document asks the index of benchmark items for all
    items of which it holds ``least`` of the item's own BM25 score or more; an
    item is confirmed if the passage holds ``overlap`` of its runs of five
    words, and half of those of its question and of its answer. Items have
    columns ``question`` and ``answer``, or only ``text``, of which the first
    half of the runs is the question. ``item_ids`` is sorted and empty for a
    clean document, whose ``best_overlap`` is 0.

    An index is sent to all tasks and holds at most about `INDEX_ITEMS` items
    and `INDEX_BYTES` of text; a larger benchmark makes several, each of which
    sees all documents in turn. Items without words match nothing. Null and
    empty texts have no matches; rows with equal ids each get a row; an empty
    table gives none.
    """
    spark = docs.sparkSession
    if {"question", "answer"} <= set(benchmark.columns):
        asked, told = F.coalesce("question", F.lit("")), F.coalesce("answer", F.lit(""))
    else:
        asked, told = F.coalesce("text", F.lit("")), F.lit("")
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), asked.alias("question"), told.alias("answer")).where("item_id is not null")
    size = items.agg(F.count("*").alias("n"), F.sum(F.octet_length("question") + F.octet_length("answer")).alias("bytes")).first()
    indexes = max(1, math.ceil(size["n"] / INDEX_ITEMS), math.ceil((size["bytes"] or 0) / INDEX_BYTES))
    own, schema = appended(docs, {"item_ids": "array<long>", "best_overlap": "double"})
    found = own.withColumn("item_ids", F.array().cast("array<long>")).withColumn("best_overlap", F.lit(0.0))
    for k in range(indexes):
        part = items.where(F.pmod(F.xxhash64("item_id"), F.lit(indexes)) == k).orderBy("item_id", "question", "answer")
        sent = spark.sparkContext.broadcast([tuple(r) for r in part.collect()])
        found = found.mapInArrow(matcher(sent, least, overlap), schema)
    return found


def matcher(sent, least: float, overlap: float):
    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index([Item(*row) for row in sent.value])
        for part in slices_of(batches):
            found = index.matches([words_of(t or "") for t in part.column("text").to_pylist()], least, overlap)
            before = zip(part.column("item_ids").to_pylist(), part.column("best_overlap").to_pylist(), strict=True)
            ids, best = [], []
            for own, (known, most) in zip(found, before, strict=True):
                ids.append(sorted({*own, *known}))
                best.append(max([most, *own.values()]))
            columns = dict(zip(part.schema.names, part.columns, strict=True))
            columns |= {"item_ids": pa.array(ids, pa.list_(pa.int64())), "best_overlap": pa.array(best, pa.float64())}
            yield pa.RecordBatch.from_pydict(columns)

    return match


def find_contamination(docs: DataFrame, benchmark: DataFrame, **options: float) -> DataFrame:
    """Only ``doc_id, item_ids, best_overlap`` of `with_contamination`."""
    return with_contamination(texts_of(docs), benchmark, **options).drop("text")
