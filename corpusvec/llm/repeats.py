"""Repeated byte strings by suffix order over content-chosen segments."""

from __future__ import annotations

import functools
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusvec.llm.common import NO_ID, rows_of, stored, texts_of
from corpusvec.llm.membership import split_by
from corpusvec.llm.shingles import mixed

#: Bytes of a string that is hashed to choose anchors.
GRAM = 64
#: Bytes of a text that are handled at once; longer ones in overlapping parts.
CHUNK = 1 << 18
#: Bytes of segments that are sorted at once (a sort takes about 30 times as
#: many), and segments and bytes of one anchor that are; anchors with more of
#: either are compared string by string (`by_strings`).
SORTED_BYTES, SORTED_SEGMENTS, ANCHOR_BYTES = 1 << 20, 1 << 13, 1 << 22
#: Keys hold the place of a gram in its part in their low bits.
PLACE = np.uint64((1 << 22) - 1)


@functools.lru_cache(maxsize=1)
def powers(size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Random values of bytes, and ``size`` powers of an odd base and of its inverse mod 2**64."""
    values = np.random.default_rng(8).integers(1, 1 << 63, size=256, dtype=np.uint64)
    base = 0x9E3779B97F4A7C15
    up = np.multiply.accumulate(np.full(size, base, dtype=np.uint64))
    down = np.multiply.accumulate(np.full(size, pow(base, -1, 1 << 64), dtype=np.uint64))
    return values, up, down


def gram_hashes(data: np.ndarray) -> np.ndarray:
    # As many for all parts, unless strings are longer than parts.
    values, up, down = powers(max(2 * CHUNK, 1 << len(data).bit_length()))
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(values[data] * up[: len(data)], out=sums[1:])
    return mixed((sums[GRAM:] - sums[:-GRAM]) * down[: len(data) - GRAM + 1])


def sliding_min(keys: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbours, from prefix and suffix minima of blocks."""
    n = len(keys)
    blocks = np.full(-(-n // width) * width, np.iinfo(keys.dtype).max, dtype=keys.dtype)
    blocks[:n] = keys
    blocks = blocks.reshape(-1, width)
    before = np.minimum.accumulate(blocks, axis=1).ravel()
    after = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(after[: n - width + 1], before[width - 1 : n])


def anchors(data: bytes, span: int) -> Iterator[tuple[int, int, int]]:
    """``hash, first, last``: an anchor's gram and the strings it stands for.

    The anchor of a string of ``span`` bytes is its gram of least hash, the
    first of equals; equal strings have equal anchors in equal places. An
    anchor stands for the run of strings starting at ``first`` to ``last``.
    """
    every = np.frombuffer(data, dtype=np.uint8)
    for start in range(0, len(data) - span + 1, CHUNK):
        part = every[start : start + CHUNK + span - 1]
        hashes = gram_hashes(part)
        keys = (hashes & ~PLACE) | np.arange(len(hashes), dtype=np.uint64)
        place = (sliding_min(keys, span - GRAM + 1) & PLACE).astype(np.int64)
        turns = np.nonzero(place[1:] != place[:-1])[0]
        first = np.concatenate(([0], turns + 1))
        last = np.concatenate((turns, [len(place) - 1]))
        yield from zip(hashes[place[first]].astype(np.int64).tolist(), (first + start).tolist(), (last + start).tolist(), strict=True)


def encoded(text: str) -> bytes:
    return text.encode("utf-8", "surrogatepass")


def segments(texts: DataFrame, span: int) -> DataFrame:
    """Every anchor of every text with a digest of all its strings together."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in rows_of(batches, limit=1 << 22):
            out: tuple[list, ...] = ([], [], [], [], [], [])
            for doc_id, text_hash, text in rows:
                data = encoded(text)
                if len(data) < span:
                    continue
                view = memoryview(data)
                for anchor, first, last in anchors(data, span):
                    digest = xxhash.xxh3_128_digest(view[first : last + span])
                    for column, value in zip(out, (doc_id, text_hash, anchor, digest, first, last), strict=True):
                        column.append(value)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(out, kinds, strict=True)],
                names=["doc_id", "text_hash", "anchor", "segment", "first", "last"],
            )

    return texts.select("doc_id", "text_hash", "text").mapInArrow(
        find, "doc_id long, text_hash long, anchor long, segment binary, first long, last long"
    )


def ranked(keys: np.ndarray) -> np.ndarray:
    """The rank of each key among the distinct ones."""
    order = np.argsort(keys)
    inside = keys[order]
    del keys
    steps = np.zeros(len(order), dtype=np.uint32)
    np.not_equal(inside[1:], inside[:-1], out=steps[1:])
    del inside
    np.cumsum(steps, dtype=np.uint32, out=steps)
    rank = np.empty_like(steps)
    rank[order] = steps
    return rank


def paired(high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """Keys that order by one rank, then by another."""
    keys = high.astype(np.uint64)
    keys <<= np.uint64(32)
    keys |= low
    return keys


def earlier_and_later(parts: list[bytes], span: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where each string of ``span`` bytes of some segments occurs again.

    Returns the offsets of the segments' strings, and for each string whether
    an equal one comes before and after it, in the order of ``parts``. The
    suffixes are ranked by their first 8, 16, 32 … bytes, each round from the
    ranks of the one before, up to ``span`` bytes; in suffix order, ties by
    place, the nearest earlier place is the neighbour before, and the longest
    previous factor reaches ``span`` where it is equal.
    """
    sizes = np.array([len(p) - span + 1 for p in parts])
    begins = np.cumsum([0, *(len(p) for p in parts[:-1])])
    data = np.frombuffer(b"".join([*parts, bytes(span)]), dtype=np.uint8)
    n = len(data) - 7
    keys = np.zeros(n, dtype=np.uint64)
    for k in range(8):
        keys <<= np.uint64(8)
        keys |= data[k : k + n]
    rank, length = ranked(keys), 8
    del data, keys
    while 2 * length <= span:
        rank = ranked(paired(rank[:-length], rank[length:]))
        length *= 2
    offsets = np.concatenate(([0], np.cumsum(sizes)))
    places = np.arange(offsets[-1]) - np.repeat(offsets[:-1], sizes) + np.repeat(begins, sizes)
    keys = paired(rank[places], rank[places + (span - length)])
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    before, after = np.zeros(len(keys), dtype=bool), np.zeros(len(keys), dtype=bool)
    before[order[1:]], after[order[:-1]] = same, same
    return offsets, before, after


def runs_of(flags: np.ndarray) -> list[tuple[int, int]]:
    """First and last places of runs of true."""
    edge = np.diff(np.concatenate(([0], flags.astype(np.int8), [0])))
    return list(zip(np.nonzero(edge == 1)[0].tolist(), (np.nonzero(edge == -1)[0] - 1).tolist(), strict=True))


SPANS = "doc_id long, text_hash long, start long, end long"


def spans_batch(rows: list[tuple[int, int, int, int]]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * 4
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["doc_id", "text_hash", "start", "end"])


def whole_anchors(rows: Iterator[tuple], limit: int) -> Iterator[list[tuple]]:
    """Rows in order of their first column, all of a value together.

    A list holds up to ``limit`` bytes of the last column, or one value alone.
    """
    held: list[tuple] = []
    size = begin = before = 0
    for row in rows:
        if not held or row[0] != held[-1][0]:
            begin, before = len(held), size
        if begin and size + len(row[-1]) > limit:
            yield held[:begin]
            held, size, begin = held[begin:], size - before, 0
        held.append(row)
        size += len(row[-1])
    if held:
        yield held


def by_suffixes(found: DataFrame, span: int, keep_first: bool) -> DataFrame:
    """Spans to remove of segments that share an anchor but differ.

    Rows of an anchor come together; whole anchors are sorted up to
    `SORTED_BYTES` at a time, larger ones by themselves.
    """

    def compare(rows: list[tuple]) -> list[tuple[int, int, int, int]]:
        # Rows of equal id and text are one text here.
        rows = sorted(set(rows), key=lambda r: (r[1], r[2], r[3]))
        offsets, before, after = earlier_and_later([r[4] for r in rows], span)
        again = before if keep_first else before | after
        return [
            (doc_id, text_hash, first + a, first + b + span)
            for k, (_, doc_id, text_hash, first, _) in enumerate(rows)
            for a, b in runs_of(again[offsets[k] : offsets[k + 1]])
        ]

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = chain.from_iterable(rows_of(batches, "bytes", SORTED_BYTES))
        for together in whole_anchors(rows, SORTED_BYTES):
            yield spans_batch(compare(together))

    rows = found.select("anchor", "doc_id", "text_hash", "first", "bytes")
    return rows.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(sort, SPANS)


def by_strings(found: DataFrame, span: int, keep_first: bool) -> DataFrame:
    """The same for anchors with very many segments: each string is a key of its own."""

    def strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in rows_of(batches, "bytes", 1 << 16):
            out = [
                (doc_id, text_hash, first + at, xxhash.xxh3_128_digest(memoryview(data)[at : at + span]))
                for doc_id, text_hash, first, data in rows
                for at in range(len(data) - span + 1)
            ]
            columns = list(zip(*out, strict=True)) or [()] * 4
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["doc_id", "text_hash", "start", "string"]
            )

    rows = found.select("doc_id", "text_hash", "first", "bytes").mapInArrow(
        strings, "doc_id long, text_hash long, start long, string binary"
    )
    rows = stored(rows, "strings")
    place = F.struct("doc_id", "text_hash", "start")
    again = rows.groupBy("string").agg(F.count_distinct(place).alias("n"), F.min(place).alias("earliest")).where("n > 1")
    out = rows.join(stored(again, "repeated-strings"), "string")
    if keep_first:
        out = out.where(place != F.col("earliest"))
    return out.select("doc_id", "text_hash", "start", (F.col("start") + span).alias("end"))


def repeated_spans(texts: DataFrame, span: int, keep_first: bool) -> DataFrame:
    """``doc_id, text_hash, start, end`` of repeated strings, overlaps and all."""
    every = stored(segments(texts, span), "segments")
    shared = every.groupBy("anchor").agg(
        F.count("*").alias("n"), F.min("segment").alias("least"), F.max("segment").alias("most")
    )
    shared = stored(shared.where("n > 1").select("anchor", (F.col("least") != F.col("most")).alias("differ")), "anchors")
    members = stored(every.join(shared, "anchor"), "members")
    place = F.struct("doc_id", "text_hash", "first", "last")
    classes = stored(
        members.groupBy("anchor", "differ", "segment").agg(F.count("*").alias("copies"), F.min(place).alias("earliest")), "classes"
    )
    # Equal segments: all their strings are repeated.
    copied = members.join(classes.where("copies > 1").select("anchor", "segment", "earliest"), ["anchor", "segment"])
    if keep_first:
        copied = copied.where(place != F.col("earliest"))
    spans = copied.select("doc_id", "text_hash", F.col("first").alias("start"), (F.col("last") + span).alias("end"))

    # Differing segments of one anchor: one of each class, with its bytes.
    size = F.sum(F.col("earliest.last") - F.col("earliest.first") + span)
    crowded = classes.where("differ").groupBy("anchor").agg(
        ((F.count("*") > SORTED_SEGMENTS) | (size > ANCHOR_BYTES)).alias("crowded")
    )
    ask = classes.where("differ").join(crowded, "anchor").select("anchor", "crowded", "earliest.*")
    ask = ask.groupBy("doc_id", "text_hash").agg(F.collect_list(F.struct("anchor", "crowded", "first", "last")).alias("asked"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in rows_of(batches, limit=1 << 20):
            out: tuple[list, ...] = ([], [], [], [], [], [])
            seen = set()
            for doc_id, text_hash, text, asked in rows:
                if (doc_id, text_hash) in seen:
                    continue
                seen.add((doc_id, text_hash))
                data = encoded(text)
                for a in asked:
                    row = (a["anchor"], a["crowded"], doc_id, text_hash, a["first"], data[a["first"] : a["last"] + span])
                    for column, value in zip(out, row, strict=True):
                        column.append(value)
            kinds = (pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(out, kinds, strict=True)],
                names=["anchor", "crowded", "doc_id", "text_hash", "first", "bytes"],
            )

    ask = stored(ask, "asked")
    few, _ = split_by(texts, ask.select("doc_id"))
    found = few.join(ask, ["doc_id", "text_hash"]).select("doc_id", "text_hash", "text", "asked")
    found = stored(
        found.mapInArrow(cut, "anchor long, crowded boolean, doc_id long, text_hash long, first long, bytes binary"), "segment-bytes"
    )
    return spans.unionByName(by_suffixes(found.where("not crowded"), span, keep_first)).unionByName(
        by_strings(found.where("crowded"), span, keep_first)
    )


def remove_repeats(docs: DataFrame, span: int = 400, keep_first: bool = True) -> DataFrame:
    """``doc_id, n_bytes, spans, kept`` of every row of ``docs``.

    ``spans`` are the maximal runs of bytes, as ``start, end``, covered by
    strings of ``span`` bytes that occur elsewhere, in the same text or
    another; ``kept`` holds the other bytes of the text as UTF-8. With
    ``keep_first`` the first occurrence, by id and place, is left alone;
    without, all go. Strings are judged on the input, and never reach over the
    end of a text.

    Texts are cut into segments at anchors that equal strings share, so only
    segments of one anchor are compared: equal ones by digest, others by
    suffix order and longest previous factors. Null and empty texts, and those
    shorter than ``span``, lose nothing. Of rows with equal id and text all but
    the first are copies; with ``keep_first`` such rows all lose the same
    bytes. An empty table gives none.
    """
    texts = texts_of(docs).withColumn("text_hash", F.xxhash64("text")).withColumn("doc_id", F.coalesce("doc_id", F.lit(NO_ID)))
    spans = repeated_spans(texts, span, keep_first)
    of_doc = spans.groupBy("doc_id", "text_hash").agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    of_doc = stored(of_doc, "spans")

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in rows_of(batches):
            ids, sizes, cuts, kept = [], [], [], []
            for doc_id, text, spans in rows:
                data = encoded(text)
                merged: list[list[int]] = []
                for start, end in sorted((s["start"], s["end"]) for s in spans or ()):
                    if merged and start <= merged[-1][1]:
                        merged[-1][1] = max(end, merged[-1][1])
                    else:
                        merged.append([start, end])
                edges = [0, *(x for pair in merged for x in pair), len(data)]
                ids.append(doc_id)
                sizes.append(len(data))
                cuts.append([{"start": a, "end": b} for a, b in merged])
                kept.append(b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)))
            shape = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.array(cuts, shape), pa.array(kept, pa.binary())],
                names=["doc_id", "n_bytes", "spans", "kept"],
            )

    few, whole = split_by(texts, of_doc.select("doc_id"))
    joined = few.join(of_doc, ["doc_id", "text_hash"], "left").select("doc_id", "text", "spans")
    joined = joined.unionByName(whole.select("doc_id", "text", F.lit(None).cast(of_doc.schema["spans"].dataType).alias("spans")))
    removed = joined.mapInArrow(remove, "doc_id long, n_bytes long, spans array<struct<start:long,end:long>>, kept binary")
    return removed.withColumn("doc_id", F.nullif("doc_id", F.lit(NO_ID)))
