"""Packing token sequences by a linear program over configurations."""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusvec.llm import tokens
from corpusvec.llm.common import slices_of, texts_of
from corpusvec.session import materialize

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
#: Bytes of text that a worker encodes at once; what it needs meanwhile is a multiple of this.
ENCODED_BYTES = 1 << 21
#: Rows a window task should hold of one length.
BUCKET_ROWS = 1 << 14
#: Groups of lengths in a program, and how often it is solved on what the last rounding left.
GROUPS, PHASES = 64, 4
#: How near the fractional cover comes to the least one, the rate at which
#: weights fall, and the most rounds, which ends a program that converges badly.
GAP, STEP, ROUNDS = 0.02, 0.2, 20_000


def encoded_pieces(docs: DataFrame, tokenizer_path: str, size: int) -> DataFrame:
    """Every document's ids, then id 0, cut into pieces of ``size`` ids."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = tokens.memo(tokenizer_path)
        for rows in slices_of(batches, limit=ENCODED_BYTES):
            out = []
            every, before = memo.ids(rows.column("text"))
            for doc_id, (first, last) in zip(rows.column("doc_id").to_pylist(), pairwise(before.tolist()), strict=True):
                ids = every[first:last].tobytes() + b"\0\0\0\0"
                for piece, at in enumerate(range(0, len(ids), 4 * size)):
                    part = ids[at : at + 4 * size]
                    out.append((doc_id, piece, at // 4, len(part) // 4, zlib.crc32(part)))
            columns = list(zip(*out, strict=True))
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                names=["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return texts_of(docs).mapInArrow(encode, PIECES)


def best_configuration(worth: np.ndarray, lengths: np.ndarray, size: int) -> dict[int, int]:
    """Knapsack: the multiset of lengths within ``size`` of the greatest worth.

    ``best[room]`` grows by one length after the other. Rooms that differ by
    multiples of a length are a column; taking the length ``k`` times goes ``k``
    rows up in it, so the best number of times is a running maximum.
    """
    best, last = np.zeros(size + 1), np.full(size + 1, -1)
    for at, (length, value) in enumerate(zip(lengths.tolist(), worth.tolist(), strict=True)):
        rows = -(-(size + 1) // length)
        column = np.full(rows * length, -np.inf)
        column[: size + 1] = best
        taken = value * np.arange(rows)[:, None]
        with_it = (np.maximum.accumulate(column.reshape(rows, length) - taken) + taken).ravel()[: size + 1]
        better = with_it > best + 1e-12
        last[better] = at
        best = np.where(better, with_it, best)
    found: dict[int, int] = {}
    room = size
    while last[room] >= 0:
        length = int(lengths[last[room]])
        found[length] = found.get(length, 0) + 1
        room -= length
    return found


@dataclass
class Cover:
    """Configurations (a row each, a column a length), how often each is used, and the least any cover needs."""

    configurations: np.ndarray
    amounts: np.ndarray
    bound: float


def fractional(need: dict[int, int], size: int, gap: float = GAP) -> Cover:
    """A fractional cover of ``need`` by configurations, by multiplicative weights.

    A length starts with its share of a sequence as weight and loses weight by
    the part of its need that a round covers. A round uses the configuration of
    the greatest weight found so far, as often as the rarest of its lengths
    needs; once that is worth less than ``1 / (1 + STEP)`` of the greatest worth
    known, knapsack pricing finds the best one of all. Weights over the
    greatest worth are a dual solution, so each pricing gives a lower bound;
    rounds end when the cover is within ``gap`` of the greatest.
    """
    lengths = np.array(sorted(need))
    wanted = np.array([need[n] for n in lengths.tolist()], dtype=float)
    place = {int(n): i for i, n in enumerate(lengths)}
    logs, covered = np.log(lengths / size), np.zeros(len(lengths))
    known, amounts = np.zeros((0, len(lengths))), np.zeros(0)
    seen: dict[tuple, int] = {}
    bound, greatest = 0.0, math.inf
    for _ in range(ROUNDS):
        worth = np.exp(logs)
        values = known @ worth
        at = int(values.argmax()) if len(values) else -1
        if at < 0 or values[at] * (1 + STEP) < greatest:
            row = np.zeros(len(lengths))
            for length, times in best_configuration(worth, lengths, size).items():
                row[place[length]] = times
            greatest = float(row @ worth)
            bound = max(bound, float(worth @ wanted) / greatest)
            if covered.min() > 0 and amounts.sum() / covered.min() <= (1 + gap) * bound:
                break
            if tuple(row) not in seen:
                seen[tuple(row)] = len(known)
                known, amounts = np.vstack([known, row]), np.append(amounts, 0.0)
            at = seen[tuple(row)]
        used = known[at] > 0
        amount = float((wanted[used] / known[at][used]).min())
        amounts[at] += amount
        gain = amount * known[at] / wanted
        covered += gain
        logs -= STEP * gain
        # Only ratios of weights count; this keeps them far from 0.
        most = logs.max()
        logs -= most
        greatest *= math.exp(-most)
    return Cover(known, amounts / covered.min() if covered.min() > 0 else amounts, bound)


@dataclass
class Bins:
    """So many sequences alike: their lengths in order, the room left, and how many lengths the program placed."""

    lengths: list[int]
    count: int
    room: int
    planned: int = 0


def grouped(need: dict[int, int]) -> list[tuple[int, int]]:
    """Ranges of neighbouring lengths with about equal shares of the ids, at most `GROUPS`."""
    lengths = sorted(need)
    upto = np.cumsum([n * need[n] for n in lengths])
    group = np.minimum((upto - 1) * GROUPS // upto[-1], GROUPS - 1)
    first = np.nonzero(np.diff(group, prepend=-1))[0]
    last = np.append(first[1:], len(lengths)) - 1
    return [(lengths[a], lengths[b]) for a, b in zip(first.tolist(), last.tolist(), strict=True)]


def planned_bins(need: dict[int, int], size: int) -> list[Bins]:
    """Sequences after the configurations of one fractional cover of groups of lengths.

    A group stands in the program with its greatest length. Amounts are rounded
    by their running sum. A configuration takes the longest pieces left of its
    groups, but for its last and shortest place the longest that still fits,
    at least the least of that group; where a group is used up it ends.
    """
    have = np.zeros(size + 1, dtype=np.int64)
    have[list(need)] = list(need.values())
    groups = grouped(need)
    cover = fractional({high: int(have[low : high + 1].sum()) for low, high in groups}, size)
    packed, carry = [], 0.0
    for at in np.argsort(-cover.amounts, kind="stable"):
        places = [groups[g] for g in np.nonzero(cover.configurations[at])[0][::-1] for _ in range(int(cover.configurations[at][g]))]
        carry += float(cover.amounts[at])
        times = int(carry + 1e-9)
        carry -= times
        while times:
            items: list[int] = []
            for k, (low, high) in enumerate(places):
                room = size - sum(items)
                left = have[low : (room if k + 1 == len(places) else high) + 1].copy()
                for n in items:
                    if 0 <= n - low < len(left):
                        left[n - low] -= 1
                fits = np.nonzero(left > 0)[0]
                if not len(fits):
                    break
                items.append(low + int(fits[-1]))
            if len(items) < len(places):
                break
            each = Counter(items)
            count = min(times, *(int(have[n]) // k for n, k in each.items()))
            for n, k in each.items():
                have[n] -= count * k
            packed.append(Bins(items, count, size - sum(items), len(items)))
            times -= count
    return packed


def by_program(histogram: dict[int, int], size: int, waste: int) -> tuple[list[Bins], dict[int, int]]:
    """Sequences that the program fills up to ``waste``, solved anew on what each rounding left, and the rest."""
    need, packed = {n: k for n, k in histogram.items() if k and n < size}, []
    for _ in range(PHASES):
        tight = [bins for bins in planned_bins(need, size) if bins.room <= waste] if need else []
        if not tight:
            break
        packed += tight
        for bins in tight:
            for n in bins.lengths:
                need[n] -= bins.count
        need = {n: k for n, k in need.items() if k}
    return packed, need


def best_fit(packed: list[Bins], need: dict[int, int], size: int) -> list[Bins]:
    """What the program left, longest first, each into the fullest sequences with room."""
    open_by_room: dict[int, list[Bins]] = {}
    for bins in packed:
        open_by_room.setdefault(bins.room, []).append(bins)
    for length in sorted(need, reverse=True):
        left = need[length]
        while left:
            room = min((r for r, group in open_by_room.items() if r >= length and group), default=None)
            if room is None:
                each = min(size // length, left)
                bins = Bins([length] * each, left // each, size - each * length)
                left -= each * bins.count
            else:
                bins = open_by_room[room].pop()
                used = min(bins.count, left)
                if used < bins.count:
                    open_by_room[room].append(Bins(list(bins.lengths), bins.count - used, room, bins.planned))
                bins = Bins([*bins.lengths, length], used, room - length, bins.planned)
                left -= used
            open_by_room.setdefault(bins.room, []).append(bins)
    return [bins for group in open_by_room.values() for bins in group]


def pack(histogram: dict[int, int], size: int) -> list[Bins]:
    """Sequences for a histogram of lengths; all its work is on lengths, not documents.

    Of the plans for several wastes the one of fewest sequences, then of most
    pieces placed by the program.
    """
    plans = [best_fit(*by_program(histogram, size, waste), size) for waste in sorted({0, size // 512, size // 16})]
    least = min(plans, key=lambda plan: (sum(b.count for b in plan), -sum(b.count * b.planned for b in plan)))
    return least + ([Bins([size], histogram[size], 0)] if histogram.get(size) else [])


def plan_of(packed: list[Bins]) -> tuple[np.ndarray, ...]:
    """For each length, which sequence and place its pieces take, by rank.

    Sorted arrays: ``length << 40 | first rank``, first sequence, offset, and
    whether the program placed it.
    """
    rank: dict[int, int] = {}
    rows, sequence = [], 0
    for bins in packed:
        offset = 0
        for k, length in enumerate(bins.lengths):
            first = rank.get(length, 0)
            rows.append((length << 40 | first, sequence, offset, k < bins.planned))
            rank[length] = first + bins.count
            offset += length
        sequence += bins.count
    rows.sort()
    columns = zip(*rows, strict=True) if rows else ((), (), (), ())
    return tuple(np.array(c, dtype=np.int64) for c in columns)


def with_rank(pieces: DataFrame, rows: int) -> DataFrame:
    """Number the pieces of each length from 0.

    Pieces of one length are dealt over buckets, numbered inside a bucket, and
    start where the buckets before end: no task holds all of a common length.
    """
    buckets = math.ceil(rows / BUCKET_ROWS)
    dealt = pieces.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(buckets)))
    by_length = Window.partitionBy("length").orderBy("bucket")
    first = dealt.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    first = first.select(
        "length", "bucket", (F.sum("n").over(by_length) - F.col("n")).alias("first")
    )
    inside = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece")
    numbered = dealt.withColumn("within", F.row_number().over(inside) - 1)
    return (
        numbered.join(first, ["length", "bucket"])
        .withColumn("rank", F.col("first") + F.col("within"))
        .drop("first", "within", "bucket")
    )


def pack_documents(docs: DataFrame, tokenizer_path: str, size: int = 2048) -> DataFrame:
    """Pack every document's ids into sequences of at most ``size`` ids.

    Returns ``doc_id, piece, start, length, ids_crc32, sequence_id, offset,
    by_program``, a row per piece; the last tells pieces that the configuration
    program placed from those that best fit did and from whole sequences. Only documents longer than a sequence are cut. The
    configuration program works on the histogram of lengths, which has at most
    ``size`` rows; the plan it gives is sent to the tasks. A null or empty text
    is the single id 0; rows with equal ids are packed each; an empty table
    gives no rows.
    """
    pieces = materialize(encoded_pieces(docs, tokenizer_path, size))
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    plan = docs.sparkSession.sparkContext.broadcast(plan_of(pack(histogram, size)))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, sequences, offsets, planned = plan.value
        for batch in batches:
            rank = batch.column("rank").to_numpy(zero_copy_only=False)
            length = batch.column("length").to_numpy(zero_copy_only=False)
            wanted = length << 40 | rank
            at = np.searchsorted(keys, wanted, side="right") - 1
            columns = {name: batch.column(name) for name in ("doc_id", "piece", "start", "length", "ids_crc32")}
            columns["sequence_id"] = pa.array(sequences[at] + (wanted - keys[at]), pa.int64())
            columns["offset"] = pa.array(offsets[at], pa.int64())
            columns["by_program"] = pa.array(planned[at] > 0)
            yield pa.RecordBatch.from_pydict(columns)

    ranked = with_rank(pieces, max(1, sum(histogram.values())))
    return ranked.mapInArrow(place, f"{PIECES}, sequence_id long, offset long, by_program boolean")
