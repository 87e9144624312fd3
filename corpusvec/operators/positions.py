"""Global running numbers without passing the data through one task."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpusvec.functions import rows, text
from corpusvec.operators.shards import whole_division
from corpusvec.session import materialize

# One task may order this many buckets; more are grouped into parents first.
LEVEL_BITS = 16
# Rows of one bucket are ordered by one task: 32 to 16384 keys.
MIN_BUCKET_BITS, MAX_BUCKET_BITS = 5, 14
# Bucket tables of up to 2 ** (BROADCAST_BITS + 1) rows of about 32 bytes are broadcast.
BROADCAST_BITS = 20
# Bytes of text whose words one batch of rows holds, unless a single text is longer.
BATCH_BYTES = 1 << 19


def _bucket_offsets(buckets: DataFrame, names: list[str], bits: int) -> DataFrame:
    """Exclusive running totals over ``bucket`` order.

    ``bits`` bounds the spread of bucket numbers: at most ``2**bits`` rows.
    A level that one task may not order is summed into parents of at most
    ``2**LEVEL_BITS`` buckets, and the parents' totals are added on top.
    """
    if bits <= LEVEL_BITS:
        order = W.orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
        return buckets.select(
            "bucket", *[F.coalesce(F.sum(n).over(order), F.lit(0)).alias(n) for n in names]
        )
    child = buckets.withColumn("parent", F.shiftright("bucket", LEVEL_BITS))
    parents = child.groupBy(F.col("parent").alias("bucket")).agg(*[F.sum(n).alias(n) for n in names])
    above = _bucket_offsets(parents, names, bits - LEVEL_BITS).select(
        F.col("bucket").alias("parent"), *[F.col(n).alias(f"{n}_above") for n in names]
    )
    order = W.partitionBy("parent").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    inside = child.select(
        "parent", "bucket", *[F.coalesce(F.sum(n).over(order), F.lit(0)).alias(n) for n in names]
    )
    return inside.join(above, "parent").select(
        "bucket", *[(F.col(n) + F.col(f"{n}_above")).alias(n) for n in names]
    )


def with_offsets(
    df: DataFrame, key: str, counts: list[str], in_order: bool = False, keys: DataFrame | None = None
) -> DataFrame:
    """Replace each count column by its exclusive running total in key order.

    ``key`` is a unique BIGINT. Keys are cut into buckets of neighbouring
    values, which bounds a bucket whatever the spread of keys: no two rows
    share one. Bucket totals (combined before their shuffle) give each bucket
    its start; a window inside the bucket does the rest, so rows move once.
    ``in_order`` moves them by range instead of by hash: the partitions then
    follow each other in key order and rows inside are sorted. ``keys`` is a
    table of the same keys that is cheaper to read, for the least and greatest.
    """
    low, high = (df if keys is None else keys).agg(F.min(key), F.max(key)).first()
    spread = int(high - low).bit_length() if low is not None else 0
    shift = min(max(spread - BROADCAST_BITS, MIN_BUCKET_BITS), MAX_BUCKET_BITS)
    # Buckets are numbered from the lowest key's, so they need these bits.
    bits = max(spread - shift, 0) + 1
    first = (low or 0) >> shift
    keyed = df.withColumn("bucket", F.shiftright(key, shift) - F.lit(first).cast("bigint"))

    totals = keyed.groupBy("bucket").agg(*[F.sum(n).alias(n) for n in counts])
    starts = _bucket_offsets(totals, counts, bits).select(
        "bucket", *[F.col(n).alias(f"{n}_start") for n in counts]
    )
    small = bits <= BROADCAST_BITS + 1
    if small:
        starts = F.broadcast(starts)
    if in_order and small:
        keyed = keyed.repartitionByRange("bucket")
    order = W.partitionBy("bucket").orderBy(key).rowsBetween(W.unboundedPreceding, -1)
    inside = keyed.withColumns({n: F.coalesce(F.sum(n).over(order), F.lit(0)) for n in counts})
    placed = inside.join(starts, "bucket").withColumns(
        {n: F.col(n) + F.col(f"{n}_start") for n in counts}
    )
    placed = placed.drop("bucket", *[f"{n}_start" for n in counts])
    if in_order and not small:
        placed = placed.repartitionByRange(key).sortWithinPartitions(key)
    return placed


def with_totals_before(df: DataFrame, order: list[str], count: str, name: str) -> DataFrame:
    """Add ``name``: the sum of ``count`` over all rows before, in the order of columns of any type.

    Rows are dealt by ranges of the order, of at most about ``2**LEVEL_BITS``
    rows each. The ranges' sums, one number for each, give them their starts; a
    window inside a range does the rest. ``order`` has to tell rows apart. The
    table is read twice, and should be cheap to read.
    """
    ranges = -(-df.count() // (1 << LEVEL_BITS)) or 1
    # Written down, a row's range stays what it is, also where a task is run again.
    ranged = materialize(df.repartitionByRange(ranges, *order).withColumn("range", F.spark_partition_id()))
    totals = dict(ranged.groupBy("range").agg(F.sum(count)).collect())
    starts, total = [], 0
    for k in sorted(totals):
        starts.append((k, total))
        total += totals[k]
    before = df.sparkSession.createDataFrame(starts, "range int, start long")
    inside = F.sum(count).over(W.partitionBy("range").orderBy(*order).rowsBetween(W.unboundedPreceding, -1))
    return (
        ranged.withColumn(name, F.coalesce(inside, F.lit(0)))
        .join(F.broadcast(before), "range").withColumn(name, F.col(name) + F.col("start")).drop("range", "start")
    )


def with_row_index(df: DataFrame, key: str, name: str = "row_index") -> DataFrame:
    """Add the row's number from 0 in ascending order of a unique BIGINT key."""
    return with_offsets(df.withColumn(name, F.lit(1).cast("bigint")), key, [name])


def indexed_lines(docs: DataFrame) -> DataFrame:
    """Lines of documents ``(doc_id, line_no, line_index, line)``.

    ``line_index`` runs over the whole corpus in ``(doc_id, line_no)`` order.
    """
    sized = docs.withColumn("before", F.size(text.split_lines(F.col("text"))).cast("bigint"))
    return (
        with_offsets(sized, "doc_id", ["before"])
        .select("doc_id", "before", F.posexplode(text.split_lines(F.col("text"))).alias("line_no", "line"))
        .select("doc_id", "line_no", (F.col("before") + F.col("line_no")).alias("line_index"), "line")
    )


def positioned_words(docs: DataFrame, in_order: bool = False) -> DataFrame:
    """Every space-separated word with its position in the corpus: ``(pos, word)``."""
    words = text.space_words(F.col("text"))
    sized = docs.withColumn("before", F.size(words).cast("bigint"))
    return (
        with_offsets(sized, "doc_id", ["before"], in_order)
        .select("before", F.posexplode(words).alias("j", "word"))
        .select((F.col("before") + F.col("j")).alias("pos"), "word")
    )


def positioned_words_of_lines(lines: DataFrame) -> DataFrame:
    """``(line_index, pos, word)`` from numbered lines ``(line_index, line)``."""
    words = text.space_words(F.col("line"))
    sized = lines.withColumn("before", F.size(words).cast("bigint"))
    return (
        with_offsets(sized, "line_index", ["before"])
        .select("line_index", "before", F.posexplode(words).alias("j", "word"))
        .select("line_index", (F.col("before") + F.col("j")).alias("pos"), "word")
    )


def positioned_lines(docs: DataFrame) -> DataFrame:
    """Words with their line: ``(line_index, pos, word)``.

    A document's words are numbered while they still sit in one row, tagged
    with their line, so lines need no shuffle of their own.
    """
    lines = text.split_lines(F.col("text"))
    tagged = F.flatten(
        F.transform(
            lines,
            lambda line, i: F.transform(
                text.space_words(line), lambda w: F.struct(i.alias("line_no"), w.alias("word"))
            ),
        )
    )
    sized = docs.withColumns(
        {
            "before": F.size(text.space_words(F.col("text"))).cast("bigint"),
            "lines_before": F.size(lines).cast("bigint"),
        }
    )
    return (
        with_offsets(sized, "doc_id", ["before", "lines_before"])
        .select("before", "lines_before", F.posexplode(tagged).alias("j", "w"))
        .select(
            (F.col("lines_before") + F.col("w.line_no")).alias("line_index"),
            (F.col("before") + F.col("j")).alias("pos"),
            F.col("w.word").alias("word"),
        )
    )


def ordered_words(docs: DataFrame, in_order: bool = False) -> DataFrame:
    """Words reduced to letters: ``(pos, row_index, word)``.

    A word without letters is dropped and its position stays unused;
    ``row_index`` numbers the kept rows without gaps. Both numbers come from
    one pass over the documents, so no word is ever shuffled on its own.
    """
    placed = _with_word_offsets(docs, in_order).select("before", "kept_before", "text")
    return placed.mapInArrow(_lettered_rows, "pos long, row_index long, word string")


IS_SPACE, IS_LETTER = np.zeros(256, bool), np.zeros(256, bool)
IS_SPACE[list(text.SPACES.encode())] = True
IS_LETTER[[*range(65, 91), *range(97, 123)]] = True


def _some_texts(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Texts ``[at, to)`` of about `BATCH_BYTES`: ``at, to``, their bytes, and where in these each begins."""
    texts = texts.cast(pa.large_string())
    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data or b"", np.uint8)
    at = 0
    while at < len(texts):
        to = max(int(np.searchsorted(ends, ends[at] + BATCH_BYTES, "right")) - 1, at + 1)
        yield at, to, data[ends[at] : ends[to]], ends[at:to] - ends[at]
        at = to


def _words(held: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where each word of some texts begins, how many letters it has, and where all letters are."""
    inside = ~IS_SPACE[held]
    opens = inside.copy()
    opens[1:] &= ~inside[:-1]
    # A text's first byte goes on with no word of the text before.
    firsts = begins[begins < len(held)]
    opens[firsts] = inside[firsts]
    letters = np.flatnonzero(IS_LETTER[held])
    word_at = np.flatnonzero(opens)
    return word_at, np.bincount((np.cumsum(opens) - 1)[letters], minlength=len(word_at)), letters


def _lettered_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``(pos, row_index, word)`` of documents ``(before, kept_before, text)``, some texts at a time."""
    for batch in batches:
        numbers = [batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1)]
        for at, to, held, begins in _some_texts(batch.column(2)):
            word_at, count, letters = _words(held, begins)
            kept = np.flatnonzero(count)
            # Words of a text, and kept ones, are numbered from its first.
            doc = np.searchsorted(begins, word_at[kept], "right") - 1
            place = kept - np.searchsorted(word_at, begins)[doc]
            row = np.arange(len(kept)) - np.searchsorted(word_at[kept], begins)[doc]
            words = pa.Array.from_buffers(
                pa.string(), len(kept),
                [None, pa.py_buffer(np.concatenate([[0], np.cumsum(count[kept])]).astype(np.int32)), pa.py_buffer(held[letters])],
            )
            yield pa.RecordBatch.from_arrays(
                [pa.array(numbers[0][at:to][doc] + place, pa.int64()), pa.array(numbers[1][at:to][doc] + row, pa.int64()), words],
                names=["pos", "row_index", "word"],
            )


def _word_numbers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts, in the last column, with their numbers of words and of those with letters; null of a null text."""
    for batch in batches:
        texts = batch.column(batch.num_columns - 1)
        numbers = np.zeros((2, len(texts)), np.int64)
        for at, to, held, begins in _some_texts(texts):
            word_at, count, _ = _words(held, begins)
            for k, places in enumerate((word_at, word_at[count > 0])):
                numbers[k, at:to] = np.diff(np.searchsorted(places, begins), append=len(places))
        missing = texts.is_null().to_numpy(zero_copy_only=False)
        counts = [pa.array(n, mask=missing) for n in numbers]
        yield pa.RecordBatch.from_arrays([*batch.columns, *counts], names=[*batch.schema.names, "before", "kept_before"])


def _with_word_offsets(docs: DataFrame, in_order: bool = False) -> DataFrame:
    """``(doc_id, text)`` with the words and lettered words before each document, as ``before`` and ``kept_before``."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, text string, before bigint, kept_before bigint"
    sized = docs.select("doc_id", "text").mapInArrow(_word_numbers, schema)
    return with_offsets(sized, "doc_id", ["before", "kept_before"], in_order, keys=docs)


def lettered_words(docs: DataFrame) -> int:
    """How many words of the corpus have letters: one sum over the documents."""
    counted = docs.select("text").mapInArrow(_word_numbers, "text string, before bigint, kept_before bigint")
    return counted.agg(F.sum("kept_before")).first()[0] or 0


def word_slices(docs: DataFrame, rows_per_shard: int) -> DataFrame:
    """Ordered words cut by document and shard: ``(shard_id, row_index, words)``.

    The rows of :func:`ordered_words`, kept as arrays: one row for the part of
    a document that falls in a shard, ``row_index`` being its first word's.
    What follows then moves a few arrays a document instead of a row a word.
    """
    words = F.filter(text.space_words(F.col("text")), text.has_letters)
    lettered = (
        _with_word_offsets(docs)
        .select("kept_before", F.transform(words, text.letters_only).alias("words"))
        .withColumn("last", F.col("kept_before") + F.size("words") - 1)
    )
    per_shard = F.lit(rows_per_shard)
    shards = F.sequence(
        whole_division(F.col("kept_before"), per_shard), whole_division(F.col("last"), per_shard)
    )
    first = F.greatest(F.col("shard_id") * rows_per_shard, F.col("kept_before"))
    skipped = (first - F.col("kept_before")).cast("int")
    room = (F.col("shard_id") + 1) * rows_per_shard - first
    return (
        lettered.select(
            "kept_before", "words",
            F.explode(F.when(F.size("words") > 0, shards)).alias("shard_id"),
        )
        .select(
            "shard_id", first.alias("row_index"),
            F.slice("words", skipped + 1, room.cast("int")).alias("words"),
        )
    )


def letters_of_positioned(words: DataFrame) -> DataFrame:
    """The same cleaning for a ready table ``(pos, word)``."""
    return words.withColumn("word", text.letters_only(F.col("word"))).where(F.col("word") != "")


def max_position(words: DataFrame) -> DataFrame:
    """One row ``(max_position)``: the highest position, at least 0."""
    return words.agg(F.greatest(F.coalesce(F.max("pos"), F.lit(0)), F.lit(0)).alias("max_position"))


def max_position_of_lines(lines: DataFrame) -> DataFrame:
    """The same over raw ``pos_word`` lines, which are not trimmed here."""
    return max_position(lines.select(rows.position_of(F.col("value")).alias("pos")))


def with_range_partition(words: DataFrame, partitions: int) -> DataFrame:
    """Add the equal-width position range a row falls in, as ``part``.

    The last range takes what rounding leaves over. Writing in total order
    needs no such column: ``orderBy('pos')`` samples its own ranges.
    """
    highest = max_position(words).scalar()
    width = F.greatest(F.ceil(highest / F.lit(partitions)), F.lit(1))
    part = F.least(whole_division(F.col("pos"), width), F.lit(partitions - 1))
    return words.withColumn("part", part.cast("int"))
