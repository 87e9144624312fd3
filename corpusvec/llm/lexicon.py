"""Sums over the words of every document, each word valued once.

A value that depends on the word alone (its number of tokens, its probability)
is computed once for each distinct word and then joined to the words of each
document. Frequent words, of which there are at most `HEAD`, go to every task
as a dictionary, so that no key of the join is hot; all others are joined.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusvec.llm.common import row_numbers, rows_of

Split = Callable[[str], list]

#: Most words that are sent to every task.
HEAD = 1 << 18
#: Distinct words that a task counts before it hands them on.
FLUSH = 1 << 19


def word_counts(docs: DataFrame, split: Split) -> DataFrame:
    """``(unit, n, n_train)`` of ``(doc_id, text, train)``.

    Counts are combined in each task first, so a word of every document costs
    one row a task.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        every: Counter = Counter()
        train: Counter = Counter()

        def flush() -> pa.RecordBatch:
            units = list(every)
            out = pa.RecordBatch.from_arrays(
                [
                    pa.array(units, pa.binary()),
                    pa.array(every.values(), pa.int64()),
                    pa.array([train[u] for u in units], pa.int64()),
                ],
                names=["unit", "n", "n_train"],
            )
            every.clear()
            train.clear()
            return out

        for rows in rows_of(batches):
            for _, text, trained in rows:
                units = split(text)
                every.update(units)
                if trained:
                    train.update(units)
                if len(every) >= FLUSH:
                    yield flush()
        yield flush()

    counted = docs.select("doc_id", "text", "train").mapInArrow(
        count, "unit binary, n long, n_train long"
    )
    return counted.groupBy("unit").agg(F.sum("n").alias("n"), F.sum("n_train").alias("n_train"))


def frequent_from(table: DataFrame, head: int = HEAD) -> int:
    """The least count that at most ``head`` units reach, out of a geometric series."""
    steps = 8
    level = F.floor(F.log2(F.col("n").cast("double")) * steps).cast("int")
    sizes = {r["level"]: r["size"] for r in table.groupBy(level.alias("level")).agg(F.count("*").alias("size")).collect()}
    reached, least = 0, max(sizes, default=0) + 1
    while least > 0 and reached + sizes.get(least - 1, 0) <= head:
        least -= 1
        reached += sizes.get(least, 0)
    return math.ceil(2 ** (least / steps) - 1e-9)


def document_sums(docs: DataFrame, split: Split, table: DataFrame, names: list[str]) -> DataFrame:
    """Sum the values of each document's words.

    ``table`` has ``unit, n, values array<double>`` with a row for every word,
    and should be a table that is cheap to read again. Returns ``doc_id,
    n_units, n_bytes`` and one column for each of ``names``; one row for each
    row of ``docs``, also where ids repeat.
    """
    spark = docs.sparkSession
    least = frequent_from(table)
    head = {r["unit"]: tuple(r["values"]) for r in table.where(F.col("n") >= least).select("unit", "values").collect()}
    sent = spark.sparkContext.broadcast({bytes(unit): values for unit, values in head.items()})
    width = len(names)

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, number = sent.value, row_numbers()
        for rows in rows_of(batches, limit=1 << 22):
            out: tuple[list, ...] = ([], [], [], [], [], [], [])
            uid, ids, unit_of, times, n_units, n_bytes, sums = out

            def add(*row, out=out) -> None:
                for column, value in zip(out, row, strict=True):
                    column.append(value)

            for doc_id, text in rows:
                own, total, size = next(number), [0.0] * width, 0
                for unit, k in Counter(split(text)).items():
                    size += k
                    values = known.get(unit)
                    if values is None:
                        uid.append(own), ids.append(doc_id), unit_of.append(unit), times.append(k)
                        n_units.append(0), n_bytes.append(0), sums.append(None)
                    else:
                        for i in range(width):
                            total[i] += k * values[i]
                # A key of its own: this row meets no word and burdens no task.
                add(own, doc_id, b"\xff%d" % own, 0, size, len(text.encode("utf-8", "surrogatepass")), total)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(uid, pa.int64()), pa.array(ids, pa.int64()), pa.array(unit_of, pa.binary()),
                    pa.array(times, pa.int64()), pa.array(n_units, pa.int64()), pa.array(n_bytes, pa.int64()),
                    pa.array(sums, pa.list_(pa.float64())),
                ],
                names=["uid", "doc_id", "unit", "times", "n_units", "n_bytes", "sums"],
            )

    rows = docs.select("doc_id", "text").mapInArrow(
        words, "uid long, doc_id long, unit binary, times long, n_units long, n_bytes long, sums array<double>"
    )
    rare = table.where(F.col("n") < least).select("unit", "values")
    joined = rows.join(rare, "unit", "left")

    def value(i: int):
        own = F.coalesce(F.get("sums", F.lit(i)), F.lit(0.0))
        return F.sum(own + F.coalesce(F.col("times") * F.get("values", F.lit(i)), F.lit(0.0)))

    return (
        joined.groupBy("uid", "doc_id")
        .agg(
            F.sum("n_units").alias("n_units"), F.sum("n_bytes").alias("n_bytes"),
            *(value(i).alias(name) for i, name in enumerate(names)),
        )
        .drop("uid")
    )
