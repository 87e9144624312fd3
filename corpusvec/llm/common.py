"""Small helpers that several operators share."""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusvec.session import scratch_path

#: ASCII white space between words; every other character belongs to a word.
WORD = r"[^\x20\x09-\x0D]+"


#: Stands for a null id where ids are join keys.
NO_ID = -(1 << 63)


def texts_of(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Only the key and the text (null: empty), whatever else the table holds."""
    return docs.select(
        F.col(f"`{key}`").cast("long").alias("doc_id"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"),
    )


def words_of(text: str) -> list[bytes]:
    """Words with A-Z in lower case.

    ``bytes.lower`` and ``bytes.split`` know ASCII letters and ASCII white
    space only, which is the rule of `WORD`.
    """
    return text.encode("utf-8", "surrogatepass").lower().split()


def slices_of(batches: Iterator[pa.RecordBatch], text: str = "text", limit: int = 1 << 23) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut to about ``limit`` bytes of text.

    A slice holds one row at least, so a very long text comes alone.
    """
    for batch in batches:
        size = max(1, batch.column(batch.schema.get_field_index(text)).nbytes)
        step = max(1, batch.num_rows * limit // size)
        for start in range(0, batch.num_rows, step):
            yield batch.slice(start, step)


def rows_of(batches: Iterator[pa.RecordBatch], text: str = "text", limit: int = 1 << 23) -> Iterator[list[tuple]]:
    """The rows of Arrow batches as tuples, a list for each slice."""
    for part in slices_of(batches, text, limit):
        yield list(zip(*(column.to_pylist() for column in part.columns), strict=True))


def appended(docs: DataFrame, columns: dict[str, str]) -> tuple[DataFrame, str]:
    """``docs`` without columns of the names to come, and the schema with them, as DDL."""
    own = docs.drop(*columns)
    added = ", ".join(f"{name} {kind}" for name, kind in columns.items())
    return own, f"{own.schema.toDDL()}, {added}"


def unused(name: str, taken: list[str]) -> str:
    """``name``, or a longer one where a table has a column so named."""
    known = {t.lower() for t in taken}
    while name.lower() in known:
        name += "_"
    return name


def bound_batches(spark: SparkSession, limit: str = "4m") -> None:
    """Let Arrow batches between the JVM and Python hold bytes, not rows, of a bounded number.

    The default of 10,000 rows is hundreds of megabytes where texts are long.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", limit)


_held: dict = {}


def held(kind: str, key, make):
    """What a Python worker keeps from task to task, made where it is not there.

    A worker serves one operator after another; only what the last one made is
    kept, so that their memory does not add up.
    """
    if (kind, key) not in _held:
        _held.clear()
        _held[kind, key] = make()
    return _held[kind, key]


def row_numbers() -> Iterator[int]:
    """Numbers that no other task gives, for rows that may share a key."""
    first = TaskContext.get().partitionId() << 40
    while True:
        yield first
        first += 1


def fold(doc_id: Column, folds: int) -> Column:
    """The fold of a document: crc32 of its id as text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds


def tasks_for(spark: SparkSession, rows: int, each: int) -> int:
    """Tasks that hold at most about ``each`` rows, and at least the session's."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(rows / each))


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared scratch folder and read it from there.

    Cuts the lineage as a checkpoint does, in compressed columns.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
