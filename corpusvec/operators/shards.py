"""Shard numbers as columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusvec.functions.text import clean_line


def whole_division(index: Column, by: Column) -> Column:
    """Integer division that stays exact beyond the precision of doubles."""
    return F.call_function("div", index, by.cast("bigint"))


def fixed_shard(index: Column, rows_per_shard: int) -> Column:
    """Number of the shard when each takes ``rows_per_shard`` rows."""
    return whole_division(index, F.lit(rows_per_shard))


def with_equal_shards(df: DataFrame, index: str, shards: int) -> DataFrame:
    """Add ``shard_id`` so that each shard takes ``ceil(rows / shards)`` rows.

    Rounding up may leave fewer shards than asked for: 5 rows in 4 shards
    make 3 shards of two, two and one row.
    """
    total = df.agg(F.count("*")).scalar()
    per_shard = F.greatest(F.ceil(total / F.lit(shards)), F.lit(1))
    return df.withColumn("shard_id", whole_division(F.col(index), per_shard))


def clean_line_shards(lines: DataFrame, rows_per_shard: int = 500) -> DataFrame:
    """Cleaned lines with their shard: ``(shard_id, line_index, line)``."""
    return lines.select(
        fixed_shard(F.col("line_index"), rows_per_shard).alias("shard_id"),
        "line_index",
        clean_line(F.col("line")).alias("line"),
    )
