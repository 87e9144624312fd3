"""Sub-word vocabularies published as text files of base64 token and rank."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_vocabulary_file(spark: SparkSession, path: str) -> DataFrame:
    """``(token_id INT, token_bytes BINARY)`` from lines ``<base64> <rank>``."""
    parts = F.split("value", " ")
    return (
        spark.read.text(path)
        .where(F.trim("value") != "")
        .select(
            F.get(parts, F.lit(1)).cast("int").alias("token_id"),
            F.unbase64(F.get(parts, F.lit(0))).alias("token_bytes"),
        )
    )
