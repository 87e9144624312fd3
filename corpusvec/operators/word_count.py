"""Word frequencies."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusvec.functions import text


def word_count(docs: DataFrame, clean: bool = True) -> DataFrame:
    """``(word, frequency)`` over a ``text`` column, whole texts or lines alike.

    With ``clean`` punctuation is dropped before splitting, so ``up--down``
    counts as ``updown``; without it the two halves count as two words.
    Splitting needs no lines first: a line break ends a word either way.
    Counts are combined in each task before the shuffle, so a word that makes
    up a third of the corpus still sends one row a task.
    """
    body = F.regexp_replace("text", r"[^\w\s]", "") if clean else F.col("text")
    words = docs.select(F.explode(text.lowercase_words(body)).alias("word"))
    return words.where(F.col("word") != "").groupBy("word").agg(F.count("*").alias("frequency"))
