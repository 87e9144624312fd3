"""The same tasks from text files to text files, one function a job.

Each reads a file, a folder or a list of them and replaces what stands at
``out``. The steps hand over through their files: ``shard_lines`` feeds
``count_words``; ``position_words`` feeds ``order_tokens``, which feeds
``train_embeddings``, which feeds ``find_similar``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusvec.functions import rows
from corpusvec.operators import positions
from corpusvec.operators.shards import clean_line_shards, fixed_shard
from corpusvec.operators.similarity import similar_words
from corpusvec.operators.subwords import encode_words, learn_vocabulary
from corpusvec.operators.training import TrainingOptions
from corpusvec.operators.word_count import word_count
from corpusvec.plans import jobs
from corpusvec.session import materialize
from corpusvec.sinks import (
    embedding_csv,
    ordered_token_csv,
    similar_words_yaml,
    vocabulary_rows,
    word_count_csv,
    write_packed_shards,
    write_shards,
    write_text,
)
from corpusvec.sinks.rows import WORD_COUNT_HEADER
from corpusvec.sources import (
    embedding_rows,
    numbered_lines,
    positioned_words_from_lines,
    read_lines,
    read_vocabulary_file,
    token_rows,
)
from corpusvec.sources.rows import EMBEDDING_HEADER, TOKEN_HEADER


def shard_lines(spark: SparkSession, path: str, out: str, lines_per_shard: int = 500, packed: bool = False) -> None:
    """Cleaned lines in shards of ``lines_per_shard``: a folder each, or ``packed`` into files."""
    write = write_packed_shards if packed else write_shards
    write(clean_line_shards(numbered_lines(spark, path, recursive=True), lines_per_shard), out)


def learn(spark: SparkSession, path: str, out: str, merges: int, merges_per_round: int = 64) -> None:
    """A vocabulary file learned from text files."""
    vocabulary = learn_vocabulary(_counts(spark, path), merges, merges_per_round)
    write_text(vocabulary_rows(vocabulary), out)


def _counts(spark: SparkSession, path: str) -> DataFrame:
    lines = read_lines(spark, path, recursive=True)
    return word_count(lines.withColumnRenamed("value", "text"), clean=False)


def count_words(spark: SparkSession, path: str, vocabulary: str, out: str) -> None:
    """Word-count CSV of text files as they are; shard them first to clean them."""
    counts = encode_words(_counts(spark, path), read_vocabulary_file(spark, vocabulary))
    # The sort samples its input, so do not encode inside it.
    write_text(word_count_csv(materialize(counts)), out, header=WORD_COUNT_HEADER)


def position_words(spark: SparkSession, path: str, out: str, lines_per_shard: int = 500, packed: bool = False) -> None:
    """``pos_word`` lines of raw text files in shards of so many source lines."""
    words = positions.positioned_words_of_lines(numbered_lines(spark, path, recursive=True))
    shards = words.select(
        fixed_shard(F.col("line_index"), lines_per_shard).alias("shard_id"),
        F.col("pos").alias("line_index"),
        rows.format_positioned_word(F.col("pos"), F.col("word")).alias("line"),
    )
    (write_packed_shards if packed else write_shards)(shards, out)


def order_tokens(spark: SparkSession, path: str, vocabulary: str, out: str) -> None:
    """Ordered-token CSV from ``pos_word`` lines."""
    words = positioned_words_from_lines(read_lines(spark, path, recursive=True))
    # Sort the words first: the encoding then keeps their order.
    ordered = positions.letters_of_positioned(words).orderBy("pos")
    tokens = encode_words(ordered, read_vocabulary_file(spark, vocabulary), one_piece=True)
    kept = tokens.where(F.size("token_ids") > 0)
    write_text(ordered_token_csv(kept, sort=False), out, header=TOKEN_HEADER)


def train_embeddings(
    spark: SparkSession,
    path: str,
    vocabulary: str,
    out: str,
    rows_per_shard: int = jobs.TOKEN_ROWS_PER_SHARD,
    options: TrainingOptions = TrainingOptions(),
) -> None:
    """Embedding CSV from ordered-token CSV."""
    tokens = token_rows(read_lines(spark, path, recursive=True))
    known = read_vocabulary_file(spark, vocabulary)
    embeddings = materialize(jobs.token_embeddings(tokens, known, rows_per_shard, options))
    write_text(embedding_csv(embeddings), out, header=EMBEDDING_HEADER)


def find_similar(spark: SparkSession, path: str, out: str, n: int = 5) -> None:
    """YAML of similar words from embedding CSV, whose rows all have one length."""
    table = embedding_rows(read_lines(spark, path, recursive=True))
    dim = table.agg(F.max(F.size("embedding"))).first()[0] or 1
    write_text(similar_words_yaml(similar_words(jobs.word_vectors(table, dim), n)), out)
