"""The user tasks: from documents to similar words."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusvec.operators.positions import lettered_words, ordered_words, with_row_index, word_slices
from corpusvec.operators.shards import fixed_shard
from corpusvec.operators.similarity import similar_words
from corpusvec.operators.subwords import (
    decode_tokens,
    encode_slices,
    encode_words,
    learn_vocabulary,
)
from corpusvec.operators.training import TrainingOptions, train_shards
from corpusvec.operators.vectors import concat_vectors, mean_vectors
from corpusvec.operators.word_count import word_count
from corpusvec.session import materialize

TOKEN_ROWS_PER_SHARD = 10_000


def counted_tokens(docs: DataFrame, vocabulary: DataFrame, clean: bool = True) -> DataFrame:
    """``(word, token_ids, frequency)``: each distinct word is encoded once."""
    counts = encode_words(word_count(docs, clean), vocabulary)
    return counts.select("word", "token_ids", "frequency")


def ordered_tokens(docs: DataFrame, vocabulary: DataFrame, in_order: bool = False) -> DataFrame:
    """``(pos, row_index, word, token_ids)`` of every word that has letters."""
    # Words with letters have tokens; a filter that says so would encode all words once more.
    return encode_words(ordered_words(docs, in_order), vocabulary, one_piece=True)


def shard_embeddings(
    tokens: DataFrame,
    rows_per_shard: int = TOKEN_ROWS_PER_SHARD,
    options: TrainingOptions = TrainingOptions(),
) -> DataFrame:
    """Vectors of each shard's own model, before merging.

    Rows without a ``row_index`` are numbered by ``pos`` first.
    """
    if "row_index" not in tokens.columns:
        tokens = with_row_index(tokens, "pos")
    shards = tokens.withColumn("shard_id", fixed_shard(F.col("row_index"), rows_per_shard))
    return train_shards(shards, options)


def merged_embeddings(trained: DataFrame, vocabulary: DataFrame, dim: int) -> DataFrame:
    """``(token_id, word, embedding)``: per token the mean over all shards."""
    merged = mean_vectors(trained, ["token_id"], dim)
    return decode_tokens(merged, vocabulary).select("token_id", "word", "embedding")


def token_embeddings(
    tokens: DataFrame,
    vocabulary: DataFrame,
    rows_per_shard: int = TOKEN_ROWS_PER_SHARD,
    options: TrainingOptions = TrainingOptions(),
) -> DataFrame:
    """Embeddings from a table of ordered tokens."""
    trained = shard_embeddings(tokens, rows_per_shard, options)
    return merged_embeddings(trained, vocabulary, options.dim)


def corpus_embeddings(
    docs: DataFrame,
    vocabulary: DataFrame,
    rows_per_shard: int = TOKEN_ROWS_PER_SHARD,
    options: TrainingOptions = TrainingOptions(),
) -> DataFrame:
    """The same embeddings straight from documents.

    Nobody asks for the token table here, so documents are cut into one array
    of words a shard and encoded as such; only those arrays are shuffled.
    """
    slices = encode_slices(word_slices(docs, rows_per_shard), vocabulary)
    shards = -(-lettered_words(docs) // rows_per_shard)
    return merged_embeddings(train_shards(slices, options, shards), vocabulary, options.dim)


def word_vectors(embeddings: DataFrame, dim: int, on_duplicate: str = "mean") -> DataFrame:
    """One vector a word where several tokens read the same.

    Their ``mean``, or by ``concat`` one after the other in the order of their
    ids; the similarity of vectors of different lengths is that of their
    common part.
    """
    if on_duplicate == "concat":
        return concat_vectors(embeddings, "word", "token_id")
    if on_duplicate != "mean":
        raise ValueError(f"on_duplicate is mean or concat, not {on_duplicate}")
    return mean_vectors(embeddings, ["word"], dim)


def corpus_similar_words(
    docs: DataFrame,
    merges: int = 128,
    merges_per_round: int = 16,
    n: int = 5,
    rows_per_shard: int = TOKEN_ROWS_PER_SHARD,
    options: TrainingOptions = TrainingOptions(),
    vocabulary: DataFrame | None = None,
) -> DataFrame:
    """All steps in one: similar words of a corpus, nested form.

    Without a vocabulary one is learned from the corpus. The embeddings are
    checkpointed, as sizing the blocks and scoring them both read them.
    """
    if vocabulary is None:
        vocabulary = learn_vocabulary(word_count(docs), merges, merges_per_round)
    embeddings = materialize(corpus_embeddings(docs, vocabulary, rows_per_shard, options))
    return similar_words(word_vectors(embeddings, options.dim), n)


def run_corpus(
    docs: DataFrame,
    out: str,
    vocabulary: DataFrame,
    n: int = 5,
    rows_per_shard: int = TOKEN_ROWS_PER_SHARD,
    options: TrainingOptions = TrainingOptions(),
) -> None:
    """Write each task's table under ``out`` as Parquet, each read by the next.

    Tables: ``word_counts``, ``ordered_tokens``, ``embeddings`` and
    ``similar_words``. A rerun replaces them.
    """
    spark = docs.sparkSession

    def table(df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{out}/{name}")
        return spark.read.parquet(f"{out}/{name}")

    table(counted_tokens(docs, vocabulary), "word_counts")
    tokens = table(ordered_tokens(docs, vocabulary, in_order=True), "ordered_tokens")
    embeddings = table(token_embeddings(tokens, vocabulary, rows_per_shard, options), "embeddings")
    table(similar_words(word_vectors(embeddings, options.dim), n), "similar_words")
