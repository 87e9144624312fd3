"""Registered queries: every operator over the whole of the given tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusvec.functions import rows, text, vectors
from corpusvec.operators import positions, shards, similarity, subwords, windows
from corpusvec.operators.training import TrainingOptions, shard_losses
from corpusvec.operators.vectors import concat_vectors, mean_vectors
from corpusvec.operators.word_count import word_count
from corpusvec.plans import jobs
from corpusvec.session import materialize, scratch_path, ship_package, tasks_of_text
from corpusvec.sinks import (
    embedding_csv,
    ordered_token_csv,
    vocabulary_rows,
    word_count_csv,
    write_numbered_shards,
    write_packed_shards,
    write_shards,
    write_text,
    yaml_entry,
)
from corpusvec.sinks.rows import WORD_COUNT_HEADER
from corpusvec.sources import (
    embedding_rows,
    numbered_lines,
    packed_shards,
    positioned_words_from_lines,
    read_documents,
    read_lines,
    read_vocabulary_file,
    token_rows,
)
from corpusvec.sources.rows import EMBEDDING_HEADER, TOKEN_HEADER, rejected_embeddings, rejected_positions, rejected_tokens

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

# Parameters of the registered queries.
RANGES = 8
EQUAL_SHARDS = 7
LINES_PER_SHARD = 500
TOKEN_ROWS_PER_SHARD = 10_000
PACKED_BYTES = 1 << 18
WINDOW, STRIDE = 8, 2
TOP = 5
DIM = 64
DUPLICATES = 5
MERGES, MERGES_PER_ROUND = 128, 16
SMALL_MODEL = TrainingOptions(window=2, stride=2, dim=4, learning_rate=0.5, dtype="float64")


def query(f: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return f(spark, sf_dir)

    QUERIES[f.__name__] = run
    return f


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_documents(spark, f"{sf_dir}/documents.parquet")


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return table.withColumn("embedding", F.col("embedding").cast("array<double>"))


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of documents, each with its own number only: no shuffle."""
    return documents(spark, sf_dir).select(
        "doc_id", F.posexplode(text.split_lines(F.col("text"))).alias("line_no", "line")
    )


def rounded(value: Column, name: str) -> Column:
    return F.round(value, 6).alias(name)


# --- text -----------------------------------------------------------------


@query
def clean_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines(spark, sf_dir).withColumn("line", text.clean_line(F.col("line")))


@query
def word_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return word_count(documents(spark, sf_dir))


@query
def word_counts_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return word_count(documents(spark, sf_dir), clean=False)


# --- positions and shards -------------------------------------------------


@query
def indexed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return positions.indexed_lines(documents(spark, sf_dir))


@query
def positioned_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return positions.positioned_words(documents(spark, sf_dir))


@query
def positioned_words_of_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    numbered = positions.indexed_lines(documents(spark, sf_dir)).select("line_index", "line")
    return positions.positioned_words_of_lines(numbered)


@query
def positioned_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return positions.positioned_lines(documents(spark, sf_dir))


@query
def ordered_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return positions.ordered_words(documents(spark, sf_dir))


@query
def positioned_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return positions.letters_of_positioned(positioned_words(spark, sf_dir))


@query
def row_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gap-free numbers for rows whose keys have gaps."""
    kept = positions.letters_of_positioned(positioned_words(spark, sf_dir))
    return positions.with_row_index(kept, "pos").select("pos", "row_index")


@query
def max_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    return positions.max_position(positioned_words(spark, sf_dir))


@query
def max_position_of_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return positions.max_position_of_lines(position_lines(documents(spark, sf_dir)))


@query
def position_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = materialize(positioned_words(spark, sf_dir).select("pos"))
    return (
        positions.with_range_partition(words, RANGES)
        .groupBy("part")
        .agg(F.count("*").alias("n"), F.min("pos").alias("first_pos"), F.max("pos").alias("last_pos"))
    )


@query
def fixed_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.clean_line_shards(indexed_lines(spark, sf_dir), LINES_PER_SHARD)


@query
def equal_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    numbered = materialize(indexed_lines(spark, sf_dir).select("line_index"))
    return (
        shards.with_equal_shards(numbered, "line_index", EQUAL_SHARDS)
        .groupBy("shard_id")
        .agg(
            F.count("*").alias("n"),
            F.min("line_index").alias("first_line"),
            F.max("line_index").alias("last_line"),
        )
    )


# --- rows in text form ----------------------------------------------------


def dealt_documents(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, int]:
    """The documents dealt over tasks of bounded text, and the number of these.

    A split of the scan holds up to 128 MB compressed, whose words as rows are
    gigabytes in a task that sorts or groups them.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    tasks = tasks_of_text(docs, "text")
    return docs.repartition(tasks, "doc_id", "text"), tasks


def position_lines(docs: DataFrame) -> DataFrame:
    """``pos_word`` lines from every word, every fourth kind malformed."""
    word = docs.select(
        "doc_id", F.posexplode(text.space_words(F.col("text"))).alias("j", "word")
    )
    key = F.col("doc_id").cast("string")
    return word.select(
        F.when(F.col("j") % 4 == 0, F.concat(F.lit("_"), "word"))
        .when(F.col("j") % 4 == 1, F.concat(F.lit("x"), key, F.lit("_"), "word"))
        .when(F.col("j") % 4 == 2, F.concat(F.lit(" "), key, F.lit("_"), "word", F.lit(" ")))
        .otherwise(F.concat(key, F.lit("_a_"), "word"))
        .alias("value")
    )


@query
def parse_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, tasks = dealt_documents(spark, sf_dir)
    parsed = positioned_words_from_lines(position_lines(docs))
    # Most of these pairs are single: counting them before they move saves
    # little, and would hold all pairs of a task once more.
    return parsed.repartition(tasks, "pos", "word").groupBy("pos", "word").agg(F.count("*").alias("n"))


@query
def reject_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, _ = dealt_documents(spark, sf_dir)
    rejected = rejected_positions(position_lines(docs))
    return rejected.groupBy("value").agg(F.count("*").alias("n"))


def embedding_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV lines with quoted commas from ``part``, headers and lines without numbers in between."""
    part = spark.read.parquet(f"{sf_dir}/part.parquet")
    key = F.col("p_partkey").cast("string")
    line = F.concat_ws(
        ",", key,
        F.concat(F.lit('"'), "p_name", F.lit(", "), "p_brand", F.lit('"')),
        F.col("p_size").cast("string"), F.col("p_retailprice").cast("string"),
    )
    kinds = (
        F.when(F.col("p_partkey") % 10 == 3, F.lit(EMBEDDING_HEADER))
        .when(F.col("p_partkey") % 10 == 7, F.concat_ws(",", key, "p_name"))
        .otherwise(line)
    )
    return part.select(kinds.alias("value"))


@query
def parse_embedding_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_rows(embedding_lines(spark, sf_dir)).select(
        "token_id", "word",
        F.get("embedding", F.lit(0)).alias("size"), F.get("embedding", F.lit(1)).alias("price"),
    )


@query
def reject_embedding_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines without numbers, and lines with a word where a number should be."""
    good = embedding_lines(spark, sf_dir)
    return rejected_embeddings(good.unionByName(good.select(F.concat("value", F.lit(",high")).alias("value"))))


@query
def reject_token_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ordered-token lines from ``part``: headers, no position, no tokens, and tokens that are none."""
    part = spark.read.parquet(f"{sf_dir}/part.parquet")
    key, word = F.col("p_partkey").cast("string"), F.concat(F.lit('"'), "p_name", F.lit('"'))
    kind = F.col("p_partkey") % 10
    tokens = F.concat(F.lit("["), F.col("p_size").cast("string"), F.lit(" 7]"))
    line = (
        F.when(kind == 3, F.lit(TOKEN_HEADER))
        .when(kind == 5, F.concat_ws(",", F.concat(F.lit("x"), key), word, tokens))
        .when(kind == 7, F.concat_ws(",", key, word))
        .when(kind == 9, F.concat_ws(",", key, word, F.lit("[1 two]")))
        .otherwise(F.concat_ws(",", key, word, tokens))
    )
    return rejected_tokens(part.select(line.alias("value")))


@query
def split_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line of every document as CSV, with a quoted, a comma and an open quote field."""
    line = F.concat(F.lit('7,"a, b", '), F.col("line"), F.lit(',x"y,z'))
    return lines(spark, sf_dir).select(
        "doc_id", "line_no", F.posexplode(rows.split_csv(line)).alias("field_no", "field")
    )


@query
def token_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word lengths of a line through their text form and back."""
    lengths = F.transform(text.space_words(F.col("line")), F.length)
    shown = lines(spark, sf_dir).select(
        "doc_id", "line_no", rows.format_token_list(lengths).alias("token_list")
    )
    parsed = rows.parse_token_list(F.col("token_list"))
    return shown.where(rows.all_parsed(parsed)).select(
        "doc_id", "line_no", "token_list",
        F.size(parsed).alias("n"),
        F.aggregate(parsed, F.lit(0), lambda s, x: s + x).cast("bigint").alias("total"),
    )


@query
def vector_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors through their text form and back."""
    shown = embeddings(spark, sf_dir).select(
        "vec_id", rows.format_vector(F.col("embedding")).alias("v")
    )
    parsed = rows.parse_vector(F.split("v", ","))
    return shown.where(rows.all_parsed(parsed)).select(
        "vec_id", F.posexplode(parsed).alias("i", "x")
    )


# --- sinks, each read back ------------------------------------------------


@query
def line_shards_on_disk(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "line_shards")
    write_shards(fixed_shards(spark, sf_dir), path)
    return spark.read.text(path).groupBy("shard_id", "value").agg(F.count("*").alias("n"))


@query
def numbered_shards_on_disk(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "numbered_shards")
    numbered = materialize(indexed_lines(spark, sf_dir))
    write_numbered_shards(shards.with_equal_shards(numbered, "line_index", EQUAL_SHARDS), path)
    line = F.split("value", "\t", 2)
    return spark.read.text(path).select(
        "shard_id", line[0].cast("bigint").alias("line_index"), line[1].alias("line")
    )


@query
def position_shards_on_disk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``pos_word`` lines of 500 source lines a shard, scanned recursively."""
    path = scratch_path(spark, "position_shards")
    write_shards(position_shards(spark, sf_dir), path)
    return positioned_words_from_lines(read_lines(spark, path, recursive=True))


def position_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = positions.positioned_lines(documents(spark, sf_dir))
    return words.select(
        shards.fixed_shard(F.col("line_index"), LINES_PER_SHARD).alias("shard_id"),
        F.col("pos").alias("line_index"),
        rows.format_positioned_word(F.col("pos"), F.col("word")).alias("line"),
    )


@query
def packed_line_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shards of 500 lines packed into files, read back through the manifest."""
    path = scratch_path(spark, "packed_lines")
    write_packed_shards(fixed_shards(spark, sf_dir), path, file_bytes=PACKED_BYTES)
    return packed_shards(spark, path)


@query
def packed_position_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Packed ``pos_word`` lines, scanned as a folder of text."""
    path = scratch_path(spark, "packed_positions")
    write_packed_shards(position_shards(spark, sf_dir), path, file_bytes=PACKED_BYTES)
    return positioned_words_from_lines(read_lines(spark, path, recursive=True))


@query
def numbered_text_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines written in order as text files, numbered again by the scan."""
    path = scratch_path(spark, "lines")
    ordered = indexed_lines(spark, sf_dir).orderBy("line_index")
    write_text(ordered.select(F.col("line").alias("value")), path)
    return numbered_lines(spark, path)


@query
def word_count_csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The word-count CSV with its header, scanned with the quote-aware split."""
    path = scratch_path(spark, "word_count_csv")
    counts = encoded_with_one_merge(spark, sf_dir)
    write_text(word_count_csv(counts), path, header=WORD_COUNT_HEADER)
    fields = rows.split_csv(F.col("value"))
    return (
        read_lines(spark, path)
        .where(~F.col("value").startswith(WORD_COUNT_HEADER))
        .select(fields.alias("f"))
        .select(
            F.get("f", F.lit(0)).alias("word"), F.get("f", F.lit(1)).alias("token_list"),
            F.get("f", F.lit(2)).cast("bigint").alias("frequency"),
        )
    )


@query
def ordered_token_csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "ordered_tokens_csv")
    tokens = jobs.ordered_tokens(
        documents(spark, sf_dir), one_merge_vocabulary(spark, sf_dir), in_order=True
    )
    write_text(ordered_token_csv(tokens, sort=False), path, header=TOKEN_HEADER)
    return token_rows(read_lines(spark, path)).select(
        "pos", "word", rows.format_token_list(F.col("token_ids")).alias("token_list")
    )


@query
def embedding_csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "embeddings_csv")
    table = embeddings(spark, sf_dir).select(
        F.col("vec_id").alias("token_id"),
        F.concat(F.lit("w"), F.col("vec_id").cast("string")).alias("word"), "embedding",
    )
    write_text(embedding_csv(table), path, header=EMBEDDING_HEADER)
    return embedding_rows(read_lines(spark, path)).select(
        "token_id", "word", F.posexplode("embedding").alias("i", "x")
    )


def rows_in_order(spark: SparkSession, path: str, header: str) -> DataFrame:
    """``(row_no, field)``: the first field of each written row, numbered as it stands in the files."""
    kept = numbered_lines(spark, path).where(F.col("line") != header)
    return positions.with_row_index(materialize(kept), "line_index", "row_no").select(
        "row_no", F.substring_index("line", ",", 1).alias("field")
    )


@query
def word_count_csv_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word order in the files, after a second run has replaced the first."""
    path = scratch_path(spark, "word_count_csv")
    for counts in (word_counts_raw(spark, sf_dir), encoded_with_one_merge(spark, sf_dir)):
        if "token_ids" not in counts.columns:
            counts = counts.withColumn("token_ids", F.array(F.lit(0)))
        write_text(word_count_csv(counts), path, header=WORD_COUNT_HEADER)
    return rows_in_order(spark, path, WORD_COUNT_HEADER).withColumnRenamed("field", "word")


def written_embeddings(spark: SparkSession, sf_dir: str, text_order: bool) -> DataFrame:
    path = scratch_path(spark, "embeddings_csv")
    table = embeddings(spark, sf_dir).select(
        F.col("vec_id").alias("token_id"), F.lit("w").alias("word"), "embedding"
    )
    write_text(embedding_csv(table, text_order), path, header=EMBEDDING_HEADER)
    return rows_in_order(spark, path, EMBEDDING_HEADER).withColumnRenamed("field", "token_id")


@query
def embedding_csv_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return written_embeddings(spark, sf_dir, text_order=False)


@query
def embedding_csv_text_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return written_embeddings(spark, sf_dir, text_order=True)


@query
def ordered_token_csv_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "ordered_tokens_csv")
    tokens = jobs.ordered_tokens(documents(spark, sf_dir), one_merge_vocabulary(spark, sf_dir))
    write_text(ordered_token_csv(tokens), path, header=TOKEN_HEADER)
    return rows_in_order(spark, path, TOKEN_HEADER).withColumnRenamed("field", "pos")


# --- windows --------------------------------------------------------------


def word_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return positions.ordered_words(documents(spark, sf_dir)).select(
        shards.fixed_shard(F.col("row_index"), TOKEN_ROWS_PER_SHARD).alias("shard_id"),
        "row_index", "word",
    )


@query
def token_indexes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.token_index(word_shards(spark, sf_dir), token="word")


@query
def dense_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.with_token_index(word_shards(spark, sf_dir), token="word")


@query
def tokens_of_indexes(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = word_shards(spark, sf_dir)
    coded = windows.with_token_index(words, token="word").drop("word")
    return windows.token_of_index(coded, windows.token_index(words, token="word"))


def shown_windows(spark: SparkSession, sf_dir: str, partial: str) -> DataFrame:
    coded = windows.with_token_index(word_shards(spark, sf_dir), token="word")
    return windows.token_windows(
        coded, ["row_index"], "token_index", WINDOW, STRIDE, partial
    ).select(
        "shard_id", "start_idx", rows.format_token_list(F.col("context")).alias("context"), "target"
    )


@query
def token_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown_windows(spark, sf_dir, "keep")


@query
def full_token_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown_windows(spark, sf_dir, "drop")


# --- vectors and similarity -----------------------------------------------


@query
def vector_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    means = mean_vectors(embeddings(spark, sf_dir), ["label"], DIM)
    return means.select("label", F.posexplode("embedding").alias("i", "x")).withColumn(
        "x", F.round("x", 6)
    )


@query
def vector_concat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """At most five vectors share a key."""
    keyed = embeddings(spark, sf_dir).withColumn(
        "word", shards.whole_division(F.col("vec_id"), F.lit(DUPLICATES))
    )
    joined = concat_vectors(keyed, "word", "vec_id")
    return joined.select("word", F.posexplode("embedding").alias("i", "x"))


@query
def vector_norms(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = F.col("embedding")
    return embeddings(spark, sf_dir).select(
        "vec_id", rounded(vectors.dot(v, v), "sum_of_squares"), rounded(vectors.norm(v), "norm")
    )


@query
def cosine_to_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cosine of each vector with the mean of its label."""
    table = embeddings(spark, sf_dir)
    means = mean_vectors(table, ["label"], DIM).withColumnRenamed("embedding", "mean")
    return table.join(means, "label").select(
        "vec_id", rounded(vectors.cosine_similarity(F.col("embedding"), F.col("mean")), "similarity")
    )


def named_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.concat(F.lit("w"), F.col("vec_id").cast("string"))
    return embeddings(spark, sf_dir).select(name.alias("word"), "embedding")


@query
def top_n_similar(spark: SparkSession, sf_dir: str) -> DataFrame:
    best = similarity.top_n_similar(named_vectors(spark, sf_dir), TOP)
    return best.withColumn("similarity", F.round("similarity", 6))


@query
def top_n_similar_concat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of several vectors, one after the other as one vector."""
    key = shards.whole_division(F.col("vec_id"), F.lit(DUPLICATES)).cast("string")
    table = embeddings(spark, sf_dir).select(
        F.col("vec_id").alias("token_id"), F.concat(F.lit("w"), key).alias("word"), "embedding"
    )
    best = similarity.top_n_similar(jobs.word_vectors(table, DIM, on_duplicate="concat"), TOP)
    return best.withColumn("similarity", F.round("similarity", 6))


@query
def similar_yaml(spark: SparkSession, sf_dir: str) -> DataFrame:
    nested = similarity.similar_words(named_vectors(spark, sf_dir), TOP)
    entry = yaml_entry(
        F.col("word"), F.col("neighbours"), lambda s: F.format_string("%.4f", F.round(s, 4))
    )
    return nested.select(entry.alias("entry"))


# --- sub-words ------------------------------------------------------------


@query
def subword_pair_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return subwords.pair_counts(subwords.piece_symbols(word_counts_raw(spark, sf_dir)))


def one_merge_vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return subwords.learn_vocabulary(word_counts(spark, sf_dir), merges=1)


def corpus_vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return subwords.learn_vocabulary(word_counts(spark, sf_dir), MERGES, MERGES_PER_ROUND)


@query
def first_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return one_merge_vocabulary(spark, sf_dir).select("token_id", F.hex("token_bytes").alias("token"))


@query
def vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_vocabulary(spark, sf_dir).select("token_id", F.hex("token_bytes").alias("token"))


@query
def vocabulary_file_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The learned vocabulary written as a file of base64 and rank, and read back."""
    path = scratch_path(spark, "vocabulary")
    write_text(vocabulary_rows(corpus_vocabulary(spark, sf_dir)), path)
    return read_vocabulary_file(spark, path).select("token_id", F.hex("token_bytes").alias("token"))


def encoded_with_one_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words are counted once, for learning and for encoding."""
    counts = materialize(word_counts(spark, sf_dir))
    coded = subwords.encode_words(counts, subwords.learn_vocabulary(counts, merges=1))
    return coded.select("word", "token_ids", "frequency")


@query
def counted_tokens_one_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoded_with_one_merge(spark, sf_dir).select(
        "word", rows.format_token_list(F.col("token_ids")).alias("token_list"), "frequency"
    )


@query
def counted_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.counted_tokens(documents(spark, sf_dir), corpus_vocabulary(spark, sf_dir))


@query
def counted_tokens_by_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows by the way for a vocabulary too large to send."""
    counts = materialize(word_counts(spark, sf_dir))
    known = subwords.learn_vocabulary(counts, MERGES, MERGES_PER_ROUND)
    return subwords.encode_words_by_join(counts, known).select("word", "token_ids", "frequency")


@query
def ordered_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.ordered_tokens(documents(spark, sf_dir), corpus_vocabulary(spark, sf_dir))


@query
def subword_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Space-separated words, accents and all, encoded and decoded."""
    words = documents(spark, sf_dir).select(
        F.explode(text.space_words(F.col("text"))).alias("word")
    ).distinct()
    known = corpus_vocabulary(spark, sf_dir)
    return subwords.decode_sequences(subwords.encode_words(words, known), known, "word")


@query
def token_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each token of the one-merge vocabulary occurs, with its text."""
    coded = encoded_with_one_merge(spark, sf_dir)
    counts = (
        coded.select(F.explode("token_ids").alias("token_id"), "frequency")
        .groupBy("token_id")
        .agg(F.sum("frequency").alias("n"))
    )
    return subwords.decode_tokens(counts, one_merge_vocabulary(spark, sf_dir)).select(
        "token_id", "word", "n"
    )


# --- training -------------------------------------------------------------


@query
def token_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = corpus_vocabulary(spark, sf_dir)
    return jobs.corpus_embeddings(documents(spark, sf_dir), known)


def small_models(spark: SparkSession, sf_dir: str, epochs: int) -> DataFrame:
    """Models of all shards that are small enough for SQL to follow, over the one-merge vocabulary."""
    tokens = jobs.ordered_tokens(documents(spark, sf_dir), one_merge_vocabulary(spark, sf_dir))
    return jobs.shard_embeddings(tokens, TOKEN_ROWS_PER_SHARD, replace(SMALL_MODEL, epochs=epochs))


@query
def one_epoch_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors after one gradient step in each shard, averaged over the shards."""
    merged = mean_vectors(small_models(spark, sf_dir, 1), ["token_id"], SMALL_MODEL.dim)
    return merged.select("token_id", F.posexplode("embedding").alias("i", "value")).select("token_id", "i", rounded(F.col("value"), "value"))


@query
def training_losses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The loss of each shard before its first step, and whether each of four steps lowers it."""
    losses = shard_losses(small_models(spark, sf_dir, 5))
    falls = F.forall(F.sequence(F.lit(1), F.size("loss") - 1), lambda k: F.get("loss", k) < F.get("loss", k - 1))
    return losses.select("shard_id", rounded(F.get("loss", F.lit(0)), "first_loss"), falls.alias("falls"))


def shard_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(shard_id, row_index, i, token_id)``: what the shards train on, one token a row."""
    tokens = jobs.ordered_tokens(documents(spark, sf_dir), corpus_vocabulary(spark, sf_dir))
    shard = shards.fixed_shard(F.col("row_index"), TOKEN_ROWS_PER_SHARD).alias("shard_id")
    return tokens.select(shard, "row_index", F.posexplode("token_ids").alias("i", "token_id"))


@query
def shard_vocabularies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.token_index(shard_token_ids(spark, sf_dir))


@query
def training_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contexts and targets over token ids, complete contexts only, as training takes them."""
    every = windows.token_windows(shard_token_ids(spark, sf_dir), ["row_index", "i"], "token_id", WINDOW, STRIDE)
    return every.where(F.size("context") == WINDOW).select(
        "shard_id", "start_idx", rows.format_token_list(F.col("context")).alias("context"), "target"
    )


@query
def word_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of a document by shard, one row for each part."""
    slices = positions.word_slices(documents(spark, sf_dir), TOKEN_ROWS_PER_SHARD)
    return slices.select(
        "shard_id", "row_index", F.size("words").alias("n"), F.array_join("words", " ").alias("words")
    )


@query
def corpus_similar_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.corpus_similar_words(
        documents(spark, sf_dir), MERGES, MERGES_PER_ROUND, TOP
    )
