"""Registered queries of this subpackage, over the whole of their tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusvec.llm.common import bound_batches, fold
from corpusvec.llm.decontamination import find_contamination
from corpusvec.llm.html_text import extract_text
from corpusvec.llm.language import identify_language
from corpusvec.llm.lattice import score_texts
from corpusvec.llm.minhash import near_duplicates
from corpusvec.llm.oracles import ORACLES  # noqa: F401
from corpusvec.llm.packing import pack_documents
from corpusvec.llm.periodic_runs import collapse_runs
from corpusvec.llm.pii import KINDS, find_personal_data, shown
from corpusvec.llm.quality import judge_documents
from corpusvec.llm.repeats import remove_repeats
from corpusvec.llm.source_divergence import source_divergence
from corpusvec.llm.token_counts import token_counts
from corpusvec.llm.vectors import near_vectors
from corpusvec.session import ship_package

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

#: Longest sequence of the model, in tokens.
SEQUENCE = 2048


def word_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def piece_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def prepare(spark: SparkSession) -> None:
    ship_package(spark)
    bound_batches(spark)


def query(f: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        prepare(spark)
        return f(spark, sf_dir)

    QUERIES[f.__name__] = run
    return f


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"), least=0.98)


@query
def op2_pii_sanitisation(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_personal_data(table(spark, sf_dir, "documents"))
    kinds = F.transform("base", lambda s: s["kind"])
    counts = [
        (F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{kind}") for k, kind in enumerate(KINDS[:4])
    ]
    every = F.array_sort(F.concat("base", "terms"))
    return found.select(
        "doc_id", *counts, F.sha2(shown(F.col("base")).cast("binary"), 256).alias("base_sha256"), shown(every).alias("spans")
    )


@query
def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = score_texts(docs, fold(F.col("doc_id"), 10) != 0, piece_vocabulary())
    return scored.withColumn("held_out", fold(F.col("doc_id"), 10) == 0)


@query
def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), word_tokenizer(), SEQUENCE)


@query
def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(table(spark, sf_dir, "pages"))


@query
def op6_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), least=85).drop("text_hash", "leads")


@query
def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = token_counts(table(spark, sf_dir, "documents"), word_tokenizer())
    return counted.withColumn("over_limit", F.col("n_tokens") > SEQUENCE)


@query
def op8_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = remove_repeats(table(spark, sf_dir, "documents"), span=400, keep_first=False)
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return cleaned.select(
        "doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
        # What is left, to be read; a character that a removed run cuts becomes U+FFFD.
        F.make_valid_utf8(F.col("kept").cast("string")).alias("text"),
    )


@query
def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "item_ids", F.size("item_ids").cast("long").alias("n_items"), "best_overlap",
        (F.size("item_ids") == 0).alias("kept"),
    )


@query
def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = identify_language(docs, docs.where(fold(F.col("doc_id"), 5) != 0))
    held_out = (fold(F.col("doc_id"), 5) == 0).alias("held_out")
    return found.select("doc_id", held_out, "lang_pred", "score")


def with_planted_run(docs: DataFrame) -> DataFrame:
    """``doc_id, text``; in a tenth of the documents, by crc32 of the id, the words from some place on repeat."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    split = docs.select(
        "doc_id", "text", (h % 10 == 0).alias("chosen"), F.floor(h / 10).cast("long").alias("g"),
        F.filter(F.split(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "").alias("words"),
    )
    n = F.size("words")
    placed = split.withColumn("a", F.when(n > 0, F.col("g") % n).cast("int")).withColumn(
        "p", F.expr("cast(1 + (size(words) - a) div (3 + g % 8) as int)")
    )
    tail = F.flatten(F.array_repeat(F.slice("words", F.col("a") + 1, F.col("p")), F.ceil((n - F.col("a")) / F.col("p")).cast("int")))
    repeated = F.concat(F.slice("words", F.lit(1), F.col("a")), F.slice(tail, F.lit(1), n - F.col("a")))
    return placed.select("doc_id", F.when(F.col("chosen") & (n > 0), F.array_join(repeated, " ")).otherwise(F.col("text")).alias("text"))


@query
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = collapse_runs(with_planted_run(table(spark, sf_dir, "documents")), least=6, times=4)
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    every = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    # Greatest length, then smallest start, then smallest period.
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"], (-r["start"]).alias("s"), (-r["period"]).alias("p"))))
    return found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"), every.alias("every"), "text").select(
        "doc_id", "n_runs", (-F.col("best.s")).alias("start"), F.col("best.length").alias("length"), (-F.col("best.p")).alias("period"),
        F.expr("1000 * best.length div -best.p").alias("exponent_milli"),
        F.sha2("every", 256).alias("runs_sha256"), F.sha2("text", 256).alias("collapsed_sha256"),
    )


@query
def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence(table(spark, sf_dir, "documents"), least=10, top=10)


@query
def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = judge_documents(table(spark, sf_dir, "documents"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "host_failed"
    )
