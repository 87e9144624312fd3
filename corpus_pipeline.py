"""Documents to training sequences, stage by stage.

Each stage takes ``(spark, docs, sf_dir)`` and returns a table, which is
written as Parquet and read again as the next one's documents. All but the
last return the columns of ``documents``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusvec.llm.common import NO_ID, fold, stored, unused
from corpusvec.llm.decontamination import with_contamination
from corpusvec.llm.language import UNKNOWN, with_language
from corpusvec.llm.membership import split_by
from corpusvec.llm.minhash import near_duplicates
from corpusvec.llm.packing import pack_documents
from corpusvec.llm.pii import sanitise
from corpusvec.llm.queries import SEQUENCE, prepare, word_tokenizer


def same_columns(df: DataFrame, docs: DataFrame) -> DataFrame:
    return df.select(*(F.col(f"`{c}`") for c in docs.columns))


#: Phrases of a text in no known language are letters that stand alone: fewer
#: letters and spaces a phrase than this.
LEAST_PHRASE = 1.5


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in none of the labelled languages go.

    So do null texts, those without a letter, and all where nothing is labelled.
    """
    prepare(spark)
    found = with_language(docs, docs.where(fold(F.col("doc_id"), 5) != 0), least_phrase=LEAST_PHRASE)
    return same_columns(found.where(F.col("lang_pred") != UNKNOWN), docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a similarity of 0.8 or more the one of least id stays.

    Of rows equal in id and text one stays, also where the id is null. Texts
    without a word are like nothing and all stay.
    """
    prepare(spark)
    found = near_duplicates(docs, least=80).where("n_shingles > 0")
    key, text_hash, leads = (unused(n, docs.columns) for n in ("_id", "_hash", "_leads"))
    touched = found.groupBy(F.coalesce("doc_id", F.lit(NO_ID)).alias(key), F.col("text_hash").alias(text_hash))
    touched = touched.agg(F.every("leads").alias(leads), F.count("*").alias("n")).where(F.expr(f"not {leads} or n > 1"))
    touched = stored(touched.drop("n"), "near-copies")
    keyed = docs.withColumn(key, F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)))
    few, others = split_by(keyed, touched.select(key), key)
    few = few.withColumn(text_hash, F.xxhash64(F.coalesce("text", F.lit("")))).join(touched, [key, text_hash], "left")
    once = few.where(leads).dropDuplicates([key, text_hash])
    parts = (few.where(F.col(leads).isNull()), once, others)
    return reduce(DataFrame.unionByName, (same_columns(part, docs) for part in parts))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    prepare(spark)
    found = with_contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return same_columns(found.where(F.size("item_ids") == 0), docs)


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is put in general terms; ``n_chars`` follows the text."""
    clean = sanitise(docs)
    if "n_chars" in docs.columns:
        clean = clean.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return same_columns(clean, docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return pack_documents(docs, word_tokenizer(), SEQUENCE)


STAGES = [
    ("language", language),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("pii", pii),
    ("packing", packing),
]

#: Language models, signatures and tokens are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
