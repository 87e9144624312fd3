"""Token counts of whole texts without making their ids."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusvec.llm import tokens
from corpusvec.llm.common import held, stored, texts_of
from corpusvec.llm.lexicon import document_sums, word_counts


def pre_tokens(text: str) -> list[bytes]:
    return [w.encode("utf-8", "surrogatepass") for w in tokens.spaced(text)]


def with_piece_counts(table: DataFrame, path: str) -> DataFrame:
    """Add ``values``: the number of tokens of each distinct pre-token."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = held("tokenizer", path, lambda: tokens.load(path))
        for batch in batches:
            words = [u.decode("utf-8", "replace") for u in batch.column(0).to_pylist()]
            sizes: list[list[float]] = []
            for start in range(0, len(words), 4096):
                coded = tokenizer.encode_batch(words[start : start + 4096], add_special_tokens=False)
                sizes += [[float(len(c.ids))] for c in coded]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sizes, pa.list_(pa.float64()))],
                names=["unit", "n", "values"],
            )

    return table.select("unit", "n").mapInArrow(count, "unit binary, n long, values array<double>")


def token_counts(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """``doc_id, n_bytes, n_tokens`` of every row of ``docs``.

    Pre-tokens are what spaces and line feeds separate; each distinct one is
    tokenised once, and its count is joined to the documents that hold it. No
    ids are made for documents. A null or empty text has 0 bytes and 0 tokens;
    rows with equal ids each get a row; an empty table gives none.
    """
    texts = texts_of(docs)
    counts = word_counts(texts.withColumn("train", F.lit(False)), pre_tokens)
    table = stored(with_piece_counts(counts, tokenizer_path), "pre-tokens")
    sums = document_sums(texts, pre_tokens, table, ["n_tokens"])
    return sums.select("doc_id", "n_bytes", F.col("n_tokens").cast("long").alias("n_tokens"))
