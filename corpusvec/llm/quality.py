"""Quality rules, and verdicts on hosts whose documents break them."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusvec.llm.common import stored
from corpusvec.llm.word_blocks import Words, joined, single_words, text_slices, words_in

WINDOW = 5
SPACE = b" \t\n\v\f\r"
SYMBOLS = b"#*$%&|<>"
#: Bytes that go on with a character that another byte began.
CONTINUED = bytes(range(0x80, 0xC0))

COUNTS = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"]

#: What a document may break. A host is judged by each rule for itself.
RULES = {
    "short": "n_words < 10",
    "repeats": "100 * n_repeat_words > 20 * n_words",
    "symbols": "100 * n_symbols > 10 * word_chars",
    "lines": "100 * n_dup_lines > 30 * n_lines",
}
#: The rules that a document is dropped for by itself.
BASE = ["short", "repeats"]

#: Failing hosts sent to every task, and the bytes of their names; more are joined.
SENT_HOSTS, SENT_BYTES = 1 << 17, 1 << 23
#: Parts that a host's documents are dealt to where verdicts are joined.
SALTS = 64


def repeated_words(found: Words) -> np.ndarray:
    """How many words of each text lie in windows that the text holds twice or more."""
    total = len(found.words)
    one = single_words(found)
    two = joined(one, one, total)
    four = joined(two, two, total)
    windows = joined(four, four, total, overlap=2 * 4 - WINDOW)
    steps = np.zeros(total + 1, np.int64)
    np.add.at(steps, windows.place - WINDOW + 1, 1)
    np.add.at(steps, windows.place + 1, -1)
    covered = np.concatenate([[0], np.cumsum(np.cumsum(steps)[:-1] > 0)])
    return covered[found.starts[1:]] - covered[found.starts[:-1]]


def text_counts(texts: list[bytes]) -> list[np.ndarray]:
    """The numbers of `COUNTS` for each text."""
    found = words_in(texts)
    chars, symbols, lines, again = (np.zeros(len(texts), np.int64) for _ in range(4))
    for k, text in enumerate(texts):
        chars[k] = len(text.translate(None, SPACE + CONTINUED))
        symbols[k] = len(text) - len(text.translate(None, SYMBOLS))
        held = [line for line in text.split(b"\n") if line.strip()]
        lines[k], again[k] = len(held), len(held) - len(set(held))
    return [np.diff(found.starts), chars, symbols, lines, again, repeated_words(found)]


def count_quality(docs: DataFrame, host: str = "source") -> DataFrame:
    """``doc_id, host`` and the numbers of `COUNTS` for every row of ``docs``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_slices(batches):
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), *(pa.array(c, pa.int64()) for c in text_counts(texts))],
                names=["doc_id", "host", *COUNTS],
            )

    texts = docs.select(
        F.col("`doc_id`").cast("long").alias("doc_id"), F.col(f"`{host}`").cast("string").alias("host"),
        F.coalesce(F.col("`text`"), F.lit("")).alias("text"),
    )
    return texts.mapInArrow(count, "doc_id long, host string, " + ", ".join(f"{c} long" for c in COUNTS))


def broken(rule: str) -> Column:
    return F.expr(RULES[rule])


@dataclass(frozen=True)
class Prior:
    """A beta distribution of the hosts' rates, as its mean and its strength in documents."""

    mean: float
    strength: float

    def shrunk(self, failed: Column, n: Column) -> Column:
        return (failed + F.lit(self.mean * self.strength)) / (n + F.lit(self.strength))


#: Bounds for the strength, in documents: however unlike hosts are, a handful of
#: documents condemns none, and however alike, thousands do.
WEAKEST, STRONGEST = 10.0, 1000.0


def fit_prior(hosts: int, n: float, n_squared: float, failed: float, spread: float) -> Prior:
    """Beta prior by moments, from sums over hosts.

    ``spread`` is the sum of failed^2 / n. What the rates vary beyond chance
    gives the share of variance between hosts, and that the strength.
    """
    mean = failed / n if n else 0.0
    chance = mean * (1 - mean)
    room = n - (n_squared / n if n else 0.0) - (hosts - 1)
    if chance <= 0 or room <= 0:
        return Prior(mean, STRONGEST)
    between = (spread - n * mean * mean - chance * (hosts - 1)) / (chance * room)
    return Prior(mean, min(STRONGEST, max(WEAKEST, 1 / between - 1)) if between > 0 else STRONGEST)


def host_rates(counted: DataFrame) -> DataFrame:
    """``host, n_docs`` and for each rule the failures, ``failed_<rule>``, and the shrunken ``rate_<rule>``.

    Failures are summed in each task before they move, so a host with a third
    of all documents is as cheap as any. Only sums over hosts reach the driver.
    """
    hosts = counted.where(F.col("host").isNotNull()).groupBy("host").agg(
        F.count("*").alias("n_docs"),
        *(F.sum(broken(r).cast("long")).alias(f"failed_{r}") for r in RULES),
    )
    hosts = stored(hosts, "hosts")
    n = F.col("n_docs").cast("double")
    sums = hosts.agg(
        F.count("*").alias("hosts"), F.coalesce(F.sum(n), F.lit(0.0)).alias("n"), F.coalesce(F.sum(n * n), F.lit(0.0)).alias("n2"),
        *(F.coalesce(F.sum(F.col(f"failed_{r}").cast("double")), F.lit(0.0)).alias(f"x_{r}") for r in RULES),
        *(F.coalesce(F.sum(F.pow(F.col(f"failed_{r}").cast("double"), 2) / n), F.lit(0.0)).alias(f"s_{r}") for r in RULES),
    ).first()
    priors = {r: fit_prior(sums["hosts"], sums["n"], sums["n2"], sums[f"x_{r}"], sums[f"s_{r}"]) for r in RULES}
    return hosts.select(
        "*", *(priors[r].shrunk(F.col(f"failed_{r}"), F.col("n_docs")).alias(f"rate_{r}") for r in RULES)
    )


def on_hosts(counted: DataFrame, hosts: DataFrame) -> DataFrame:
    """``counted`` with ``host_failed``: whether its host is one of ``hosts``.

    Few hosts are sent to the documents. More are joined, with each host's
    documents dealt over `SALTS` keys, so that none gathers in one task.
    """
    size = hosts.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.octet_length("host")), F.lit(0)).alias("bytes")).first()
    failing = hosts.select("host", F.lit(True).alias("host_failed"))
    if size["n"] <= SENT_HOSTS and size["bytes"] <= SENT_BYTES:
        joined_rows = counted.join(F.broadcast(failing), "host", "left")
    else:
        salted = failing.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        salt = F.pmod(F.xxhash64("doc_id", *COUNTS), F.lit(SALTS)).cast("int")
        joined_rows = counted.withColumn("salt", salt).join(salted, ["host", "salt"], "left").drop("salt")
    return joined_rows.withColumn("host_failed", F.coalesce("host_failed", F.lit(False)))


def judge_documents(docs: DataFrame, host: str = "source", bound: float = 0.5) -> DataFrame:
    """``doc_id, host``, the numbers of `COUNTS`, ``base_failed, host_failed, kept`` of every row of ``docs``.

    Each document is measured against `RULES`. A host's rate of failures of a
    rule is shrunk towards that of all hosts by a beta prior that is fitted to
    them, so that a few bad documents don't condemn a small host; a host fails
    whose shrunken rate of any rule is above ``bound``. A document stays if it
    breaks neither rule of `BASE` and its host stands.

    A null or empty text has no words and fails. A document without a host
    counts for none and is judged by itself. Rows that share an id, or have
    none, each count and give a row; an empty table gives none. Other columns
    aren't looked at.
    """
    counted = stored(count_quality(docs, host), "quality")
    rates = host_rates(counted)
    worst = F.greatest(*(F.col(f"rate_{r}") for r in RULES))
    judged = on_hosts(counted, rates.where(worst > bound))
    failed = broken(BASE[0]) | broken(BASE[1])
    return judged.select(
        "doc_id", "host", *COUNTS, failed.alias("base_failed"), "host_failed", (~failed & ~F.col("host_failed")).alias("kept")
    )
