import random
import re

import pytest
from pyspark.sql import functions as F

from corpusvec.operators import positions, shards

WORDS = ["a", "--", "B2", "naïve", "x_y", "1903", "the", "\"q\""]


def corpus(keys, seed=1):
    rng = random.Random(seed)
    docs = []
    for k in keys:
        parts = [rng.choice(WORDS) for _ in range(rng.randrange(0, 12))]
        docs.append((k, "".join(p + rng.choice([" ", "\n", "  ", "\r\n"]) for p in parts)))
    return docs


def by_hand(docs):
    positioned, ordered, pos = [], [], 0
    for _, body in sorted(docs):
        for word in body.split():
            positioned.append((pos, word))
            letters = re.sub("[^a-zA-Z]", "", word)
            if letters:
                ordered.append((pos, len(ordered), letters))
            pos += 1
    return positioned, ordered


KEYS = {
    "dense": range(500),
    "negative": range(-250, 250),
    "one": [7],
    "sparse": [random.Random(i).randrange(-(2**62), 2**62) for i in range(400)],
    "clustered": [*range(300), *(2**60 + 5 * i for i in range(100)), 2**63 - 1, -(2**63)],
}


@pytest.mark.parametrize("kind", KEYS)
@pytest.mark.parametrize("in_order", [False, True])
def test_positions_match_a_plain_loop(spark, kind, in_order):
    docs = corpus(KEYS[kind])
    positioned, ordered = by_hand(docs)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(7)
    got = [tuple(r) for r in positions.positioned_words(df, in_order).collect()]
    assert (got if in_order else sorted(got)) == positioned
    got = [tuple(r) for r in positions.ordered_words(df, in_order).collect()]
    assert (got if in_order else sorted(got)) == ordered


@pytest.mark.parametrize("parts", [1, 7, 64])
def test_partitioning_does_not_matter(spark, parts):
    docs = corpus(range(90), seed=5)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(parts)
    got = sorted(tuple(r) for r in positions.positioned_lines(df).collect())
    expected, line_index, pos = [], 0, 0
    for _, body in sorted(docs):
        for line in re.split("\r\n|\r|\n", body)[: None if body and not body.endswith("\n") else -1]:
            for word in line.split():
                expected.append((line_index, pos, word))
                pos += 1
            line_index += 1
    assert got == expected
    indexed = positions.indexed_lines(df).orderBy("line_index").collect()
    assert [r.line_index for r in indexed] == list(range(line_index))


def test_levels_of_buckets(spark, monkeypatch):
    """Few rows a level, so that totals pass through several levels."""
    monkeypatch.setattr(positions, "LEVEL_BITS", 2)
    monkeypatch.setattr(positions, "MIN_BUCKET_BITS", 2)
    monkeypatch.setattr(positions, "MAX_BUCKET_BITS", 2)
    monkeypatch.setattr(positions, "BROADCAST_BITS", 3)
    docs = corpus(range(0, 3000, 7), seed=9)
    positioned, ordered = by_hand(docs)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert sorted(tuple(r) for r in positions.positioned_words(df).collect()) == positioned
    assert [tuple(r) for r in positions.ordered_words(df, in_order=True).collect()] == ordered


def test_no_documents(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert positions.positioned_words(df).count() == 0
    assert positions.max_position(positions.positioned_words(df)).first().max_position == 0


def test_row_index_has_no_gaps(spark):
    keys = random.Random(2).sample(range(10**6), 1000)
    df = spark.createDataFrame([(k,) for k in keys], "pos long")
    got = positions.with_row_index(df, "pos").orderBy("pos").collect()
    assert [r.row_index for r in got] == list(range(1000))


def test_cleaned_words_leave_gaps(spark):
    df = spark.createDataFrame([(0, "I"), (1, "--"), (2, "1903")], "pos long, word string")
    assert [tuple(r) for r in positions.letters_of_positioned(df).collect()] == [(0, "I")]


def test_max_position(spark):
    df = spark.createDataFrame([("5_a",), ("x_9",), (" 12_b",), ("7_",)], "value string")
    assert positions.max_position_of_lines(df).first().max_position == 5
    none = spark.createDataFrame([("-4_a",)], "value string")
    assert positions.max_position_of_lines(none).first().max_position == 0


@pytest.mark.parametrize("highest, parts", [(0, 3), (1, 3), (10, 3), (9, 3), (11, 4)])
def test_range_partitions(spark, highest, parts):
    df = spark.range(highest + 1).withColumnRenamed("id", "pos")
    got = {r.pos: r.part for r in positions.with_range_partition(df, parts).collect()}
    width = max(-(-highest // parts), 1)
    assert got == {p: min(p // width, parts - 1) for p in range(highest + 1)}


def test_shards(spark):
    df = spark.range(5).withColumnRenamed("id", "i")
    fixed = df.select(shards.fixed_shard(F.col("i"), 2).alias("s")).collect()
    assert sorted(r.s for r in fixed) == [0, 0, 1, 1, 2]
    equal = shards.with_equal_shards(df, "i", 4).collect()
    assert sorted(r.shard_id for r in equal) == [0, 0, 1, 1, 2]
    big = spark.createDataFrame([(2**53 + 1,)], "i long").select(shards.fixed_shard(F.col("i"), 1))
    assert big.first()[0] == 2**53 + 1
