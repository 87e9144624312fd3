"""What keeps queries in proportion to their input: no work done twice, no task for each small file."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpusvec import session
from corpusvec.functions import text
from corpusvec.operators import packed_groups, positions, subwords, training, windows
from corpusvec.operators.subwords import vocabulary_from
from corpusvec.plans import jobs
from corpusvec.plans.queries import QUERIES
from corpusvec.sinks import write_packed_shards
from corpusvec.sources import packed_shards, positioned_words_from_lines, token_rows

TEXTS = ["up--down 12 don't", "", None, "  \t7 \n x\x0b\x0cy ", "é a b ß1", "…", "one\r\ntwo 3 four5six"]


def plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_lines_are_parsed_once(spark):
    lines = spark.createDataFrame([("7_a_b",), ("_x",), ("7_",), ("+8_ ",), ("x7_c",), (None,)], "value string")
    parsed = positioned_words_from_lines(lines)
    assert [tuple(r) for r in parsed.collect()] == [(7, "a_b")]
    assert plan(parsed).count("try_cast") == 1
    lines = spark.createDataFrame([('7,"a,\x01b",[1 2]',), ("8,c,[3]",), ("9,,[x]",), ("no",)], "value string")
    parsed = token_rows(lines)
    assert [tuple(r) for r in parsed.collect()] == [(7, "a,\x01b", [1, 2]), (8, "c", [3])]
    assert len(re.findall(r"contains", plan(parsed), re.I)) <= 2


def test_position_lines_come_in_tasks_of_bounded_text(spark, tmp_path, monkeypatch):
    docs = [(k % 40 if k % 7 else None, None if k % 9 == 0 else "a b c d_e  c b " * (k % 5) + f"w{k}") for k in range(60)]
    spark.createDataFrame(docs, "doc_id long, text string").coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    good, bad = Counter(), Counter()
    for doc_id, text in docs:
        for j, word in enumerate((text or "").split()):
            if j % 4 == 0:
                bad[f"_{word}"] += 1
            elif doc_id is None:
                bad[None] += 1
            elif j % 4 == 1:
                bad[f"x{doc_id}_{word}"] += 1
            else:
                good[doc_id, word if j % 4 == 2 else f"a_{word}"] += 1
    monkeypatch.setattr(session, "TASK_TEXT", 64)
    parsed = QUERIES["parse_positions"](spark, str(tmp_path))
    assert sorted(tuple(r) for r in parsed.collect()) == sorted((*k, n) for k, n in good.items())
    # Neither side of a shuffle has more tasks than the text asks for, nor fewer.
    size = sum(len(t) for _, t in docs if t)
    counts = re.findall(r"RepartitionByExpression \[.*?\], (\d+)", plan(parsed))
    assert counts == [str(-(-size // 64))] * 2 and int(counts[0]) > 16
    rejected = QUERIES["reject_positions"](spark, str(tmp_path))
    assert {r["value"]: r["n"] for r in rejected.collect()} == bad
    assert len(re.findall("RepartitionByExpression", plan(rejected))) == 1


def test_strict_rows_fail(spark):
    with pytest.raises(Exception, match="row does not parse: x"):
        positioned_words_from_lines(spark.createDataFrame([("x",)], "value string"), strict=True).collect()


def test_ordered_words_of_odd_texts(spark, monkeypatch):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    words = [w for t in TEXTS if t for w in re.findall(r"[^ \t\n\x0b\f\r]+", t)]
    lettered = [(pos, re.sub("[^a-zA-Z]", "", w)) for pos, w in enumerate(words)]
    want = [(pos, k, w) for k, (pos, w) in enumerate((p, w) for p, w in lettered if w)]
    for size in (1, 1 << 19):
        monkeypatch.setattr(positions, "BATCH_BYTES", size)
        got = positions.ordered_words(docs.repartition(2))
        assert sorted(tuple(r) for r in got.collect()) == want
    assert positions.lettered_words(docs) == len(want)


def test_words_are_encoded_once(spark):
    docs = spark.createDataFrame([(0, "ab 1 b")], "doc_id long, text string")
    tokens = jobs.ordered_tokens(docs, vocabulary_from(spark, {"6162": 256}))
    executed = tokens._jdf.queryExecution().executedPlan().toString()
    assert executed.count("ArrowEvalPython") == 1
    assert sorted(tuple(r) for r in tokens.collect()) == [(0, 0, "ab", [256]), (2, 1, "b", [98])]


def test_an_encoder_remembers_bounded_bytes(monkeypatch):
    ranks = {bytes([b]): b for b in range(256)} | {b"ab": 256}
    words = [f"ab{k}" for k in range(300)] + ["ab" * 5000, "", "é", "ab7", "ab7"]
    want = [subwords._merge_piece(w.encode(), ranks) for w in words]
    monkeypatch.setattr(subwords, "MEMO_BYTES", 20_000)
    memo, most = subwords._Memo(ranks), 0
    for start in range(0, len(words), 50):
        some = words[start : start + 50]
        got = subwords._encode_batch(pa.array([[w] for w in some]), memo)
        assert got.to_pylist() == want[start : start + 50]
        most = max(most, len(memo.known))
        assert memo.size == sum(subwords.MEMO_ENTRY + len(w) + 8 * len(t) for w, t in memo.known.items())
        # One piece may be larger than all that is remembered, then it is alone.
        assert memo.size <= 20_000 or len(memo.known) == 1
    assert 50 < most < 100


@pytest.mark.parametrize("partial", ["keep", "drop"])
@pytest.mark.parametrize("window, stride", [(8, 2), (2, 3), (3, 1)])
def test_windows_follow_the_groups_of_an_array(spark, partial, window, stride):
    rows = [(s, i, f"t{i % 4}" if i % 5 else None) for s in range(13) for i in range(s)]
    df = spark.createDataFrame(rows, "shard_id long, i int, t string").repartition(3)
    got = windows.token_windows(df, ["i"], "t", window, stride, partial)
    held = windows.shard_sequences(df, ["i"], "t")
    want = held.select("shard_id", F.inline(windows.sliding_windows(F.col("tokens"), window, stride, partial)))
    assert got.dtypes == want.dtypes
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
    assert "collect_list" not in plan(got)


def test_one_task_writes_many_small_files(spark, tmp_path):
    rows = [(s, k, f"{s} {k}" if k else None) for s in range(2, 302) for k in range(3)]
    df = spark.createDataFrame(rows, "shard_id long, line_index long, line string").repartition(5)
    path = str(tmp_path / "packed")
    write_packed_shards(df.withColumn("line", F.coalesce("line", F.lit(""))), path, file_bytes=64)
    names = [f.name for f in (tmp_path / "packed").iterdir() if f.name.startswith("part-")]
    assert len(names) > 20 and len({n[:10] for n in names}) == 1
    want = [(s, k, t or "") for s, k, t in rows]
    assert sorted(tuple(r) for r in packed_shards(spark, path).collect()) == want
    some = packed_shards(spark, path, [2, 150, 301])
    assert sorted(tuple(r) for r in some.collect()) == [r for r in want if r[0] in (2, 150, 301)]


def test_sums_of_runs():
    rows = np.arange(30.0).reshape(10, 3)
    first = np.array([0, 1, 4, 9])
    assert (training._sums_of_runs(rows, first) == np.add.reduceat(rows, first)).all()


@pytest.mark.parametrize("cached", [1, 1 << 17])
def test_training_in_parts_gives_the_same(monkeypatch, cached):
    tokens = np.random.default_rng(3).integers(0, 40, 3000)
    options = training.TrainingOptions(dim=6, epochs=3, learning_rate=0.5, dtype="float64")
    want = training.train_tokens(tokens, options)
    monkeypatch.setattr(training, "CACHED", cached)
    monkeypatch.setattr(training, "SCORES", 1 << 14)
    got = training.train_tokens(tokens, options)
    assert np.allclose(got[1], want[1]) and np.allclose(got[2], want[2])


def rows_of(df):
    return sorted(map(repr, df.collect()))


@pytest.mark.parametrize("packed", [7, 1 << 18])
@pytest.mark.parametrize("kind", ["string", "bigint"])
def test_indexes_of_rows_that_travel_packed(spark, monkeypatch, packed, kind):
    """The same as by windows and a join, which move every row on its own."""
    monkeypatch.setattr(packed_groups, "PACKED_ROWS", packed)
    rng = random.Random(1)
    words = ["a", "b", "é", "ß", "東", "Ä", "aa", "", "Z"]
    rows = [(rng.choice([None, 0, 1, 2, 7]), k, rng.choice([None, *words])) for k in range(300)]
    df = spark.createDataFrame(rows + rows[:40], "shard_id long, `row.index` long, word string").repartition(3)
    if kind == "bigint":
        df = df.withColumn("word", F.xxhash64("word") % 9)
    order = W.partitionBy("shard_id").orderBy("word")
    coded, index = windows.with_token_index(df, token="word"), windows.token_index(df, token="word")
    want = df.withColumn("token_index", F.dense_rank().over(order) - 1)
    want_index = df.select("shard_id", "word").distinct().withColumn("token_index", F.row_number().over(order) - 1)
    assert coded.dtypes == want.dtypes and rows_of(coded) == rows_of(want)
    assert index.dtypes == want_index.dtypes and rows_of(index) == rows_of(want_index)
    # An index may be missing for some rows, and be there twice for others.
    table = want_index.where("token_index <> 2").unionByName(want_index.where("token_index = 1")).localCheckpoint()
    held = want.drop("word").withColumn("token_index", F.expr("if(`row.index` % 11 = 0, null, token_index)")).localCheckpoint()
    back, joined = windows.token_of_index(held, table), held.join(table, ["shard_id", "token_index"]).drop("token_index")
    assert back.dtypes == joined.dtypes and rows_of(back) == rows_of(joined)
    assert not any(re.search("Window|Join|Distinct", plan(x)) for x in (coded, index, back))


@pytest.mark.parametrize("size", [1, 1 << 19])
def test_words_of_texts_are_counted_without_patterns(spark, monkeypatch, size):
    monkeypatch.setattr(positions, "BATCH_BYTES", size)
    docs = spark.createDataFrame([*enumerate(TEXTS), (-5, " ab"), (900, "z 1 ")], "doc_id long, text string").repartition(3)
    got = positions._with_word_offsets(docs)
    words = text.space_words(F.col("text"))
    counted = docs.withColumns({"before": F.size(words).cast("long"), "kept_before": F.size(F.filter(words, text.has_letters)).cast("long")})
    want = positions.with_offsets(counted, "doc_id", ["before", "kept_before"])
    assert rows_of(got) == rows_of(want)
    assert not re.search("rlike|split", plan(got), re.I)
    assert positions.lettered_words(docs) == counted.agg(F.sum("kept_before")).first()[0]
    assert positions.lettered_words(docs.limit(0)) == 0
    # The least and greatest key are looked for without counting words.
    texts = spark.createDataFrame([(3, "a b"), (4, None)], "doc_id long, text string")
    failing = texts.withColumn("text", F.raise_error(F.lit("text was read")).cast("string"))
    assert positions._with_word_offsets(failing).columns == ["doc_id", "text", "before", "kept_before"]


def test_rows_of_windows_travel_packed(spark):
    df = spark.range(90).selectExpr("id % 3 shard_id", "id row_index", "0 i", "cast(id % 7 as int) token_id").repartition(4)
    got = windows.token_windows(df, ["row_index", "i"])
    held = windows.shard_sequences(df, ["row_index", "i"], "token_id")
    want = held.select("shard_id", F.inline(windows.sliding_windows(F.col("tokens"), 8, 2)))
    assert rows_of(got) == rows_of(want)
    assert plan(got).count("MapInArrow") == 1
