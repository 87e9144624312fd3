import pytest
from pyspark.errors import PySparkException

from corpusvec.operators import positions
from corpusvec.sinks import (
    embedding_csv,
    ordered_token_csv,
    similar_words_yaml,
    word_count_csv,
    write_numbered_shards,
    write_packed_shards,
    write_shards,
    write_text,
)
from corpusvec.sinks.rows import WORD_COUNT_HEADER
from corpusvec.sources import (
    embedding_rows,
    numbered_lines,
    packed_shards,
    positioned_words_from_lines,
    read_lines,
    read_vocabulary_file,
    token_rows,
)
from corpusvec.sources.rows import EMBEDDING_HEADER, TOKEN_HEADER, rejected_embeddings, rejected_positions, rejected_tokens


def lines(spark, values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def tuples(df):
    return sorted(tuple(r) for r in df.collect())


def test_embedding_rows(spark):
    got = embedding_rows(
        lines(
            spark,
            ["1,plum,0.1,0.2,0.3", "TokenID,Word,Embeddings", '1,"red, ripe, sweet",0.1,0.2,0.3',
             "1,word", "2,bad,0.1,x", "", "3,one,5"],
        )
    )
    assert tuples(got) == [
        ("1", "plum", [0.1, 0.2, 0.3]), ("1", "red, ripe, sweet", [0.1, 0.2, 0.3]), ("3", "one", [5.0]),
    ]


def test_strict_reading_fails(spark):
    with pytest.raises(PySparkException, match="does not parse"):
        embedding_rows(lines(spark, ["2,bad,0.1,x"]), strict=True).collect()
    with pytest.raises(PySparkException, match="does not parse"):
        positioned_words_from_lines(lines(spark, ["abc_x"]), strict=True).collect()
    with pytest.raises(PySparkException, match="does not parse"):
        token_rows(lines(spark, ["1,a"]), strict=True).collect()


def test_positions_of_lines(spark):
    given = lines(
        spark,
        ["abc_x", "_x", "5_", "5", "5_a_b", "5_6", " 7_w ", "8 _w", "99999999999999999999_x", "+3_p", "-2_m",
         "4_a\u2028b"],
    )
    assert tuples(positioned_words_from_lines(given)) == [
        (-2, "m"), (3, "p"), (4, "a\u2028b"), (5, "6"), (5, "a_b"), (7, "w"),
    ]
    assert {r.value for r in rejected_positions(given).collect()} == {
        "abc_x", "_x", "5_", "5", "8 _w", "99999999999999999999_x",
    }


def test_token_rows(spark):
    got = token_rows(lines(spark, [TOKEN_HEADER, "17,up,[11 22]", "18,a", "19,b,[]", "x,b,[1]"]))
    assert tuples(got) == [(17, "up", [11, 22])]


def test_vocabulary_file(spark, tmp_path):
    path = tmp_path / "v.txt"
    path.write_text("IQ== 0\nIg== 1\nISI= 2\n")
    got = {r.token_id: bytes(r.token_bytes) for r in read_vocabulary_file(spark, str(path)).collect()}
    assert got == {0: b"!", 1: b'"', 2: b'!"'}


def test_lines_are_numbered_over_files_and_splits(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    expected = []
    for name in ["a.txt", "b.txt", "sub/c.txt", "z.txt"]:
        body = [f"{name} {i} " + "x" * (i % 37) for i in range(700)] + [""]
        (tmp_path / name).write_text("\n".join(body) + "\n")
        expected += body
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        df = numbered_lines(spark, str(tmp_path), recursive=True)
        assert read_lines(spark, str(tmp_path), recursive=True).rdd.getNumPartitions() > 8
        got = df.orderBy("line_index").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [r.line_index for r in got] == list(range(len(expected)))
    assert [r.line for r in got] == expected


def test_csv_sinks(spark, tmp_path):
    counts = spark.createDataFrame(
        [("the", [5], 42), ("a", [1, 2], 7)], "word string, token_ids array<int>, frequency long"
    )
    assert [r.value for r in word_count_csv(counts).collect()] == ['a,"[1 2]",7', 'the,"[5]",42']
    path = str(tmp_path / "counts")
    for _ in range(2):  # a second run replaces the first
        write_text(word_count_csv(counts).coalesce(1), path, header=WORD_COUNT_HEADER)
    assert [r.value for r in read_lines(spark, path).collect()] == [
        "Word,EncodedTokens,Frequency", 'a,"[1 2]",7', 'the,"[5]",42',
    ]

    tokens = spark.createDataFrame(
        [(17, "up", [11, 22]), (3, "I", [4])], "pos long, word string, token_ids array<int>"
    )
    write_text(ordered_token_csv(tokens), str(tmp_path / "tokens"), header=TOKEN_HEADER)
    assert tuples(token_rows(read_lines(spark, str(tmp_path / "tokens")))) == [
        (3, "I", [4]), (17, "up", [11, 22]),
    ]


def test_embedding_csv_order(spark, tmp_path):
    table = spark.createDataFrame(
        [(20, "b", [0.5, 1e-7]), (100, "c", [1.0, 2.0]), (3, "a", [0.0, -1.0])],
        "token_id int, word string, embedding array<double>",
    )
    assert [r.value for r in embedding_csv(table).collect()] == [
        "3,a,0.0,-1.0", "20,b,0.5,1.0E-7", "100,c,1.0,2.0",
    ]
    assert [r.value.split(",")[0] for r in embedding_csv(table, text_order=True).collect()] == [
        "100", "20", "3",
    ]
    write_text(embedding_csv(table), str(tmp_path / "e"), header=EMBEDDING_HEADER)
    got = embedding_rows(read_lines(spark, str(tmp_path / "e")))
    assert sorted(r.embedding for r in got.collect()) == [[0.0, -1.0], [0.5, 1e-7], [1.0, 2.0]]


def test_text_with_quotes_and_blanks_survives(spark, tmp_path):
    values = ['say "hi", ok', " lead", "trail ", "back\\slash", "", "tab\there"]
    write_text(lines(spark, values).coalesce(1), str(tmp_path / "t"), header="Head,er")
    assert [r.value for r in read_lines(spark, str(tmp_path / "t")).collect()] == ["Head,er", *values]


def test_shards_on_disk(spark, tmp_path):
    df = spark.createDataFrame(
        [(i // 2, i, f"line {i}") for i in range(5)], "shard_id long, line_index long, line string"
    ).repartition(3)
    path = str(tmp_path / "shards")
    write_numbered_shards(df, path)
    write_shards(df, path)
    got = spark.read.text(path)
    assert tuples(got.select("shard_id", "value")) == [(i // 2, f"line {i}") for i in range(5)]
    write_numbered_shards(df, path)
    assert tuples(spark.read.text(path).select("value")) == [(f"{i}\tline {i}",) for i in range(5)]


def test_packed_shards(spark, tmp_path):
    """Shards of unequal size, numbers with gaps, several to a file."""
    sizes = {3: 2, 4: 700, 5: 1, 8: 1300, 9: 3, 20: 40}
    rows = [(s, k, f"{s} line {k}" if k % 7 else "") for s, n in sizes.items() for k in range(n)]
    df = spark.createDataFrame(rows, "shard_id long, line_index long, line string").repartition(5)
    path = str(tmp_path / "packed")
    for size in (1, 1 << 14, 1 << 30):
        write_packed_shards(df, path, file_bytes=size)
        files = [f for f in (tmp_path / "packed").iterdir() if f.name.startswith("part-")]
        assert len(files) == {1: 6, 1 << 14: 3, 1 << 30: 1}[size]
        assert tuples(packed_shards(spark, path)) == sorted(rows)
        assert tuples(packed_shards(spark, path, [20, 8, 7])) == [r for r in sorted(rows) if r[0] in (8, 20)]
        assert packed_shards(spark, path, [7]).count() == 0
        # The folder is plain text for all others.
        assert read_lines(spark, path, recursive=True).count() == len(rows)
    write_packed_shards(df.limit(0), path)
    assert spark.read.parquet(f"{path}/_manifest").count() == 0


def test_totals_before_by_ranges_of_names(spark, monkeypatch):
    monkeypatch.setattr(positions, "LEVEL_BITS", 4)
    names = [f"n{i:03d}" for i in range(200)]
    df = spark.createDataFrame([(n, i + 1) for i, n in enumerate(names)], "name string, n long").repartition(7)
    got = tuples(positions.with_totals_before(df, ["name"], "n", "before"))
    assert got == [(n, i + 1, i * (i + 1) // 2) for i, n in enumerate(names)]
    assert positions.with_totals_before(df.limit(0), ["name"], "n", "before").count() == 0


def test_rejected_rows(spark):
    tokens = lines(spark, [TOKEN_HEADER, "1,a,[1 2]", "x,a,[1]", "2,a", "3,a,[]", "4,a,[1 b]", "", "5,\"a,b\",[7]"])
    assert tuples(rejected_tokens(tokens)) == [
        ("", "position"), ("2,a", "tokens"), ("3,a,[]", "tokens"), ("4,a,[1 b]", "tokens"), ("x,a,[1]", "position"),
    ]
    assert tuples(token_rows(tokens)) == [(1, "a", [1, 2]), (5, "a,b", [7])]
    vectors = lines(spark, [EMBEDDING_HEADER, "1,a,0.5", "2,a", "3", "", "4,a,x", "5,a,1,", "6,\"a,b\",1e3"])
    assert tuples(rejected_embeddings(vectors)) == [
        ("", "no numbers"), ("2,a", "no numbers"), ("3", "no numbers"), ("4,a,x", "numbers"), ("5,a,1,", "numbers"),
    ]
    assert tuples(embedding_rows(vectors)) == [("1", "a", [0.5]), ("6", "a,b", [1000.0])]


def test_yaml(spark):
    nested = spark.createDataFrame(
        [("a", [(1, "b", 0.5), (2, "c", -0.25)]), ("z", [])],
        "word string, neighbours array<struct<rank int, word string, similarity double>>",
    )
    assert {r.value for r in similar_words_yaml(nested).collect()} == {
        "a:\n  - word: b\n    similarity: 0.5\n  - word: c\n    similarity: -0.25", "z:\n",
    }


def test_lines_count_files_by_their_numbers(spark, tmp_path):
    for name in ("part-99999", "part-100000", "part-00002", "shard_10.txt", "shard_2.txt"):
        (tmp_path / name).write_text(f"{name} a\n{name} b\n")
    got = [r.line for r in numbered_lines(spark, str(tmp_path)).orderBy("line_index").collect()]
    names = ["part-00002", "part-99999", "part-100000", "shard_2.txt", "shard_10.txt"]
    assert got == [f"{n} {x}" for n in names for x in "ab"]
