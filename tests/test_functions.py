import pytest
from pyspark.sql import functions as F

from corpusvec.functions import rows, text
from corpusvec.functions.vectors import cosine_similarity
from corpusvec.operators.windows import sliding_windows
from corpusvec.operators.word_count import word_count


def value(spark, data, schema, column):
    return spark.createDataFrame(data, schema).select(column.alias("v")).first().v


@pytest.mark.parametrize(
    "a, b, expected",
    [
        ([1.0, 2.0, 3.0], [1.0, 2.0, 3.0], 1.0),
        ([1.0, 2.0, 3.0], [-1.0, -2.0, -3.0], -1.0),
        ([1.0, 0.0, 0.0], [0.0, 1.0, 0.0], 0.0),
        ([0.0, 0.0, 0.0], [1.0, 2.0, 3.0], 0.0),
        ([1.0, 2.0, 3.0], [0.0, 0.0, 0.0], 0.0),
        ([0.0, 0.0, 0.0], [0.0, 0.0, 0.0], 0.0),
        ([1.0, 2.0, 3.0], [4.0, 5.0, 6.0], 0.974631846),
        ([5.0], [10.0], 1.0),
        # The product stops at the shorter vector, the norms do not.
        ([3.0, 4.0], [3.0], 0.6),
    ],
)
def test_cosine(spark, a, b, expected):
    got = value(
        spark, [(a, b)], "a array<double>, b array<double>", cosine_similarity(F.col("a"), F.col("b"))
    )
    assert got == pytest.approx(expected, abs=1e-9)


def windows(spark, tokens, window, stride, partial="keep"):
    got = value(
        spark, [(tokens,)], "t array<int>", sliding_windows(F.col("t"), window, stride, partial)
    )
    return [(w.start_idx, w.context, w.target) for w in got]


def windows_by_hand(tokens, window, stride):
    """Groups every ``stride`` until one reaches the end."""
    out, start = [], 0
    while start < len(tokens):
        group = tokens[start : start + window + 1]
        out.append((start, group[:window], group[-1]))
        if start + window + 1 >= len(tokens):
            break
        start += stride
    return out


def test_windows_of_ten_tokens(spark):
    assert windows(spark, list(range(1, 11)), 3, 2) == [
        (0, [1, 2, 3], 4), (2, [3, 4, 5], 6), (4, [5, 6, 7], 8), (6, [7, 8, 9], 10),
    ]


def test_windows_of_nothing(spark):
    assert windows(spark, [], 3, 2) == []
    assert windows(spark, [], 3, 2, "drop") == []


@pytest.mark.parametrize("window, stride", [(3, 2), (8, 2), (2, 5), (1, 1)])
def test_windows_by_hand(spark, window, stride):
    for n in range(1, 21):
        tokens = list(range(100, 100 + n))
        by_hand = windows_by_hand(tokens, window, stride)
        assert windows(spark, tokens, window, stride) == by_hand
        full = [w for w in by_hand if w[0] + window + 1 <= n]
        assert windows(spark, tokens, window, stride, "drop") == full


def test_last_window_repeats_its_target(spark):
    got = windows(spark, list(range(10)), 8, 2)
    assert got == [(0, list(range(8)), 8), (2, list(range(2, 10)), 9)]


def test_word_count_lowers_case(spark):
    docs = spark.createDataFrame([("Hello world hello",), ("",)], "text string")
    got = {r.word: r.frequency for r in word_count(docs).collect()}
    assert got == {"hello": 2, "world": 1}


def test_word_count_of_empty_text(spark):
    assert word_count(spark.createDataFrame([("",)], "text string")).count() == 0


def test_word_count_with_and_without_cleaning(spark):
    docs = spark.createDataFrame([("genius--though naïve\tx_1",)], "text string")
    assert {r.word for r in word_count(docs).collect()} == {"geniusthough", "nave", "x_1"}
    assert {r.word for r in word_count(docs, clean=False).collect()} == {
        "genius", "though", "na", "ve", "x_1",
    }


def test_clean_line(spark):
    line = ' \x01genius--though a "good" fellow \x1f'
    assert value(spark, [(line,)], "l string", text.clean_line(F.col("l"))) == "geniusthough a good fellow"


@pytest.mark.parametrize(
    "body, lines",
    [
        ("", []), ("a", ["a"]), ("a\n", ["a"]), ("a\n\n", ["a", ""]), ("\n", [""]),
        ("a\r\nb\rc\nd", ["a", "b", "c", "d"]), ("a\r\n", ["a"]),
    ],
)
def test_split_lines(spark, body, lines):
    assert value(spark, [(body,)], "t string", text.split_lines(F.col("t"))) == lines


@pytest.mark.parametrize(
    "body, words",
    [("", []), (" \n\t", []), (" a  b\x0bc\n", ["a", "b", "c"]), ("é ü", ["é", "ü"])],
)
def test_space_words(spark, body, words):
    assert value(spark, [(body,)], "t string", text.space_words(F.col("t"))) == words


@pytest.mark.parametrize(
    "line, fields",
    [
        ('1,"word, with, commas",0.1', ["1", "word, with, commas", "0.1"]),
        ('3,mid"q,uote"x,9', ["3", "midq,uotex", "9"]),
        ('4,a""b,1', ["4", "ab", "1"]),
        ('5,"open,1,2', ["5", "open,1,2"]),
        ("2,plain\t, 0.4,", ["2", "plain", "0.4", ""]),
        ("", [""]),
        (",", ["", ""]),
        ('"', [""]),
        ("a\x01b,\x01,\x02\x03", ["a\x01b", "", "\x02\x03"]),
        ("a\x02\x01,b\x03", ["a\x02", "b"]),
    ],
)
def test_split_csv(spark, line, fields):
    got = value(spark, [(line,)], "l string", rows.split_csv(F.col("l")))
    by_hand, field, quoted = [], "", False
    for c in line:
        if c == '"':
            quoted = not quoted
        elif c == "," and not quoted:
            by_hand.append(field)
            field = ""
        else:
            field += c
    spaces = "".join(map(chr, range(33)))
    assert got == [f.strip(spaces) for f in [*by_hand, field]]
    if "\x03" not in line:
        assert got == fields


def test_token_list_text(spark):
    df = spark.createDataFrame([("[1 2  3]",), ("[]",), ("[1 x]",), ("7",)], "s string")
    got = [r.t for r in df.select(rows.parse_token_list(F.col("s")).alias("t")).collect()]
    assert got == [[1, 2, 3], [None], [1, None], [7]]
    shown = value(spark, [([4, 5],)], "t array<int>", rows.format_token_list(F.col("t")))
    assert shown == "[4 5]"
