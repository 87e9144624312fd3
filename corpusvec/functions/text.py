"""Column expressions over lines and words of text.

All character classes are Java's: ``\\w``, ``\\W``, ``\\s`` and ``\\S`` cover
ASCII only, so accented letters end a word and are dropped by cleaning.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LINE_BREAK = r"\r\n|\r|\n"
SPACES = " \t\n\x0b\f\r"
CONTROLS_AND_SPACE = "".join(map(chr, range(33)))


def trim_ascii(text: Column) -> Column:
    """Strip every character up to U+0020 from both ends."""
    return F.btrim(text, F.lit(CONTROLS_AND_SPACE))


def split_lines(text: Column) -> Column:
    """Lines of a text; a final line break ends the last line, it opens none."""
    body = F.regexp_replace(text, rf"({LINE_BREAK})\z", "")
    return F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(body, LINE_BREAK))


def clean_line(line: Column) -> Column:
    """Drop characters that are neither word characters nor spaces, then trim."""
    return trim_ascii(F.regexp_replace(line, r"[^\w\s]", ""))


def lowercase_words(text: Column) -> Column:
    """Lower-cased runs of word characters.

    The first and last element may be empty; filter after exploding.
    """
    return F.split(F.lower(text), r"\W+")


def space_words(text: Column) -> Column:
    """Words between spaces, in order and never empty."""
    body = F.btrim(text, F.lit(SPACES))
    return F.when(body == "", F.array().cast("array<string>")).otherwise(F.split(body, r"\s+"))


def letters_only(word: Column) -> Column:
    return F.regexp_replace(word, "[^a-zA-Z]", "")


def has_letters(word: Column) -> Column:
    return word.rlike("[a-zA-Z]")
