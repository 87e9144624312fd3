"""Column expressions that parse and format the text form of rows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusvec.functions.text import trim_ascii

# Inside split_csv: every MARK of the input becomes MARK + KEPT, every
# separating comma becomes MARK + CUT, so the two can never be mixed up.
MARK, KEPT, CUT = "\x01", "\x02", "\x03"


def split_csv(line: Column) -> Column:
    """Fields of a CSV line whose quotes toggle and vanish wherever they stand.

    Commas separate only outside quotes, ``""`` is no escape, an open quote
    runs to the end of the line, each field is trimmed and a trailing empty
    field is kept.
    """
    marked = F.replace(line, F.lit(MARK), F.lit(MARK + KEPT))
    # The text between quotes alternates: even segments lie outside.
    segments = F.transform(
        F.split(marked, '"'),
        lambda part, i: F.when(
            i % 2 == 0, F.replace(part, F.lit(","), F.lit(MARK + CUT))
        ).otherwise(part),
    )
    quoted = F.transform(
        F.split(F.array_join(segments, ""), MARK + CUT), lambda f: F.replace(f, F.lit(MARK + KEPT), F.lit(MARK))
    )
    # Most lines hold no quote, and all of their commas separate.
    fields = F.when(F.contains(line, F.lit('"')), quoted).otherwise(F.split(line, ","))
    return F.transform(fields, trim_ascii)


def position_of(line: Column) -> Column:
    """Number before the first ``_``, or NULL when the line is malformed."""
    digits = F.substring_index(line, "_", 1)
    # A line without ``_`` is its own head.
    goes_on = F.octet_length(line) > F.octet_length(digits) + 1
    return F.when(goes_on & digits.rlike(r"\A[+-]?[0-9]+\z"), digits.try_cast("bigint"))


def positioned_word_of(line: Column) -> Column:
    """Everything behind the first ``_``."""
    head = F.substring_index(line, "_", 1)
    return F.when(head == "", head).otherwise(F.substr(line, F.char_length(head) + 2))


def format_positioned_word(pos: Column, word: Column) -> Column:
    return F.concat_ws("_", pos.cast("string"), word)


def parse_token_list(text: Column) -> Column:
    """``[1 2 3]`` as an integer array; an element that is no int is NULL."""
    inner = F.regexp_replace(trim_ascii(text), r"\A\[|\]\z", "")
    return F.transform(F.split(inner, r"\s+"), lambda t: t.try_cast("int"))


def format_token_list(token_ids: Column) -> Column:
    return F.concat(F.lit("["), F.array_join(token_ids, " "), F.lit("]"))


def parse_vector(fields: Column) -> Column:
    """String fields as doubles; a field that is no number is NULL."""
    return F.transform(fields, lambda x: x.try_cast("double"))


def format_vector(vector: Column) -> Column:
    return F.array_join(vector, ",")


def all_parsed(values: Column) -> Column:
    """True for a non-empty array without NULL elements."""
    return (F.size(values) > 0) & ~F.exists(values, lambda v: v.isNull())
