"""Personal data in texts: patterns, and terms that give protected values away.

Only DataFrame functions: texts never leave the JVM.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusvec.llm.common import NO_ID, stored, texts_of, unused
from corpusvec.llm.lexicon import frequent_from
from corpusvec.llm.membership import split_by

#: The kinds in the order of their numbers.
KINDS = ("email", "ip", "card", "phone", "term")

# A match may start where the one before ended or where no longer one could
# have started; without this a long run would be tried from each of its
# characters. Possessive repeats keep the matcher from descending once for
# each repeat.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
#: Words of letters and digits of any length, the terms that may give something away.
TERM = r"[\p{L}\p{M}\p{N}]++"


def spans(text: Column, pattern: str, wanted: Callable[[Column], Column] = lambda value: F.lit(True)) -> Column:
    """Leftmost matches that do not overlap: ``start, end, value``, in code points.

    The gaps between matches are what splitting leaves, so places are running
    sums of lengths. Only matches whose value is ``wanted`` are given.
    """
    gaps = F.split(text, pattern, -1)
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    sized = F.zip_with(
        F.slice(gaps, 1, F.size(values)), values, lambda g, v: F.struct(F.char_length(g).alias("gap"), v.alias("value"))
    )
    nothing = F.array().cast("array<struct<start:int,end:int,value:string>>")
    placed = F.aggregate(
        sized,
        F.struct(F.lit(0).alias("at"), nothing.alias("found")),
        lambda so_far, x: F.struct(
            (so_far["at"] + x["gap"] + F.char_length(x["value"])).alias("at"),
            F.when(
                wanted(x["value"]),
                F.concat(
                    so_far["found"],
                    F.array(F.struct(
                        (so_far["at"] + x["gap"]).alias("start"),
                        (so_far["at"] + x["gap"] + F.char_length(x["value"])).alias("end"),
                        x["value"].alias("value"),
                    )),
                ),
            ).otherwise(so_far["found"]).alias("found"),
        ),
    )
    return placed["found"]


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def is_ip(value: Column) -> Column:
    """Every part is at most 255, whatever its leading zeros."""
    parts = F.transform(F.split(value, r"\."), lambda p: F.regexp_replace(p, "^0+(?=.)", ""))
    return F.forall(parts, lambda p: (F.length(p) <= 3) & (F.substring(p, 1, 3).cast("int") <= 255))


def is_card(value: Column) -> Column:
    """12 to 19 digits whose Luhn sum ends in 0."""
    number = F.reverse(digits(value))
    size = F.length(number)

    def worth(i: Column) -> Column:
        digit = F.substring(number, i + 1, F.lit(1)).cast("int")
        twice = digit * 2
        return F.when(i % 2 == 0, digit).when(twice > 9, twice - 9).otherwise(twice)

    total = F.aggregate(F.sequence(F.lit(0), F.least(size, F.lit(19)) - 1), F.lit(0), lambda s, i: s + worth(i))
    return size.between(12, 19) & (total % 10 == 0)


def is_phone(value: Column) -> Column:
    return F.length(digits(value)).between(9, 15)


def protected_spans(text: Column) -> Column:
    """All base spans of a text: ``start, kind (number), end, value``, in order."""

    def of(number: int, pattern: str, hint: str, test) -> Column:
        found = spans(text, pattern)
        if test is not None:
            found = F.filter(found, lambda s: test(s["value"]))
        shaped = F.transform(
            found, lambda s: F.struct(s["start"], F.lit(number).alias("kind"), s["end"], s["value"])
        )
        nothing = F.array().cast("array<struct<start:int,kind:int,end:int,value:string>>")
        # Most texts have none of a kind; a short test spares them the rest.
        return F.when(text.rlike(hint), shaped).otherwise(nothing)

    return F.array_sort(
        F.concat(
            of(0, EMAIL, "@", None),
            of(1, IP, r"[0-9]\.[0-9]++\.[0-9]", is_ip),
            of(2, CARD, r"[0-9](?:[\x20-]?[0-9]){11}", is_card),
            of(3, PHONE, r"\+[0-9]", is_phone),
        )
    )


def shown(found: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined, by start and then kind."""
    names = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(
        F.transform(
            found,
            lambda s: F.concat(F.get(names, s["kind"]), F.lit(":"), s["start"].cast("string"), F.lit(":"), s["end"].cast("string")),
        ),
        ",",
    )


def masked(text: Column, base: Column) -> Column:
    """The text with blanks for its base spans, so that all else keeps its place."""
    state = F.aggregate(
        base,
        F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts")),
        lambda so_far, s: F.struct(
            F.greatest(so_far["at"], s["end"]).alias("at"),
            F.concat(
                so_far["parts"],
                F.array(
                    F.substring(text, so_far["at"] + 1, F.greatest(s["start"] - so_far["at"], F.lit(0))),
                    F.repeat(F.lit(" "), F.greatest(s["end"] - F.greatest(so_far["at"], s["start"]), F.lit(0))),
                ),
            ).alias("parts"),
        ),
    )
    rest = F.substring(text, state["at"] + 1, F.char_length(text))
    return F.when(F.size(base) == 0, text).otherwise(F.concat(F.array_join(state["parts"], ""), rest))


def distinct_terms(clear: Column) -> Column:
    """The terms of a text whose base spans are masked, each once."""
    return F.array_distinct(F.transform(F.regexp_extract_all(clear, F.lit(TERM), F.lit(0)), F.lower))


def recurring_values(found: DataFrame, documents: int, support: int) -> DataFrame:
    """``doc_id, text_hash, first, value, n_value`` of values in ``support`` different texts or more.

    No other value can have a telling term. ``first`` is 1 for one document of
    each text and 0 for its copies.
    """
    held = found.where(F.size("base") > 0).select(
        "doc_id", "text_hash", F.array_distinct(F.transform("base", lambda s: s["value"])).alias("held")
    ).dropDuplicates(["doc_id", "text_hash"])
    firsts = held.groupBy("text_hash").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(1))
    held = held.join(firsts, ["doc_id", "text_hash"], "left").select(
        "doc_id", "text_hash", F.coalesce("first", F.lit(0)).alias("first"), F.explode("held").alias("value")
    )
    held = stored(held, "held-values")
    values = held.groupBy("value").agg(F.count("*").alias("n_value"), F.sum("first").alias("texts"))
    values = values.where((F.col("texts") >= support) & (F.col("n_value") < documents)).drop("texts")
    return held.join(values, "value")


def telling_terms(held: DataFrame, clear: DataFrame, counts: DataFrame, documents: int, share: float, support: int) -> DataFrame:
    """``doc_id, text_hash, term``: the terms of each document that give away a value it holds.

    ``held`` is as in `recurring_values`, ``clear`` has the masked text of each
    of its documents once, ``counts`` is ``term, n`` over all documents.

    Documents are counted, not occurrences. The information a term carries on
    a protected value is their pointwise mutual information,
    ``log2(documents * n(term, value) / (n(term) * n(value)))``; a term is
    telling if that is ``share`` or more of all there is to know,
    ``log2(documents / n(value))``, and all of it means the term occurs with
    this value only. Documents of one and the same text support a pair once
    only; a line that different texts share supports it once for each of them.

    As ``n(term, value)`` is at most ``n(value)``, a term of more than
    ``documents^(1 - share) * n(value)^share`` documents is never telling, and
    frequent ones are left out by that before pairs are made.
    """
    least = frequent_from(counts)
    frequent = counts.where(F.col("n") >= least).select("term", F.col("n").alias("n_frequent"))
    rare = counts.where(F.col("n") < least).select("term", F.col("n").alias("n_term"))
    terms = clear.select("doc_id", "text_hash", F.explode(distinct_terms(F.col("clear"))).alias("term"))
    bound = F.pow(F.lit(float(documents)), F.lit(1 - share)) * F.pow(F.col("n_value").cast("double"), F.lit(share))
    beside = (
        terms.join(F.broadcast(frequent), "term", "left").join(held, ["doc_id", "text_hash"])
        .where(F.col("n_frequent").isNull() | (F.col("n_frequent") <= bound * (1 + 1e-9)))
    )
    beside = stored(beside.select("doc_id", "text_hash", "first", "value", "n_value", "term", "n_frequent"), "beside-values")
    pairs = beside.groupBy("value", "term").agg(
        F.count("*").alias("n_both"), F.sum("first").alias("support"),
        F.first("n_value").alias("n_value"), F.first("n_frequent").alias("n_frequent"),
    )
    pairs = stored(pairs.where(F.col("support") >= support).drop("support"), "term-pairs")
    known = pairs.where("n_frequent is not null").withColumnRenamed("n_frequent", "n_term")
    others = pairs.where("n_frequent is null").drop("n_frequent").join(rare, "term")
    information = F.log2(documents * F.col("n_both") / (F.col("n_term") * F.col("n_value")))
    telling = known.unionByName(others).where(information >= share * F.log2(documents / F.col("n_value"))).select("value", "term")
    return beside.join(telling, ["value", "term"]).select("doc_id", "text_hash", "term")


def find_personal_data(docs: DataFrame, share: float = 0.8, support: int = 2) -> DataFrame:
    """``doc_id, text_hash, base, terms`` of every row of ``docs``.

    ``base`` holds the spans of the four patterns as ``start, kind, end,
    value``. ``terms`` holds, as ``start, kind, end, value``, every occurrence
    of the words of letters and digits that give away a value which the same
    text holds, wherever in the text: those that stand with the value in ``support`` different texts or
    more and carry ``share`` of its information or more, by counts over all
    documents. What is inside a base span is no word. ``text_hash`` tells texts
    of equal ids apart.

    Null and empty texts have no spans. Rows with equal id and text count as
    one document and each get its spans; an empty table gives none.
    """
    texts = texts_of(docs).withColumn("doc_id", F.coalesce("doc_id", F.lit(NO_ID))).withColumn("text_hash", F.xxhash64("text"))
    with_base = texts.withColumn("base", protected_spans(F.col("text")))
    found = stored(with_base.drop("text"), "protected")
    key = ["doc_id", "text_hash"]
    # Equal rows are one document in all counts. They are few as a rule, and
    # only texts whose id repeats move to be told apart.
    repeated = stored(found.groupBy(*key).agg((F.count("*") - 1).alias("more")).where("more > 0"), "repeated-rows")
    documents = found.count() - repeated.agg(F.coalesce(F.sum("more"), F.lit(0))).first()[0]
    held = stored(recurring_values(found, documents, support), "recurring-values")
    again, single = split_by(texts, repeated.select("doc_id"))
    once = single.unionByName(again.dropDuplicates(key)).withColumn("base", protected_spans(F.col("text")))
    clear = once.select(masked(F.col("text"), F.col("base")).alias("clear"))
    # Counted in each task before they move; a term of every text is no burden.
    counts = clear.select(F.explode(distinct_terms(F.col("clear"))).alias("term")).groupBy("term").agg(F.count("*").alias("n"))
    counts = stored(counts, "term-counts")
    few, _ = split_by(texts, held.select("doc_id"), "doc_id")
    few = few.join(held.select("doc_id", "text_hash").distinct(), ["doc_id", "text_hash"], "left_semi").dropDuplicates(["doc_id", "text_hash"])
    few = few.withColumn("base", protected_spans(F.col("text")))
    few = stored(few.select("doc_id", "text_hash", masked(F.col("text"), F.col("base")).alias("clear")), "holders")
    telling = telling_terms(held, few, counts, documents, share, support)
    telling = telling.groupBy("doc_id", "text_hash").agg(F.collect_set("term").alias("telling"))
    places = spans(F.col("clear"), TERM, lambda value: F.array_contains("telling", F.lower(value)))
    marked = few.join(telling, ["doc_id", "text_hash"]).select(
        "doc_id", "text_hash",
        F.transform(places, lambda s: F.struct(s["start"], F.lit(4).alias("kind"), s["end"], F.lower(s["value"]).alias("value"))).alias("terms"),
    )
    nothing = F.array().cast("array<struct<start:int,kind:int,end:int,value:string>>")
    return found.join(marked, ["doc_id", "text_hash"], "left").select(
        F.nullif("doc_id", F.lit(NO_ID)).alias("doc_id"), "text_hash", "base", F.coalesce("terms", nothing).alias("terms")
    )


def sanitised(text: Column, found: Column) -> Column:
    """The text with each span put in general terms: its kind in angle brackets.

    Where spans overlap, the one that starts first is replaced and the rest of
    the other goes with it.
    """
    names = F.array(*(F.lit(f"<{k.upper()}>") for k in KINDS))
    state = F.aggregate(
        F.array_sort(found),
        F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts")),
        lambda so_far, s: F.when(
            s["start"] >= so_far["at"],
            F.struct(
                s["end"].alias("at"),
                F.concat(so_far["parts"], F.array(F.substring(text, so_far["at"] + 1, s["start"] - so_far["at"]), F.get(names, s["kind"]))).alias("parts"),
            ),
        ).otherwise(F.struct(F.greatest(so_far["at"], s["end"]).alias("at"), so_far["parts"].alias("parts"))),
    )
    rest = F.substring(text, state["at"] + 1, F.char_length(text))
    return F.when(F.size(found) == 0, text).otherwise(F.concat(F.array_join(state["parts"], ""), rest))


def sanitise(docs: DataFrame, **options: float) -> DataFrame:
    """``docs`` with every span of personal data and every telling term generalised.

    A null text stays null.
    """
    found = find_personal_data(docs, **options).dropDuplicates(["doc_id", "text_hash"])
    doc, text_hash, marks = (unused(n, docs.columns) for n in ("_id", "_hash", "_spans"))
    marked = found.where(F.size("base") + F.size("terms") > 0).select(
        F.coalesce("doc_id", F.lit(NO_ID)).alias(doc), F.col("text_hash").alias(text_hash), F.concat("base", "terms").alias(marks)
    )
    marked = stored(marked, "spans")
    keyed = docs.withColumn(doc, F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)))
    few, clean = split_by(keyed, marked.select(doc), doc)
    few = few.withColumn(text_hash, F.xxhash64(F.coalesce("text", F.lit("")))).join(marked, [doc, text_hash], "left")
    text = F.when(F.col(marks).isNull(), F.col("text")).otherwise(sanitised(F.col("text"), F.col(marks)))
    own = [F.col(f"`{c}`") for c in docs.columns]
    return few.withColumn("text", text).select(*own).unionByName(clean.select(*own))
