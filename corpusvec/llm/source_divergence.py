"""How far the sources of a language differ in the terms they use."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusvec.llm.common import slices_of, stored
from corpusvec.llm.membership import split_by

#: ASCII letters, A-Z as a-z, and all beyond ASCII make terms; the rest parts them.
LETTERS = np.array([b | 0x20 if chr(b).isascii() and chr(b).isalpha() else b if b >= 0x80 else 0 for b in range(256)], np.uint8)
#: Follows a complete term; no term holds this byte.
END = b"\x00"

#: Bytes of a prefix at the first level; each level doubles them.
FIRST_LEVEL = 2
#: Bits of the table of kept prefixes that is sent to every task: 4 MB, however
#: many are kept. With very many, more are counted in vain, none are lost.
BITS = 1 << 25
#: Entries that a task counts before it hands them on.
FLUSH = 1 << 19
#: Bytes of texts that a task looks at together.
SLICE = 1 << 22

#: What shares are counted in.
UNIT = 1_000_000_000
#: Sources, and terms x sources, that are compared in one group.
TILE, CELLS = 256, 1 << 17


def with_groups(docs: DataFrame) -> DataFrame:
    """``doc_id, lang, source, text``, a null of the last three read as empty."""
    return docs.select(
        F.col("`doc_id`").cast("long").alias("doc_id"),
        *(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")),
    )


# --- terms of a slice of rows -----------------------------------------------


@dataclass
class Terms:
    """The terms of a slice of rows: each distinct ``(lang, term)`` once, and where they stand."""

    langs: pa.Array
    #: For each distinct pair the place of its language, and its term.
    lang: np.ndarray
    term: pa.Array
    #: For each occurrence its distinct pair, and its row.
    pair: np.ndarray
    row: np.ndarray


def numbered(keys: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys, all below ``size``, and for each key its place among them."""
    if size > 8 * len(keys):
        return np.unique(keys, return_inverse=True)
    seen = np.zeros(size, bool)
    seen[keys] = True
    return np.flatnonzero(seen), (np.cumsum(seen) - 1)[keys]


def codes_of(coded: pa.DictionaryArray) -> np.ndarray:
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)


def numbered_pairs(first: np.ndarray, second: np.ndarray, n_first: int, n_second: int) -> tuple[np.ndarray, ...]:
    """Distinct pairs of numbers, as their two halves, and for each pair its place among them."""
    width = max(1, n_second)
    pairs, place = numbered(first * np.int64(width) + second, n_first * width)
    return *np.divmod(pairs, width), place


def counted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys in order, and how often each is there."""
    keys = np.sort(keys)
    opens = np.flatnonzero(np.diff(keys, prepend=-1))
    return keys[opens], np.diff(np.append(opens, len(keys)))


def terms_in(part: pa.RecordBatch, least_bytes: int = 0) -> Terms:
    """Terms of ``least_bytes`` or more, cut out of the texts' bytes all at once."""
    texts = part.column(part.schema.get_field_index("text")).cast(pa.large_binary())
    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    folded = LETTERS[np.frombuffer(data or b"", np.uint8)[ends[0] : ends[-1]]]
    ends = ends - ends[0]
    inside = folded != 0
    opens, closes = inside.copy(), inside.copy()
    opens[1:] &= ~inside[:-1]
    closes[:-1] &= ~inside[1:]
    held = np.diff(ends) > 0
    first, last = ends[:-1][held], ends[1:][held] - 1
    opens[first], closes[last] = inside[first], inside[last]
    begins = np.flatnonzero(opens)
    sizes = np.flatnonzero(closes) - begins + 1
    # Without what parts them terms lie end to end.
    starts = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    terms = pa.Array.from_buffers(pa.large_binary(), len(begins), [None, pa.py_buffer(starts), pa.py_buffer(folded[inside])])
    row = np.searchsorted(ends, begins, side="right") - 1
    if least_bytes > 1:
        long = sizes >= least_bytes
        terms, row = terms.filter(pa.array(long)), row[long]
    coded = terms.dictionary_encode()
    lang = part.column(part.schema.get_field_index("lang")).cast(pa.binary()).dictionary_encode()
    of, at, pair = numbered_pairs(codes_of(lang)[row], codes_of(coded), len(lang.dictionary), len(coded.dictionary))
    return Terms(lang.dictionary, of, coded.dictionary.take(pa.array(at)), pair, row)


def summed(tables: list[pa.Table], keys: list[str], value: str, distinct: bool = False) -> pa.Table:
    """One row for each of the keys, with the sum of the values (the greatest where ``distinct``)."""
    kind = "max" if distinct else "sum"
    sums = pa.concat_tables(tables).group_by(keys, use_threads=False).aggregate([(value, kind)])
    return sums.rename_columns([*keys, value] if sums.column_names[0] == keys[0] else [value, *keys]).select([*keys, value])


# --- terms of enough documents, by growing prefixes -------------------------


def places(langs: pa.Array, lang: np.ndarray, prefixes: pa.Array) -> np.ndarray:
    """The bit of each ``(lang, prefix)``, a language being given by its place."""
    fronts = np.array([crc32(name + END) for name in langs.to_pylist()], np.int64)[lang].tolist()
    # Objects come from Arrow in one go, which is far faster than as a list.
    return np.array(list(map(crc32, prefixes.to_numpy(zero_copy_only=False), fronts)), np.int64) % BITS


def place(lang: Column, prefix: Column) -> Column:
    """The same in Spark: crc32 of the whole goes on where that of its front ended."""
    return F.crc32(F.concat(lang.cast("binary"), F.lit(END), prefix)) % BITS


def bits_of(prefixes: DataFrame) -> Broadcast:
    """A table of bits, one set for each ``(lang, prefix)``, for every task."""
    # The functions of bitmaps count from 1.
    at = prefixes.select((place(F.col("lang"), F.col("prefix")) + 1).alias("at"))
    parts = at.groupBy(F.bitmap_bucket_number("at").alias("part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits"))
    table = bytearray(BITS // 8)
    for part, bits in parts.collect():
        table[(part - 1) * len(bits) : part * len(bits)] = bits
    return prefixes.sparkSession.sparkContext.broadcast(bytes(table))


def are_set(bits: bytes, at: np.ndarray) -> np.ndarray:
    return np.frombuffer(bits, np.uint8)[at >> 3] >> (at & 7) & 1 == 1


def prefix_documents(texts: DataFrame, size: int, bits: Broadcast | None, by_id: bool) -> DataFrame:
    """``(lang, prefix, n_docs)`` of terms and their `END`, cut to ``size`` bytes.

    Only terms whose first half was kept at the level before, as ``bits`` has
    it. A document counts once for a prefix, however many of its terms begin
    with it. Documents are counted in each task before they move; ``by_id``
    takes rows of equal ids as one document.
    """
    half = size // 2

    def is_kept(found: Terms, table: bytes) -> np.ndarray:
        parents = pc.binary_slice(found.term, 0, half).dictionary_encode()
        lang, parent, place_of = numbered_pairs(found.lang, codes_of(parents), len(found.langs), len(parents.dictionary))
        return are_set(table, places(found.langs, lang, parents.dictionary.take(pa.array(parent))))[place_of]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = bits.value if bits is not None else None
        waiting: list[pa.Table] = []
        for part in slices_of(batches, limit=SLICE):
            found = terms_in(part, half if table is not None else 0)
            whole = pc.binary_join_element_wise(found.term, pa.scalar(END, pa.large_binary()), pa.scalar(b"", pa.large_binary()))
            prefixes = pc.binary_slice(whole, 0, size).dictionary_encode()
            lang, prefix, number = numbered_pairs(found.lang, codes_of(prefixes), len(found.langs), len(prefixes.dictionary))
            row = found.row
            if table is not None:
                held = is_kept(found, table)[found.pair]
                row, number = row[held], number[found.pair[held]]
            else:
                number = number[found.pair]
            width = max(1, len(lang))
            row, number = np.divmod(counted(row * np.int64(width) + number)[0], width)
            if by_id:
                ids, at, n = part.column("doc_id").take(pa.array(row)), number, np.ones(len(row), np.int64)
            else:
                n = np.bincount(number, minlength=width)[: len(lang)]
                at = np.flatnonzero(n)
                ids, n = pa.nulls(len(at), pa.int64()), n[at]
            waiting.append(pa.table(
                [found.langs.take(pa.array(lang[at])).cast(pa.string()), ids, prefixes.dictionary.take(pa.array(prefix[at])).cast(pa.binary()), pa.array(n)],
                names=["lang", "doc_id", "prefix", "n_docs"],
            ))
            if sum(t.num_rows for t in waiting) >= FLUSH:
                # What is still too much after it was put together goes on.
                waiting = [summed(waiting, ["lang", "doc_id", "prefix"], "n_docs", distinct=by_id)]
                if waiting[0].num_rows >= FLUSH // 2:
                    yield from waiting.pop().to_batches()
        if waiting:
            yield from summed(waiting, ["lang", "doc_id", "prefix"], "n_docs", distinct=by_id).to_batches()

    rows = texts.select("doc_id", "lang", "text").mapInArrow(count, "lang string, doc_id long, prefix binary, n_docs long")
    return rows.dropDuplicates(["lang", "doc_id", "prefix"]) if by_id else rows


def frequent_terms(texts: DataFrame, least: int) -> DataFrame:
    """``(lang, prefix)``: terms, with `END`, that ``least`` documents of their language hold.

    Prefixes of 2 bytes are counted first, then those of 4, 8, ... bytes of
    terms whose prefix before was in enough documents, until no kept prefix is
    without its end. A prefix is in all documents that any longer one is in, so
    what is discarded can't lead to a kept term; terms of few documents, which
    are most, don't get as far as being moved.
    """
    again = texts.where(F.col("doc_id").isNotNull()).groupBy("doc_id").count().where("count > 1").select("doc_id")
    again = stored(again, "repeated-ids")
    parts = [(texts, False)]
    if not again.isEmpty():
        few, others = split_by(texts, again)
        parts = [(few, True), (others, False)]
    whole = F.endswith(F.col("prefix"), F.lit(END))
    kept, bits, size = None, None, FIRST_LEVEL
    while True:
        counted = [prefix_documents(part, size, bits, by_id) for part, by_id in parts]
        rows = counted[0] if len(counted) == 1 else counted[0].unionByName(counted[1])
        enough = rows.groupBy("lang", "prefix").agg(F.sum("n_docs").alias("n_docs")).where(F.col("n_docs") >= least)
        level = stored(enough.select("lang", "prefix"), f"prefixes-{size}")
        done = level.where(whole)
        kept = done if kept is None else kept.unionByName(done)
        open_ends = level.where(~whole)
        if open_ends.isEmpty():
            return kept
        bits, size = bits_of(open_ends), 2 * size


# --- occurrences ------------------------------------------------------------


def term_counts(texts: DataFrame, kept: DataFrame) -> DataFrame:
    """``(lang, source, term, n)`` of kept terms that occur.

    Summed in each task before they move; then a term has one row a task, with
    all its sources.
    """
    bits = bits_of(kept)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = bits.value
        waiting: list[pa.Table] = []

        def by_term() -> Iterator[pa.RecordBatch]:
            lists = waiting.pop().group_by(["lang", "term"], use_threads=False).aggregate([("source", "list"), ("n", "list")])
            names = ["lang", "term", "sources", "times"]
            yield from lists.select(["lang", "term", "source_list", "n_list"]).rename_columns(names).to_batches(max_chunksize=1 << 14)

        for part in slices_of(batches, limit=SLICE):
            held = terms_in(part)
            source = part.column("source").dictionary_encode()
            whole = pc.binary_join_element_wise(held.term, pa.scalar(END, pa.large_binary()), pa.scalar(b"", pa.large_binary()))
            stay = are_set(table, places(held.langs, held.lang, whole))[held.pair]
            width = max(1, len(source.dictionary))
            keys, times = counted(held.pair[stay] * np.int64(width) + codes_of(source)[held.row[stay]])
            pair, at = np.divmod(keys, width)
            waiting.append(pa.table(
                [
                    held.langs.take(pa.array(held.lang[pair])).cast(pa.string()), held.term.take(pa.array(pair)).cast(pa.binary()).cast(pa.string()),
                    source.dictionary.take(pa.array(at)), pa.array(times),
                ],
                names=["lang", "term", "source", "n"],
            ))
            if sum(t.num_rows for t in waiting) >= 2 * FLUSH:
                waiting = [summed(waiting, ["lang", "term", "source"], "n")]
                if waiting[0].num_rows >= FLUSH:
                    yield from by_term()
        if waiting:
            waiting = [summed(waiting, ["lang", "term", "source"], "n")]
            yield from by_term()

    rows = texts.select("lang", "source", "text").mapInArrow(count, "lang string, term string, sources array<string>, times array<long>")
    # Sums by source need no further shuffle where a term's rows are together.
    each = rows.repartition("lang", "term").select("lang", "term", F.inline(F.arrays_zip("sources", "times")))
    terms = kept.select("lang", F.expr("cast(substr(prefix, 1, length(prefix) - 1) as string)").alias("term"))
    return (
        each.groupBy("lang", "term", F.col("sources").alias("source")).agg(F.sum("times").alias("n"))
        .join(terms, ["lang", "term"], "left_semi").select("lang", "source", "term", "n")
    )


def share(n: str, total: str, terms: str) -> Column:
    """1 + floor(UNIT * (n + 2) / (total + 2 * terms)) in whole numbers of any size."""
    wide = f"cast({UNIT} as decimal(10,0)) * cast({n} + 2 as decimal(20,0))"
    return F.expr(f"1 + ({wide}) div cast({total} + 2 * {terms} as decimal(20,0))")


def difference(p: str, q: str) -> Column:
    return F.expr(f"(({p} - {q}) * ({p} - {q})) div ({p} + {q})")


# --- comparisons ------------------------------------------------------------

GROUP = ["lang", "bucket", "tile_a", "tile_b"]


def compare_group(key: tuple, rows: pa.Table) -> pa.Table:
    """Sums of differences between the sources of two tiles, over the terms of a bucket."""
    term = rows.column("term").combine_chunks()
    is_source = np.asarray(term.is_null())
    source = rows.column("source").combine_chunks().dictionary_encode()
    names, at = source.dictionary, source.indices.to_numpy(zero_copy_only=False)
    p, tile = (rows.column(c).to_numpy() for c in ("p", "tile"))
    absent = np.zeros(len(names), np.int64)
    absent[at[is_source]] = p[is_source]
    tile_of = np.zeros(len(names), np.int64)
    tile_of[at] = tile
    codes = term.filter(pa.array(~is_source)).dictionary_encode()
    shares = np.tile(absent, (len(codes.dictionary), 1))
    shares[codes.indices.to_numpy(zero_copy_only=False), at[~is_source]] = p[~is_source]
    n_terms = rows.column("n_terms").to_numpy()[is_source][0]
    tile_a, tile_b = key[2].as_py(), key[3].as_py()
    # By name, as every bucket has to take the two sources in the same order.
    by_name = np.argsort(names.to_numpy(zero_copy_only=False), kind="stable")
    left, right = (by_name[tile_of[by_name] == t] for t in (tile_a, tile_b))
    out = []
    for k, a in enumerate(left):
        others = right[k + 1 :] if tile_a == tile_b else right
        if not len(others):
            continue
        apart = shares[:, others] - shares[:, [a]]
        sums = (apart * apart // (shares[:, others] + shares[:, [a]])).sum(axis=0)
        if n_terms > len(shares):
            # Terms that no source of the two tiles has.
            gap, both = absent[others] - absent[a], absent[others] + absent[a]
            sums = sums + (n_terms - len(shares)) * (gap * gap // both)
        out.append((np.full(len(others), a), others, sums))
    a, b, value = (np.concatenate(c) for c in zip(*out)) if out else (np.zeros(0, np.int64),) * 3
    return pa.table(
        [pa.array([key[0].as_py()] * len(a), pa.string()), names.take(pa.array(a)), names.take(pa.array(b)), pa.array(value, pa.int64())],
        names=["lang", "a", "b", "value"],
    )


def pair_sums(groups: DataFrame, counts: DataFrame, kept: DataFrame) -> DataFrame:
    """``(lang, source, item, value)`` for each two sources of a language, both ways.

    A group of work has the terms of one bucket and the sources of two tiles,
    both of bounded size, however many terms and sources there are.
    """
    sizes = groups.groupBy("lang", "terms").agg(F.count("*").alias("sources")).select(
        "lang", F.ceil(F.col("sources") / TILE).cast("int").alias("tiles"),
        F.greatest(F.lit(1), F.ceil(F.col("terms") * F.least("sources", F.lit(2 * TILE)) / CELLS)).cast("int").alias("buckets"),
    )

    def dealt(name: str, parts: str) -> Column:
        return F.pmod(F.xxhash64(name), F.col(parts)).cast("int")

    every_tile = F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("other")
    tiles = [F.least("tile", "other").alias("tile_a"), F.greatest("tile", "other").alias("tile_b")]
    terms = kept.select("lang", F.expr("cast(substr(prefix, 1, length(prefix) - 1) as string)").alias("term"))
    per_bucket = terms.join(sizes, "lang").groupBy("lang", dealt("term", "buckets").alias("bucket")).agg(F.count("*").alias("n_terms"))
    absent = (
        groups.join(sizes, "lang")
        .select("lang", "source", F.col("p_absent").alias("p"), "tiles", dealt("source", "tiles").alias("tile"),
                F.explode(F.sequence(F.lit(0), F.col("buckets") - 1)).alias("bucket"))
        .join(per_bucket, ["lang", "bucket"], "left")
        .select("lang", "bucket", "source", "tile", F.lit(None).cast("string").alias("term"), F.coalesce("p", F.lit(1)).alias("p"),
                F.coalesce("n_terms", F.lit(0)).alias("n_terms"), every_tile)
    )
    present = (
        counts.join(sizes, "lang")
        .select("lang", dealt("term", "buckets").alias("bucket"), "source", dealt("source", "tiles").alias("tile"), "term", "p",
                F.lit(0).cast("long").alias("n_terms"), every_tile)
    )
    rows = absent.unionByName(present).select("*", *tiles).drop("other")
    sums = rows.groupBy(*GROUP).applyInArrow(compare_group, "lang string, a string, b string, value long")
    one_way = sums.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    ways = [F.struct(F.col(x).alias("source"), F.col(y).alias("item")) for x, y in ("ab", "ba")]
    return one_way.select("lang", F.inline(F.array(*ways)), "value")


def source_divergence(docs: DataFrame, least: int = 10, top: int = 10) -> DataFrame:
    """``lang, source, part, item, value, rank``: which sources differ, and by which terms.

    Terms are stretches of ASCII letters, A-Z as a-z, and characters beyond
    ASCII; a language keeps those of ``least`` of its documents. The share p of
    a term is smoothed by 2 and counted in billionths; two shares differ by
    (p - q)^2 / (p + q), all in whole numbers, rounded down.

    * part ``pair``: for each other source of the language the sum over all
      kept terms, greatest first;
    * part ``term``: the ``top`` kept terms that the source uses more than its
      language does, greatest first.

    Ties go by item in byte order. Null texts, languages and sources are read
    as empty; an empty language or source is one like any other. Rows of equal
    ids are one document where documents are counted, a row without an id is
    one of its own, and each row's occurrences count. A source without terms
    has pairs; a language without kept terms has pairs of value 0; one source
    alone has none. An empty table gives no rows. Other columns aren't looked
    at. ``docs`` is read once for each level of prefixes and twice more.
    """
    texts = with_groups(docs)
    kept = frequent_terms(texts, least)
    counts = stored(term_counts(texts, kept), "term-counts")
    terms = kept.groupBy("lang").agg(F.count("*").alias("terms"))
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = (
        texts.select("lang", "source").distinct().join(terms, "lang", "left").join(totals, ["lang", "source"], "left")
        .select("lang", "source", F.coalesce("terms", F.lit(0)).alias("terms"), F.coalesce("total", F.lit(0)).alias("total"))
    )
    groups = stored(groups.withColumn("p_absent", F.when(F.col("terms") > 0, share("0L", "total", "terms"))), "groups")
    shares = (
        counts.join(groups.drop("p_absent"), ["lang", "source"])
        .select("lang", "source", "term", share("n", "total", "terms").alias("p"))
    )
    of_lang = groups.groupBy("lang").agg(F.sum("total").alias("total"), F.first("terms").alias("terms"))
    whole = (
        counts.groupBy("lang", "term").agg(F.sum("n").alias("n")).join(of_lang, "lang")
        .select("lang", "term", share("n", "total", "terms").alias("q"))
    )
    used_more = (
        shares.join(whole, ["lang", "term"]).where("p > q")
        .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), difference("p", "q").alias("value"))
    )
    pairs = pair_sums(groups, shares, kept).withColumn("part", F.lit("pair"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")

    def numbered(rows: DataFrame) -> DataFrame:
        return rows.withColumn("rank", F.row_number().over(order)).select("lang", "source", "part", "item", "value", "rank")

    return numbered(pairs).unionByName(numbered(used_more).where(F.col("rank") <= top))
