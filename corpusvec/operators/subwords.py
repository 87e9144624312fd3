"""Byte-pair sub-words: learning a vocabulary, encoding and decoding.

A vocabulary is a table ``(token_id INT, token_bytes BINARY)``: either a
published file (see ``sources.vocabulary_file``) or learned here from word
frequencies. Its size is a parameter, never a function of the data.
"""

from __future__ import annotations

import heapq
from array import array
from collections import ChainMap
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusvec.operators import merges as merges_of
from corpusvec.session import materialize, spread_work

# Fixed value: the published pre-split pattern of the GPT-4 vocabulary.
GPT4_PATTERN = (
    r"(?i:'s|'t|'re|'ve|'m|'ll|'d)|[^\r\n\p{L}\p{N}]?+\p{L}+|\p{N}{1,3}"
    r"| ?[^\s\p{L}\p{N}]++[\r\n]*|\s*[\r\n]|\s+(?!\S)|\s+"
)

# A vocabulary up to this many entries is sent to every task (about 100 MB);
# a larger one is joined instead.
BROADCAST_TOKENS = 1_000_000
# Bytes of pieces and their tokens that a task remembers before it starts over,
# and what an entry takes besides its text and tokens.
MEMO_BYTES, MEMO_ENTRY = 1 << 24, 256
# Pieces of so many bytes are merged many at a time, if the vocabulary has at
# most so many tokens; and a key above all offers to merge.
SHORT_PIECE, DENSE_TOKENS, NO_OFFER = 64, 1024, np.iinfo(np.int64).max

BYTE_TOKENS = 256

# Merges that a pass over the pieces replays at most, before they are written anew.
REPLAYED = 512
# Pairs for whose pieces a round of learning is worth fetching them.
FETCHED_PAIRS = 8


def pieces_of(text: Column) -> Column:
    """Pieces that sub-words never cross, in order; joined they give the text."""
    return F.regexp_extract_all(text, F.lit(GPT4_PATTERN), F.lit(0))


# --- learning -------------------------------------------------------------
#
# For counting, a piece is written as one <hex> per symbol, which Spark splits
# inside generated code. Learning has a number for each symbol.


def piece_symbols(word_counts: DataFrame) -> DataFrame:
    """``(symbols, frequency)``: pieces of counted words as single bytes."""
    pieces = word_counts.select(F.explode(pieces_of(F.col("word"))).alias("piece"), "frequency")
    # Summed in each task first; then spread, as the rounds of replacing that
    # follow make these few bytes dear.
    counted = pieces.groupBy("piece").agg(F.sum("frequency").alias("frequency"))
    return spread_work(counted, "piece").select(
        F.regexp_replace(F.lower(F.hex("piece")), "(..)", "<$1>").alias("symbols"), "frequency"
    )


def pair_counts(symbols: DataFrame) -> DataFrame:
    """``(left, right, frequency)`` of adjacent symbols, weighted by piece."""
    parts = F.split(F.btrim("symbols", F.lit("<>")), "><")
    # A filter on the number of parts would be pushed below this and split
    # every piece twice; a single part simply gives no pairs.
    neighbours = F.greatest(F.size("parts") - 1, F.lit(0))
    return (
        symbols.select(parts.alias("parts"), "frequency")
        .select(
            F.explode(
                F.zip_with(
                    F.slice("parts", F.lit(1), neighbours),
                    F.slice("parts", F.lit(2), neighbours),
                    lambda a, b: F.struct(a.alias("left"), b.alias("right")),
                )
            ).alias("pair"),
            "frequency",
        )
        .groupBy("pair.left", "pair.right")
        .agg(F.sum("frequency").alias("frequency"))
    )


def _flat(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols, their pieces and the pieces' frequencies of rows ``(symbols BINARY, frequency)``."""
    held = batch.column(0).cast(pa.large_binary())
    _, offsets, data = held.buffers()
    ends = np.frombuffer(offsets, np.int64)[held.offset : held.offset + len(held) + 1]
    symbols = np.frombuffer((data or pa.py_buffer(b"")).slice(ends[0], ends[-1] - ends[0]), "<i4")
    piece = np.repeat(np.arange(len(held)), np.diff(ends) // 4)
    return symbols, piece, batch.column(1).to_numpy(zero_copy_only=False)


def _rows(symbols: np.ndarray, piece: np.ndarray, frequency: np.ndarray) -> pa.RecordBatch:
    """The same pieces as rows again."""
    ends = np.concatenate([[0], np.cumsum(np.bincount(piece, minlength=len(frequency)))]) * 4
    data = pa.py_buffer(np.ascontiguousarray(symbols, "<i4"))
    held = pa.Array.from_buffers(pa.large_binary(), len(frequency), [None, pa.py_buffer(ends.astype(np.int64)), data])
    return pa.RecordBatch.from_arrays([held.cast(pa.binary()), pa.array(frequency, pa.int64())], names=["symbols", "frequency"])


Step = tuple[merges_of.Pair, int]


def _replayed(state: DataFrame, log: list[Step], then, schema: str) -> DataFrame:
    """``then(symbols, piece, frequency)`` of the pieces, once the merges of ``log`` are made."""
    log = list(log)

    def replay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            symbols, piece, frequency = _flat(batch)
            for pair, merged in log:
                symbols, piece, _ = merges_of.merge(symbols, piece, pair, merged)
            yield then(symbols, piece, frequency)

    return state.mapInArrow(replay, schema)


PIECE_ROWS = "symbols binary, frequency long"
CHANGES = "step int, left int, right int, n long, places long"


def _change_rows(changes: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
    step = np.repeat(np.arange(len(changes)), [len(c[0]) for c in changes])
    left, right, n, places = (np.concatenate(c) for c in zip(*changes))
    kinds = {"step": pa.int32(), "left": pa.int32(), "right": pa.int32(), "n": pa.int64(), "places": pa.int64()}
    return pa.RecordBatch.from_arrays(
        [pa.array(c).cast(t) for c, t in zip((step, left, right, n, places), kinds.values())], names=list(kinds)
    )


def _collected(changes: DataFrame, steps: int) -> list[tuple[np.ndarray, ...]]:
    """Sums of changes for each step, added up in Spark."""
    rows = changes.groupBy("step", "left", "right").agg(F.sum("n").alias("n"), F.sum("places").alias("places"))
    table = rows.where("n <> 0 OR places <> 0").toArrow()
    step, *columns = (table.column(c).to_numpy() for c in ("step", "left", "right", "n", "places"))
    return [tuple(c[step == k] for c in columns) for k in range(steps)]


def learn_vocabulary(
    word_counts: DataFrame, merges: int, merges_per_round: int = 32, pieces_per_round: int = 1 << 18
) -> DataFrame:
    """Vocabulary of the 256 bytes and up to ``merges`` merged pairs.

    The rule is the textbook one: merge the most frequent pair, ties to the
    smaller in byte order, count again. Pairs are counted once; after that
    rounds of two kinds make merges and keep the sums of all pairs exact.

    * While the best pairs are in very many pieces, a round guesses the next
      merges, ``merges_per_round`` at most, asks the pieces in one pass for the
      change of all sums with each of them, and keeps merges as long as each
      was indeed the best at its turn.
    * Once a few of the best pairs are together in no more than
      ``pieces_per_round`` pieces, a round fetches the pieces that hold any of
      as many of the best pairs as that allows, and merges in those alone. It
      goes on as long as the best pair is one of these, or has a symbol made in
      this round, since all of its places are then in the pieces at hand.

    Neither number changes the result, and the last merge needs no round, as
    nobody asks for the sums behind it. The pieces stay in Spark; merges made
    since they were last written are replayed over them. The driver holds the
    pieces of a round, never more than ``pieces_per_round``, and the sums of
    pairs, whose number is bounded by the square of the vocabulary's size,
    which is a parameter.
    """
    pieces = word_counts.select(F.explode(pieces_of(F.col("word"))).alias("piece"), "frequency")
    counted = spread_work(pieces.groupBy("piece").agg(F.sum("frequency").alias("frequency")), "piece")
    state = materialize(counted.select(F.col("piece").cast("binary").alias("symbols"), "frequency").mapInArrow(_as_symbols, PIECE_ROWS))
    names = [f"{b:02x}" for b in range(BYTE_TOKENS)]
    numbers = {name: k for k, name in enumerate(names)}
    queue = merges_of.PairQueue(names)
    first = _replayed(state, [], lambda s, p, f: _change_rows([merges_of.pair_sums(s, p, f)]), CHANGES)
    queue.change(*_collected(first, 1)[0])
    log: list[Step] = []
    done = 0

    def symbol_of(pair: merges_of.Pair) -> int:
        name = names[pair[0]] + names[pair[1]]
        if name not in numbers:
            numbers[name] = len(names)
            names.append(name)
        return numbers[name]

    while done < merges and (best := queue.best()) is not None:
        if done == merges - 1:
            symbol_of(best)
            break
        hot = queue.best_of(merges - done, pieces_per_round)
        made = len(log)
        # The best pair alone may be in more pieces than the driver can hold.
        bounded = sum(queue.places[pair] for pair in hot) <= pieces_per_round
        if bounded and len(hot) >= min(FETCHED_PAIRS, merges_per_round, merges - done):
            codes = merges_of.pair_codes(hot)

            def holding(symbols, piece, frequency, codes=codes):
                held = merges_of.holds_any(symbols, piece, codes, len(frequency))
                place, stays = np.cumsum(held) - 1, held[piece]
                return _rows(symbols[stays], place[piece[stays]], frequency[held])

            fetched = _replayed(state, log, holding, PIECE_ROWS).toArrow().combine_chunks().to_batches()
            symbols, piece, frequency = _flat(fetched[0]) if fetched else (np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64))
            covered, oldest = set(hot), len(names)
            while done < merges and (pair := queue.best()) is not None and (pair in covered or max(pair) >= oldest):
                log.append((pair, symbol_of(pair)))
                symbols, piece, changes = merges_of.merge_with_changes(symbols, piece, frequency, *log[-1])
                queue.change(*changes)
                done += 1
        else:
            # A pair that overlaps a better one loses by its merge and waits.
            guesses: list[merges_of.Pair] = []
            lefts, rights = set(), set()
            for pair in queue.best_of(8 * merges_per_round, 1 << 62):
                if len(guesses) < min(merges_per_round, merges - done) and pair[0] not in rights and pair[1] not in lefts:
                    guesses.append(pair)
                    lefts.add(pair[0])
                    rights.add(pair[1])
            # Names of guesses that come to nothing are given back below.
            known = len(names)
            steps = [(pair, symbol_of(pair)) for pair in guesses]

            def changed(symbols, piece, frequency, steps=steps):
                out = []
                for pair, merged in steps:
                    symbols, piece, changes = merges_of.merge_with_changes(symbols, piece, frequency, pair, merged)
                    out.append(changes)
                return _change_rows(out)

            for step, changes in zip(steps, _collected(_replayed(state, log, changed, CHANGES), len(steps))):
                if queue.best() != step[0]:
                    break
                log.append(step)
                queue.change(*changes)
                done += 1
            kept = max([known - 1, *(merged for _, merged in log[made:])]) + 1
            for name in names[kept:]:
                del numbers[name]
            del names[kept:]
        if len(log) >= REPLAYED and done < merges:
            # What each pass replays, and a lost task redoes, stays short.
            state, log = materialize(_replayed(state, log, _rows, PIECE_ROWS)), []
    return vocabulary_from(word_counts.sparkSession, {name: k for k, name in enumerate(names) if k >= BYTE_TOKENS})


def _as_symbols(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bytes as symbols of four bytes each."""
    for batch in batches:
        held = [np.frombuffer(piece, np.uint8).astype("<i4").tobytes() for piece in batch.column(0).to_pylist()]
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.binary()), batch.column(1)], names=["symbols", "frequency"])


def vocabulary_from(spark: SparkSession, merged: dict[str, int]) -> DataFrame:
    """The byte tokens and the given ``hex -> id`` entries as a table."""
    tokens = [bytes([b]) for b in range(BYTE_TOKENS)] + [bytes.fromhex(h) for h in merged]
    ids = [*range(BYTE_TOKENS), *merged.values()]
    # From Arrow it becomes a local relation, whose size the planner knows.
    return spark.createDataFrame(
        pa.table({"token_id": pa.array(ids, pa.int32()), "token_bytes": pa.array(tokens, pa.binary())})
    )


# --- encoding -------------------------------------------------------------


def _merge_piece(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Token ids of one piece: always merge the leftmost pair of lowest rank."""
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    n = len(piece)
    # end[i] is where the symbol starting at byte i stops; before[i] where the
    # symbol in front of it starts. The heap makes long pieces n log n.
    end = list(range(1, n + 1))
    before = list(range(-1, n - 1))
    queue: list[tuple[int, int, int]] = []

    def offer(start: int) -> None:
        middle = end[start]
        if middle < n:
            rank = ranks.get(piece[start : end[middle]])
            if rank is not None:
                heapq.heappush(queue, (rank, start, end[middle]))

    for i in range(n - 1):
        offer(i)
    while queue:
        _, start, stop = heapq.heappop(queue)
        middle = end[start]
        # Skip offers that an earlier merge has made stale.
        if middle in (0, n) or end[middle] != stop:
            continue
        end[start], end[middle] = stop, 0
        if stop < n:
            before[stop] = start
        offer(start)
        if before[start] >= 0:
            offer(before[start])
    ids, i = [], 0
    while i < n:
        ids.append(ranks[piece[i : end[i]]])
        i = end[i]
    return ids


class _Merger:
    """Merges many short pieces at once, for vocabularies of at most `DENSE_TOKENS`.

    Follows :func:`_merge_piece`: in each round every piece merges its leftmost
    pair of lowest rank. Symbols are numbered, and a table says which symbol two
    of them make.
    """

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        number = {text: k for k, text in enumerate(ranks)}
        self.known = len(ranks) <= DENSE_TOKENS and all(bytes([b]) in ranks for b in range(BYTE_TOKENS))
        if self.known:
            self.ids = np.array([*ranks.values()], np.int64)
            self.bytes = np.array([number[bytes([b])] for b in range(BYTE_TOKENS)], np.int32)
            self.made = np.full((len(ranks), len(ranks)), -1, np.int32)
            for text, k in number.items():
                for at in range(1, len(text)):
                    left, right = number.get(text[:at]), number.get(text[at:])
                    if left is not None and right is not None:
                        self.made[left, right] = k

    def tokens(self, pieces: list[bytes]) -> list[array]:
        """Token ids of each piece."""
        found = [None if (whole := self.ranks.get(p)) is None else array("i", (whole,)) for p in pieces]
        short = [k for k, p in enumerate(pieces) if found[k] is None and self.known and 0 < len(p) <= SHORT_PIECE]
        if short:
            ids, ends = self._merged([pieces[k] for k in short])
            begin = 0
            for k, end in zip(short, ends):
                found[k] = ids[begin:end]
                begin = end
        return [array("i", _merge_piece(p, self.ranks)) if t is None else t for p, t in zip(pieces, found)]

    def _merged(self, pieces: list[bytes]) -> tuple[array, list[int]]:
        """Token ids of all pieces, and where each piece's end."""
        symbols = self.bytes[np.frombuffer(b"".join(pieces), np.uint8)]
        piece = np.repeat(np.arange(len(pieces)), [len(p) for p in pieces])
        done = []
        while len(symbols):
            place = np.arange(len(symbols))
            made = np.append(self.made[symbols[:-1], symbols[1:]], -1)
            offered = (made >= 0) & (piece == np.append(piece[1:], -1))
            # The lowest rank of a piece, then the leftmost place.
            keys = np.where(offered, self.ids[made] << 32 | place, NO_OFFER)
            begins = np.flatnonzero(np.diff(piece, prepend=-1))
            best = np.minimum.reduceat(keys, begins)
            merges = best != NO_OFFER
            at = best[merges] & 0xFFFFFFFF
            symbols[at] = made[at]
            stays = np.repeat(merges, np.diff(begins, append=len(symbols)))
            done.append((symbols[~stays], piece[~stays]))
            stays[at + 1] = False
            symbols, piece = symbols[stays], piece[stays]
        symbols, piece = (np.concatenate(c) for c in zip(*done))
        order = np.argsort(piece, kind="stable")
        ids = array("i", self.ids[symbols[order]].astype(np.int32).tobytes())
        return ids, np.cumsum(np.bincount(piece, minlength=len(pieces))).tolist()


class _Memo:
    """Tokens of the pieces that a task met, of about `MEMO_BYTES` at most."""

    def __init__(self, ranks: dict[bytes, int]):
        self.merger, self.known, self.size = _Merger(ranks), {}, 0

    def tokens(self, pieces: list[str]) -> list[array]:
        """Token ids of each of some different pieces; all new ones are merged together."""
        found = list(map(self.known.get, pieces))
        new = [k for k, tokens in enumerate(found) if tokens is None]
        for k, tokens in zip(new, self.merger.tokens([pieces[k].encode() for k in new])):
            found[k] = tokens
            size = MEMO_ENTRY + len(pieces[k]) + 8 * len(tokens)
            if self.size + size > MEMO_BYTES:
                self.known.clear()
                self.size = 0
            self.known[pieces[k]] = tokens
            self.size += size
        return found


def _encode_batch(pieces: pa.ListArray, memo: _Memo) -> pa.ListArray:
    """Encode a batch of piece lists, each distinct piece once."""
    distinct = pieces.flatten().dictionary_encode()
    tokens = memo.tokens(distinct.dictionary.to_numpy(zero_copy_only=False).tolist())
    ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)))
    ids = pa.array(np.frombuffer(b"".join(tokens), np.int32))
    by_piece = pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), ids)
    taken = by_piece.take(distinct.indices)
    # A word's tokens are those of its pieces, one after the other.
    ends = taken.offsets.take(pc.subtract(pieces.offsets, pieces.offsets[0]))
    return pa.ListArray.from_arrays(ends, taken.flatten())


def _encoder(vocabulary: DataFrame):
    """A function from an array of pieces to token ids, or None if too large."""
    entries = vocabulary.select("token_bytes", "token_id").limit(BROADCAST_TOKENS + 1).collect()
    if len(entries) > BROADCAST_TOKENS:
        return None
    ranks: dict[bytes, int] = {}
    for token_bytes, token_id in entries:
        ranks[bytes(token_bytes)] = min(token_id, ranks.get(bytes(token_bytes), token_id))
    shared = vocabulary.sparkSession.sparkContext.broadcast(ranks)

    @F.arrow_udf("array<int>")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        memo = _Memo(shared.value)
        for batch in batches:
            yield _encode_batch(batch, memo)

    return encode


def encode_words(
    df: DataFrame, vocabulary: DataFrame, word: str = "word", one_piece: bool = False
) -> DataFrame:
    """Add ``token_ids ARRAY<INT>`` for a word column.

    Rows are encoded where they are: only the pieces travel to Python, in
    Arrow batches whose distinct pieces are encoded once, so neither a
    shuffle nor a frequent word costs anything. ``one_piece`` skips the
    pre-split for words known to be a single piece, such as pure letters.
    """
    encode = _encoder(vocabulary)
    if encode is None:
        return encode_words_by_join(df, vocabulary, word)
    pieces = F.array(word) if one_piece else pieces_of(F.col(word))
    return df.withColumn("token_ids", encode(pieces))


def encode_slices(df: DataFrame, vocabulary: DataFrame, words: str = "words") -> DataFrame:
    """Replace an array of single-piece words by the tokens of all of them.

    With a vocabulary too large to send, the words are encoded one a row and
    put together again by ``(shard_id, row_index)``.
    """
    encode = _encoder(vocabulary)
    if encode is not None:
        return df.withColumn("token_ids", encode(F.col(words))).drop(words)
    each = df.select("shard_id", "row_index", F.posexplode(words).alias("i", "word"))
    parts = F.array_sort(F.collect_list(F.struct("i", "token_ids")))
    return (
        encode_words_by_join(each, vocabulary)
        .groupBy("shard_id", "row_index")
        .agg(F.flatten(parts["token_ids"]).alias("token_ids"))
    )


def tokens_held(pieces: DataFrame, tokens: DataFrame) -> DataFrame:
    """``(id, token_bytes, token_id)``: tokens of three bytes or more that a piece ``(id, piece)`` holds.

    The vocabulary is cut by prefix into levels of a trie: tokens of up to 4
    bytes, of up to 8, of up to 16, and so on, and the prefixes under which
    there are longer ones. Each place of a piece walks down the levels by
    joins, and leaves as soon as no longer token begins with what stands there,
    so that it looks up a few strings and not one for each possible length.
    """
    tokens = tokens.select("token_bytes", "token_id", F.octet_length("token_bytes").alias("size"))
    deepest = tokens.agg(F.max("size")).first()[0] or 0
    n = F.octet_length("piece")
    # Where a piece goes on beyond the longest token, the rest is of no use here.
    walks = pieces.where(n >= 3).select(
        "id", F.explode(F.transform(F.sequence(F.lit(1), n - 2), lambda i: F.substring(F.col("piece"), i, F.lit(deepest)))).alias("rest")
    )
    held, depth = None, 2
    while depth < deepest:
        above, depth = depth, 2 * depth
        ahead = F.octet_length("rest")
        lengths = F.sequence(F.lit(above + 1), F.least(ahead, F.lit(depth)))
        looked_up = walks.where(ahead > above).select("id", F.explode(F.transform(lengths, lambda k: F.substring(F.col("rest"), F.lit(1), k))).alias("token_bytes"))
        level = tokens.where((F.col("size") > above) & (F.col("size") <= depth)).select("token_bytes", "token_id")
        found = looked_up.join(level, "token_bytes")
        held = found if held is None else held.unionByName(found)
        if depth < deepest:
            front = F.substring(F.col("rest"), F.lit(1), F.lit(depth))
            deeper = tokens.where(F.col("size") > depth).select(F.substring("token_bytes", 1, depth).alias("front")).distinct()
            walks = materialize(walks.where(ahead > depth).withColumn("front", front).join(deeper, "front", "left_semi").drop("front"))
    if held is None:
        held = pieces.sparkSession.createDataFrame([], "id long, token_bytes binary, token_id int")
    return held.distinct()


def encode_words_by_join(df: DataFrame, vocabulary: DataFrame, word: str = "word") -> DataFrame:
    """The same for a vocabulary too large to send to every task.

    A piece needs only those tokens that it holds (:func:`tokens_held`), and is
    merged with them by the same code. Tokens of one or two bytes, which most
    pieces share and of which there are at most 65,792, are sent. Each distinct
    piece is encoded once.
    """
    spark = df.sparkSession
    tokens = vocabulary.groupBy("token_bytes").agg(F.min("token_id").alias("token_id"))
    size = F.octet_length("token_bytes")
    short = spark.sparkContext.broadcast(
        {bytes(r["token_bytes"]): r["token_id"] for r in tokens.where(size <= 2).collect()}
    )
    words = df.select(F.col(word).alias("_word")).where(F.col(word).isNotNull()).distinct()
    parts = materialize(words.select("_word", F.posexplode(pieces_of(F.col("_word"))).alias("p", "piece")))
    # Written down, the ids stay what they are, also where a task is run again.
    distinct = parts.select(F.col("piece").cast("binary").alias("piece")).distinct()
    pieces = materialize(distinct.withColumn("id", F.monotonically_increasing_id()))
    known = (
        tokens_held(pieces, materialize(tokens))
        .groupBy("id")
        .agg(F.collect_list(F.struct("token_bytes", "token_id")).alias("known"))
    )

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = []
            for piece, held in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                own = {t["token_bytes"]: t["token_id"] for t in held or ()}
                ids.append(_merge_piece(piece, own | short.value if len(own) > len(short.value) else ChainMap(own, short.value)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(ids, pa.list_(pa.int32()))], names=["piece", "ids"]
            )

    coded = pieces.join(known, "id", "left").select("piece", "known").mapInArrow(merge, "piece binary, ids array<int>")
    encoded = (
        parts.withColumn("piece", F.col("piece").cast("binary")).join(coded, "piece", "left")
        .groupBy("_word")
        .agg(F.flatten(F.array_sort(F.collect_list(F.struct("p", "ids")))["ids"]).alias("token_ids"))
    )
    nothing = F.array().cast("array<int>")
    return (
        df.join(encoded, df[word] == encoded["_word"], "left")
        .withColumn("token_ids", F.coalesce("token_ids", nothing)).drop("_word")
    )


# --- decoding -------------------------------------------------------------


def token_text(token_bytes: Column) -> Column:
    """Bytes as text; what is no whole character becomes U+FFFD."""
    return F.make_valid_utf8(token_bytes.cast("string"))


def _known(value: Column, token_id: Column) -> Column:
    """The value, or an error for a token outside the vocabulary."""
    unknown = F.raise_error(F.concat(F.lit("no such token: "), token_id.cast("string")))
    return F.when(value.isNotNull() | token_id.isNull(), value).otherwise(unknown)


def decode_tokens(df: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """Add the text of ``token_id`` as ``word``; an unknown token fails the job."""
    texts = vocabulary.select("token_id", token_text(F.col("token_bytes")).alias("word"))
    joined = df.join(texts, "token_id", "left")
    return joined.withColumn("word", _known(F.col("word"), F.col("token_id")))


def decode_sequences(df: DataFrame, vocabulary: DataFrame, key: str) -> DataFrame:
    """``(key, text)`` from ``(key, token_ids)`` with a unique key.

    Tokens may split a character, so bytes are put together before they are
    read as text. A key without tokens has an empty text; an unknown token
    fails the job.
    """
    held = vocabulary.select("token_id", F.hex("token_bytes").alias("hex"))
    return (
        df.select(key, F.posexplode_outer("token_ids").alias("i", "token_id"))
        .join(held, "token_id", "left")
        .withColumn("hex", _known(F.col("hex"), F.col("token_id")))
        .groupBy(key)
        .agg(F.array_sort(F.collect_list(F.struct("i", "hex"))).alias("parts"))
        .select(key, token_text(F.unhex(F.array_join("parts.hex", ""))).alias("text"))
    )
