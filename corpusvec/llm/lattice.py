"""Likelihood of texts over all segmentations into sub-word pieces."""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusvec.llm.common import stored, texts_of, words_of
from corpusvec.llm.lexicon import document_sums, word_counts

SPACE = "▁"
#: Added to a rank before its reciprocal is taken (Zipf and Mandelbrot).
RANK_OFFSET = 2.7
#: Pieces that the vocabulary's own scores count as beside the corpus.
PRIOR = 100.0
#: Where a word's probability is less, its double may have lost digits on the way.
SMALL = 1e-250


def vocabulary_weights(path: str) -> dict[str, float]:
    """Weights of the pieces of an existing vocabulary from its scores, adding up to 1.

    Scores that are log probabilities are taken as they are; whole numbers are
    ranks, and a piece of rank r weighs ``1 / (r + RANK_OFFSET)``.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    usual = [i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
    score = {model.id_to_piece(i): model.get_score(i) for i in usual}
    ranks = all(s == round(s) for s in score.values())
    weight = {p: 1 / (RANK_OFFSET - s) if ranks else math.exp(s) for p, s in score.items()}
    total = sum(weight.values())
    return {p: w / total for p, w in weight.items()}


class Lattice:
    """All segmentations of words into weighted pieces, in log space.

    A character without a piece is spelt in bytes, each as likely as the least
    likely piece. A text ends as often as the likeliest piece occurs.
    """

    def __init__(self, weight: dict[str, float]) -> None:
        least, most = min(weight.values()), max(weight.values())
        total = sum(weight.values()) + 256 * least + most
        self.log = {p: math.log(w / total) for p, w in weight.items()}
        self.plain = {p: w / total for p, w in weight.items()}
        self.byte = math.log(least / total)
        self.longest = max(map(len, weight))
        # A text ends where the next word could start.
        inner = sum(w for p, w in weight.items() if not p.startswith(SPACE)) + 256 * least
        self.end = math.log(most / total) - math.log1p(-inner / total)

    def log_marginal(self, word: str) -> float:
        """Natural log of the summed probability of all segmentations of a word."""
        text = SPACE + word
        size = len(text)
        mass = [-math.inf] * (size + 1)
        mass[0] = 0.0
        log, longest = self.log, self.longest
        for i in range(size):
            here = mass[i]
            arcs = []
            if i == 0 or text[i] != SPACE:
                for j in range(i + 1, min(size, i + longest) + 1):
                    piece = log.get(text[i:j])
                    if piece is not None:
                        arcs.append((j, piece))
            if not arcs or arcs[0][0] != i + 1:
                arcs.append((i + 1, self.byte * len(text[i].encode("utf-8", "surrogatepass"))))
            for j, piece in arcs:
                old, value = mass[j], here + piece
                if old == -math.inf:
                    mass[j] = value
                elif old > value:
                    mass[j] = old + math.log1p(math.exp(value - old))
                else:
                    mass[j] = value + math.log1p(math.exp(old - value))
        return mass[size]

    def expect(self, word: str, into: dict[str, float]) -> None:
        """Add how often each piece occurs in a word, over all segmentations.

        In log space where a double can't hold the word's probability.
        """
        plain, longest = self.plain, self.longest
        text = SPACE + word
        size = len(text)
        mass, back = [0.0] * (size + 1), [0.0] * (size + 1)
        mass[0] = back[size] = 1.0
        leaving = []
        for i in range(size):
            here, arcs = mass[i], []
            if here == 0.0:
                break
            for j in range(i + 1, min(size, i + longest) + 1):
                piece = text[i:j]
                p = plain.get(piece)
                if p is not None:
                    mass[j] += here * p
                    arcs.append((j, p, piece))
            if not arcs or arcs[0][0] != i + 1:
                spelt = math.exp(self.byte * len(text[i].encode("utf-8", "surrogatepass")))
                mass[i + 1] += here * spelt
                arcs.append((i + 1, spelt, None))
            leaving.append(arcs)
        whole = mass[size]
        if whole < SMALL:
            return self.expect_in_logs(text, into)
        for i in range(size - 1, -1, -1):
            total, before = 0.0, mass[i] / whole
            for j, p, piece in leaving[i]:
                through = p * back[j]
                total += through
                if piece is not None:
                    into[piece] = into.get(piece, 0.0) + before * through
            back[i] = total

    def expect_in_logs(self, text: str, into: dict[str, float]) -> None:
        """`expect` of a word of any length and any probability."""
        log, longest = self.log, self.longest
        size = len(text)
        mass, back = [-math.inf] * (size + 1), [-math.inf] * (size + 1)
        mass[0] = back[size] = 0.0

        def added(a: float, b: float) -> float:
            most = max(a, b)
            return most if most == -math.inf else most + math.log1p(math.exp(min(a, b) - most))

        leaving = []
        for i in range(size):
            arcs = []
            for j in range(i + 1, min(size, i + longest) + 1):
                p = log.get(text[i:j])
                if p is not None:
                    arcs.append((j, p, text[i:j]))
            if not arcs or arcs[0][0] != i + 1:
                arcs.append((i + 1, self.byte * len(text[i].encode("utf-8", "surrogatepass")), None))
            for j, p, _ in arcs:
                mass[j] = added(mass[j], mass[i] + p)
            leaving.append(arcs)
        whole = mass[size]
        for i in range(size - 1, -1, -1):
            for j, p, piece in leaving[i]:
                through = p + back[j]
                back[i] = added(back[i], through)
                if piece is not None:
                    into[piece] = into.get(piece, 0.0) + math.exp(mass[i] + through - whole)


def learned_weights(counts: DataFrame, path: str, rounds: int) -> dict[str, float]:
    """The vocabulary's weights moved towards the training words.

    In each round each distinct training word gives its pieces, over all
    segmentations under the present weights, the weight of one word; the
    vocabulary's own scores come first and count as `PRIOR` pieces after that.
    The sums have one row for each piece of the vocabulary.
    """
    own = vocabulary_weights(path)
    words = counts.where("n_train > 0").select("unit")
    weights = own
    for _ in range(rounds):
        sent = counts.sparkSession.sparkContext.broadcast(weights)

        def expect(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            lattice, found = Lattice(sent.value), {}
            for batch in batches:
                for word in batch.column(0).to_pylist():
                    lattice.expect(word.decode("utf-8", "replace"), found)
            yield pa.RecordBatch.from_arrays(
                [pa.array(found, pa.string()), pa.array(found.values(), pa.float64())], names=["piece", "times"]
            )

        sums = words.mapInArrow(expect, "piece string, times double")
        weights = {p: PRIOR * w for p, w in own.items()}
        for r in sums.groupBy("piece").agg(F.sum("times").alias("times")).collect():
            weights[r["piece"]] += r["times"]
        total = sum(weights.values())
        weights = {p: w / total for p, w in weights.items()}
    return weights


def with_marginals(counts: DataFrame, weights: dict[str, float]) -> DataFrame:
    """Add ``lattice``, the log marginal of each distinct word."""
    sent = counts.sparkSession.sparkContext.broadcast(weights)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Lattice(sent.value)
        for batch in batches:
            words = batch.column(0).to_pylist()
            found = [model.log_marginal(w.decode("utf-8", "replace")) for w in words]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(found, pa.float64())], names=[*batch.schema.names, "lattice"]
            )

    return counts.select("unit", "n", "n_train").mapInArrow(
        score, "unit binary, n long, n_train long, lattice double"
    )


def score_texts(docs: DataFrame, train: Column, vocabulary_path: str, rounds: int = 1) -> DataFrame:
    """Log10 probabilities of every text, learned where ``train`` holds.

    The vocabulary's scores weigh its pieces, moved towards the training
    words (`learned_weights`). A text is its words, A-Z in lower case, then one end. A word's lattice has
    an arc for each piece of the vocabulary and one for the word as a whole,
    weighed by its count among training words; the forward recursion sums over
    all ways through. With N training tokens of which s occur once, the whole
    word has probability ``count / (N + s)`` and the pieces share ``s / (N +
    s)``. No piece reaches over white space, so a text's marginal is the
    product of its words', and each distinct word is worked out once.

    Returns ``doc_id, n_tokens, n_known, train_tokens, base_score, score`` for
    every row of ``docs``. A null or empty text is one end; with nothing to
    learn from, the base score is 0 and the pieces have all the weight.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), F.coalesce(train, F.lit(False)).alias("train"))
    counted = stored(word_counts(texts, words_of), "words")
    weights = learned_weights(counted, vocabulary_path, rounds)
    counts = stored(with_marginals(counted, weights), "marginals")
    seen = counts.agg(
        F.sum("n_train").alias("words"),
        F.count_if(F.col("n_train") > 0).alias("kinds"),
        F.count_if(F.col("n_train") == 1).alias("once"),
    ).first()
    ends = texts.where("train").count()
    tokens, kinds, once = (seen["words"] or 0) + ends, seen["kinds"] + (ends > 0), max(1, seen["once"])

    def base(count: Column) -> Column:
        return F.log10((count + 0.1) / (tokens + 0.1 * (kinds + 1)))

    def model(count: Column, lattice: Column) -> Column:
        # Very unlikely words would vanish outside log space.
        unseen = math.log10(once) + lattice / math.log(10)
        return F.when(count > 0, F.log10(count + once * F.exp(lattice))).otherwise(unseen) - math.log10(tokens + once)

    count, lattice = F.col("n_train"), F.col("lattice")
    known = (count > 0).cast("double")
    table = counts.select("unit", "n", F.array(base(count), model(count, lattice), known).alias("values"))
    sums = document_sums(texts_of(docs), words_of, table, ["base", "model", "known"])
    return sums.select(
        "doc_id",
        (F.col("n_units") + 1).alias("n_tokens"),
        (F.col("known").cast("long") + int(ends > 0)).alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("base") + base(F.lit(ends))).alias("base_score"),
        (F.col("model") + model(F.lit(ends), F.lit(Lattice(weights).end))).alias("score"),
    )
