"""Run one file job: ``python -m corpusvec <job> ...`` or through spark-submit."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from corpusvec.operators.subwords import learn_vocabulary
from corpusvec.operators.training import TrainingOptions
from corpusvec.operators.word_count import word_count
from corpusvec.plans import files
from corpusvec.plans.jobs import run_corpus
from corpusvec.session import ship_package
from corpusvec.sources import read_documents


def arguments() -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="corpusvec")
    job = parser.add_subparsers(dest="job", required=True)

    def add(name: str, *paths: str) -> argparse.ArgumentParser:
        one = job.add_parser(name)
        for path in paths:
            one.add_argument(path)
        return one

    for name in ("shard-lines", "position-words"):
        one = add(name, "input", "output")
        one.add_argument("--lines", type=int, default=500)
        one.add_argument("--packed", action="store_true", help="many shards a file, with a manifest")
    learn = add("learn-vocabulary", "input", "output")
    learn.add_argument("--merges", type=int, required=True)
    add("count-words", "input", "vocabulary", "output")
    add("order-tokens", "input", "vocabulary", "output")
    train = add("train-embeddings", "input", "vocabulary", "output")
    train.add_argument("--rows", type=int, default=10_000)
    train.add_argument("--epochs", type=int, default=10)
    train.add_argument("--dim", type=int, default=50)
    train.add_argument("--window", type=int, default=8)
    train.add_argument("--stride", type=int, default=2)
    train.add_argument("--learning-rate", type=float, default=1e-3)
    whole = add("run-corpus", "documents", "output")
    whole.add_argument("--merges", type=int, required=True)
    whole.add_argument("--rows", type=int, default=10_000)
    whole.add_argument("--top", type=int, default=5)
    add("find-similar", "input", "output").add_argument("--top", type=int, default=5)
    return parser.parse_args()


def main() -> None:
    a = arguments()
    spark = SparkSession.builder.appName(f"corpusvec {a.job}").getOrCreate()
    ship_package(spark)
    if a.job == "shard-lines":
        files.shard_lines(spark, a.input, a.output, a.lines, a.packed)
    elif a.job == "learn-vocabulary":
        files.learn(spark, a.input, a.output, a.merges)
    elif a.job == "count-words":
        files.count_words(spark, a.input, a.vocabulary, a.output)
    elif a.job == "position-words":
        files.position_words(spark, a.input, a.output, a.lines, a.packed)
    elif a.job == "order-tokens":
        files.order_tokens(spark, a.input, a.vocabulary, a.output)
    elif a.job == "train-embeddings":
        options = TrainingOptions(
            window=a.window, stride=a.stride, dim=a.dim, epochs=a.epochs, learning_rate=a.learning_rate
        )
        files.train_embeddings(spark, a.input, a.vocabulary, a.output, a.rows, options)
    elif a.job == "run-corpus":
        docs = read_documents(spark, a.documents)
        vocabulary = learn_vocabulary(word_count(docs), a.merges)
        run_corpus(docs, a.output, vocabulary, a.top, a.rows)
    else:
        files.find_similar(spark, a.input, a.output, a.top)
    spark.stop()


if __name__ == "__main__":
    main()
