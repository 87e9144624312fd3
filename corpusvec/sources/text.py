"""Text scans: line files, folders of them, and a table of documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpusvec.operators.positions import with_totals_before
from corpusvec.session import materialize, spread
from corpusvec.sinks.writers import FILES_OF_TASK, MANIFEST

# Splits are broadcast up to this many rows (about 100 bytes each); beyond
# it both sides shuffle on the split.
BROADCAST_SPLITS = 200_000
# Lines of a packed file that are looked up together.
BLOCK_ROWS = 512


def natural_order(path: Column) -> Column:
    """A text that sorts as the path does with its numbers read as numbers.

    Runs of up to 20 digits are filled up to 20 with zeros.
    """
    filled = F.regexp_replace(path, r"([0-9]+)", "0" * 20 + "$1")
    return F.regexp_replace(filled, r"(?<![0-9])[0-9]{1,20}([0-9]{20})(?![0-9])", "$1")


def read_lines(spark: SparkSession, path: str | list[str], recursive: bool = False) -> DataFrame:
    """Lines of text files as ``(value)``; ``recursive`` descends into folders."""
    return spark.read.option("recursiveFileLookup", recursive).text(path)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """A documents table ``(doc_id BIGINT, text STRING)``, one row a document."""
    docs = spark.read.parquet(path).select("doc_id", "text")
    return spread(docs, "doc_id")


def _scanned(spark: SparkSession, path: str | list[str], recursive: bool) -> tuple[DataFrame, DataFrame]:
    """Lines ``(line, file, start, scan_id)``, and the splits ``(file, start, n, first_id)`` of the scan.

    The scan's increasing ids give a line's place in its split without moving
    any text: only one row a split is aggregated.
    """
    lines = read_lines(spark, path, recursive).select(
        F.col("value").alias("line"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("scan_id"),
    )
    splits = lines.groupBy("file", "start").agg(
        F.count("*").alias("n"), F.min("scan_id").alias("first_id")
    )
    return lines, materialize(splits)


def _shifted(lines: DataFrame, offsets: DataFrame) -> DataFrame:
    """Add ``number``: the line's scan id moved by the ``shift`` of its split."""
    offsets = materialize(offsets)
    if offsets.count() <= BROADCAST_SPLITS:
        offsets = F.broadcast(offsets)
    return lines.join(offsets, ["file", "start"]).withColumn("number", F.col("scan_id") + F.col("shift"))


def _before_in_file() -> Column:
    """Lines in earlier splits of the same file."""
    return F.sum("n").over(W.partitionBy("file").orderBy("start")) - F.col("n")


def numbered_lines(spark: SparkSession, path: str | list[str], recursive: bool = False) -> DataFrame:
    """Lines with their number over all files: ``(line_index BIGINT, line)``.

    Files count in path order, numbers in their names by value, so that
    ``part-100000`` comes after ``part-99999``. A line's number is the number
    of lines in earlier splits plus its place in its own split. Files are put
    in order by ranges of their names, so that no task orders all of them.
    """
    lines, splits = _scanned(spark, path, recursive)
    files = splits.groupBy("file").agg(F.sum("n").alias("n"))
    earlier = with_totals_before(files.withColumn("name", natural_order(F.col("file"))), ["name", "file"], "n", "file_offset")
    offsets = (
        splits.withColumn("split_offset", _before_in_file())
        .join(earlier.select("file", "file_offset"), "file")
        .select("file", "start", (F.col("file_offset") + F.col("split_offset") - F.col("first_id")).alias("shift"))
    )
    return _shifted(lines, offsets).select(F.col("number").alias("line_index"), "line")


def lines_of_files(spark: SparkSession, path: str | list[str], recursive: bool = False) -> DataFrame:
    """Lines with their file and their number in it: ``(file, row BIGINT, line)``."""
    lines, splits = _scanned(spark, path, recursive)
    offsets = splits.select("file", "start", (_before_in_file() - F.col("first_id")).alias("shift"))
    return _shifted(lines, offsets).select("file", F.col("number").alias("row"), "line")


def packed_shards(spark: SparkSession, path: str, shards: list[int] | None = None) -> DataFrame:
    """``(shard_id, row, line)`` of shards that ``write_packed_shards`` wrote, ``row`` counting from 0 in each.

    Only the files that hold any of ``shards`` are read. A line meets the few
    shards that share its block of `BLOCK_ROWS` lines, and is that one's in
    whose range it lies.
    """
    manifest = spark.read.parquet(f"{path}/{MANIFEST}")
    paths: str | list[str] = path
    if shards is not None:
        manifest = manifest.where(F.col("shard_id").isin(*shards))
        files = [r["file"] for r in manifest.select("file").distinct().collect()]
        if not files:
            return spark.createDataFrame([], "shard_id long, row long, line string")
        paths = [f"{path}/part-{n // FILES_OF_TASK:05d}-*-c{n % FILES_OF_TASK:03d}*" for n in sorted(files)]
    last = F.col("first_row") + F.col("rows") - 1
    blocks = F.sequence(F.floor(F.col("first_row") / BLOCK_ROWS), F.floor(last / BLOCK_ROWS))
    ranges = manifest.select("shard_id", "file", "first_row", "rows", F.explode(blocks).alias("block"))
    name = r"part-([0-9]+)-[^/]*-c([0-9]+)[^/]*$"
    task, place = (F.regexp_extract("file", name, k).cast("int") for k in (1, 2))
    lines = lines_of_files(spark, paths).select(
        (task * FILES_OF_TASK + place).alias("file"), "row", "line",
        F.floor(F.col("row") / BLOCK_ROWS).alias("block"),
    )
    inside = (F.col("row") >= F.col("first_row")) & (F.col("row") < F.col("first_row") + F.col("rows"))
    return lines.join(ranges, ["file", "block"]).where(inside).select(
        F.col("shard_id").cast("long").alias("shard_id"), (F.col("row") - F.col("first_row")).alias("row"), "line"
    )
