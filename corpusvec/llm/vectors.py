"""Near-duplicate embeddings by a pigeonhole join over subspaces."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusvec.llm.common import stored
from corpusvec.llm.components import components


@dataclass(frozen=True)
class Subspaces:
    """Blocks of ``block`` rotated dimensions, ``grid`` of which make cells.

    ``tile`` is about the most vectors of a cell that one row packs.
    """

    block: int = 8
    grid: int = 2
    tile: int = 512


def rotation(dim: int) -> np.ndarray:
    """A fixed random rotation, which spreads differences evenly over blocks."""
    q, r = np.linalg.qr(np.random.default_rng(dim).normal(size=(dim, dim)))
    return q * np.sign(np.diag(r))


def unit(vector: list | None) -> np.ndarray | None:
    """A vector of length 1, or None if it has no direction."""
    if not vector or None in vector:
        return None
    values = np.array(vector, dtype=np.float64)
    if not np.isfinite(values).all():
        return None
    most = np.abs(values).max()
    if most == 0:
        return None
    values /= most
    return values / np.sqrt(values @ values)


def prepared(vectors: DataFrame) -> DataFrame:
    """``vec_id, label, digest, unit``; the last two null for vectors that link with nothing.

    Equal vectors of a label have equal digests.
    """

    def prepare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, labels, rows = (c.to_pylist() for c in batch.columns)
            units = [unit(v) if label is not None else None for label, v in zip(labels, rows, strict=True)]
            digests = [
                None if u is None
                else hashlib.blake2b(np.array(v, dtype=np.float64).tobytes(), key=label.encode()[:64], digest_size=16).digest()
                for label, v, u in zip(labels, rows, units, strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64()), pa.array(labels, pa.string()), pa.array(digests, pa.binary()),
                    pa.array([None if u is None else u.tobytes() for u in units], pa.binary()),
                ],
                names=["vec_id", "label", "digest", "unit"],
            )

    chosen = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"), "embedding")
    return chosen.mapInArrow(prepare, "vec_id long, label string, digest binary, unit binary")


def in_blocks(classes: DataFrame, least: float, shape: Subspaces) -> DataFrame:
    """Each class once for each block: its cell and its coordinates there.

    Vectors of length 1 with cosine ``least`` are ``2 - 2 * least`` apart,
    squared. Each block has the part of that which its dimensions are of all;
    two vectors within the whole are within the part in one block or more.
    """
    whole = 2 - 2 * least

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turns: dict[int, np.ndarray] = {}
        for batch in batches:
            out: tuple[list, ...] = ([], [], [], [], [], [], [])
            for vec_id, label, raw in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                vector = np.frombuffer(raw)
                dim = len(vector)
                if dim not in turns:
                    turns[dim] = rotation(dim)
                turned = turns[dim] @ vector
                for block, at in enumerate(range(0, dim, shape.block)):
                    part = turned[at : at + shape.block]
                    reach = math.sqrt(whole * len(part) / dim) + 1e-6
                    cell = np.floor(part[: shape.grid] / reach).astype(int).tolist()
                    cell += [0] * (shape.grid - len(cell))
                    row = (vec_id, label, dim, block, cell, reach, part.astype(np.float32).tobytes())
                    for column, value in zip(out, row, strict=True):
                        column.append(value)
            kinds = (pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.list_(pa.int32()), pa.float64(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(out, kinds, strict=True)],
                names=["id", "label", "dim", "block", "cell", "reach", "part"],
            )

    return classes.select("id", "label", "unit").mapInArrow(
        cut, "id long, label string, dim int, block int, cell array<int>, reach double, part binary"
    )


def half_of_neighbours(grid: int) -> list[tuple[int, ...]]:
    """Offsets to the cell itself and one of each two opposite neighbours."""
    return [o for o in product((-1, 0, 1), repeat=grid) if o >= (0,) * grid]


def candidates(parts: DataFrame, shape: Subspaces) -> DataFrame:
    """``a, b``: pairs within the reach of a block, once each.

    The vectors of a cell are packed in tiles of bounded size, a crowded cell
    in many. Every tile meets those of its own and of neighbouring cells; only
    pairs within reach leave the task.
    """
    space = ["label", "dim", "block"]
    counts = stored(
        parts.groupBy(*space, "cell").agg(F.ceil(F.count("*") / shape.tile).cast("int").alias("tiles")), "cells"
    )
    dealt = parts.join(counts, [*space, "cell"]).withColumn("tile", F.pmod(F.xxhash64("id"), F.col("tiles")).cast("int"))
    tiles = stored(
        dealt.groupBy(*space, "cell", "tile").agg(
            F.max("reach").alias("reach"), F.sort_array(F.collect_list(F.struct("id", "part"))).alias("rows")
        ),
        "tiles",
    )
    offsets = F.array(*(F.array(*(F.lit(x) for x in o)) for o in half_of_neighbours(shape.grid)))
    near = counts.withColumn("offset", F.explode(offsets)).select(
        *space, F.col("cell").alias("cell_a"), F.col("tiles").alias("tiles_a"), "offset",
        F.zip_with("cell", "offset", lambda c, o: c + o).alias("cell_b"),
    )
    others = counts.select(*space, F.col("cell").alias("cell_b"), F.col("tiles").alias("tiles_b"))
    pairs = (
        near.join(others, [*space, "cell_b"])
        .withColumn("tile_a", F.explode(F.sequence(F.lit(0), F.col("tiles_a") - 1)))
        .withColumn("tile_b", F.explode(F.sequence(F.lit(0), F.col("tiles_b") - 1)))
        .where((F.col("cell_a") != F.col("cell_b")) | (F.col("tile_a") <= F.col("tile_b")))
        .select(*space, "cell_a", "tile_a", "cell_b", "tile_b")
    )
    left = tiles.select(*space, F.col("cell").alias("cell_a"), F.col("tile").alias("tile_a"), "reach", F.col("rows").alias("rows_a"))
    right = tiles.select(*space, F.col("cell").alias("cell_b"), F.col("tile").alias("tile_b"), F.col("rows").alias("rows_b"))
    joined = pairs.join(left, [*space, "cell_a", "tile_a"]).join(right, [*space, "cell_b", "tile_b"])

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def unpacked(rows) -> tuple[np.ndarray, np.ndarray]:
            ids = rows.field("id").to_numpy(zero_copy_only=False)
            parts = np.frombuffer(b"".join(rows.field("part").to_pylist()), dtype=np.float32)
            return ids, parts.reshape(len(ids), -1).astype(np.float64)

        for batch in batches:
            found_a, found_b = [], []
            for i in range(batch.num_rows):
                ids_a, a = unpacked(batch.column("rows_a")[i].values)
                ids_b, b = unpacked(batch.column("rows_b")[i].values)
                apart = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :] - 2 * (a @ b.T)
                x, y = np.nonzero(apart <= (batch.column("reach")[i].as_py() + 1e-5) ** 2)
                x, y = ids_a[x], ids_b[y]
                # A tile that meets itself gives each pair twice.
                keep = x < y if batch.column("same")[i].as_py() else x != y
                found_a.append(np.minimum(x, y)[keep])
                found_b.append(np.maximum(x, y)[keep])
            empty = np.empty(0, dtype=np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(found_a or [empty])), pa.array(np.concatenate(found_b or [empty]))], names=["a", "b"]
            )

    same = (F.col("cell_a") == F.col("cell_b")) & (F.col("tile_a") == F.col("tile_b"))
    return joined.select("reach", same.alias("same"), "rows_a", "rows_b").mapInArrow(match, "a long, b long").distinct()


def linked(pairs: DataFrame, units: DataFrame, least: float) -> DataFrame:
    """The pairs whose cosine in double precision is ``least`` or more."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            sides = []
            for name in ("unit_a", "unit_b"):
                sides.append([np.frombuffer(x) for x in batch.column(name).to_pylist()])
            near = pa.array([float(x @ y) >= least for x, y in zip(*sides, strict=True)], pa.bool_())
            yield batch.select(["a", "b"]).filter(near)

    a, b = (units.select(F.col("id").alias(x), F.col("unit").alias(f"unit_{x}")) for x in "ab")
    joined = pairs.join(a, "a").join(b, "b").select("a", "b", "unit_a", "unit_b")
    return joined.mapInArrow(check, "a long, b long")


def near_vectors(vectors: DataFrame, least: float = 0.98, shape: Subspaces = Subspaces()) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row of ``vectors``.

    Vectors of equal label (not null) and length link if their cosine is
    ``least`` or more. They are made unit vectors, rotated and cut into
    blocks; each block is range-joined under its share of the squared distance,
    and the union of what the blocks find is confirmed exactly. Equal vectors
    are one class, compared once, and linked with each other.

    Vectors that are null, empty or zero, hold a null or non-finite component
    or have no label link with nothing. Rows that repeat an id count as
    vectors of their own for links and share a component; an empty table gives
    no rows.
    """
    rows = stored(prepared(vectors), "vectors")
    valid = rows.where("digest is not null")
    classes = stored(
        valid.groupBy("label", "digest")
        .agg(F.min("vec_id").alias("id"), F.count("*").alias("size"), F.first("unit").alias("unit"))
        .where("id is not null"),
        "classes",
    )
    pairs = candidates(stored(in_blocks(classes, least, shape), "blocks"), shape)
    links = stored(linked(stored(pairs, "candidates"), classes, least), "links")
    both = links.union(links.select("b", "a")).toDF("id", "other")
    size = classes.select(F.col("id").alias("other"), "size")
    degrees = both.join(size, "other").groupBy("id").agg(F.sum("size").alias("outside"))
    joined = components(links).withColumnRenamed("node", "id")
    found = stored(
        classes.join(degrees, "id", "left").join(joined, "id", "left").select(
            "label", "digest", (F.col("size") - 1 + F.coalesce("outside", F.lit(0))).alias("n_links"),
            F.coalesce("component", "id").alias("component_id"),
        ),
        "class-components",
    )
    # Keys for rows that belong to no class, so that they spread.
    key = F.coalesce("digest", F.col("vec_id").cast("string").cast("binary"))
    out = rows.select("vec_id", F.coalesce("label", F.lit("")).alias("label"), key.alias("digest")).join(found, ["label", "digest"], "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"), F.coalesce(F.col("vec_id") == component, component.isNull()).alias("kept"),
    )
