"""Near-duplicate documents by an LSH forest over word shingles."""

from __future__ import annotations

import functools
import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusvec.llm.common import NO_ID, rows_of, stored, texts_of
from corpusvec.llm.components import components
from corpusvec.llm.membership import split_by
from corpusvec.llm.shingles import shingle_set


@dataclass(frozen=True)
class Forest:
    """``trees`` sorted orders of signatures, each ``depth`` minima deep.

    Documents that share ``shallow`` minima of an order are a region of it, and
    candidates. A document meets its next ``near`` neighbours of its region:
    in a thin one those are all, in a crowded one those with the longest common
    prefixes. A crowded region's members also meet its pivot, and those that
    then stand apart from the pivot meet all of the region (`left_apart`). With
    the defaults two sets of similarity 0.85 share no region in one case of
    100,000, and 0.8 in one of 4,000.
    """

    trees: int = 16
    depth: int = 8
    shallow: int = 4
    near: int = 6


@functools.lru_cache(maxsize=2)
def permutations(n: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(6)
    times = rng.integers(0, 1 << 63, size=(n, 1), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return times, rng.integers(0, 1 << 63, size=(n, 1), dtype=np.uint64)


def signature(shingles: np.ndarray, n: int) -> np.ndarray:
    times, plus = permutations(n)
    least = np.full(n, np.iinfo(np.uint64).max, dtype=np.uint64)
    step = (1 << 18) // n
    for start in range(0, len(shingles), step):
        part = times * shingles[None, start : start + step] + plus
        np.minimum(least, part.min(axis=1), out=least)
    return (least >> np.uint64(32)).astype(np.uint32)


def sketches(docs: DataFrame, forest: Forest) -> DataFrame:
    """``doc_id, text_hash, n_shingles, set_id, signature`` of every ``doc_id, text, text_hash``.

    ``set_id`` is a 128-bit digest of the whole set; minima are big-endian, so
    that bytes sort as they do.
    """

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in rows_of(batches):
            ids, hashes, sizes, sets, minima = [], [], [], [], []
            for doc_id, text, text_hash in rows:
                found = shingle_set(text)
                ids.append(doc_id)
                hashes.append(text_hash)
                sizes.append(len(found))
                sets.append(hashlib.blake2b(found.tobytes(), digest_size=16).digest() if len(found) else None)
                minima.append(signature(found, forest.trees * forest.depth).astype(">u4").tobytes() if len(found) else None)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64()), pa.array(hashes, pa.int64()), pa.array(sizes, pa.int64()),
                    pa.array(sets, pa.binary()), pa.array(minima, pa.binary()),
                ],
                names=["doc_id", "text_hash", "n_shingles", "set_id", "signature"],
            )

    return docs.select("doc_id", "text", "text_hash").mapInArrow(
        sketch, "doc_id long, text_hash long, n_shingles long, set_id binary, signature binary"
    )


def shared(a: bytes, b: bytes) -> int:
    """Minima of a common prefix."""
    if a == b:
        return len(a) // 4
    at = 0
    while a[at : at + 4] == b[at : at + 4]:
        at += 4
    return at // 4


def neighbours(rows: list[tuple[int, bytes, int]], forest: Forest) -> list[tuple[int, int, int]]:
    """Candidate pairs of sorted ``(tree, prefix, id)``: ids and how near in how deep an order."""
    found = []
    for i, (tree, prefix, a) in enumerate(rows):
        for step in range(1, min(forest.near, len(rows) - 1 - i) + 1):
            other, key, b = rows[i + step]
            if other != tree or shared(prefix, key) < forest.shallow:
                break
            if a != b:
                found.append((min(a, b), max(a, b), tree if step == 1 else forest.trees))
    return found


def tree_keys(reps: DataFrame, forest: Forest) -> DataFrame:
    """``tree, prefix, id``: each class once for each order."""
    width = 4 * forest.depth
    slices = F.transform(F.sequence(F.lit(0), F.lit(forest.trees - 1)), lambda t: F.substring("signature", t * width + 1, width))
    return reps.select(F.col("node").alias("id"), F.posexplode(slices).alias("tree", "prefix")).select("tree", "prefix", "id")


def candidates(keys: DataFrame, forest: Forest, rows: int) -> DataFrame:
    """``a, b, order``: pairs near each other in some order, once each.

    All orders are sorted at once over range partitions, ids breaking ties, so
    that equal prefixes spread. A partition passes on its first and last rows,
    and those of two neighbouring partitions are matched in a second step.
    """
    parts = max(1, math.ceil(rows * forest.trees / 65536))
    ordered = keys.repartitionByRange(parts, "tree", "prefix", "id").sortWithinPartitions("tree", "prefix", "id")

    def as_batch(pairs: list, edge: list) -> pa.RecordBatch:
        a, b, order = zip(*pairs, strict=True) if pairs else ((), (), ())
        none, k = [None] * len(pairs), len(edge)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([*a, *[None] * k], pa.int64()), pa.array([*b, *[None] * k], pa.int64()), pa.array([*order, *[None] * k], pa.int32()),
                pa.array([*none, *(e[0] for e in edge)], pa.int32()), pa.array([*none, *(e[1] for e in edge)], pa.int32()),
                pa.array([*none, *(e[2] for e in edge)], pa.binary()), pa.array([*none, *(e[3] for e in edge)], pa.int64()),
            ],
            names=["a", "b", "order", "part", "tree", "prefix", "id"],
        )

    def inside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, first, held = TaskContext.get().partitionId(), [], []
        for batch in batches:
            rows = list(zip(*(c.to_pylist() for c in batch.columns), strict=True))
            if len(first) < forest.near:
                first += rows[: forest.near - len(first)]
            # Rows held from before have met each other, but not these.
            known = set(neighbours(held, forest)) if held else set()
            yield as_batch([p for p in neighbours(held + rows, forest) if p not in known], [])
            held = (held + rows)[-forest.near :]
        yield as_batch([], [(part, *r) for r in {*first, *held}])

    schema = "a long, b long, order int, part int, tree int, prefix binary, id long"
    found = stored(ordered.mapInArrow(inside, schema), "neighbours")

    def across(key, group):
        import pandas as pd

        rows = sorted(zip(group["tree"], group["prefix"].map(bytes), group["id"], strict=True))
        return pd.DataFrame(neighbours(rows, forest), columns=["a", "b", "order"])

    # Every part's edge meets that of the next one with rows.
    edge = found.where("part is not null").select("part", "tree", "prefix", "id")
    filled = sorted(r["part"] for r in edge.select("part").distinct().collect())
    pairs = found.where("a is not null").select("a", "b", "order")
    if len(filled) > 1:
        seams = [(part, i + own) for i, part in enumerate(filled) for own in (0, 1)]
        numbered = edge.join(keys.sparkSession.createDataFrame(seams, "part int, seam int"), "part")
        pairs = pairs.unionByName(numbered.drop("part").groupBy("seam").applyInPandas(across, "a long, b long, order int"))
    return pairs.groupBy("a", "b").agg(F.min("order").alias("order"))


def crowds(keys: DataFrame, forest: Forest) -> DataFrame:
    """``tree, region, id, pivot, n`` of regions with more members than `Forest.near` reaches.

    A region is all that share ``shallow`` minima of an order. Going down from
    it along the commonest minima leads to one leaf; the member that stands in
    the leaves of most orders is closest to what the region has in common, and
    is its pivot.
    """
    region = F.substring("prefix", 1, 4 * forest.shallow)
    keyed = keys.withColumn("region", region)
    of = ["tree", "region"]
    sized = keyed.groupBy(*of).agg(F.count("*").alias("n")).where(F.col("n") > forest.near + 1)
    members = stored(keyed.join(stored(sized, "regions"), of), "members")
    leaves = members.groupBy(*of, "prefix").agg(F.count("*").alias("held"))
    leaves = stored(leaves.groupBy(*of).agg(F.max(F.struct("held", "prefix"))["prefix"].alias("leaf")), "leaves")
    scores = members.join(leaves, of).groupBy("id").agg(F.count_if(F.col("prefix") == F.col("leaf")).alias("score"))
    best = members.join(scores, "id").groupBy(*of).agg(F.max(F.struct("score", -F.col("id")))[ "col2"].alias("least"))
    pivots = stored(best.select(*of, (-F.col("least")).alias("pivot")), "pivots")
    return members.join(pivots, of).select(*of, "id", "pivot", "n")


#: Members of a region that one row packs, and minima of their longer signatures.
TILE, LONGER = 512, 1024


def longer_signatures(texts: DataFrame) -> DataFrame:
    """``id, signature`` of ``node, text``: `LONGER` minima of 16 bits each."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in rows_of(batches):
            minima = [signature(shingle_set(text), LONGER).astype("<u2").tobytes() for _, text in rows]
            yield pa.RecordBatch.from_arrays(
                [pa.array([i for i, _ in rows], pa.int64()), pa.array(minima, pa.binary())], names=["id", "signature"]
            )

    return texts.select("node", "text").mapInArrow(sketch, "id long, signature binary")


def left_apart(members: DataFrame, joined: DataFrame, texts: DataFrame, least: int) -> DataFrame:
    """Pairs of a crowded region that are still apart and whose signatures agree enough.

    All members outside the component of their region's pivot meet all members,
    in packed tiles of bounded size; a pair leaves its task only if the share
    of equal minima comes within four deviations of ``least``, by longer
    signatures that are made for these documents only.
    """
    n = LONGER
    goal = least / 100
    enough = n * (goal - 4 * math.sqrt(goal * (1 - goal) / n))
    of = ["tree", "region"]
    component = joined.select(F.col("node").alias("id"), "component")
    placed = members.join(component, "id", "left").withColumn("component", F.coalesce("component", "id"))
    home = joined.select(F.col("node").alias("pivot"), F.col("component").alias("home"))
    placed = placed.join(home, "pivot", "left").withColumn("home", F.coalesce("home", "pivot"))
    mixed = placed.groupBy(*of).agg(F.max(F.col("component") != F.col("home")).alias("mixed")).where("mixed").drop("mixed")
    placed = stored(placed.join(stored(mixed, "mixed"), of), "placed")
    ids = placed.select(F.col("id").alias("node")).distinct()
    signed = placed.join(stored(longer_signatures(texts.join(ids, "node", "left_semi")), "longer"), "id")
    signed = signed.withColumn("tiles", F.ceil(F.col("n") / TILE).cast("int"))

    def packed(df: DataFrame, name: str) -> DataFrame:
        tile = F.pmod(F.xxhash64("id"), F.col("tiles")).cast("int")
        return df.groupBy(*of, "tiles", tile.alias(f"tile_{name}")).agg(F.collect_list(F.struct("id", "component", "signature")).alias(name))

    some = packed(signed.where(F.col("component") != F.col("home")), "some")
    some = some.withColumn("tile_every", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    every = packed(signed, "every").drop("tiles")

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def unpacked(rows) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            ids, own = (rows.field(k).to_numpy(zero_copy_only=False) for k in ("id", "component"))
            return ids, own, np.frombuffer(b"".join(rows.field("signature").to_pylist()), dtype="<u2").reshape(len(ids), n)

        for batch in batches:
            found_a, found_b = [], []
            for i in range(batch.num_rows):
                ids, own, minima = unpacked(batch.column("some")[i].values)
                others, theirs, signatures = unpacked(batch.column("every")[i].values)
                for k in range(len(ids)):
                    agree = (signatures == minima[k]).sum(axis=1)
                    near = others[(agree >= enough) & (theirs != own[k])]
                    found_a.append(np.minimum(near, ids[k]))
                    found_b.append(np.maximum(near, ids[k]))
            empty = np.empty(0, dtype=np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([empty, *found_a])), pa.array(np.concatenate([empty, *found_b]))], names=["a", "b"]
            )

    return some.join(every, [*of, "tile_every"]).select("some", "every").mapInArrow(match, "a long, b long").distinct()


def confirmed(pairs: DataFrame, texts: DataFrame, least: int) -> DataFrame:
    """Pairs of which ``100 * common shingles >= least * all shingles``, on full sets."""
    left = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in rows_of(batches, "text_b"):
            kept, last, own = [], None, None
            for a, b, text_a, text_b in rows:
                if last != b:
                    last, own = b, shingle_set(text_b)
                other = shingle_set(text_a)
                common = len(np.intersect1d(own, other, assume_unique=True))
                if 100 * common >= least * (len(own) + len(other) - common):
                    kept.append((a, b))
            yield pa.RecordBatch.from_arrays(
                [pa.array([a for a, _ in kept], pa.int64()), pa.array([b for _, b in kept], pa.int64())], names=["a", "b"]
            )

    joined = pairs.select("a", "b").join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b")
    return joined.mapInArrow(check, "a long, b long")


def near_duplicates(docs: DataFrame, least: int = 85, forest: Forest = Forest()) -> DataFrame:
    """``doc_id, text_hash, n_shingles, component_id, kept, leads`` of every row of ``docs``.

    A document's set holds its runs of five words, A-Z in lower case; two are
    linked if they share ``least`` hundredths of all their shingles or more.
    Equal sets are one class, found by digest; classes are compared through
    the forest, and each candidate pair that would join two components is
    confirmed on the full sets of its texts. ``component_id`` is the least id
    reached by links; the document of that id is kept.

    Null, empty and wordless texts have no shingles and are alone. Rows are told
    apart by id and text (``text_hash``), so each text of a repeated id has its
    own links. A row without an id takes part as all others; it is kept only if
    its component holds no row with an id, and then ``component_id`` is null.
    ``leads`` marks one text of each component, that of the least id (ties: the
    least ``text_hash``): also one of several texts of an id, and of texts
    without one. Only rows equal in id and text lead together. An empty table
    gives no rows.
    """
    texts = texts_of(docs).withColumn("doc_id", F.coalesce("doc_id", F.lit(NO_ID))).withColumn("text_hash", F.xxhash64("text"))
    no_id = F.col("doc_id") == NO_ID
    sketched = stored(sketches(texts, forest), "sketches")
    reps = (
        sketched.where("set_id is not null").groupBy("set_id")
        .agg(F.min(F.struct(no_id.alias("no_id"), "doc_id", "text_hash")).alias("first"), F.first("signature").alias("signature"))
    )
    # Ids may repeat with other texts, so classes are numbered.
    reps = stored(reps.withColumn("node", F.monotonically_increasing_id()), "classes")
    keys = tree_keys(reps, forest)
    pairs = stored(candidates(keys, forest, sketched.count()), "candidates")
    members = stored(crowds(keys, forest), "crowds")
    with_pivot = members.where("id <> pivot").select(F.least("id", "pivot").alias("a"), F.greatest("id", "pivot").alias("b"))
    asked = pairs.unionByName(with_pivot.distinct().withColumn("order", F.lit(0)))
    nodes = asked.select(F.col("a").alias("node")).union(asked.select("b")).distinct()
    ids = reps.join(nodes, "node", "left_semi").select("first.doc_id", "first.text_hash", "node")
    ids = stored(ids, "ids")
    few, _ = split_by(texts, ids)
    wanted = few.join(ids, ["doc_id", "text_hash"]).dropDuplicates(["node"])
    wanted = stored(wanted.select("node", "text"), "texts")

    def joined_by(links: DataFrame) -> DataFrame:
        return stored(components(links), "components")

    def still_apart(some: DataFrame, joined: DataFrame) -> DataFrame:
        a, b = (joined.select(F.col("node").alias(x), F.col("component").alias(f"component_{x}")) for x in "ab")
        known = some.select("a", "b").distinct().join(a, "a", "left").join(b, "b", "left")
        return known.where(F.coalesce("component_a", "a") != F.coalesce("component_b", "b"))

    # First pivots and the next neighbours in a few orders, which join what is
    # crowded, then all other neighbours that are still apart, then whatever
    # else of the crowded regions is.
    links = stored(confirmed(asked.where(F.col("order") < 3), wanted, least), "links")
    joined = joined_by(links)
    second = stored(confirmed(still_apart(asked.where(F.col("order") >= 3), joined), wanted, least), "links")
    links = links.unionByName(second)
    joined = joined_by(links)
    rest = stored(left_apart(members, joined, wanted, least), "rest").join(asked.select("a", "b"), ["a", "b"], "left_anti")
    third = stored(confirmed(rest, wanted, least), "links")
    joined = joined_by(links.unionByName(third))
    placed = reps.select("set_id", "node", "first").join(joined, "node", "left")
    placed = placed.withColumn("component", F.coalesce("component", "node"))
    leaders = placed.groupBy("component").agg(F.min("first").alias("leader"))
    class_of = stored(placed.join(leaders, "component").select("set_id", "leader"), "leaders")
    found = sketched.drop("signature").join(class_of, "set_id", "left")
    own, least_id = F.nullif("doc_id", F.lit(NO_ID)), F.nullif("leader.doc_id", F.lit(NO_ID))
    component = F.when(F.col("leader").isNull(), own).otherwise(least_id)
    leads = (F.col("doc_id") == F.col("leader.doc_id")) & (F.col("text_hash") == F.col("leader.text_hash"))
    return found.select(
        own.alias("doc_id"), "text_hash", "n_shingles", component.alias("component_id"),
        F.coalesce(own == component, component.isNull()).alias("kept"), F.coalesce(leads, F.lit(True)).alias("leads"),
    )
