"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusvec.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``(a, b)``, the least id it reaches.

    Large-star and small-star steps in turn until the links stay as they are:
    each node is hung on the least node that it or its neighbours know. Links
    and nodes stay distributed; the driver sees one count and one sum a round.
    A node with very many links is one row of ``least``, stored first, so that
    its join can be split.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    edges = stored(edges, "links")
    print_of = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = stored(both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m")), "least")
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = stored(large, "large-star")
        least = stored(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        hung = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = hung.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
        edges = stored(small, "small-star")
        seen = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(seen) == print_of:
            break
        print_of = tuple(seen)
    roots = edges.select(F.col("v").alias("node")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        roots.withColumn("component", F.col("node"))
    )
