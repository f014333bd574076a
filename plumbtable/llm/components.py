"""Connected components of a link table, by alternating stars, wholly on the executors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbtable.session import settle


def connected_components(links: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``links (a, b)``; the component is its smallest node.

    Null ends and self links are ignored, repeated links count once, an empty table gives no rows. Each round
    points the larger neighbours of a node, then its smaller ones, to the smallest; the rounds grow with the
    logarithm of a component's diameter. Every round is written to the shared folder, which cuts its lineage.
    A node with very many links is a skewed key of a plain equi-join against unique keys, which the adaptive
    skew join divides.
    """
    edges = (
        links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    )
    edges = settle(edges, "components")
    state = None
    while True:
        now = tuple(edges.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(u, v))"), F.expr("bit_xor(xxhash64(v))")).first())
        if now == state or not now[0]:
            break
        state = now
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = settle(large, "components")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
        edges = settle(small, "components")
    leaves = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return leaves.unionByName(roots)
