"""Connected components of a table of links, without gathering any of them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyfold.llm.store import new_folder, removed, staged


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``node, component`` of every node in ``a, b`` links; the component is its least node.

    Each round replaces links by ones that lead closer to the least node: every larger
    neighbour of a node is linked to the node's least neighbour, then every smaller one is.
    Rounds end when nothing changes; their number grows with the logarithm of the longest
    path. Minima are summed before the shuffle and joined back, so a node with very many
    links is no single task's work. Links to itself, repeated links and nulls are ignored.
    """

    def least(edges: DataFrame) -> DataFrame:
        return edges.groupBy("u").agg(F.min("v").alias("m"))

    edges = links.select(F.col("a").alias("u"), F.col("b").alias("v"))
    edges = edges.filter("u is not null and v is not null and u <> v")
    spark = links.sparkSession
    folder = new_folder(spark, "components")
    edges = staged(
        edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "", folder
    )
    before = None
    for _ in range(max_rounds):
        # large star: u's larger neighbours go to the least of u and all its neighbours
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        near = least(both).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(near, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u <> v").distinct()
        # small star: u and its smaller neighbours go to the least of them
        near = least(large)
        joined = large.join(near, "u")
        small = joined.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        following = new_folder(spark, "components")
        edges = staged(
            small.unionByName(near.select("u", F.col("m").alias("v"))).distinct(), "", following
        )
        removed(spark, folder)
        folder = following
        now = tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())
        if now == before or not now[0]:
            break
        before = now
    else:
        raise RuntimeError("components did not settle")
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
