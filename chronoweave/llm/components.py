"""Connected components of a table of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import join_hot, write_table


def connected_components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``links (a, b)``; the root is the smallest node reachable.

    Each round links the larger neighbours of a node to its smallest one, then the smaller
    ones; after about the logarithm of the longest path every component is a star. A round
    is written to the shared folder. A node with very many links joins by :func:`join_hot`.
    """
    edges = write_table(links.where("a <> b").select(F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi")).distinct(), "stars")
    seen = None
    while True:
        n, mark = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("lo", "hi"))).first()
        if (n, mark) == seen:
            break
        seen = (n, mark)
        both = edges.select(F.col("lo").alias("u"), F.col("hi").alias("v")).unionByName(edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"), F.count("*").alias("degree"))
        large = join_hot(both, least, "u", "degree", 2 * n).where("v > u").select(F.col("m").alias("lo"), F.col("v").alias("hi")).distinct()
        large = write_table(large, "stars")
        low = large.groupBy("hi").agg(F.min("lo").alias("m"), F.count("*").alias("degree"))
        small = join_hot(large, low, "hi", "degree", n).where("lo <> m").select(F.col("m").alias("lo"), F.col("lo").alias("hi"))
        edges = write_table(small.unionByName(low.select(F.col("m").alias("lo"), "hi")).distinct(), "stars")
    return edges.select(F.col("hi").alias("node"), F.col("lo").alias("root")).unionByName(edges.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct())
