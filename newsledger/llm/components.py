"""Connected components by rounds of large-star and small-star contraction.

Each round replaces the links of a node by links to the smallest node around it, first to
larger neighbours, then to smaller ones. The number of links never grows, no pairs within
a component are made, and rounds grow with the logarithm of the longest chain. Every round
is written to the shared folder, which cuts the lineage and survives lost executors. All
joins are on one node, which adaptive execution splits where a node is hot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from newsledger.session import materialize


def _both(links: DataFrame) -> DataFrame:
    return links.unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(links: DataFrame) -> DataFrame:
    both = _both(links)
    lowest = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    return (both.where(F.col("b") > F.col("a")).join(lowest, "a")
            .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())


def _small_star(links: DataFrame) -> DataFrame:
    lowest = links.groupBy("a").agg(F.min("b").alias("m"))
    moved = links.join(lowest, "a").where(F.col("b") != F.col("m")).select(
        F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionAll(lowest.select("a", F.col("m").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node in ``links`` (two columns of one type, any direction).

    The root is the smallest node of the component and maps to itself. Self-links, nulls
    and repeated links add nothing; without links the result is empty.
    """
    left, right = links.columns
    a, b = F.col(f"`{left}`"), F.col(f"`{right}`")
    current = materialize(
        links.where(a != b).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"))
        .distinct())
    mark = None
    while True:
        found = current.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if tuple(found) == mark or found[0] == 0:
            break
        mark = tuple(found)
        current = materialize(_small_star(_large_star(current)))
    roots = current.select(F.col("b").alias("node")).distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(
        roots.select("node", F.col("node").alias("root")))
