"""Connected components of a graph given as a table of links, by alternating stars.

Each round points every node at the smallest neighbour it knows, first over larger and then
over smaller neighbours; rounds are few (logarithmic in practice) and each
is a join on the node, so a hub is an ordinary skewed key that adaptive joins split. Links, labels and
nodes stay distributed; only a count and a checksum of a round reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import durable


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return both.join(least, "u").filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter(F.col("u") != F.col("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``links`` (u, v: two bigint columns, no nulls).

    ``root`` is the smallest node reachable. Loops and repeated links are harmless; without
    links the result is empty.
    """
    links = durable(links.select("u", "v").filter(F.col("u") != F.col("v")).distinct())
    before = None
    while True:
        links = durable(_small_star(_large_star(links)))
        mark = tuple(links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())
        if mark == before:
            break
        before = mark
    roots = links.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
