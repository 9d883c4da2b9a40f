"""Connected components of a link table by repeated star contraction.

Each round is two aggregations and joins over the links; nothing but a count
and a checksum reaches the driver, and every round is written to the shared
folder, so a lost executor never replays earlier rounds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .text import written


def _oriented(links: DataFrame) -> DataFrame:
    """Distinct links from the larger to the smaller end."""
    return links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter(
        "u > v").distinct()


def _large_star(links: DataFrame) -> DataFrame:
    """Hang every larger neighbour of a node on the node's smallest neighbour."""
    both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(links: DataFrame) -> DataFrame:
    """Hang a node and its smaller neighbours on the smallest of them."""
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    moved = links.join(least, "u").filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v")))


def _signature(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (columns u, v) but the roots themselves.

    The root is the smallest node.  An empty table has no components; loops and
    repeated links change nothing.
    """
    stars = written(_oriented(links), "links")
    seen = _signature(stars)
    while seen[0]:
        stars = written(_oriented(_small_star(_oriented(_large_star(stars)))), "links")
        now = _signature(stars)
        if now == seen:
            break
        seen = now
    return stars.select(F.col("u").alias("node"), F.col("v").alias("root"))
