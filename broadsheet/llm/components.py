"""Connected components of a link table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from broadsheet.llm.common import cut


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component) of every node in ``links`` (u, v); a component is its smallest node.

    Each round lets every node hand its smallest neighbour first to its larger
    neighbours, then to its smaller ones. Rounds grow with the logarithm of the
    longest chain. The links stay a distributed table, stored after every round;
    the driver sees their number and checksum only. No link, no rows.
    """
    edges = cut(
        links.select(F.least("u", "v").alias("low"), F.greatest("u", "v").alias("high")).filter("low < high").distinct()
    )
    state = _state(edges)
    while True:
        edges = cut(_small_star(_large_star(edges)))
        before, state = state, _state(edges)
        if state == before:
            return edges.select(F.col("high").alias("node"), F.col("low").alias("component")).unionByName(
                edges.select(F.col("low").alias("node"), F.col("low").alias("component")).distinct()
            )


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("low", "high"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node gets the smallest node around."""
    both = edges.select(F.col("low").alias("n"), F.col("high").alias("m")).unionByName(
        edges.select(F.col("high").alias("n"), F.col("low").alias("m"))
    )
    least = both.groupBy("n").agg(F.min("m").alias("least")).select("n", F.least("n", "least").alias("least"))
    larger = edges.select(F.col("low").alias("n"), F.col("high").alias("m"))
    return larger.join(least, "n").select(F.col("least").alias("low"), F.col("m").alias("high")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, get the smallest of them."""
    least = edges.groupBy("high").agg(F.min("low").alias("least"))
    handed = edges.join(least, "high").select("low", "high", "least")
    others = handed.filter("low > least").select(F.col("least").alias("low"), F.col("low").alias("high"))
    own = least.select(F.col("least").alias("low"), "high")
    return others.unionByName(own).distinct()
