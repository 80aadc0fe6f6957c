"""Connected components by alternating large and small stars (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.llm.common import stored, with_lookup


def least_neighbour(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("least"), F.count("*").alias("n"))


def large_star(edges: DataFrame, total: int) -> DataFrame:
    """Ties every larger neighbour of a node to the smallest node it knows."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    joined = with_lookup(both, least_neighbour(both), "u", "n", F.xxhash64("v"), 2 * total)
    return joined.filter("v > u").select(F.col("v").alias("u"), F.least("u", "least").alias("v")).distinct()


def small_star(edges: DataFrame, total: int) -> DataFrame:
    """Ties a node and its smaller neighbours to the smallest of them."""
    joined = with_lookup(edges, least_neighbour(edges), "u", "n", F.xxhash64("v"), total)
    ends = joined.select(F.explode(F.array("u", "v")).alias("u"), F.col("least").alias("v"))
    return ends.filter("u <> v").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every linked node but the roots themselves; ``links`` are long (a, b).

    The root is the smallest node of its component. Each round is written to the
    shared folder; rounds grow with the logarithm of a component's size.
    """
    edges = links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    edges = stored(edges.distinct(), "links")
    before = None
    while True:
        mark = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
        if mark == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = mark
        grown = stored(large_star(edges, mark["n"]), "large-star")
        edges = stored(small_star(grown, mark["n"]), "small-star")
