"""Connected components of a graph given as links, by alternating large and small stars (distributed union-find).

A round replaces each node's links by links to the least node it knows: first among all neighbours for the larger
ones, then among the smaller ones for itself. Every step is an aggregation that combines before its shuffle and an
equi-join that adaptive execution may split, so a node with very many links is no obstacle. Rounds are written to the
shared folder, so a lost executor costs a re-read. The number of rounds grows with the logarithm of the size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import materialise


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())


def components(links: DataFrame) -> DataFrame:
    """node, component (the least node reachable) for every node of ``links`` (a, b, of one type).

    Links to oneself and links with a null end are left out; nodes without links don't appear.
    """
    both = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b")
    edges = materialise(both.distinct(), "links")
    mark = _mark(edges)
    while mark[0]:
        edges = materialise(_small_star(_large_star(edges)), "links")
        mark, last = _mark(edges), mark
        if mark == last:
            break
    root = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(root)
