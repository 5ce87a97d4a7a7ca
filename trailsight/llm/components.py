"""Connected components of a table of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailsight.llm.common import written


def _mark(edges: DataFrame) -> tuple:
    sums = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    return tuple(edges.agg(F.count("*"), sums).first())


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of links (a, b): the smallest node that it reaches.

    In each round the neighbours of a node are tied to its smallest neighbour, the larger ones first,
    then the smaller ones. Only minima are gathered for a node, never its list of neighbours.
    """
    pairs = links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b")
    edges = written(pairs.distinct())
    mark = _mark(edges)
    while mark[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        larger = both.join(least, "a").where("b > a").select(F.col("m").alias("a"), "b").distinct()
        least = larger.groupBy("b").agg(F.min("a").alias("m"))
        rest = larger.join(least, "b").where("a > m").select(F.col("m").alias("a"), F.col("a").alias("b"))
        edges = written(rest.unionByName(least.select(F.col("m").alias("a"), "b")).distinct())
        before, mark = mark, _mark(edges)
        if mark == before:
            break
    roots = edges.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct()
    return edges.select(F.col("b").alias("node"), F.col("a").alias("component")).unionByName(roots)
