"""Connected components of a graph given as a table of edges."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattlake.llm.common import store


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of edges (a, b); the component is its smallest node.

    Alternating stars: each node hands its smallest neighbour to its larger neighbours,
    then to its smaller ones. The number of rounds grows with the logarithm of the
    largest component. Every round is stored, so lost executors cost one round. Minima
    are combined before the exchange; they are stored before they are joined back, as
    Spark splits a node with very many edges only where both sides come from exchanges.
    """
    edges = store(
        edges.where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(),
        "edges",
    )
    seen = _mark(edges)
    while True:
        both = edges.union(edges.select("b", "a"))
        low = store(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low")), "lows")
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()
        large = store(large, "large_stars")
        low = store(large.groupBy("a").agg(F.min("b").alias("low")), "lows")
        small = (
            large.join(low, "a").select(F.col("low").alias("a"), "b").where("a != b").distinct()
            .union(low.select(F.col("low").alias("a"), F.col("a").alias("b"))).distinct()
        )
        edges = store(small, "edges")
        now = _mark(edges)
        if now == seen:
            break
        seen = now
    nodes = edges.select(F.col("b").alias("node"), F.col("a").alias("component"))
    return nodes.union(edges.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct())


def _mark(edges: DataFrame) -> tuple:
    """Two numbers that differ when the edges do."""
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
