"""Connected components by alternating large and small stars, as joins and grouped minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwatch.llm.common import stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Hang each larger neighbour of a node on the smallest of node and neighbours."""
    both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    return (both.filter("b > a").join(least, "a")
            .select(F.col("b").alias("a"), F.least("a", "m").alias("b")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """Hang each smaller neighbour of a node, and the node, on the smallest neighbour."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").filter("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionAll(least.select("a", F.col("m").alias("b"))).distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def connected(links: DataFrame, a: str, b: str, name: str = "components") -> DataFrame:
    """(node, component): the smallest node each linked node reaches. Nodes without a link are left out.

    Every step is written to the shared folder; the number of steps grows with the logarithm of the
    longest chain. Only a count and a checksum come to the driver. Links of a node to itself and links
    with a NULL count for nothing; repeated ones count once.
    """
    edges = (links.filter(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
             .select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct())
    edges = stored(edges, name)
    state = _state(edges)
    while state[0]:
        edges = stored(_small_star(_large_star(edges)), name)
        state, before = _state(edges), state
        if state == before:
            break
    ends = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return ends.unionAll(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
