"""Connected components by alternating large-star and small-star steps, each a grouped minimum and a join.

No neighbour list is ever gathered: a node's smallest neighbour is a partial aggregate, and the join that hands it back is
one that Spark splits at hot nodes. Every round is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import save


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """edges (a, b). Large: each node's larger neighbours go to its smallest; small: its smaller ones and itself do."""
    both = edges.union(edges.select("b", "a")) if large else edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("m"))
    joined = both.join(least, F.col("a") == F.col("node"))
    if large:
        moved = joined.filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        moved = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select(F.col("node").alias("a"), F.col("m").alias("b")))
    return moved.filter(F.col("a") != F.col("b")).distinct()


def _settled(stars: DataFrame) -> bool:
    """Whether every node has one smaller neighbour and no smaller one of its own has any: each component is a star."""
    n = stars.agg(F.count("*").alias("n"), F.count_distinct("a").alias("a")).first()
    return n["n"] == n["a"] and stars.join(stars.select(F.col("b").alias("a")).distinct(), "a", "left_semi").isEmpty()


def components(edges: DataFrame, most_rounds: int = 50) -> DataFrame:
    """(node, comp) for every node with an edge; comp is the component's smallest node. edges has two columns of one kind."""
    a, b = edges.columns
    now = save(edges.select(F.col(a).alias("a"), F.col(b).alias("b")).filter(F.col("a") != F.col("b")), "edges")
    for _ in range(most_rounds):
        now = save(_star(_star(now, True), False), "edges")
        if _settled(now):
            break
    else:
        raise RuntimeError("components did not settle")
    return now.select(F.col("a").alias("node"), F.col("b").alias("comp")).union(now.select(F.col("b").alias("node"), F.col("b").alias("comp"))).distinct()
