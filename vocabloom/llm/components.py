"""Connected components of a graph given as an edge table, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vocabloom.llm._common import staged


def _least(rows: DataFrame, least: Column) -> DataFrame:
    """(_k, least) of each node. _k is an expression, so that a join with it has an exchange of its own, whose large parts
    Spark can split: a hub's edges are then not one task's. It is never broadcast, since the driver would hold it anew in every round."""
    return rows.groupBy("a").agg(least.alias("least")).select(F.bitwise_not(F.bitwise_not("a")).alias("_k"), "least").hint("merge")


def _ends(rows: DataFrame, *pairs: tuple[str, str]) -> DataFrame:
    """A row (a, b) for each of ``pairs`` of columns of each row; the rows are read once, as a union would not do."""
    return rows.select(F.explode(F.array(*(F.struct(F.col(x).alias("a"), F.col(y).alias("b")) for x, y in pairs))).alias("_e")).select("_e.a", "_e.b").where("a <> b")


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node moves to the smallest of the node and its neighbours."""
    both = _ends(edges, ("a", "b"), ("b", "a"))
    least = _least(both, F.least(F.col("a"), F.min("b")))
    return both.join(least, F.col("a") == F.col("_k")).where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours move to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    return _ends(down.join(_least(down, F.min("b")), F.col("a") == F.col("_k")), ("b", "least"), ("a", "least"))


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, root) for every node with an edge; root is the smallest node of its component.

    ``edges`` has two long columns ``a`` and ``b``. Each half of a round is written to the shared folder, so that no join is made twice for
    the two uses of its rows; only an edge count and a checksum reach the driver. Rounds grow with the logarithm of
    the longest path, and hubs are joined with Spark's skew handling, never gathered.
    """
    mark = (F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h"))
    now = staged(edges.where("a <> b").distinct(), name)
    seen = now.agg(*mark).first()
    while seen["n"]:
        now = staged(_small_star(staged(_large_star(now), f"{name}-large")).distinct(), name)
        was, seen = seen, now.agg(*mark).first()
        if was == seen:
            break
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)
