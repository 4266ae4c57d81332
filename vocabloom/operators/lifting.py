"""Deep trees: depth, roots and common ancestors in a number of rounds that grows with the logarithm of the depth.

Every node keeps its 1st, 2nd, 4th, 8th, ... ancestor (a row for each node, not for each node and ancestor). A chain of n nodes takes log2(n) rounds and
n * log2(n) entries, where a table of all ancestors has n * n / 2 rows. Of several parents the first in order counts. Tables of
all nodes are joined by shuffles at every size: a broadcast would send them to the driver anew in every round.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vocabloom.functions.frame import written
from vocabloom.operators.hierarchy import build_graph


def tops(parents: DataFrame) -> DataFrame:
    """(id, top, hops): the last node on the way up from each node of a forest (id, parent), and its distance; pointers double their reach in each round.

    A node whose way up is a cycle has a null top and null hops.
    """
    now = written(parents.select("id", F.col("parent").alias("top"), F.lit(1).cast("long").alias("hops"), F.lit(True).alias("_open")), "lifting")
    ids, most = now.count(), 1
    while True:
        next_ = now.select(F.col("id").alias("_at"), F.col("top").alias("_top"), F.col("hops").alias("_hops")).hint("merge")
        moved = now.join(next_, F.col("top") == F.col("_at"), "left").select(
            "id", F.coalesce("_top", "top").alias("top"), (F.col("hops") + F.coalesce("_hops", F.lit(0))).alias("hops"), F.col("_at").isNotNull().alias("_open")
        )
        now = written(moved, "lifting")
        most *= 2
        if not now.where("_open").limit(1).count() or most > 2 * ids:
            break
    return now.select("id", F.when(~F.col("_open"), F.col("top")).alias("top"), F.when(~F.col("_open"), F.col("hops")).alias("hops"))


def single_parents(nodes: DataFrame) -> DataFrame:
    """(id, parent) with the first parent of each node that has one; a node is not its own parent."""
    return nodes.where("parent_id IS NOT NULL AND parent_id <> id").groupBy("id").agg(F.min("parent_id").alias("parent"))


def tree_depths(nodes: DataFrame) -> DataFrame:
    """(id, depth, root) of every node, also of parents without a record; both are null on and below a cycle."""
    found = tops(single_parents(nodes)).select("id", F.lit(True).alias("_child"), "top", "hops")
    every = build_graph(nodes).select("id").join(found.hint("merge"), "id", "left")
    child = F.coalesce("_child", F.lit(False))
    return every.select("id", F.when(child, F.col("hops")).otherwise(F.lit(0)).alias("depth"), F.when(child, F.col("top")).otherwise(F.col("id")).alias("root"))


def ladders(nodes: DataFrame) -> DataFrame:
    """(id, depth, root, up): up[k] is the 2^k-th ancestor, null above the root; nodes on and below a cycle are left out."""
    known = written(tree_depths(nodes).where("depth IS NOT NULL"), "lifting")
    deepest = known.agg(F.max("depth")).first()[0] or 0
    rungs = known.join(single_parents(nodes).hint("merge"), "id", "left").select("id", "depth", "root", F.array("parent").alias("up"))
    for k in range(1, max(1, deepest).bit_length()):
        rungs = written(rungs, "lifting")
        above = rungs.select(F.col("id").alias("_at"), F.get("up", F.lit(k - 1)).alias("_far")).hint("merge")
        rungs = rungs.join(above, F.get("up", F.lit(k - 1)) == F.col("_at"), "left").select("id", "depth", "root", F.array_append("up", F.col("_far")).alias("up"))
    return written(rungs, "lifting")


def lowest_common(nodes: DataFrame, pairs: DataFrame, rungs: DataFrame | None = None) -> DataFrame:
    """(a, b, ancestor): the deepest node above both of each pair (a, b), where a node is above itself; pairs of two trees are left out.

    The deeper node climbs to the other's depth, then both climb by falling powers of two as long as they stay apart.
    """
    rungs = ladders(nodes) if rungs is None else rungs
    top = rungs.agg(F.max(F.size("up"))).first()[0] or 0
    kind = dict(rungs.dtypes)["up"]

    def at(df: DataFrame, place: Column, name: str) -> DataFrame:
        """Fetches the ladder of the node at ``place`` into ``name`` and ``name``_up."""
        other = rungs.select(F.col("id").alias("_at"), F.col("depth").alias("_d"), F.col("root").alias("_r"), F.col("up").alias("_u")).hint("merge")
        rest = [c for c in df.columns if c not in (name, f"{name}_up", f"{name}_depth", f"{name}_root")]
        return df.withColumn("_place", place).join(other, F.col("_place") == F.col("_at")).select(
            *rest, F.col("_place").alias(name), F.col("_u").cast(kind).alias(f"{name}_up"), F.col("_d").alias(f"{name}_depth"), F.col("_r").alias(f"{name}_root")
        )

    x = pairs.select("a", "b").distinct()
    x = at(at(x, F.col("a"), "p"), F.col("b"), "q").where("p_root = q_root")
    x = written(x, "lifting")
    for k in reversed(range(top)):
        for name, other in (("p", "q"), ("q", "p")):
            x = at(x, F.when(F.col(f"{name}_depth") - F.col(f"{other}_depth") >= 1 << k, F.get(f"{name}_up", F.lit(k))).otherwise(F.col(name)), name)
        x = written(x, "lifting")
    for k in reversed(range(top)):
        apart = F.coalesce(F.get("p_up", F.lit(k)) != F.get("q_up", F.lit(k)), F.lit(False))
        step = lambda name: F.when(F.col("_go"), F.get(f"{name}_up", F.lit(k))).otherwise(F.col(name))  # noqa: E731, B023
        x = written(at(at(x.withColumn("_go", apart), step("p"), "p"), step("q"), "q").drop("_go"), "lifting")
    return x.select("a", "b", F.when(F.col("p") == F.col("q"), F.col("p")).otherwise(F.get("p_up", F.lit(0))).alias("ancestor"))
