"""Pairs within groups, spread over tasks whatever the size of a group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows of a group that meet in one tile.
SLOT = 1000


def _apart(c: str) -> Column:
    """The column as an expression, so that a join with what is aggregated by it has an exchange of its own, whose large parts Spark can split."""
    return F.element_at(F.array(c), F.lit(1))


def tiled_pairs(rows: DataFrame, group: str, item: str, carry: list[str] = (), slot: int = SLOT) -> DataFrame:
    """(group, a, b, and each column c of ``carry`` as c_a and c_b): the pairs of different items (a < b) of each group, each once.

    The rows of ``rows`` are different (group, item). A group of n rows has g = n / ``slot`` slots, to which its items are dealt by hash, and g * (g + 1) / 2 tiles;
    a row goes to the g tiles of its slot, and a tile pairs two slots. So a group that holds a third of all rows is dealt to as many tasks as its pairs need, and
    rows are copied as often as a group has slots, not items.
    """
    sizes = rows.groupBy(group).agg(F.ceil(F.count("*") / F.lit(slot)).cast("int").alias("_g")).select(_apart(group).alias("_of"), "_g")
    one = rows.join(sizes, rows[group] == F.col("_of")).drop("_of").withColumn("_s", F.pmod(F.xxhash64(item, F.lit(11)), "_g").cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("_g") - 1))
    dealt = one.withColumn("_o", other).select(
        group, item, *carry, "_s", F.least("_s", "_o").alias("_x"), F.greatest("_s", "_o").alias("_y")
    )
    side = lambda k: dealt.select(group, F.col(item).alias(k), *(F.col(c).alias(f"{c}_{k}") for c in carry), F.col("_s").alias(f"_s{k}"), "_x", "_y")
    met = side("a").join(side("b"), [group, "_x", "_y"]).where((F.col("a") < F.col("b")) & ((F.col("_x") == F.col("_y")) | (F.col("_sa") != F.col("_sb"))))
    return met.select(group, "a", "b", *(f"{c}_{k}" for c in carry for k in "ab"))
