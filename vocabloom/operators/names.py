"""Names a few letters apart: the pairs within an edit distance, and the groups of variants that they make."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vocabloom.functions.frame import first_by, written
from vocabloom.functions.pairs import tiled_pairs
from vocabloom.operators.lifting import tops

#: An edit distance counts up to this share of the shorter key's length, so that short names do not all run together.
SHARE = 0.2


def name_key(name: str) -> Column:
    """The name in lower case, without anything but letters and digits."""
    return F.regexp_replace(F.lower(name), r"[^\p{L}\p{N}]", "")


def _deletions(key: str, most: int) -> Column:
    """Hashes of the key and of what is left of it without one character or, for two, any two."""
    one = f"CASE WHEN length({key}) > 0 THEN transform(sequence(1, length({key})), i -> concat(substring({key}, 1, i - 1), substring({key}, i + 1))) ELSE array() END"
    two = (
        f"CASE WHEN length({key}) > 1 THEN flatten(transform(sequence(1, length({key}) - 1), i -> transform(sequence(i + 1, length({key})), "
        f"j -> concat(substring({key}, 1, i - 1), substring({key}, i + 1, j - i - 1), substring({key}, j + 1))))) ELSE array() END"
    )
    parts = [f"array({key})", one, two][: most + 1]
    return F.array_distinct(F.transform(F.expr(f"concat({', '.join(parts)})"), lambda x: F.xxhash64(x)))


def near_names(keys: DataFrame, key: str, most: int = 2) -> DataFrame:
    """(a, b, distance), a < b: the pairs of different keys at most ``most`` (0 to 2) edits apart; exact.

    Two keys are that near only if they become equal by deleting at most ``most`` characters from each, so those that share the hash of a deletion are compared.
    A key of n characters has n * n / 2 deletions; a deletion that very many keys share is dealt to many tasks.
    """
    if most not in (0, 1, 2):
        raise ValueError("deletions are made for distances up to 2")
    each = keys.select(F.col(key).alias("key")).where("key IS NOT NULL").distinct().select("key", F.explode(_deletions("key", most)).alias("left"))
    met = tiled_pairs(each, "left", "key").select("a", "b").distinct()
    return met.withColumn("distance", F.levenshtein("a", "b", most)).where(F.col("distance") >= 0)


def connected(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a, b); root is the smallest node that is reached.

    In each round every node with a smaller neighbour points to the smallest one, pointers are followed to their ends by doubling, and the edges are
    drawn anew between the ends; their number falls until none is left.
    """
    left = written(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct(), "names")
    of = written(left.select(F.col("a").alias("node")).union(left.select("b")).distinct().select("node", F.col("node").alias("root")), "names")
    while not left.isEmpty():
        ends = tops(left.groupBy(F.col("b").alias("id")).agg(F.min("a").alias("parent"))).select("id", "top")
        to = lambda df, c: df.join(ends, df[c] == ends["id"], "left").withColumn(c, F.coalesce("top", c)).drop("id", "top")  # noqa: E731, B023
        of = written(to(of, "root"), "names")
        drawn = to(to(left, "a"), "b")
        left = written(drawn.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct(), "names")
    return of


def variant_groups(names: DataFrame, most: int = 2, share: float = SHARE) -> DataFrame:
    """(name, key, canonical): names whose keys are equal or, over any number of steps, at most ``most`` edits and ``share`` of the shorter key's length apart.

    ``names`` has name and n, the number of its mentions; the canonical name of a group is the most frequent one (of equals the first in order).
    """
    keyed = written(names.where("name IS NOT NULL").groupBy("name").agg(F.sum("n").alias("n")).withColumn("key", name_key("name")), "names")
    near = near_names(keyed.where("key <> ''"), "key", most).where(F.col("distance") <= F.least(F.length("a"), F.length("b")) * F.lit(share))
    groups = connected(near.select("a", "b"))
    placed = keyed.join(groups, keyed["key"] == groups["node"], "left").select("name", "n", "key", F.coalesce("root", "key").alias("_group"))
    best = first_by(placed, ["_group"], [F.desc("n"), "name"]).select(F.col("_group").alias("_g"), F.col("name").alias("canonical"))
    return placed.join(best, F.col("_group") == F.col("_g")).select("name", "key", "canonical")


def variant_edges(groups: DataFrame, senses: DataFrame) -> DataFrame:
    """``equivalent_sense`` edges from the sense of each variant to that of its canonical name; both have a sense (sense_id, label). A label stands for its smallest sense."""
    of = senses.groupBy("label").agg(F.min("sense_id").alias("sense_id"))
    a, b = (of.select(F.col("label").alias(c), F.col("sense_id").alias(s)) for c, s in (("name", "source_sense_id"), ("canonical", "target_sense_id")))
    pairs = groups.where("name <> canonical").join(a, "name").join(b, "canonical")
    return pairs.select("source_sense_id", "target_sense_id", F.lit("equivalent_sense").alias("relationship_type"), F.lit("toward").alias("direction")).distinct()
