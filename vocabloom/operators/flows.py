"""Aggregations that feed charts: flows between sources and disciplines, adjacency, layouts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vocabloom.functions.frame import top_by


def source_flow(*derivations: DataFrame) -> DataFrame:
    """Different labels of each source and discipline; of several derivations (source, discipline, label) the one that has more counts."""
    counts = reduce(DataFrame.unionByName, (
        x.groupBy("source", "discipline").agg(F.countDistinct("label").alias("labels")) for x in derivations
    ))
    return counts.groupBy("source", "discipline").agg(F.max("labels").alias("labels"))


def shared_labels(senses: DataFrame, by: str) -> DataFrame:
    """Labels that two values of ``by`` share, ignoring case."""
    one = senses.select(F.lower("label").alias("l"), F.col(by).alias("a")).distinct()
    return one.join(one.select("l", F.col("a").alias("b")), "l").where("a < b").groupBy("a", "b").agg(F.count("*").alias("labels"))


def subcategories(rows: DataFrame, path: str, group: str, part: int, least: int, most: int) -> DataFrame:
    """The commonest parts at a place of the path (parts are set off by " > ") of each group, those of at least ``least`` rows."""
    sub = F.try_element_at(F.split(path, " > "), F.lit(part))
    counted = rows.withColumn("sub", sub).where("sub IS NOT NULL AND sub <> ''").groupBy(group, "sub").agg(F.count("*").alias("n")).where(F.col("n") >= least)
    return top_by(counted, [group], [F.desc("n"), "sub"], most, "place")


def polysemy_counts(senses: DataFrame) -> DataFrame:
    per = senses.groupBy(F.lower("label").alias("l")).agg(F.countDistinct("discipline").alias("d"), F.countDistinct("source").alias("s"))
    return per.agg(
        F.sum(F.when(F.col("d") > 1, 1).otherwise(0)).alias("multi_discipline"), F.sum(F.when(F.col("s") > 1, 1).otherwise(0)).alias("multi_source"),
        F.count("*").alias("labels"),
    )


def symmetric(pairs: DataFrame) -> DataFrame:
    """(a, b, labels) in both directions."""
    return pairs.union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"), "labels"))


def top_labels(senses: DataFrame, degree: DataFrame, n: int) -> DataFrame:
    per = senses.join(degree, "sense_id").groupBy("discipline", "label").agg(F.sum("degree").alias("edges"))
    return top_by(per, ["discipline"], [F.desc("edges"), "label"], n, "place")


def cross_edges(edges: DataFrame, senses: DataFrame) -> DataFrame:
    """Unordered label pairs of edges that cross disciplines."""
    a = senses.select(F.col("sense_id").alias("source_sense_id"), F.concat_ws("/", "discipline", "label").alias("x"), F.col("discipline").alias("_a"))
    b = senses.select(F.col("sense_id").alias("target_sense_id"), F.concat_ws("/", "discipline", "label").alias("y"), F.col("discipline").alias("_b"))
    return edges.join(a, "source_sense_id").join(b, "target_sense_id").where("_a <> _b").select(
        F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")
    ).distinct()


def radial_layout(senses: DataFrame, n: int) -> DataFrame:
    """Nodes of each discipline in a sector of the unit disk; the level sets the radius tanh(level / 2)."""
    node = top_by(senses, ["discipline"], [F.desc("confidence"), "sense_id"], n, "place")
    sectors = senses.select("discipline").distinct().withColumn("sector", F.row_number().over(Window.orderBy("discipline")) - 1)  # one row a discipline
    count = senses.select("discipline").distinct().agg(F.count("*").alias("k"))
    angle = 2 * F.lit(3.141592653589793) * (F.col("sector") + F.col("place") / (F.lit(n) + 1)) / F.col("k")
    r = F.least(F.tanh((F.coalesce("level", F.lit(0)) + 1) / 2.0), F.lit(0.97))
    return node.join(F.broadcast(sectors), "discipline").crossJoin(F.broadcast(count)).select(
        "sense_id", "discipline", F.round(r * F.cos(angle), 6).alias("x"), F.round(r * F.sin(angle), 6).alias("y")
    )


def paper_positions(topics: DataFrame, index: DataFrame) -> DataFrame:
    """The mean position of each publication's topics (pub, topic) in an index (label, x, y).

    A topic takes the position of its own label, else of its first word (over three letters) that is a
    label; a publication without any takes the centre of the index.
    """
    place = index.select(F.lower("label").alias("_l"), "x", "y")
    t = topics.where("topic IS NOT NULL").select(F.lower("topic").alias("topic")).distinct()
    words = t.select("topic", F.posexplode(F.split("topic", " ")).alias("pos", "_l")).where("length(_l) > 3")
    tried = t.select("topic", F.lit(-1).alias("pos"), F.col("topic").alias("_l")).unionByName(words)
    placed = tried.join(place, "_l").groupBy("topic").agg(F.min_by("x", "pos").alias("x"), F.min_by("y", "pos").alias("y"))
    centre = index.agg(F.avg("x").alias("cx"), F.avg("y").alias("cy"))
    per = topics.select("pub", F.lower("topic").alias("topic")).join(placed, "topic", "left").groupBy("pub").agg(F.avg("x").alias("x"), F.avg("y").alias("y"), F.count("x").alias("matched"))
    return per.crossJoin(centre).select("pub", F.round(F.coalesce("x", "cx"), 6).alias("x"), F.round(F.coalesce("y", "cy"), 6).alias("y"), "matched")  # one row
