"""Consensus of experts who are right to different degrees, by expectation-maximisation over their confusions (Dawid and Skene)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vocabloom.functions.frame import first_by, written

#: Added to every count of a confusion, so that what an expert never said is unlikely and not impossible.
SMOOTH = 0.01


def consensus(votes: DataFrame, rounds: int = 20, smooth: float = SMOOTH) -> tuple[DataFrame, DataFrame]:
    """Beliefs (item, class, p) and confusions (rater, class, label, p) from ``votes`` (item, rater, label).

    Beliefs start as shares of votes. Each round counts from them how often each expert calls a class by each label, and how frequent classes are, and
    weighs the votes of each item by that. Of one expert's votes on an item each counts. Classes are the labels that occur, and each item weighs only those that
    an expert gave it. Null items, raters and labels do not count.
    """
    cast = written(votes.where("item IS NOT NULL AND rater IS NOT NULL AND label IS NOT NULL").groupBy("item", "rater", "label").agg(F.count("*").alias("n")), "consensus")
    of_item = Window.partitionBy("item")
    beliefs = written(cast.groupBy("item", F.col("label").alias("class")).agg(F.sum("n").alias("_n")).select("item", "class", (F.col("_n") / F.sum("_n").over(of_item)).alias("p")), "consensus")
    labels = cast.select("label").distinct().count()
    confusions = None
    for _ in range(rounds):
        met = cast.join(beliefs.hint("merge"), "item")  # grows with the items, so never broadcast
        said = met.groupBy("rater", "class", "label").agg(F.sum(F.col("n") * F.col("p")).alias("_w"))
        whole = said.groupBy("rater", "class").agg(F.sum("_w").alias("_all"))
        total = F.col("_all") + F.lit(smooth * labels)
        confusions = written(said.join(whole, ["rater", "class"]).select("rater", "class", "label", ((F.col("_w") + smooth) / total).alias("p"), (F.lit(smooth) / total).alias("_none")), "consensus")
        priors = beliefs.groupBy("class").agg(F.sum("p").alias("_prior"))
        # An expert's label that was never met with a class has the confusion of no count.
        none = confusions.groupBy(F.col("rater").alias("_r"), F.col("class").alias("_c")).agg(F.max("_none").alias("_none"))
        pairs = met.select("item", "rater", "label", "n", "class").join(confusions.select("rater", "class", "label", F.col("p").alias("_p")), ["rater", "class", "label"], "left")
        weighed = pairs.join(none, (F.col("rater") == F.col("_r")) & (F.col("class") == F.col("_c")), "left")
        logs = weighed.groupBy("item", "class").agg(F.sum(F.col("n") * F.log(F.coalesce("_p", "_none"))).alias("_log")).join(priors, "class").select("item", "class", (F.col("_log") + F.log("_prior")).alias("_log"))
        raised = logs.withColumn("_e", F.exp(F.col("_log") - F.max("_log").over(of_item)))
        beliefs = written(raised.select("item", "class", (F.col("_e") / F.sum("_e").over(of_item)).alias("p")), "consensus")
    return beliefs, confusions.drop("_none") if confusions is not None else None


def best_class(beliefs: DataFrame) -> DataFrame:
    """(item, class, p): the likeliest class of each item (of equals the first in order), its belief rounded to six places."""
    return first_by(beliefs.withColumn("p", F.round("p", 6)), ["item"], [F.desc("p"), "class"])


def skills(confusions: DataFrame, priors: DataFrame | None = None) -> DataFrame:
    """(rater, skill): the chance that an expert calls a class by its own name, over the classes of ``priors`` (class, p) or equally over those of the expert."""
    right = confusions.where(F.col("class") == F.col("label")).select("rater", "class", "p")
    if priors is None:
        classes = confusions.select("rater", "class").distinct().groupBy("rater").agg(F.count("*").alias("_n"))
        return right.groupBy("rater").agg(F.sum("p").alias("_s")).join(classes, "rater").select("rater", (F.col("_s") / F.col("_n")).alias("skill"))
    w = priors.select("class", F.col("p").alias("_w"))
    return right.join(w, "class").groupBy("rater").agg((F.sum(F.col("p") * F.col("_w")) / F.sum("_w")).alias("skill"))
