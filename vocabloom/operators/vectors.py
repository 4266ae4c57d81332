"""Embedding operators: similarity edges, nearest neighbours, centroids and principal components."""

from __future__ import annotations

import numpy as np
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vocabloom.functions.automaton import Rule, classified
from vocabloom.functions.frame import checkpointed, first_by
from vocabloom.operators.cells import CellIndex


def similar(queries: DataFrame, rows: DataFrame, key: str, vector: str, least: float) -> DataFrame:
    """(source, target, cosine) of each query and each row whose cosine, rounded to six places, is ``least`` or more; exact, by a :class:`CellIndex`. Null and zero
    vectors have no edges."""
    return CellIndex(rows, key, vector).search(queries, key, vector, least, places=6)


def nearest(queries: DataFrame, rows: DataFrame, key: str, vector: str, least: float) -> DataFrame:
    """The most similar other row of each query, the smallest key of equals."""
    return first_by(similar(queries, rows, key, vector, least), ["source"], [F.desc("cosine"), "target"])


def centroid_assign(rows: DataFrame, key: str, vector: str, label: str) -> DataFrame:
    """The label whose mean vector has the greatest cosine with each row, the smallest of equals.

    One row holds all centroids (a label each).
    """
    each = rows.where(F.col(label).isNotNull()).select(label, F.posexplode(F.col(vector).cast("array<double>")).alias("i", "x"))
    means = each.groupBy(label, "i").agg(F.avg("x").alias("m")).groupBy(label).agg(F.array_sort(F.collect_list(F.struct("i", "m"))).alias("c"))
    centroids = means.select(F.struct(F.col(label).alias("label"), F.transform("c", lambda x: x["m"]).alias("m")).alias("c")).agg(F.array_sort(F.collect_list("c")).alias("all"))
    dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    v = F.col(vector).cast("array<double>")
    scored = F.transform("all", lambda c: F.struct((-F.round(dot(v, c["m"]) / F.sqrt(dot(c["m"], c["m"])), 9)).alias("s"), c["label"].alias("label")))
    return rows.crossJoin(centroids).select(key, F.array_min(scored)["label"].alias("assigned"))  # one row of centroids


def sub_categories(senses: DataFrame, vectors: DataFrame, key: str, vector: str, rules: list[Rule], least: float) -> DataFrame:
    """(key, sub_category, strategy, cosine) of the senses (key, label) that have a sub-category: by the first rule that their label meets (``pattern``), else
    that of the nearest centroid at a cosine of ``least`` or more (``centroid``).

    Centroids are the mean vectors of what the rules placed, one for each name in ``rules``, and travel in one row. A sense without a vector has its rule alone.
    """
    placed = checkpointed(classified(senses.select(key, "label"), rules, {"label": F.lower("label")}, name="sub_category"))
    rows = placed.join(vectors.select(key, F.col(vector).cast("array<double>").alias("_v")), key).where("_v IS NOT NULL")
    each = rows.where("sub_category IS NOT NULL").select("sub_category", F.posexplode("_v").alias("i", "x")).groupBy("sub_category", "i").agg(F.avg("x").alias("m"))
    means = each.groupBy("sub_category").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "m"))), lambda x: x["m"]).alias("m"))
    dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    some = means.where(F.exists("m", lambda x: x != 0))
    every = some.agg(F.array_sort(F.collect_list(F.struct(F.col("sub_category").alias("name"), "m"))).alias("all"))
    cosine = lambda c: F.round(dot("_v", c["m"]) / F.sqrt(dot(c["m"], c["m"]) * dot("_v", "_v")), 6)
    open_ = rows.where("sub_category IS NULL AND exists(_v, x -> x <> 0)").crossJoin(F.broadcast(every))  # one row
    best = open_.select(key, F.array_min(F.transform("all", lambda c: F.struct((-cosine(c)).alias("s"), c["name"].alias("name")))).alias("b"))
    near = best.where(F.col("b.s") <= -least).select(key, F.col("b.name").alias("sub_category"), F.lit("centroid").alias("strategy"), (-F.col("b.s")).alias("cosine"))
    by_rule = placed.where("sub_category IS NOT NULL").select(key, "sub_category", F.lit("pattern").alias("strategy"), F.lit(None).cast("double").alias("cosine"))
    return by_rule.unionByName(near)


def principal_components(rows: DataFrame, key: str, vector: str, k: int = 3) -> DataFrame:
    """(key, coordinates): the first ``k`` principal components; each axis points to where its largest weight is positive."""
    data = rows.where(F.col(vector).isNotNull()).select(key, array_to_vector(F.col(vector).cast("array<double>")).alias("_v"))
    if data.isEmpty():
        return rows.select(key, F.col(vector).cast("array<double>").alias("coordinates")).limit(0)
    model = PCA(k=k, inputCol="_v", outputCol="_p").fit(data)
    axes = model.pc.toArray()
    signs = [float(np.sign(axes[np.abs(axes[:, i]).argmax(), i]) or 1.0) for i in range(k)]
    return model.transform(data).select(key, F.zip_with(vector_to_array("_p"), F.array(*map(F.lit, signs)), lambda x, s: x * s).alias("coordinates"))
