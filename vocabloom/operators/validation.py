"""Agreement, coherence, divergence and citation statistics."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vocabloom.functions.frame import average_ranks, sum_before, top_by, written
from vocabloom.functions.pairs import tiled_pairs


def stratified_sample(df: DataFrame, strata: list, key: str, per_stratum: int, seed: int = 1, order: Column | None = None) -> DataFrame:
    """``per_stratum`` rows of each stratum in ``order``, a seeded hash of the key by default."""
    order = F.xxhash64(key, F.lit(seed)) if order is None else order
    named = df.select("*", *(c.alias(f"_s{i}") for i, c in enumerate(strata)))
    return top_by(named, [f"_s{i}" for i in range(len(strata))], [order, key], per_stratum, "_place").drop("_place")


def quota_sample(df: DataFrame, strata: list, key: str, n: int, order: Column | None = None) -> DataFrame:
    """``n`` rows: an equal quota of each stratum, and what is left of ``n`` from all other rows, both in ``order`` (the hash of the key by default).

    No row of the sample lies beyond the first 2 * n of its stratum, and so of its share of the stratum: shares are cut to that before a stratum is put in order.
    """
    order = F.xxhash64(key, F.lit(1)) if order is None else order
    names = [f"_s{i}" for i in range(len(strata))]
    named = df.select("*", *(c.alias(s) for c, s in zip(strata, names)), order.alias("_o"))
    quota = named.select(*names).distinct().agg(F.floor(F.lit(n) / F.count("*"))).scalar()
    few = top_by(named.withColumn("_share", F.pmod(F.xxhash64(key, F.lit(2)), F.lit(64))), [*names, "_share"], ["_o", key], 2 * n, "_place")
    placed = few.withColumn("_place", F.row_number().over(Window.partitionBy(*names).orderBy("_o", key)))
    return placed.orderBy(F.col("_place") > quota, "_o", key).limit(n).drop(*names, "_o", "_place", "_share")


def edge_sample(edges: DataFrame, key: list[str], share: float, seed: int = 1, hashed: Column | None = None) -> DataFrame:
    """A repeatable share of the edges, chosen by a hash: a whole number, that of the key and seed by default."""
    hashed = F.xxhash64(*key, F.lit(seed)) if hashed is None else hashed
    return edges.where(F.pmod(hashed, F.lit(1_000_000)) < int(share * 1_000_000))


def kappa(df: DataFrame, a: str, b: str) -> DataFrame:
    """Cohen's kappa of two raters, from the confusion matrix."""
    cells = df.where(F.col(a).isNotNull() & F.col(b).isNotNull()).groupBy(F.col(a).alias("a"), F.col(b).alias("b")).agg(F.count("*").alias("n"))
    rows = cells.groupBy("a").agg(F.sum("n").alias("na"))
    cols = cells.groupBy("b").agg(F.sum("n").alias("nb"))
    expected = rows.join(cols, rows["a"] == cols["b"]).agg(F.coalesce(F.sum(F.col("na") * F.col("nb")), F.lit(0)).alias("e"))
    total = cells.agg(F.sum("n").alias("n"), F.sum(F.when(F.col("a") == F.col("b"), F.col("n")).otherwise(0)).alias("agree"))
    po, pe = F.col("agree") / F.col("n"), F.col("e") / (F.col("n") * F.col("n"))
    return total.crossJoin(expected).select(  # one row each
        "n", F.round(po, 6).alias("observed"), F.round(pe, 6).alias("expected"), F.round((po - pe) / (1 - pe), 6).alias("kappa")
    )


def per_category(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """Precision, recall, F1 and support of each category."""
    each = F.explode(F.array_distinct(F.array(truth, predicted)))
    c = df.select(truth, predicted, each.alias("category"))
    t, p = F.col(truth) == F.col("category"), F.col(predicted) == F.col("category")
    n = lambda x: F.sum(F.when(x, 1).otherwise(0))
    out = c.groupBy("category").agg(n(t & p).alias("tp"), n(p).alias("pp"), n(t).alias("support"))
    precision = F.when(F.col("pp") > 0, F.col("tp") / F.col("pp")).otherwise(0.0)
    recall = F.when(F.col("support") > 0, F.col("tp") / F.col("support")).otherwise(0.0)
    f1 = F.when(precision + recall > 0, 2 * precision * recall / (precision + recall)).otherwise(0.0)
    return out.select("category", F.round(precision, 6).alias("precision"), F.round(recall, 6).alias("recall"), F.round(f1, 6).alias("f1"), "support")


def top_set_jaccard(before: DataFrame, after: DataFrame, group: str, item: str) -> DataFrame:
    """Jaccard similarity of two sets of items for each group."""
    a = before.select(group, item).distinct().withColumn("_a", F.lit(1))
    b = after.select(group, item).distinct().withColumn("_b", F.lit(1))
    return a.join(b, [group, item], "full").groupBy(group).agg(
        F.round(F.sum(F.when(F.col("_a").isNotNull() & F.col("_b").isNotNull(), 1).otherwise(0)) / F.count("*"), 6).alias("jaccard")
    )


def npmi(pairs: DataFrame, singles: DataFrame, n: Column) -> DataFrame:
    """Normalised pointwise mutual information of label pairs; ``n`` is the number of publications."""
    a = singles.select(F.col("label").alias("a"), F.col("pubs").alias("na"))
    b = singles.select(F.col("label").alias("b"), F.col("pubs").alias("nb"))
    j = pairs.join(a, "a").join(b, "b")
    p = F.col("pubs") / n
    pmi = F.log(p / ((F.col("na") / n) * (F.col("nb") / n)))
    return j.select("a", "b", "pubs", F.round(F.when(p < 1, pmi / -F.log(p)).otherwise(1.0), 6).alias("npmi"))


def spearman(scores: DataFrame, group: str, item: str, value: str) -> DataFrame:
    """Spearman correlation of the items' values for each pair of groups (a few lenses)."""
    r = average_ranks(scores.select(group, item, value), group, value, "r").select(group, item, "r")
    b = r.select(F.col(group).alias("b"), item, F.col("r").alias("rb"))
    return r.select(F.col(group).alias("a"), item, F.col("r").alias("ra")).join(b, item).where("a < b").groupBy("a", "b").agg(
        F.round(F.corr("ra", "rb"), 6).alias("spearman")
    )


def jaccard(a: str, b: str) -> Column:
    """Jaccard similarity of two arrays, 0 where either is empty."""
    both = F.size(F.array_union(a, b))
    return F.when((F.size(a) > 0) & (F.size(b) > 0), F.round(F.size(F.array_intersect(a, b)) / both, 6)).otherwise(0.0)


def linked_similarity(sets: DataFrame, links: DataFrame) -> DataFrame:
    """Jaccard similarity of the sets (pub, items) at the two ends of each link (a, b)."""
    a = sets.select(F.col("pub").alias("a"), F.col("items").alias("_x"))
    b = sets.select(F.col("pub").alias("b"), F.col("items").alias("_y"))
    return links.join(a, "a").join(b, "b").select("a", "b", jaccard("_x", "_y").alias("similarity"))


def similarity_summary(sets: DataFrame, links: dict[str, DataFrame]) -> DataFrame:
    """Pairs, mean and median of the similarity of each kind of link, such as citing and random pairs."""
    every = reduce(DataFrame.unionByName, (linked_similarity(sets, some).withColumn("kind", F.lit(kind)) for kind, some in links.items()))
    return every.groupBy("kind").agg(F.count("*").alias("pairs"), F.round(F.avg("similarity"), 6).alias("mean"), F.round(F.median("similarity"), 6).alias("median"))


def neighbourhood_coherence(senses: DataFrame, edges: DataFrame, pub_keywords: DataFrame, least_edges: int = 5, most_neighbours: int = 20, ahead: int = 4, least_confidence: float = 0.5) -> DataFrame:
    """(sense_id, neighbours, pairs, npmi): the mean NPMI of the neighbour labels of each centre.

    Centres are senses of ``least_confidence`` with ``least_edges`` outgoing edges and three different neighbour labels; of at most ``most_neighbours``
    labels, in their order, each is paired with the ``ahead`` next ones. Pairs that never meet in a publication do not count.
    """
    out = edges.select(F.col("source_sense_id").alias("sense_id"), F.col("target_sense_id").alias("_n"))
    centres = out.groupBy("sense_id").agg(F.count("*").alias("_e")).where(F.col("_e") >= least_edges).select("sense_id")
    centres = centres.join(senses.where(F.col("confidence") >= least_confidence).select("sense_id"), "sense_id", "left_semi")
    near = out.join(centres, "sense_id").join(senses.select(F.col("sense_id").alias("_n"), F.lower("label").alias("label")), "_n").select("sense_id", "label").distinct()
    placed = top_by(near, ["sense_id"], ["label"], most_neighbours, "_at")
    sizes = placed.groupBy("sense_id").agg(F.count("*").alias("neighbours")).where("neighbours >= 3")
    a = placed.select("sense_id", F.col("label").alias("a"), "_at")
    b = placed.select("sense_id", F.col("label").alias("b"), F.col("_at").alias("_bt"))
    pairs = a.join(b, "sense_id").where((F.col("_bt") > F.col("_at")) & (F.col("_bt") <= F.col("_at") + ahead)).select("sense_id", "a", "b")  # at most 20 rows a centre
    keywords = written(pub_keywords.select("pub", F.lower("label").alias("label")).distinct(), "pub-keywords")
    singles = keywords.groupBy("label").agg(F.count("*").alias("pubs"))
    # From the publications: a pair of labels has as many rows as it has publications, not as many as its first label has.
    wanted = pairs.select("a", "b").distinct()
    asked = keywords.join(placed.select("label").distinct(), "label", "left_semi")
    met = tiled_pairs(asked, "pub", "label").groupBy("a", "b").agg(F.count("*").alias("pubs")).join(wanted, ["a", "b"], "left_semi")
    scored = npmi(met, singles, keywords.agg(F.countDistinct("pub")).scalar()).select("a", "b", "npmi")
    means = pairs.join(scored, ["a", "b"]).groupBy("sense_id").agg(F.count("*").alias("pairs"), F.round(F.avg("npmi"), 4).alias("npmi"))
    return sizes.join(means, "sense_id", "left").select("sense_id", "neighbours", F.coalesce("pairs", F.lit(0)).alias("pairs"), F.coalesce("npmi", F.lit(0.0)).alias("npmi"))


def mann_whitney(df: DataFrame, group: str, value: str) -> DataFrame:
    """U of the rows where ``group`` is true against the others, with z by the tie-corrected normal
    approximation. Ranks come from counts of equal values, added up over all tasks."""
    counts = df.where(F.col(value).isNotNull()).groupBy(value).agg(
        F.count("*").alias("t"), F.sum(F.when(F.col(group), 1).otherwise(0)).alias("g")
    )
    ranked = sum_before(counts, [value], "t").withColumn("rank", F.col("before") + (F.col("t") + 1) / 2.0)
    s = ranked.agg(
        F.sum(F.col("g") * F.col("rank")).alias("r"), F.sum("g").cast("double").alias("n1"), F.sum("t").cast("double").alias("n"),
        F.sum(F.pow(F.col("t").cast("double"), 3) - F.col("t")).alias("ties"),
    )
    u = F.col("r") - F.col("n1") * (F.col("n1") + 1) / 2
    n2 = F.col("n") - F.col("n1")
    sd = F.sqrt(F.col("n1") * n2 / 12 * (F.col("n") + 1 - F.col("ties") / (F.col("n") * (F.col("n") - 1))))
    return s.select(F.round(u, 3).alias("u"), F.round((u - F.col("n1") * n2 / 2) / sd, 6).alias("z"))


def coverage(senses: DataFrame, shares: DataFrame, universe: float) -> DataFrame:
    """Labels of each discipline over the expected number (universe x share), at most 1; null without a share."""
    ours = senses.groupBy("discipline").agg(F.countDistinct("label").alias("labels"))
    expected = F.col("share") * universe
    return ours.join(shares, "discipline", "left").select(
        "discipline", "labels", F.round(expected, 6).alias("expected"), F.round(F.least(F.lit(1.0), F.when(expected > 0, F.col("labels") / expected)), 6).alias("coverage_raw")
    ).withColumn("coverage", F.when(F.col("expected").isNotNull(), F.col("coverage_raw"))).drop("coverage_raw")


def scorecard(senses: DataFrame, edges: DataFrame) -> DataFrame:
    """Quality measures of a sense graph as rows (metric, value)."""
    ends = edges.select(F.col("source_sense_id").alias("sense_id")).union(edges.select("target_sense_id")).distinct().withColumn("_on", F.lit(1))
    s = senses.join(ends, "sense_id", "left").agg(
        F.count("*").alias("n"), F.count("_on").alias("on"), F.count("level").alias("level"), F.count("discipline").alias("disc"), F.avg("confidence").alias("conf"),
        F.countDistinct("sense_id").alias("ids"), F.countDistinct(F.lower("label")).alias("labels"), F.countDistinct("source").alias("sources"),
    )
    e = edges.agg(F.count("*").alias("e"), F.countDistinct("source_sense_id", "target_sense_id", "relationship_type").alias("triples"))
    share = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b))
    metrics = {
        "senses": F.col("n").cast("double"), "edges": F.col("e").cast("double"), "edges_per_sense": share("e", "n"), "connected": share("on", "n"), "with_level": share("level", "n"),
        "with_discipline": share("disc", "n"), "mean_confidence": F.col("conf"), "unique_ids": share("ids", "n"), "unique_edges": share("triples", "e"), "labels": F.col("labels").cast("double"),
        "sources": F.col("sources").cast("double"),
    }
    rows = F.explode(F.array(*(F.struct(F.lit(k).alias("metric"), F.round(v, 6).alias("value")) for k, v in metrics.items())))
    return s.crossJoin(e).select(rows.alias("r")).select("r.*")  # one row each


def consensus(mappings: DataFrame) -> DataFrame:
    """Experts' mappings (expert, category, source, confidence) merged: experts for each pair, and the
    chance that at least one is right (noisy or) from each expert's surest mapping."""
    per = mappings.groupBy("category", "source", "expert").agg(F.max("confidence").alias("c"))
    return per.groupBy("category", "source").agg(
        F.count("*").alias("experts"),
        F.round(F.when(F.max("c") >= 1, 1.0).otherwise(1 - F.exp(F.sum(F.log1p(-F.col("c"))))), 6).alias("confidence"),
    )
