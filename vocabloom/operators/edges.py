"""Relationship builders: joins that make the sense graph and the citation graph."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vocabloom.functions.frame import first_by, top_by
from vocabloom.functions.pairs import tiled_pairs


def _typed(same: Column) -> list[Column]:
    return [
        F.when(same, "equivalent_sense").otherwise("cross_domain_bridge").alias("relationship_type"),
        F.when(same, "toward").otherwise("across").alias("direction"),
    ]


def alignment_edges(alignment: DataFrame, senses: DataFrame) -> DataFrame:
    """Aligned keywords as sense edges; both ends must exist, one edge for each triple."""
    s = senses.select(F.col("keyword_id").alias("source_id"), F.col("sense_id").alias("source_sense_id"), F.col("discipline").alias("_a"))
    t = senses.select(F.col("keyword_id").alias("target_id"), F.col("sense_id").alias("target_sense_id"), F.col("discipline").alias("_b"))
    joined = alignment.join(s, "source_id").join(t, "target_id")
    return joined.select("source_sense_id", "target_sense_id", *_typed(F.col("_a") == F.col("_b"))).distinct()


def label_alignment(keywords: DataFrame) -> DataFrame:
    """Equal labels, ignoring case, of two sources; surer where three or more share one."""
    one = keywords.select(F.lower("label").alias("key"), "source").distinct()
    shared = one.groupBy("key").agg(F.count("*").alias("sources")).where("sources >= 2")
    a = one.join(shared, "key")
    b = one.select("key", F.col("source").alias("target"))
    return a.join(b, "key").where("source < target").select(
        "key", "source", "target", F.when(F.col("sources") >= 3, 0.9).otherwise(0.75).alias("confidence"),
        F.when(F.col("sources") >= 3, "label_match_3plus").otherwise("label_match_2").alias("method"),
    )


def hierarchy_edges(keywords: DataFrame, senses: DataFrame) -> DataFrame:
    """``subtopic_of`` from each sense to the senses of its parents."""
    s = senses.select(F.col("keyword_id").alias("id"), F.col("sense_id").alias("source_sense_id"))
    t = senses.select(F.col("keyword_id").alias("parent_id"), F.col("sense_id").alias("target_sense_id"))
    return keywords.select("id", "parent_id").join(s, "id").join(t, "parent_id").select("source_sense_id", "target_sense_id").distinct()


def containment(labels: DataFrame, least: int = 4) -> DataFrame:
    """Labels of several words and the single-word labels among their words: an equality join on words."""
    words = labels.select("label", F.explode(F.array_distinct(F.split(F.lower("label"), " "))).alias("word")).where(F.col("label").contains(" "))
    single = labels.where(~F.col("label").contains(" ") & (F.length("label") >= least)).select(F.lower("label").alias("word"), F.col("label").alias("broader")).distinct()
    return words.join(single, "word").select(F.col("label").alias("narrower"), "broader").distinct()


def cooccurrence(pub_keywords: DataFrame, least_pubs: int, relevance: float = 0.0) -> DataFrame:
    """Label pairs (a < b) by the publications they share. The labels of a publication meet in tiles, so that one with very many is dealt to many tasks."""
    rows = pub_keywords.where(F.col("relevance") >= relevance).select("pub", "label").distinct()
    return tiled_pairs(rows, "pub", "label").groupBy("a", "b").agg(F.count("*").alias("pubs")).where(F.col("pubs") >= least_pubs)


def cooccurrence_edges(pairs: DataFrame, senses: DataFrame, confidence: Column, per_label: int, direction: str | None = None) -> DataFrame:
    """Pairs as edges between the ``per_label`` surest senses of each label; toward within a discipline and across between two, or ``direction``."""
    best = top_by(senses, ["label"], [F.desc("confidence"), "sense_id"], per_label).select("label", "sense_id", "discipline")
    a = best.select(F.col("label").alias("a"), F.col("sense_id").alias("source_sense_id"), F.col("discipline").alias("_a"))
    b = best.select(F.col("label").alias("b"), F.col("sense_id").alias("target_sense_id"), F.col("discipline").alias("_b"))
    return pairs.join(a, "a").join(b, "b").select(
        "source_sense_id", "target_sense_id", "pubs", F.round(confidence, 6).alias("edge_confidence"),
        (F.lit(direction) if direction else F.when(F.col("_a") == F.col("_b"), "toward").otherwise("across")).alias("direction"),
    )


def _classes(senses: DataFrame, key: Column) -> DataFrame:
    """(key, discipline, first, n): the senses of one key and discipline, by the smallest of them and their number."""
    return senses.groupBy(key.alias("key"), "discipline").agg(F.min("sense_id").alias("first"), F.count("*").alias("n"))


def polysemy_edges(senses: DataFrame, least_sources: int = 1) -> DataFrame:
    """The links between all senses of one label, by classes: senses of a label and discipline are equivalent, those of two disciplines bridge.

    Each class is a star (its smallest sense to each other one, ``equivalent_sense``), and two classes of a label are one row
    between their smallest senses; pairs is the number of pairs of senses that a bridge stands for, or the size of the star's class.
    Rows grow with the senses, not with their square.
    """
    labels = senses.groupBy("label").agg(F.countDistinct("source").alias("_n")).where(F.col("_n") >= least_sources).select("label")
    some = senses.join(labels, "label")
    classes = _classes(some, F.col("label"))
    members = some.select("sense_id", F.col("label").alias("key"), "discipline").join(classes, ["key", "discipline"]).where("sense_id <> first")
    stars = members.select(F.col("first").alias("source_sense_id"), F.col("sense_id").alias("target_sense_id"), *_typed(F.lit(True)), F.col("n").alias("pairs"))
    other = classes.select("key", F.col("first").alias("_first"), F.col("n").alias("_m"), F.col("discipline").alias("_d"))
    bridges = classes.join(other, "key").where("first < _first").select(  # a row for each two disciplines of a label
        F.col("first").alias("source_sense_id"), F.col("_first").alias("target_sense_id"), *_typed(F.lit(False)), (F.col("n") * F.col("_m")).alias("pairs")
    )
    return stars.unionByName(bridges)


def label_links(new: DataFrame, senses: DataFrame) -> DataFrame:
    """Links from new senses to those with an equal label, ignoring case, by classes of label and discipline: a row between the smallest
    senses of two classes stands for ``pairs`` links, ``equivalent_sense`` within a discipline, else a bridge."""
    other = _classes(senses, F.lower("label")).select("key", F.col("first").alias("target_sense_id"), F.col("discipline").alias("_d"), F.col("n").alias("_m"))
    return _classes(new, F.lower("label")).join(other, "key").select(
        F.col("first").alias("source_sense_id"), "target_sense_id", *_typed(F.col("discipline") == F.col("_d")), (F.col("n") * F.col("_m")).alias("pairs")
    )


def doi_bridge(ours: DataFrame, works: DataFrame) -> DataFrame:
    """Rows of two tables with one DOI, ignoring case and URL prefixes."""
    def norm(c: str) -> Column:
        return F.lower(F.regexp_replace(c, r"^https?://(dx\.)?doi\.org/", ""))

    w = works.withColumn("_doi", norm("doi")).where("_doi <> ''").select("_doi", "work_id")
    return ours.withColumn("_doi", norm("doi")).where("_doi <> ''").join(w, "_doi").select("our_id", "work_id", F.col("_doi").alias("doi"))


def citation_edges(references: DataFrame, corpus: DataFrame) -> DataFrame:
    """Distinct citations, flagged where the cited work is in the corpus."""
    known = corpus.select(F.col("pub").alias("cited")).distinct().withColumn("_in", F.lit(True))
    return references.select("citing", "cited").distinct().join(known, "cited", "left").select(
        "citing", "cited", F.coalesce("_in", F.lit(False)).alias("in_corpus")
    )


def citation_tree(cites: DataFrame, centre: int | Column, *known: DataFrame) -> DataFrame:
    """Works that the centre cites (roots) and works that cite it (branches): side, pub, year, cited_by and found.

    Year and citations come from the first of the tables ``known`` that has them; found is the number of the first one
    with the work, null if none has it.
    """
    roots = cites.where(F.col("citing") == centre).select(F.lit("root").alias("side"), F.col("cited").alias("pub"))
    branches = cites.where(F.col("cited") == centre).select(F.lit("branch").alias("side"), F.col("citing").alias("pub"))
    tree = roots.union(branches)
    for k, table in enumerate(known):
        tree = tree.join(table.select(F.col("pub"), F.col("year").alias(f"_y{k}"), F.col("cited_by").alias(f"_c{k}"), F.lit(k).alias(f"_f{k}")), "pub", "left")
    first = lambda c: F.coalesce(*(f"_{c}{k}" for k in range(len(known))))
    return tree.select("side", "pub", first("y").alias("year"), first("c").alias("cited_by"), first("f").alias("found"))


def citation_tree_2hop(cites: DataFrame, pubs: DataFrame, centre: int | Column, first: int, second: int) -> DataFrame:
    """The most cited roots and branches of a centre, and of each the most cited next ones."""
    one = citation_tree(cites, centre, pubs)
    top = top_by(one, ["side"], [F.desc_nulls_last("cited_by"), "pub"], first).select("side", F.col("pub").alias("via"))
    step = cites.select(F.lit("root").alias("side"), F.col("citing").alias("via"), F.col("cited").alias("pub")).union(
        cites.select(F.lit("branch").alias("side"), F.col("cited").alias("via"), F.col("citing").alias("pub"))
    )
    near = top.join(step, ["side", "via"]).join(pubs.select("pub", "cited_by"), "pub", "left")
    return top_by(near, ["side", "via"], [F.desc_nulls_last("cited_by"), "pub"], second).select("side", "via", "pub", "cited_by")


def citation_list(tree: DataFrame, most: int) -> DataFrame:
    """Of a :func:`citation_tree` the references by year (unknown first) and the ``most`` most cited citing works, with their places."""
    references = top_by(tree.where("side = 'root'"), ["side"], [F.asc_nulls_first("year"), "pub"], 2**31 - 1, "place")
    citing = top_by(tree.where("side = 'branch'"), ["side"], [F.desc_nulls_last("cited_by"), "pub"], most, "place")
    return references.unionByName(citing).select("side", "place", "pub", "year", "cited_by")


def citation_totals(tree: DataFrame) -> DataFrame:
    """Works, known works and range of years of each side of a :func:`citation_tree`."""
    return tree.groupBy("side").agg(F.count("*").alias("works"), F.count("found").alias("known"), F.min("year").alias("first_year"), F.max("year").alias("last_year"))


def year_anomalies(cites: DataFrame, pubs: DataFrame) -> DataFrame:
    """Citations of a work that is younger than the citing one."""
    a = pubs.select(F.col("pub").alias("citing"), F.col("year").alias("citing_year"))
    b = pubs.select(F.col("pub").alias("cited"), F.col("year").alias("cited_year"))
    return cites.join(a, "citing").join(b, "cited").where("cited_year > citing_year").select(*cites.columns, "citing_year", "cited_year")


def anomaly_counts(cites: DataFrame, pubs: DataFrame) -> DataFrame:
    """For each level of a crawl (column level of ``cites``): its citations, and those of younger works."""
    odd = year_anomalies(cites, pubs).groupBy("level").agg(F.count("*").alias("_n"))
    every = cites.groupBy("level").agg(F.count("*").alias("citations"))
    return every.join(odd, "level", "left").select("level", "citations", F.coalesce("_n", F.lit(0)).alias("anomalies"))


def category_pairs(pubs: DataFrame, first: str, second: str, least: int) -> DataFrame:
    return pubs.where(F.col(first).isNotNull() & F.col(second).isNotNull()).groupBy(first, second).agg(F.count("*").alias("pubs")).where(F.col("pubs") >= least)


def tfidf(docs: DataFrame, key: str, text: str, max_share: float = 0.5, stops: list[str] = ()) -> DataFrame:
    """L2-normalised weights tf * (ln((1+n)/(1+df)) + 1) of words and pairs of words; those in more than ``max_share`` of documents are dropped.

    Words have two characters or more; stop words are taken out before pairs are made.
    """
    words = F.filter(F.split(F.lower(text), r"[^a-z0-9]+"), lambda x: (F.length(x) > 1) & ~x.isin(["", *stops]))
    both = F.arrays_zip(F.col("_w").alias("x"), F.slice("_w", F.lit(2), F.greatest(F.size("_w") - 1, F.lit(0))).alias("y"))
    each = docs.select(key, words.alias("_w")).select(key, F.explode(both).alias("_p"))
    grams = each.select(key, F.explode(F.array(F.col("_p.x"), F.concat("_p.x", F.lit(" "), "_p.y"))).alias("term")).where("term IS NOT NULL")
    tf = grams.groupBy(key, "term").agg(F.count("*").alias("tf"))
    n = docs.agg(F.count("*").alias("n"))
    df = tf.groupBy("term").agg(F.count("*").alias("df")).crossJoin(F.broadcast(n)).where(F.col("df") <= F.greatest(F.col("n") * max_share, F.lit(2)))  # n is one row
    w = tf.join(df, "term").select(key, "term", (F.col("tf") * (F.log((1 + F.col("n")) / (1 + F.col("df"))) + 1)).alias("w"))
    norm = w.groupBy(key).agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    return w.join(norm, key).select(key, "term", (F.col("w") / F.col("norm")).alias("w"))


def tfidf_edges(weights: DataFrame, key: str, least: float, most: int, n: int | None = None) -> DataFrame:
    """Cosine of documents through their common terms; the ``most`` nearest of each, and of those the ``n`` nearest of all."""
    a = weights.select(F.col(key).alias("a"), "term", F.col("w").alias("wa"))
    b = weights.select(F.col(key).alias("b"), "term", F.col("w").alias("wb"))
    cosine = a.join(b, "term").where("a <> b").groupBy("a", "b").agg(F.round(F.sum(F.col("wa") * F.col("wb")), 6).alias("cosine"))
    near = top_by(cosine.where(F.col("cosine") >= least), ["a"], [F.desc("cosine"), "b"], most)
    return near if n is None else near.orderBy(F.desc("cosine"), "a", "b").limit(n)


def orphan_links(orphans: DataFrame, senses: DataFrame, abbreviations: DataFrame) -> DataFrame:
    """One link for each orphan that any strategy can place; the first strategy wins.

    1 an abbreviation table (short, full), 0.85; 2 a word of the orphan is in that table, 0.70; 3 a word of the
    orphan is a label, 0.60; 4 the orphan is a word of a label, 0.55; 5 the surest sense of its discipline, 0.30.
    Labels stand for their surest sense, so that joins are by equality and no label fans out. Within a strategy
    the longest label goes first.
    """
    best = first_by(senses.withColumn("_l", F.lower("label")), ["_l"], [F.desc("confidence"), "sense_id"]).select("_l", F.col("sense_id").alias("target_sense_id"))
    o = orphans.select(F.col("sense_id").alias("source_sense_id"), F.lower("label").alias("_o"), "discipline")
    word = lambda c: F.explode(F.array_distinct(F.split(c, " ")))
    short = abbreviations.select(F.lower("short").alias("_s"), F.lower("full").alias("_l"))
    found = [
        o.withColumn("_s", F.col("_o")).join(short, "_s").drop("_s").join(best, "_l").withColumn("strategy", F.lit(1)),
        o.withColumn("_s", word("_o")).where("_s <> _o").join(short, "_s").drop("_s").join(best, "_l").withColumn("strategy", F.lit(2)),
        o.withColumn("_l", word("_o")).where("length(_l) > 3").join(best, "_l").withColumn("strategy", F.lit(3)),
        o.join(first_by(best.withColumn("_o", word("_l")), ["_o"], [F.desc(F.length("_l")), "_l"]), "_o").withColumn("strategy", F.lit(4)),
        o.join(first_by(senses, ["discipline"], [F.desc("confidence"), "sense_id"]).select("discipline", F.col("sense_id").alias("target_sense_id"), F.lower("label").alias("_l")), "discipline").withColumn("strategy", F.lit(5)),
    ]
    every = found[0]
    for f in found[1:]:
        every = every.unionByName(f)
    every = every.where("source_sense_id <> target_sense_id")
    confidence = F.element_at(F.array(*map(F.lit, (0.85, 0.70, 0.60, 0.55, 0.30))), F.col("strategy"))
    return first_by(every, ["source_sense_id"], ["strategy", F.desc(F.length("_l")), "_l", "target_sense_id"]).select("source_sense_id", "target_sense_id", "strategy", confidence.alias("confidence"))
