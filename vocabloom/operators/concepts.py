"""From parsed concepts, topics and descriptors to keyword rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vocabloom.functions.frame import first_by, written


def triples_to_concepts(triples: DataFrame) -> DataFrame:
    """A row for each subject that has a label.

    The English label goes before the first other one; the first definition, else scope note, else
    note is the definition; links are sorted sets.
    """
    of = lambda *names: F.col("predicate").isin(*names)
    english = F.coalesce(F.col("lang") == "en", F.lit(False))
    rank = F.when(of("definition"), 0).when(of("scopeNote"), 1).when(of("note"), 2)
    links = lambda name: F.array_sort(F.collect_set(F.when(of(name), F.col("object")))).alias(name)
    return triples.groupBy("subject").agg(
        F.min_by("object", F.when(of("prefLabel"), F.struct((~english).alias("other"), "pos"))).alias("label"),
        F.array_sort(F.collect_set(F.when(of("altLabel") & (english | F.col("lang").isNull()), F.col("object")))).alias("aliases"),
        F.min_by("object", F.when(rank.isNotNull(), F.struct(rank.alias("k"), "pos"))).alias("definition"),
        *(links(n) for n in ("broader", "narrower", "related")),
    ).where("label IS NOT NULL")


def text_in(texts: str, lang: str) -> Column:
    """The first text of a language in an array of (lang, text), null where there is none."""
    return F.try_element_at(F.filter(texts, lambda x: x["lang"] == lang), F.lit(1))["text"]


def text_any(texts: str, uri: str) -> Column:
    """English, else any language, else the tail of the URI."""
    return F.coalesce(text_in(texts, "en"), F.try_element_at(texts, F.lit(1))["text"], F.substring_index(uri, "/", -1))


def skos_matches(triples: DataFrame) -> DataFrame:
    """Match links once each: exact ones are certain, others 0.9."""
    kinds = {"exactMatch": "exact", "closeMatch": "close", "broadMatch": "broad", "narrowMatch": "narrow"}
    kind = F.lit(None).cast("string")
    for name, short in kinds.items():
        kind = F.when(F.col("predicate") == name, short).otherwise(kind)
    return triples.where(F.col("predicate").isin(list(kinds))).select(
        F.col("subject").alias("source_id"), F.col("object").alias("target_id"), kind.alias("match_type"), F.when(F.col("predicate") == "exactMatch", 1.0).otherwise(0.9).alias("confidence")
    ).distinct()


def entity_rows(entities: DataFrame, kind: str) -> DataFrame:
    """Keyword rows of domain, field, subfield or topic entities, with path and parent from their embedded ancestors."""
    above = ["domain", "field", "subfield", "topic"]
    above = above[: above.index(kind)]
    parent = F.substring_index(F.col(f"{above[-1]}.id"), "/", -1) if above else F.lit(None).cast("string")
    names = [F.col(f"{c}.display_name") for c in above]
    return entities.where("id IS NOT NULL").select(
        F.substring_index("id", "/", -1).alias("id"), F.col("display_name").alias("label"), parent.alias("parent_id"),
        F.concat_ws(" > ", *names, "display_name").alias("full_path"), F.lit(len(above)).alias("level"),
    )


def topic_keywords(topics: DataFrame) -> DataFrame:
    """Keywords of topics as rows of their own; of equal lower-cased texts the first topic (by id) wins, and a topic's own label is none."""
    each = topics.select(F.substring_index("id", "/", -1).alias("parent_id"), "display_name", F.posexplode("keywords").alias("pos", "label"))
    rows = each.where((F.trim("label") != "") & (F.lower("label") != F.lower(F.coalesce("display_name", F.lit("")))))
    key = F.lower("label")
    return first_by(rows.withColumn("_key", key), ["_key"], ["parent_id", "pos"]).select(
        F.concat(F.lit("kw-"), F.substring(F.sha2("_key", 256), 1, 16)).alias("id"), "label", "parent_id", F.lit(4).alias("level")
    )


def tree_parents(descriptors: DataFrame) -> DataFrame:
    """(ui, parent_ui) of every tree number whose parent number a descriptor owns."""
    own = written(descriptors.select("ui", F.explode("tree_numbers").alias("tree")), "tree-numbers")  # both sides of the join, parsed once
    up = own.select("ui", F.regexp_extract("tree", r"^(.*)\.[^.]*$", 1).alias("tree")).where("tree <> ''")
    return up.join(own.select(F.col("ui").alias("parent_ui"), "tree"), "tree").select("ui", "parent_ui").distinct()


def two_level_hierarchy(categories: DataFrame, groups: DataFrame) -> DataFrame:
    """Groups (group_id, label) above categories (code, label, group_id); the code is an alias."""
    top = groups.select(F.concat(F.lit("group-"), "group_id").alias("id"), "label", F.lit(None).cast("string").alias("parent_id"), F.lit(None).cast("string").alias("alias"), F.lit(0).alias("level"))
    low = categories.select(F.concat(F.lit("code-"), "code").alias("id"), "label", F.concat(F.lit("group-"), "group_id").alias("parent_id"), F.col("code").alias("alias"), F.lit(1).alias("level"))
    return top.unionByName(low)


def concept_definition(definitions: str) -> Column:
    """Definition texts, each with its reference, joined by `` | ``."""
    one = lambda x: F.when(F.coalesce(x["reference"], F.lit("")) != "", F.concat(x["text"], F.lit(" [Ref: "), x["reference"], F.lit("]"))).otherwise(x["text"])
    return F.array_join(F.transform(F.filter(definitions, lambda x: F.coalesce(x["text"], F.lit("")) != ""), one), " | ")


def enrichment_stats(keywords: DataFrame, found: DataFrame) -> DataFrame:
    """Outcome counts of an enrichment: ``found`` has id, definition and aliases; rows without a uri are skipped."""
    new = found.select(F.col("id").alias("_id"), F.col("definition").alias("_d"), F.col("aliases").alias("_a"))
    j = keywords.join(new, F.col("id") == F.col("_id"), "left")
    n = lambda c: F.coalesce(F.sum(F.when(c, 1).otherwise(0)), F.lit(0))
    todo, hit = F.col("uri").isNotNull(), F.col("_id").isNotNull()
    return j.agg(
        n(todo & hit).alias("enriched"), n(todo & hit & (F.col("_d") != "")).alias("with_definition"), n(todo & hit & (F.size("_a") > 0)).alias("with_aliases"),
        n(todo & ~hit).alias("failed"), n(~todo).alias("skipped"),
    )
