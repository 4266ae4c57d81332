"""Senses: classification by rules, polysemy, and senses made from publication keywords."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vocabloom.functions.automaton import Rule, classified
from vocabloom.functions.frame import first_by, top_by
from vocabloom.operators.normalize import split_list
from vocabloom.operators.rule_tables import CATEGORIES, keyword_rules, source_rules


def classify(text: str, rules: list[tuple[str, list[str]]], default: str) -> Column:
    """The class of the first rule one of whose words is in the text; a generated ``when`` chain."""
    out = None
    for name, words in rules:
        hit = F.lower(F.col(text)).rlike("|".join(words))
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return F.lit(default) if out is None else out.otherwise(default)


def classify_keyword(
    label: str, category: str, exact: dict[str, list[str]], rules: list[tuple[str, list[str]]], categories: dict[str, str],
    category_rules: list[tuple[str, list[str]]], default: str,
) -> Column:
    """The class of a keyword: by the exact sets, else the first rule whose text is in the label, else the exact category, else
    the first category rule, else ``default``; all ignoring case. The tables are parameters."""
    low, cat = F.lower(F.trim(F.col(label))), F.lower(F.trim(F.col(category)))

    def first(text: Column, ordered: list[tuple[str, list[str]]]) -> Column:
        out = F.lit(None).cast("string")
        for name, words in reversed(ordered):
            out = F.when(F.coalesce(text.rlike("|".join(re.escape(w) for w in words)), F.lit(False)), name).otherwise(out)
        return out

    sets = F.lit(None).cast("string")
    for name, labels in reversed(exact.items()):
        sets = F.when(low.isin(labels), name).otherwise(sets)
    known = F.element_at(F.create_map(*(F.lit(x) for k, v in categories.items() for x in (k.lower(), v))), cat) if categories else F.lit(None).cast("string")
    return F.coalesce(sets, first(low, rules), known, first(cat, category_rules), F.lit(default))


def source_disciplines(keywords: DataFrame, name: str = "discipline") -> DataFrame:
    """Keywords (source, path, label, kind) with the discipline that the rules of their source give; the table is :func:`source_rules`.

    A path's parts are parted by `` > ``; blank ones do not count.
    """
    parts = F.filter(F.transform(F.split(F.coalesce("path", F.lit("")), " > ", -1), F.trim), lambda x: x != "")
    part = lambda k: F.get(parts, F.lit(k))
    of = {
        "part1": part(0), "part2": part(1), "topic": F.when(F.col("kind") == "sciencekeywords", part(1)), "path": F.lower("path"), "label": F.lower("label"),
        "kind": F.col("kind"), "letter": F.substring("kind", 1, 1),
    }
    return classified(keywords, source_rules(), of, F.col("source"), name)


def keyword_disciplines(keywords: DataFrame, label: str = "label", category: str = "category", name: str = "discipline") -> DataFrame:
    """Publication keywords with their discipline, by :func:`keyword_rules`: the keyword itself goes before its publication's category."""
    low = F.lower(F.trim(F.col(label)))
    return classified(keywords, keyword_rules(), {"label": low, "category": F.col(category), "category_low": F.lower(category)}, name=name)


def publication_senses(mentions: DataFrame, senses: DataFrame, disciplines: DataFrame, prefix: str = "wos", source: str = "WoS_publication") -> DataFrame:
    """A sense of each different keyword of publications, from ``mentions`` (pub, label, kind, category), with kinds ``author`` and ``plus``.

    Keywords are trimmed and in lower case; the category is that of the first publication that has one; tags say where the keyword comes from, that
    ten publications or more have it, and that ``senses`` has its label. Of keywords whose shortened ids collide the first in order stays, as do
    ids that ``senses`` has already.
    """
    low = F.lower(F.trim("label"))
    n = lambda kind: F.count(F.when(F.col("kind") == kind, 1))
    counted = mentions.select("pub", low.alias("label"), "kind", "category").where("label <> ''").groupBy("label").agg(
        F.countDistinct("pub").alias("pubs"), n("author").alias("author"), n("plus").alias("plus"), F.expr("min_by(category, pub) FILTER (WHERE category IS NOT NULL)").alias("category")
    )
    sense_id = F.concat(F.lit(f"{prefix}:"), F.substring(F.replace("label", F.lit(" "), F.lit("_")), 1, 60), F.lit(f"@{source}#0"))
    unique = first_by(counted.withColumn("sense_id", sense_id), ["sense_id"], ["label"]).join(senses.select("sense_id"), "sense_id", "left_anti")
    known = senses.select(F.lower("label").alias("label")).distinct().withColumn("_known", F.lit(True))
    tag = lambda hit, name: F.when(hit, F.lit(name))
    tags = F.array_compact(F.array(
        tag(F.col("author") > 0, "author_keyword"), tag(F.col("plus") > 0, "keywords_plus"), tag(F.col("pubs") >= 10, "high_frequency"), tag(F.col("_known"), "pillar_overlap")
    ))
    named = keyword_disciplines(unique.join(known, "label", "left"))
    return with_tier(named, disciplines).select(
        "sense_id", F.concat(F.lit(f"{prefix}:"), "label").alias("keyword_id"), F.lit(source).alias("source"), "label", "category", "discipline", "resolution_tier", "pubs", "author", "plus",
        F.array_join(tags, ",").alias("tags"), F.round(F.least(F.lit(0.95), 0.5 + F.col("pubs") / 100), 6).alias("confidence"),
    )


def _value_senses(values: DataFrame, prefix: str, source: str, drop: str = "") -> DataFrame:
    """(label, ...) with sense_id, keyword_id and source; a label's id is its lower-case form without ``drop``, with underscores and cut to 60 characters, and of
    labels with one id the first in order stays."""
    slug = F.substring(F.replace(F.translate(F.lower("label"), drop, ""), F.lit(" "), F.lit("_")), 1, 60)
    named = values.withColumns({"sense_id": F.concat(F.lit(f"{prefix}:"), slug, F.lit(f"@{source}#0")), "keyword_id": F.concat(F.lit(f"{prefix}:"), "label"), "source": F.lit(source)})
    return first_by(named, ["sense_id"], ["label"])


def category_senses(pubs: DataFrame, key: str, fields: list[str], disciplines: DataFrame, prefix: str = "woscat", source: str = "WoS_category") -> DataFrame:
    """A sense of each different category in ``fields`` of publications, with the number of publications that have it in any of them; its discipline is
    that of the exact category."""
    each = unpivot_fields(pubs, key, fields).select(key, F.trim("value").alias("label")).where("label <> ''").distinct()
    counted = each.groupBy("label").agg(F.count("*").alias("pubs"))
    exact = [Rule(name, "is", "label", c) for name, some in CATEGORIES for c in some] + [Rule("math_physics", "any")]
    placed = with_tier(classified(_value_senses(counted, prefix, source, ","), exact, {"label": F.col("label")}), disciplines)
    return placed.select("sense_id", "keyword_id", "source", "label", "discipline", "resolution_tier", "pubs", F.lit(0.9).alias("confidence"))


def field_senses(rows: DataFrame, key: str, groups: list[tuple[list[str], str, str, float, int | None]], senses: DataFrame, disciplines: DataFrame) -> DataFrame:
    """Senses of the different values, longer than two characters, of groups of fields (fields, prefix, source, confidence, tier).

    A group without a tier is classified as keywords that are their own category; the others are about policy, in the given tier. Labels and
    ids that ``senses`` has are left out.
    """
    known = senses.select(F.lower("label").alias("_l")).distinct()
    every = None
    for fields, prefix, source, confidence, tier in groups:
        values = unpivot_fields(rows, key, fields).select(F.trim("value").alias("label")).where("length(label) > 2").distinct()
        fresh = values.join(known, F.lower("label") == F.col("_l"), "left_anti")
        named = _value_senses(fresh, prefix, source, "," if tier is None else "").join(senses.select("sense_id"), "sense_id", "left_anti")
        if tier is None:
            placed = with_tier(keyword_disciplines(named, "label", "label"), disciplines)
        else:
            placed = named.withColumn("discipline", F.lit("policy_economics")).withColumn("resolution_tier", F.lit(tier))
        part = placed.select("sense_id", "source", "label", "discipline", "resolution_tier", F.lit(confidence).alias("confidence"))
        every = part if every is None else every.unionByName(part)
    return every


def journal_disciplines(pubs: DataFrame, classifier: Callable[[str, str], Column]) -> DataFrame:
    """(journal, category, discipline): the class of each journal by its name and its commonest category."""
    named = pubs.where("journal IS NOT NULL AND category IS NOT NULL").select(F.trim("journal").alias("journal"), F.trim("category").alias("category"))
    return modal_value(named, "journal", "category").select("journal", "category", classifier("journal", "category").alias("discipline"))


def update_disciplines(senses: DataFrame, found: DataFrame, sources: list[str]) -> DataFrame:
    """Senses of the given sources take the discipline that ``found`` (journal, discipline) has for their label, ignoring case."""
    by_label = found.groupBy(F.lower("journal").alias("_l")).agg(F.min("discipline").alias("_d"))
    joined = senses.join(by_label, (F.lower("label") == F.col("_l")) & F.col("source").isin(sources), "left")
    return joined.select(*(F.coalesce("_d", "discipline").alias(c) if c == "discipline" else F.col(c) for c in senses.columns))


def with_tier(senses: DataFrame, disciplines: DataFrame, default: int = 4) -> DataFrame:
    """Adds the tier of the discipline (a small dimension)."""
    tiers = disciplines.select(F.col("discipline_id").alias("discipline"), F.col("tier").alias("resolution_tier"))
    return senses.join(tiers, "discipline", "left").withColumn("resolution_tier", F.coalesce("resolution_tier", F.lit(default)))


def polysemy(senses: DataFrame) -> DataFrame:
    """Senses whose label is in two or more sources, with a disambiguation and confidence."""
    labels = senses.groupBy("label").agg(F.countDistinct("source").alias("sources")).where("sources >= 2")
    first_word = F.split_part("source", F.lit(" "), F.lit(1))
    return senses.join(labels, "label").select(
        "sense_id", "label", "sources",
        F.concat("label", F.lit(" ("), first_word, F.lit(")")).alias("disambiguation"),
        F.when(F.col("sources") >= 3, 0.7).otherwise(0.75).alias("polysemy_confidence"),
    )


def secondary_disciplines(senses: DataFrame) -> DataFrame:
    """Other disciplines of a label, without those already seen on an earlier sense of it.

    A discipline counts as seen from its first sense on. The lists stay short: a label has as many
    entries as disciplines, not senses.
    """
    firsts = senses.groupBy("label", "discipline").agg(F.min("sense_id").alias("first_id"))
    of_label = firsts.groupBy("label").agg(F.array_sort(F.collect_list(F.struct("discipline", "first_id"))).alias("all"))
    joined = senses.select("sense_id", "label", "discipline").join(of_label, "label")
    later = F.filter("all", lambda x: (x["discipline"] != F.col("discipline")) & (x["first_id"] >= F.col("sense_id")))
    return joined.select("sense_id", F.array_join(F.transform(later, lambda x: x["discipline"]), ",").alias("secondary"))


def pub_senses(pub_keywords: DataFrame) -> DataFrame:
    """For each publication keyword: publications, mentions by kind and a confidence that grows with them."""
    n = F.countDistinct("pub")
    return pub_keywords.groupBy("label").agg(
        n.alias("pubs"), F.sum(F.when(F.col("kind") == "R", 1).otherwise(0)).alias("kind_r"),
        F.sum(F.when(F.col("kind") != "R", 1).otherwise(0)).alias("kind_other"),
        F.round(F.least(F.lit(0.95), 0.5 + n / 100), 6).alias("pub_confidence"),
    )


def modal_value(df: DataFrame, key: str, value: str) -> DataFrame:
    """The most frequent value of each key, the smallest of equals."""
    counted = df.where(F.col(value).isNotNull()).groupBy(key, value).agg(F.count("*").alias("n"))
    return first_by(counted, [key], [F.desc("n"), value])


def top_counts(df: DataFrame, value: str, n: int) -> DataFrame:
    return df.groupBy(value).agg(F.count("*").alias("mentions")).orderBy(F.desc("mentions"), value).limit(n)


def agency_senses(rows: DataFrame, names: str, n: int, rules: list[tuple[str, list[str]]], default: str) -> DataFrame:
    """The ``n`` names that most comma lists mention, with the class of the first rule one of whose words is in the name."""
    each = rows.select(F.explode(split_list(names)).alias("label"))
    return top_counts(each, "label", n).withColumn("discipline", classify("label", rules, default))


def top_modal(df: DataFrame, key: str, value: str, n: int) -> DataFrame:
    """The ``n`` most frequent keys, each with its most frequent value."""
    return modal_value(df, key, value).join(F.broadcast(top_counts(df.where(F.col(key).isNotNull()), key, n)), key)  # n rows


def missing_labels(vocabulary: DataFrame, senses: DataFrame) -> DataFrame:
    """Vocabulary labels without a sense, ignoring case."""
    have = senses.select(F.lower("label").alias("_l")).distinct()
    return vocabulary.join(have, F.lower(vocabulary["label"]) == F.col("_l"), "left_anti")


def new_pub_senses(pub_keywords: DataFrame, senses: DataFrame, least: float) -> DataFrame:
    strong = pub_keywords.where(F.col("relevance") >= least)
    return missing_labels(strong, senses).groupBy("label").agg(
        F.countDistinct("pub").alias("pubs"), F.round(F.avg("relevance"), 6).alias("avg_relevance"),
        F.round(F.least(F.avg("relevance") * 0.8, F.lit(0.9)), 6).alias("new_confidence"),
    )


def majority_vote(senses: DataFrame, edges: DataFrame) -> DataFrame:
    """The commonest discipline among a sense's neighbours, over both directions."""
    both = edges.select(F.col("source_sense_id").alias("sense_id"), F.col("target_sense_id").alias("_n")).union(
        edges.select("target_sense_id", "source_sense_id")
    )
    votes = both.join(senses.select(F.col("sense_id").alias("_n"), "discipline"), "_n").groupBy("sense_id", "discipline").agg(F.count("*").alias("votes"))
    return first_by(votes, ["sense_id"], [F.desc("votes"), "discipline"])


def unpivot_fields(df: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """(key, value, field) for every non-null value, distinct."""
    return df.select(key, *(F.col(f).cast("string").alias(f) for f in fields)).unpivot([key], fields, "field", "value").where("value IS NOT NULL").distinct()


def field_provenance(df: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """For each value the fields it comes from."""
    return unpivot_fields(df, key, fields).groupBy("value").agg(
        F.array_join(F.array_sort(F.collect_set("field")), ",").alias("fields"), F.countDistinct(key).alias("n")
    )


def share_of_group(df: DataFrame, group: str, value: str) -> DataFrame:
    w = Window.partitionBy(group)
    return df.groupBy(group, value).agg(F.count("*").alias("n")).withColumn("share", F.round(F.col("n") / F.sum("n").over(w), 6))


def lab_senses(pubs: DataFrame, key: str, fields: list[str], category: str, senses: DataFrame) -> DataFrame:
    """Values of several fields of publications, once for each publication and longer than two characters.

    Per label: publications, first category, and whether a sense has the label already.
    """
    values = F.array_distinct(F.flatten(F.array(*(F.coalesce(F.array(F.col(f).cast("string")), F.array().cast("array<string>")) for f in fields))))
    each = pubs.select(key, F.col(category).alias("_c"), F.explode(values).alias("label")).where(F.length("label") > 2)
    counted = each.groupBy("label").agg(F.countDistinct(key).alias("pubs"), F.min("_c").alias("category"))
    have = senses.select(F.lower("label").alias("_l")).distinct()
    return counted.join(have, F.lower("label") == F.col("_l"), "left").select("label", "pubs", "category", F.col("_l").isNotNull().alias("matching"))


def lab_links(labels: DataFrame, senses: DataFrame, most: int = 3) -> DataFrame:
    """At most ``most`` senses of each matching label."""
    per = top_by(senses.select("sense_id", F.lower("label").alias("_l")), ["_l"], ["sense_id"], most, "place")
    return labels.where("matching").join(per, F.lower("label") == F.col("_l")).select("label", F.col("sense_id").alias("target_sense_id"), "place")


def resolve_entities(names: DataFrame, aliases: DataFrame) -> DataFrame:
    """(name, canonical): by the alias table (variant, canonical), else the smallest name that differs
    only in case, blanks and punctuation."""
    key = lambda c: F.regexp_replace(F.lower(c), "[^a-z0-9]", "")
    n = names.select("name").where("name IS NOT NULL").distinct().withColumn("_key", key("name"))
    known = aliases.select(key("variant").alias("_key"), "canonical").groupBy("_key").agg(F.min("canonical").alias("_given"))
    own = n.groupBy("_key").agg(F.min("name").alias("_own"))
    return n.join(own, "_key").join(known, "_key", "left").select("name", F.coalesce("_given", "_own").alias("canonical"))
