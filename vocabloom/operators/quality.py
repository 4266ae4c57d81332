"""Search, replacement, validation and coverage of keyword tables (id, label, parent_id, source, ...)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vocabloom.functions.frame import first_by


def search_label(keywords: DataFrame, text: str, source: str | None = None) -> DataFrame:
    """Rows whose label contains ``text``, ignoring case; ``%`` and ``_`` in it are wildcards."""
    hit = keywords.where(F.col("label").ilike(f"%{text}%"))
    return hit.where(F.col("source") == source) if source else hit


def by_source(keywords: DataFrame, source: str) -> DataFrame:
    """The keywords of a source in the order of their full path (where there is one), label and id."""
    return keywords.where(F.col("source") == source).orderBy(*(c for c in ("full_path", "label", "id") if c in keywords.columns))


def upsert_replace(stored: DataFrame, records: DataFrame) -> DataFrame:
    """Sources that ``records`` has are replaced by it, others stay."""
    fresh = records.select("source").distinct()
    kept = stored.join(fresh, "source", "left_anti").select(stored.columns)
    return kept.unionByName(records.select(stored.columns))


def upsert_stats(stored: DataFrame, records: DataFrame) -> DataFrame:
    """source, inserted, previous and delta of :func:`upsert_replace`."""
    new = records.groupBy("source").agg(F.count("*").alias("inserted"))
    old = stored.groupBy("source").agg(F.count("*").alias("previous"))
    return new.join(old, "source", "left").select(
        "source", "inserted", F.coalesce("previous", F.lit(0)).alias("previous"),
        (F.col("inserted") - F.coalesce("previous", F.lit(0))).alias("delta"),
    )


def overwrite_columns(stored: DataFrame, records: DataFrame) -> DataFrame:
    """A whole-table replacement: the new rows in the stored columns, missing ones null."""
    return stored.limit(0).unionByName(records, allowMissingColumns=True).select(stored.columns)


def validate_source(keywords: DataFrame) -> DataFrame:
    """For each source: rows, orphan parents, empty labels, repeated ids, and whether it is valid."""
    ids = keywords.select(F.col("source").alias("_s"), F.col("id").alias("_i")).distinct()
    joined = keywords.join(
        ids, (F.col("source") == F.col("_s")) & (F.col("parent_id") == F.col("_i")), "left"
    )
    out = joined.groupBy("source").agg(
        F.count("*").alias("row_count"),
        F.sum(F.when(F.col("parent_id").isNotNull() & F.col("_i").isNull(), 1).otherwise(0)).alias("orphan_parents"),
        F.sum(F.when(F.trim(F.coalesce("label", F.lit(""))) == "", 1).otherwise(0)).alias("empty_labels"),
        (F.count("*") - F.countDistinct("id")).alias("duplicate_ids"),
    )
    return out.withColumn("valid", (F.col("orphan_parents") + F.col("empty_labels") + F.col("duplicate_ids")) == 0)


def source_stats(keywords: DataFrame) -> DataFrame:
    return keywords.groupBy("source").agg(F.count("*").alias("n"))


def field_audit(df: DataFrame, fields: list[str], minimum: float) -> DataFrame:
    """For each field: non-null values, their share, and whether it reaches ``minimum``; one pass."""
    counts = df.agg(F.count("*").alias("n"), *(F.count(c).alias(f"c_{i}") for i, c in enumerate(fields)))
    rows = F.explode(F.array(*(F.struct(F.lit(c).alias("field"), F.col(f"c_{i}").alias("filled")) for i, c in enumerate(fields))))
    share = F.round(F.col("r.filled") / F.col("n"), 6)
    return counts.select("n", rows.alias("r")).select(
        "r.field", "r.filled", share.alias("share"), (share >= minimum).alias("enough")
    )


def insert_new_edges(existing: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """The new edges, once each, whose key is not there yet."""
    return new.dropDuplicates(key).join(existing.select(*key), key, "left_anti").select(new.columns)


def merge_priority(primary: DataFrame, gap: DataFrame) -> DataFrame:
    """Primary rows win; gap rows fill labels that primary lacks, ignoring case."""
    both = primary.withColumn("priority", F.lit(0)).unionByName(gap.withColumn("priority", F.lit(1)))
    return first_by(both.withColumn("_key", F.lower("label")), ["_key"], ["priority", "label"]).drop("_key")


def pending(todo: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Keys that have no output yet."""
    return todo.join(done.select(key).distinct(), key, "left_anti")


def true_orphans(keywords: DataFrame) -> DataFrame:
    """Labels that are no keywords: too short, numeric codes, or classification codes."""
    reason = (
        F.when(F.length("label") <= 2, "short")
        .when(F.col("label").rlike(r"^[0-9.\-]+$"), "numeric_code")
        .when(F.col("label").rlike(r"^[0-9]{2}\.[0-9]{2}\.[A-Za-z+\-]{2}$"), "pacs_code")
    )
    return keywords.withColumn("tag", F.concat(F.lit("true_orphan:"), reason)).where("tag IS NOT NULL")


def category_gaps(full: DataFrame, ours: DataFrame, category: str, index: str) -> DataFrame:
    """Per index: categories, those in our data, and the share covered."""
    seen = ours.select(category).distinct().withColumn("_in", F.lit(1))
    return full.join(seen, category, "left").groupBy(index).agg(
        F.count("*").alias("categories"), F.count("_in").alias("in_our_data"),
        F.round(F.count("_in") / F.count("*"), 6).alias("covered"),
    )


def category_breakdown(rows: DataFrame, trees: str, synonyms: str) -> DataFrame:
    """Rows (measure, n) of a poly-hierarchy: tree numbers by first letter, and descriptors, those in several categories, those without a tree, and synonyms."""
    none = F.array().cast("array<string>")
    given = rows.select(F.coalesce(trees, none).alias("_t"), F.coalesce(synonyms, none).alias("_s"))
    letters = F.array_distinct(F.transform("_t", lambda x: F.substring(x, 1, 1)))
    totals = given.agg(
        F.count("*").alias("descriptors"), F.count_if(F.size(letters) > 1).alias("multi_category"), F.count_if(F.size("_t") == 0).alias("no_tree"), F.sum(F.size("_s")).alias("synonyms")
    )
    measures = F.explode(F.array(*(F.struct(F.lit(c).alias("measure"), F.col(c).cast("long").alias("n")) for c in totals.columns)))
    by_letter = given.select(F.explode("_t").alias("x")).groupBy(F.substring("x", 1, 1).alias("measure")).agg(F.count("*").alias("n"))
    return by_letter.unionByName(totals.select(measures.alias("m")).select("m.*"))


def coverage_stats(rows: DataFrame, group: str, fields: list[str], year: str, key: str, other: DataFrame) -> DataFrame:
    """Per group, and over all (null): rows, the share of each field that is filled, the share of all rows, first and last year, and how many keys ``other`` has too."""
    have = other.select(F.col(key).alias("_k")).distinct().withColumn("_in", F.lit(True))
    joined = rows.join(have, F.col(key) == F.col("_k"), "left")
    every = rows.agg(F.count("*")).scalar()
    filled = lambda c: F.col(c).isNotNull() & (F.trim(F.col(c).cast("string")) != "")
    return joined.rollup(group).agg(
        F.count("*").alias("n"), *(F.round(F.count_if(filled(c)) / F.count("*"), 6).alias(f"share_{c}") for c in fields),
        F.min(year).alias("first_year"), F.max(year).alias("last_year"), F.count("_in").alias("overlap"),
    ).withColumn("share", F.round(F.col("n") / every, 6))
