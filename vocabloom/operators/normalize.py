"""Projections of raw source rows to the unified keyword schema."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vocabloom.functions.frame import first_by

#: Values that end a hierarchy path (fixed values).
STOPS = ["", "NOT APPLICABLE", "NOT PROVIDED"]


def path_of(columns: list[str]) -> Column:
    """Hierarchy columns joined up to the first blank or stop value."""
    parts = F.array(*(F.coalesce(F.trim(F.col(c).cast("string")), F.lit("")) for c in columns))
    stops = F.transform(parts, lambda x: F.upper(x).isin(STOPS))
    n = F.array_position(stops, True)
    return F.array_join(F.when(n > 0, F.slice(parts, F.lit(1), (n - 1).cast("int"))).otherwise(parts), " > ")


def synthetic_ancestors(paths: DataFrame) -> DataFrame:
    """Prefix paths that no row has, with an id made from the path."""
    parts = F.split("path", " > ")
    prefix = paths.where(F.size(parts) > 1).select(
        F.explode(F.transform(F.sequence(F.lit(1), F.size(parts) - 1), lambda i: F.array_join(F.slice(parts, F.lit(1), i), " > "))).alias("path")
    ).distinct()
    missing = prefix.join(paths.select("path").distinct(), "path", "left_anti")
    return missing.select(F.substring(F.sha2("path", 256), 1, 16).alias("id"), "path", F.size(F.split("path", " > ")).alias("parts"))


def parent_by_path(rows: DataFrame) -> DataFrame:
    """The id of the row whose path is one part shorter."""
    up = F.regexp_replace("path", r"(^| > )[^>]*$", "")
    parents = rows.select(F.col("path").alias("_p"), F.col("id").alias("parent_id"))
    return rows.withColumn("_up", up).join(parents, F.col("_up") == F.col("_p"), "left").select("id", "path", "parent_id")


def alias_list(label: str, names: list[str]) -> Column:
    """Other names in order, without stop values, the label itself and repeats."""
    given = F.array_distinct(F.array(*(F.trim(F.coalesce(F.col(c).cast("string"), F.lit(""))) for c in names)))
    return F.filter(given, lambda x: ~F.upper(x).isin(STOPS) & (x != F.col(label)))


def clean_markup(text: str) -> Column:
    return F.trim(F.regexp_replace(text, r"</?[a-zA-Z]+[^>]*>", ""))


def split_list(text: str, separator: str = ",") -> Column:
    """Trimmed, non-blank parts; a blank text has none."""
    return F.filter(F.transform(F.split(F.coalesce(F.col(text), F.lit("")), separator), lambda x: F.trim(x)), lambda x: x != "")


def null_tokens(c: str) -> Column:
    return F.when(~F.trim(F.col(c)).isin("#N/A", "0", ""), F.trim(F.col(c)))


def vocabulary_term(c: str) -> Column:
    return F.trim(F.lower(F.regexp_replace(F.trim(F.col(c)), r"[()]+$", "")))


def doi_key(c: str) -> Column:
    return F.lower(F.regexp_replace(F.trim(F.col(c)), r"^https?://(dx\.)?doi\.org/", ""))


def uri_vocabulary(c: str, hosts: dict[str, str]) -> Column:
    """The vocabulary of a URI by its host, else ``Unknown (host)``."""
    host = F.split_part(F.split_part(F.col(c), F.lit("://"), F.lit(2)), F.lit("/"), F.lit(1))
    out = F.concat(F.lit("Unknown ("), host, F.lit(")"))
    for part, name in reversed(hosts.items()):
        out = F.when(F.col(c).contains(part), name).otherwise(out)
    return out


def path_columns(path: str, names: list[str]) -> list[Column]:
    parts = F.split(path, " > ")
    return [F.try_element_at(parts, F.lit(i + 1)).alias(n) for i, n in enumerate(names)]


def backfill(stored: DataFrame, source: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Values of ``source`` replace those of ``stored`` where they are not null and fit the stored type."""
    new = source.select(F.col(key).alias("_key"), *(F.col(c).try_cast(stored.schema[c].dataType).alias(f"_{c}") for c in columns))
    joined = stored.join(new, stored[key] == F.col("_key"), "left")
    return joined.select(*(F.coalesce(f"_{c}", c).alias(c) if c in columns else F.col(c) for c in stored.columns))


def load_new(rows: DataFrame, key: str, order: list, present: DataFrame) -> DataFrame:
    """The first row of each key that another table does not have yet."""
    return first_by(rows.where(F.col(key).isNotNull()), [key], order).join(present.select(key).distinct(), key, "left_anti")


#: Names of the top categories of descriptor trees (fixed values).
TREE_ROOTS = {
    "A": "Anatomy", "B": "Organisms", "C": "Diseases", "D": "Chemicals and Drugs", "E": "Analytical, Diagnostic and Therapeutic Techniques, and Equipment",
    "F": "Psychiatry and Psychology", "G": "Phenomena and Processes", "H": "Disciplines and Occupations", "I": "Anthropology, Education, Sociology, and Social Phenomena",
    "J": "Technology, Industry, and Agriculture", "K": "Humanities", "L": "Information Science", "M": "Named Groups", "N": "Health Care",
    "V": "Publication Characteristics", "Z": "Geographicals",
}


def tree_category(number: Column) -> Column:
    """Letter and name of a tree number's category, like ``A (Anatomy)``."""
    letter = F.substring(number, 1, 1)
    names = F.create_map(*(F.lit(x) for kv in TREE_ROOTS.items() for x in kv))
    return F.concat(letter, F.lit(" ("), F.coalesce(F.element_at(names, letter), F.lit("Unknown")), F.lit(")"))


def tree_facts(c: str) -> list[Column]:
    """Depth, parents and category (that of the first one) of a list of dotted tree numbers; without any, 0, none and ``Unknown``."""
    dots = F.array_min(F.transform(c, lambda x: F.size(F.split(x, r"\.")) - 1))
    parents = F.filter(F.transform(c, lambda x: F.regexp_extract(x, r"^(.*)\.[^.]*$", 1)), lambda x: x != "")
    category = F.coalesce(tree_category(F.try_element_at(c, F.lit(1))), F.lit("Unknown"))
    return [F.coalesce(dots, F.lit(0)).alias("depth"), F.coalesce(F.array_join(parents, ","), F.lit("")).alias("parents"), category.alias("category")]


def alias_merge(stored: DataFrame, found: DataFrame, key: str) -> DataFrame:
    """Order-preserving union of alias arrays; a found definition replaces the stored one."""
    new = found.select(F.col(key).alias("_key"), F.col("aliases").alias("_a"), F.col("definition").alias("_d"))
    empty = F.array().cast("array<string>")
    return stored.join(new, stored[key] == F.col("_key"), "left").select(
        key, F.array_distinct(F.concat(F.coalesce("aliases", empty), F.coalesce("_a", empty))).alias("aliases"),
        F.coalesce("_d", "definition").alias("definition"),
    )


def rename_dedup(df: DataFrame, names: dict[str, str], key: str, order: list, lists: list[str] = (), numbers: list[str] = ()) -> DataFrame:
    """The columns in ``names`` under their new names, the first row of each key that is not null; comma lists as arrays (null if empty)
    and numbers as longs (null if they are none)."""
    kept = first_by(df.where(F.col(key).isNotNull()), [key], order).select(*(F.col(c).alias(n) for c, n in names.items() if c in df.columns))
    for c in lists:
        kept = kept.withColumn(c, F.when(F.size(split_list(c)) > 0, split_list(c)))
    return kept.withColumns({c: F.trim(F.col(c).cast("string")).try_cast("bigint") for c in numbers})


def assemble(parts: dict[str, Callable[[], DataFrame]], version: str) -> tuple[DataFrame | None, list[str]]:
    """One source from its parts, by name of columns and with one version on all rows, and the names of parts that cannot be read."""
    read, failed = [], []
    for name, part in parts.items():
        try:
            read.append(part())
        except AnalysisException:
            failed.append(name)
    whole = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), read) if read else None
    return whole and whole.withColumn("version", F.lit(version)), failed


def category_lookup(
    rows: DataFrame, gaps: DataFrame, pairs: dict[tuple[str, str], str], categories: dict[str, str], override: dict[str, list[str]], default: str
) -> DataFrame:
    """Discipline of each subject: rows (subject, main, sub) by their pair of categories; of ``gaps`` (subject, main, sub) those
    that rows lack, by the subject itself where ``override`` (discipline to subjects) has it, else by main category."""
    at = F.create_map(*(F.lit(x) for (m, s), v in pairs.items() for x in (f"{m}\x1f{s}", v)))
    by_main = F.create_map(*(F.lit(x) for kv in categories.items() for x in kv))
    own = rows.select("subject", "main", "sub", F.coalesce(F.element_at(at, F.concat_ws("\x1f", F.trim("main"), F.trim("sub"))), F.lit(default)).alias("discipline"))
    fallback = F.coalesce(F.element_at(by_main, F.trim("main")), F.lit(default))
    for discipline, subjects in override.items():
        fallback = F.when(F.lower(F.trim("subject")).isin(subjects), discipline).otherwise(fallback)
    have = rows.select(F.lower(F.trim("subject")).alias("_s")).distinct()
    more = gaps.join(have, F.lower(F.trim("subject")) == F.col("_s"), "left_anti")
    return own.unionByName(more.select("subject", "main", "sub", fallback.alias("discipline")))
