"""Readers of vocabulary files: keyword CSV, N-Triples, SKOS and descriptor XML, dumps and JSON entities.

Each ``parse_*`` takes a DataFrame of text lines (or one record in a column), so that it works on
``spark.read.text``, on a table and on a stream alike; broken lines give no row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vocabloom.functions.frame import first_by

#: Columns of a keyword file that are no part of the hierarchy (fixed values).
METADATA = ["UUID", "SHORT_NAME", "LONG_NAME"]
SKOS = "http://www.w3.org/2004/02/skos/core#"
#: SKOS predicates that the triple scan keeps (fixed values).
PREDICATES = ["prefLabel", "altLabel", "broader", "narrower", "related", "note", "scopeNote", "definition", "exactMatch", "closeMatch", "broadMatch", "narrowMatch"]

_TEXTS = "ARRAY<STRUCT<`_VALUE`: STRING, `_xml:lang`: STRING>>"
_LINKS = "ARRAY<STRUCT<`_rdf:resource`: STRING>>"
CONCEPT_XML = (
    f"`_rdf:about` STRING, `skos:prefLabel` {_TEXTS}, `skos:altLabel` {_TEXTS}, `skos:definition` {_TEXTS}, `skos:scopeNote` {_TEXTS}, "
    f"`skos:broader` {_LINKS}, `skos:narrower` {_LINKS}, `skos:related` {_LINKS}"
)
_STRING = "STRUCT<String: STRING>"
DESCRIPTOR_XML = (
    f"DescriptorUI STRING, DescriptorName {_STRING}, TreeNumberList STRUCT<TreeNumber: ARRAY<STRING>>, "
    f"ConceptList STRUCT<Concept: ARRAY<STRUCT<`_PreferredConceptYN`: STRING, ScopeNote: STRING, TermList: STRUCT<Term: ARRAY<{_STRING}>>>>>"
)
_NAMED = "STRUCT<id: STRING, display_name: STRING>"
ENTITY_JSON = f"id STRING, display_name STRING, description STRING, domain {_NAMED}, field {_NAMED}, subfield {_NAMED}, keywords ARRAY<STRING>"
WORK_JSON = f"id STRING, display_name STRING, topics ARRAY<{_NAMED}>, keywords ARRAY<STRUCT<display_name: STRING>>, referenced_works ARRAY<STRING>"
_DATE = "STRUCT<`date-parts`: ARRAY<ARRAY<INT>>>"
RECORD_JSON = f"DOI STRING, title ARRAY<STRING>, `published-print` {_DATE}, `published-online` {_DATE}, issued {_DATE}"


#: A line of N-Triples: subject, predicate, and as object an address or a text with its language.
TRIPLE = r'^\s*<([^>]*)>\s+<([^>]*)>\s+(?:<([^>]*)>|"((?:[^"\\]|\\.)*)"(?:@([A-Za-z0-9-]+)|\^\^<[^>]*>)?)\s*\.\s*$'


def hierarchy_columns(header: list[str]) -> list[str]:
    """The columns of a keyword file that form its hierarchy, in order."""
    return [c for c in header if c.strip().upper() not in METADATA]


def split_header(line: str) -> list[str]:
    return [c.strip().strip('"') for c in line.split(",")]


def parse_csv(lines: DataFrame, header: str, metadata: str = "") -> DataFrame:
    """Keyword rows of quoted lines, without the header, the metadata line and blank lines."""
    columns = split_header(header)
    schema = ", ".join(f"`{c}` STRING" for c in columns)
    body = lines.where((F.trim("value") != "") & ~F.col("value").isin(header, metadata))
    return body.select(F.from_csv("value", schema, {"quote": '"'}).alias("r")).select("r.*")


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """A keyword file: line 0 metadata, line 1 header. A file of fewer than three lines has no rows."""
    lines = spark.read.text(path)
    head = [r.value for r in lines.take(3)]
    if len(head) < 3:
        return spark.createDataFrame([], "UUID string")
    return parse_csv(lines, head[1], head[0])


def read_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(value, pos, file): lines of text files with a place that orders them the same way however the files are split: by path, start of
    the block in the file, and order in the block (whose rows are read by one task, one after the other)."""
    lines = spark.read.text(paths)
    file, block = F.col("_metadata.file_path"), F.col("_metadata.file_block_start")
    return lines.select("value", F.struct(file.alias("file"), block.alias("block"), F.monotonically_increasing_id().alias("at")).alias("pos"), file.alias("file"))


def version_of(line: Column) -> Column:
    """The version that a metadata line names: its first field, if the line speaks of a version."""
    return F.when(line.contains("Version"), F.trim(F.translate(F.split_part(line, F.lit(","), F.lit(1)), '"', "")))


def file_versions(lines: DataFrame) -> DataFrame:
    """(file, version) of the first line of each file (of :func:`read_lines`)."""
    first = lines.groupBy("file").agg(F.min_by("value", "pos").alias("_line"))
    return first.select("file", version_of(F.col("_line")).alias("version"))


def read_versioned_csv(spark: SparkSession, paths: list[str]) -> DataFrame:
    """The rows of several keyword files, each with its ``file`` and the version that its metadata line names; columns that a file lacks are null.

    A file of fewer than three lines has no rows. Only the first three lines of each file reach the driver.
    """
    every = None
    for path in paths:
        head = [r["value"] for r in spark.read.text(path).take(3)]
        if len(head) == 3:
            rows = parse_csv(spark.read.text(path), head[1], head[0]).withColumns({"file": F.lit(path), "version": version_of(F.lit(head[0]))})
            every = rows if every is None else every.unionByName(rows, allowMissingColumns=True)
    return spark.createDataFrame([], "file string, version string") if every is None else every


def broken_triples(lines: DataFrame) -> DataFrame:
    """(value, pos, reason) of the lines that are neither a triple, a comment nor blank: ``subject``, ``predicate``, ``object`` or ``end``, the first part that is wrong."""
    iri, text = r"<[^>]*>", r'"(?:[^"\\]|\\.)*"(?:@[A-Za-z0-9-]+|\^\^<[^>]*>)?'
    parts = [("subject", rf"^\s*{iri}\s"), ("predicate", rf"^\s*{iri}\s+{iri}\s"), ("object", rf"^\s*{iri}\s+{iri}\s+(?:{iri}|{text})")]
    reason = F.lit("end")
    for name, pattern in reversed(parts):
        reason = F.when(~F.col("value").rlike(pattern), name).otherwise(reason)
    some = lines.where(~F.col("value").rlike(r"^\s*(?:#.*)?$") & ~F.col("value").rlike(TRIPLE))
    return some.select("value", "pos", reason.alias("reason"))


def parse_triples(lines: DataFrame) -> DataFrame:
    """(subject, predicate, object, lang, pos) of N-Triples lines; ``pos`` keeps the order of lines.

    A column ``pos`` that the lines already have, such as that of :func:`read_lines`, is kept; else the order is that of one read of the files.
    """
    part = lambda k: F.regexp_extract("value", TRIPLE, k)
    text = F.replace(F.replace(part(4), F.lit('\\"'), F.lit('"')), F.lit("\\\\"), F.lit("\\"))
    pos = F.col("pos") if "pos" in lines.columns else F.monotonically_increasing_id()
    return lines.where(F.col("value").rlike(TRIPLE)).select(
        part(1).alias("subject"), part(2).alias("predicate"), F.when(part(3) != "", part(3)).otherwise(text).alias("object"), F.nullif(part(5), F.lit("")).alias("lang"), pos.alias("pos")
    )


def skos_triples(triples: DataFrame) -> DataFrame:
    """Triples with a SKOS predicate of :data:`PREDICATES`, by its local name."""
    name = F.substring_index("predicate", "#", -1)
    return triples.where(F.col("predicate").startswith(SKOS) & name.isin(PREDICATES)).withColumn("predicate", name)


def _concept(r: str = "r") -> list[Column]:
    links = lambda c: F.transform(F.coalesce(F.col(f"{r}.`skos:{c}`"), F.array()), lambda x: x["_rdf:resource"]).cast("array<string>")
    texts = lambda c: F.transform(F.col(f"{r}.`skos:{c}`"), lambda x: F.struct(x["_xml:lang"].alias("lang"), x["_VALUE"].alias("text")))
    return [
        F.col(f"{r}.`_rdf:about`").alias("uri"), texts("prefLabel").alias("pref_labels"), texts("altLabel").alias("alt_labels"),
        texts("definition").alias("definitions"), texts("scopeNote").alias("notes"), links("broader").alias("broader"), links("narrower").alias("narrower"), links("related").alias("related"),
    ]


def parse_skos(records: DataFrame, column: str = "value") -> DataFrame:
    """Concepts of SKOS XML records, one ``skos:Concept`` in each row."""
    return records.select(F.from_xml(F.col(column), CONCEPT_XML).alias("r")).where("r.`_rdf:about` IS NOT NULL").select(*_concept())


def read_skos(spark: SparkSession, path: str) -> DataFrame:
    raw = spark.read.format("xml").option("rowTag", "skos:Concept").schema(CONCEPT_XML).load(path)
    return raw.select(F.struct("*").alias("r")).where("r.`_rdf:about` IS NOT NULL").select(*_concept())


def parse_nodes(lines: DataFrame) -> DataFrame:
    """(tax_id, parent_id, rank) of a dump of nodes; the root's link to itself becomes null."""
    p = F.split("value", r"\t\|\t?")
    out = lines.where(F.size(p) >= 3).select(*(F.trim(p[i]).alias(n) for i, n in enumerate(["tax_id", "parent_id", "rank"])))
    return out.withColumn("parent_id", F.when(F.col("parent_id") != F.col("tax_id"), F.col("parent_id")))


def parse_names(lines: DataFrame) -> DataFrame:
    """For each tax_id its scientific name, its common name and its sorted aliases."""
    p = F.split("value", r"\t\|\t?")
    rows = lines.where(F.size(p) >= 4).select(F.trim(p[0]).alias("tax_id"), F.trim(p[1]).alias("name"), F.trim(p[3]).alias("kind"))
    of = lambda kind: F.when(F.col("kind") == kind, F.col("name"))
    alias = F.when(~F.col("kind").isin("scientific name", "authority"), F.col("name"))
    return rows.groupBy("tax_id").agg(
        F.min(of("scientific name")).alias("label"), F.min(of("genbank common name")).alias("common_name"), F.array_sort(F.collect_set(alias)).alias("aliases")
    ).where("label IS NOT NULL")


def parse_descriptors(records: DataFrame, column: str = "value") -> DataFrame:
    """Descriptor XML records: ui, heading, tree numbers, preferred scope note, other terms."""
    r = records.select(F.from_xml(F.col(column), DESCRIPTOR_XML, {"attributePrefix": "_"}).alias("r")).where("r.DescriptorUI IS NOT NULL")
    concepts = F.coalesce(F.col("r.ConceptList.Concept"), F.array())
    preferred = F.filter(concepts, lambda x: x["_PreferredConceptYN"] == "Y")
    terms = F.flatten(F.transform(concepts, lambda x: F.coalesce(F.transform(x["TermList"]["Term"], lambda y: F.trim(y["String"])), F.array().cast("array<string>"))))
    heading = F.trim(F.col("r.DescriptorName.String"))
    return r.select(
        F.col("r.DescriptorUI").alias("ui"), heading.alias("heading"), F.coalesce(F.col("r.TreeNumberList.TreeNumber"), F.array().cast("array<string>")).alias("tree_numbers"),
        F.trim(F.try_element_at(preferred, F.lit(1))["ScopeNote"]).alias("scope_note"), F.array_distinct(F.filter(terms, lambda x: x != heading)).alias("synonyms"),
    )


def parse_json(records: DataFrame, schema: str, column: str = "value") -> DataFrame:
    """JSON records of a column in a fixed schema; ``spark.read.schema(schema).json`` reads files alike."""
    return records.select(F.from_json(F.col(column), schema).alias("r")).where("r IS NOT NULL").select("r.*")


def tail(c: str | Column) -> Column:
    """The last part of a URI."""
    return F.substring_index(c, "/", -1)


def work_summary(works: DataFrame) -> DataFrame:
    """Works with their topics and keywords joined by ``;``; a work of several files is taken once."""
    named = lambda c, f: F.array_join(F.transform(F.coalesce(F.col(c), F.array()), lambda x: F.coalesce(f(x), F.lit(""))), ";")
    out = works.where("id IS NOT NULL").select(
        tail("id").alias("work_id"), F.col("display_name").alias("title"), named("topics", lambda x: tail(x["id"])).alias("topic_ids"),
        named("topics", lambda x: x["display_name"]).alias("topics"), named("keywords", lambda x: x["display_name"]).alias("keywords"),
    )
    return first_by(out, ["work_id"], ["title", "topic_ids", "topics", "keywords"])


def slim_records(records: DataFrame) -> DataFrame:
    """(doi, title, year): the year of the first date that a record has; one row for each DOI."""
    first = lambda c: F.try_element_at(F.try_element_at(F.col(f"`{c}`")["date-parts"], F.lit(1)), F.lit(1))
    out = records.where("DOI IS NOT NULL").select(
        F.lower("DOI").alias("doi"), F.try_element_at("title", F.lit(1)).alias("title"), F.coalesce(*(first(c) for c in ("published-print", "published-online", "issued"))).alias("year")
    )
    return first_by(out, ["doi"], ["year", "title"])


def json_documents(rows: DataFrame, key: str, order: str, name: str) -> DataFrame:
    """One nested JSON document for each key, ready for ``df.write.text``; its rows are sorted by ``order``."""
    others = [c for c in rows.columns if c not in (key, order)]
    nested = F.array_sort(F.collect_list(F.struct(order, *others)))
    return rows.groupBy(key).agg(F.to_json(F.struct(nested.alias(name))).alias("document"))


def explode_mappings(experts: DataFrame) -> DataFrame:
    """Rows (expert, category, source, confidence) of nested expert files."""
    c = experts.select("expert", F.explode("categories").alias("c"))
    return c.select("expert", F.col("c.name").alias("category"), F.explode("c.source_mappings").alias("m")).select("expert", "category", "m.source", "m.confidence")
