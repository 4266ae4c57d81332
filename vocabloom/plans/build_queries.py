"""Queries of ingest, assembly, deeper hierarchies and the whole build, with their SQL."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vocabloom.functions.frame import scratch_path
from vocabloom.operators import edges as J
from vocabloom.operators import hierarchy as G
from vocabloom.operators import normalize as N
from vocabloom.operators import senses as C
from vocabloom.operators import validation as V
from vocabloom.plans import standins as S
from vocabloom.plans.registry import LENS_PAIRS, _lenses, query
from vocabloom.plans.standins import t
from vocabloom.sources.parquet import export_parquet, read_parquet

# Ingest

query("rename_dedup", "", """SELECT CAST(l_orderkey AS VARCHAR) AS accession, l_returnflag || '|' || l_linestatus AS keywords, CASE WHEN l_linenumber % 2 = 0 THEN CAST(l_quantity AS BIGINT) END AS times_cited
  FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber DESC, l_partkey, l_returnflag, l_linestatus, l_quantity) = 1""")(
    lambda s, d: N.rename_dedup(
        t(s, d, "lineitem").select("*", F.concat("l_returnflag", F.lit(" , ,"), "l_linestatus").alias("DE"),
                                   F.when(F.col("l_linenumber") % 2 == 0, F.col("l_quantity").cast("bigint").cast("string")).otherwise("n/a").alias("TC"), F.col("l_orderkey").cast("string").alias("UT")),
        {"UT": "accession", "DE": "keywords", "TC": "times_cited", "XX": "absent"}, "UT", [F.desc("l_linenumber"), "l_partkey", "l_returnflag", "l_linestatus", "l_quantity"], ["keywords"], ["times_cited"],
    ).withColumn("keywords", F.array_join("keywords", "|")))


def _parquet_roundtrip(s: SparkSession, d: str) -> DataFrame:
    return read_parquet(s, export_parquet(S.keywords(s, d), scratch_path(s, "export"), "geo"))


query("parquet_roundtrip", "kw", "SELECT * FROM kw WHERE source = 'geo'")(_parquet_roundtrip)
_LOOKUP = {("PROMO", "Brand#1"): "sales", ("ECONOMY", "Brand#2"): "budget"}
query("category_lookup", "", """WITH r AS (SELECT DISTINCT p_name AS subject, p_type AS main, p_brand AS sub FROM part WHERE p_size < 10), g AS (SELECT DISTINCT p_name || CASE WHEN p_size % 2 = 0 THEN '' ELSE '!' END AS subject, p_type AS main, p_brand AS sub FROM part)
  SELECT *, CASE WHEN main = 'PROMO' AND sub = 'Brand#1' THEN 'sales' WHEN main = 'ECONOMY' AND sub = 'Brand#2' THEN 'budget' ELSE 'general' END AS discipline FROM r
  UNION ALL SELECT *, CASE WHEN lower(subject) IN ('red gear!', 'blue bolt!') THEN 'energy' WHEN main = 'LARGE' THEN 'big' ELSE 'general' END FROM g WHERE lower(subject) NOT IN (SELECT lower(subject) FROM r)""")(
    lambda s, d: (lambda p: N.category_lookup(
        p.where("p_size < 10").select(F.col("p_name").alias("subject"), F.col("p_type").alias("main"), F.col("p_brand").alias("sub")).distinct(),
        p.select(F.concat("p_name", F.when(F.col("p_size") % 2 == 0, "").otherwise("!")).alias("subject"), F.col("p_type").alias("main"), F.col("p_brand").alias("sub")).distinct(),
        _LOOKUP, {"LARGE": "big"}, {"energy": ["red gear!", "blue bolt!"]}, "general"))(t(s, d, "part")))
query("alias_merge", "", """SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN p_brand || ',' || p_type || CASE WHEN p_size % 2 = 0 THEN ',' || p_name ELSE '' END ELSE p_brand END AS aliases,
  CASE WHEN p_size % 6 = 0 THEN 'found' ELSE p_name END AS definition FROM part""")(
    lambda s, d: (lambda p: N.alias_merge(
        p.select("p_partkey", F.array("p_brand").alias("aliases"), F.col("p_name").alias("definition")),
        p.where("p_size % 3 = 0").select("p_partkey", F.when(F.col("p_size") % 2 == 0, F.array("p_type", "p_brand", "p_name")).otherwise(F.array("p_type", "p_brand")).alias("aliases"),
                                         F.when(F.col("p_size") % 2 == 0, "found").alias("definition")), "p_partkey"))(t(s, d, "part")).select("p_partkey", F.array_join("aliases", ",").alias("aliases"), "definition"))
query("assemble_source", "", """SELECT 'C' || c_custkey AS id, c_name AS label, CAST(NULL AS VARCHAR) AS parent_id, 'v7' AS version FROM customer
  UNION ALL SELECT 'S' || s_suppkey, s_name, 'N' || s_nationkey, 'v7' FROM supplier""")(
    lambda s, d: N.assemble({
        "customers": lambda: t(s, d, "customer").select(F.concat(F.lit("C"), "c_custkey").alias("id"), F.col("c_name").alias("label")),
        "missing": lambda: t(s, d, "no_such_table"),
        "suppliers": lambda: t(s, d, "supplier").select(F.concat(F.lit("S"), "s_suppkey").alias("id"), F.col("s_name").alias("label"), F.concat(F.lit("N"), "s_nationkey").alias("parent_id")),
    }, "v7")[0])

# Hierarchies

query("tree_rows", "kw", """SELECT a.id, a.level - 1 AS depth, CASE a.level WHEN 1 THEN a.label WHEN 2 THEN b.label || ' > ' || a.label END AS path FROM kw a LEFT JOIN kw b ON a.parent_id = b.id
  WHERE a.level > 0 AND (a.id = 'N3' OR a.parent_id = 'N3')""")(
    lambda s, d: G.tree_rows(S.keywords(s, d), "N3", 2).select("id", "depth", F.array_join(F.transform("path", lambda x: x["label"]), " > ").alias("path")))


def _headings(s: SparkSession, d: str) -> DataFrame:
    """Keywords with several parents and references: a part's type, then its brand, and the parts next to it."""
    k = F.col("p_partkey")
    part = t(s, d, "part").select(
        F.concat(F.lit("P"), k).alias("id"), (F.col("p_size") % 9).alias("level"), F.array(F.concat(F.lit("P"), k + 1), F.concat(F.lit("P"), k + 2)).alias("parents"),
        F.array(F.concat(F.lit("P"), k + 3), F.concat(F.lit("P"), k + 5), F.lit("Q")).alias("refs"))
    return part


query("depth_capped", "", """WITH k AS (SELECT p_partkey AS p, p_size % 9 AS level FROM part), s AS (SELECT * FROM k WHERE level <= 6)
  SELECT 'P' || p AS id, level, CASE WHEN p + 1 IN (SELECT p FROM s) THEN 'P' || (p + 1) WHEN p + 2 IN (SELECT p FROM s) THEN 'P' || (p + 2) END AS parent_id,
    concat_ws(',', CASE WHEN p + 3 IN (SELECT p FROM s) THEN 'P' || (p + 3) END, CASE WHEN p + 5 IN (SELECT p FROM s) THEN 'P' || (p + 5) END) AS refs FROM s""")(
    lambda s, d: G.depth_capped(_headings(s, d), 6).withColumn("refs", F.array_join("refs", ",")))


def _ranked(s: SparkSession, d: str) -> DataFrame:
    return S.keywords(s, d).withColumn("rank", F.element_at(F.array(*map(F.lit, ("kingdom", "no rank", "species"))), F.col("level") + 1))


query("lineage", "kw", """SELECT a.id, CASE a.level WHEN 0 THEN a.label WHEN 1 THEN b.label ELSE c.label || ' > ' || a.label END AS path,
  CASE a.level WHEN 0 THEN '' WHEN 1 THEN b.label ELSE c.label || '; ' || b.label END AS lineage FROM kw a LEFT JOIN kw b ON a.parent_id = b.id LEFT JOIN kw c ON b.parent_id = c.id""")(
    lambda s, d: G.lineages(_ranked(s, d), ["kingdom", "species"]))
query("rank_filter", "kw", "SELECT id, CASE level WHEN 0 THEN 0 ELSE 1 END AS level FROM kw WHERE level IN (0, 2)")(
    lambda s, d: G.rank_filter(_ranked(s, d), ["kingdom", "species"]).select("id", "level"))
_ENVELOPE = "SELECT 'org:L{0}:' || replace(lower({1}), ' ', '_') AS envelope_id, {2} AS label, {3} AS parent_id, {0} AS level, {4} AS full_path, '{5}' AS node_type, count(*) AS pub_count FROM o GROUP BY {6}"
query("envelope", "", f"""WITH o AS (SELECT *, 'J' || (o_custkey % 50) AS journal, 'Y' || year(o_orderdate) AS y FROM orders), e AS (
  {_ENVELOPE.format(0, 'o_orderpriority', 'o_orderpriority', 'NULL', 'o_orderpriority', 'program', 'o_orderpriority')} UNION ALL
  {_ENVELOPE.format(1, 'o_orderstatus', 'o_orderstatus', "'org:L0:' || replace(lower(o_orderpriority), ' ', '_')", "o_orderpriority || ' > ' || o_orderstatus", 'sub_program', 'o_orderpriority, o_orderstatus')} UNION ALL
  {_ENVELOPE.format(2, 'journal', 'journal', "'org:L1:' || lower(o_orderstatus)", "o_orderpriority || ' > ' || o_orderstatus || ' > ' || journal", 'technology', 'o_orderpriority, o_orderstatus, journal')} UNION ALL
  SELECT 'org:L3:' || lower(x.journal || '_' || y), y, 'org:L2:' || lower(x.journal), 3, w.o_orderpriority || ' > ' || w.o_orderstatus || ' > ' || x.journal || ' > ' || y, 'sub_technology', n
    FROM (SELECT journal, y, count(*) AS n FROM o WHERE journal IN ('J1', 'J2') GROUP BY 1, 2) x JOIN (SELECT DISTINCT o_orderpriority, o_orderstatus, journal FROM o) w ON w.journal = x.journal)
  SELECT envelope_id, label, parent_id, level, full_path, node_type, pub_count FROM e QUALIFY row_number() OVER (PARTITION BY envelope_id ORDER BY full_path) = 1""")(
    lambda s, d: G.envelope(
        t(s, d, "orders").select("o_orderpriority", "o_orderstatus", F.concat(F.lit("J"), F.col("o_custkey") % 50).alias("journal"), F.concat(F.lit("Y"), F.year("o_orderdate")).alias("y")), "org", "v1",
        [("o_orderpriority", "program"), ("o_orderstatus", "sub_program"), ("journal", "technology")], ("y", "sub_technology"), ["J1", "J2"]).drop("envelope_name", "version"))

# Classification

_EXACT = {"first": ["j1", "j2"]}
_WORDS = [("threes", ["j3"]), ("fours", ["j4", "j5"])]
_CATEGORIES = {"1-URGENT": "urgent"}
_CATEGORY_WORDS = [("high", ["high"]), ("low", ["low", "medium"])]
_CLASS_SQL = """CASE WHEN lower({0}) IN ('j1', 'j2') THEN 'first' WHEN contains(lower({0}), 'j3') THEN 'threes' WHEN contains(lower({0}), 'j4') OR contains(lower({0}), 'j5') THEN 'fours'
  WHEN lower({1}) = '1-urgent' THEN 'urgent' WHEN contains(lower({1}), 'high') THEN 'high' WHEN contains(lower({1}), 'low') OR contains(lower({1}), 'medium') THEN 'low' ELSE 'general' END"""


def _classify(label: str, category: str) -> Column:
    return C.classify_keyword(label, category, _EXACT, _WORDS, _CATEGORIES, _CATEGORY_WORDS, "general")


query("classify_keyword", "pubs", f"SELECT pub, {_CLASS_SQL.format('journal', 'category')} AS discipline FROM pubs")(
    lambda s, d: S.pubs(s, d).select("pub", _classify("journal", "category").alias("discipline")))
_MODAL = "m AS (SELECT journal, category FROM pubs GROUP BY 1, 2 QUALIFY row_number() OVER (PARTITION BY journal ORDER BY count(*) DESC, category) = 1)"
query("journal_discipline", "pubs", f", {_MODAL} SELECT journal, category, {_CLASS_SQL.format('journal', 'category')} AS discipline FROM m")(
    lambda s, d: C.journal_disciplines(S.pubs(s, d), _classify))
query("journal_senses", "pubs", f""", {_MODAL}, f AS (SELECT lower(journal) AS l, {_CLASS_SQL.format('journal', 'category')} AS discipline FROM m)
  SELECT pub, journal AS label, CASE WHEN category <> '5-LOW' THEN coalesce(f.discipline, 'none') ELSE 'none' END AS discipline FROM pubs LEFT JOIN f ON lower(journal) = l""")(
    lambda s, d: C.update_disciplines(S.pubs(s, d).select("pub", F.col("journal").alias("label"), F.when(F.col("category") == "5-LOW", "other").otherwise("journal").alias("source"), F.lit("none").alias("discipline")),
                                      C.journal_disciplines(S.pubs(s, d), _classify), ["journal"]).drop("source"))
query("jaccard", "", """SELECT p_partkey, round(len(list_intersect(a, b)) / len(list_distinct(list_concat(a, b))), 6) * CASE WHEN len(a) > 0 AND len(b) > 0 THEN 1 ELSE 0 END AS similarity FROM (
  SELECT p_partkey, string_split(p_name, ' ') AS a, CASE WHEN p_size % 4 = 0 THEN [] ELSE string_split(p_type || ' ' || split_part(p_name, ' ', 1), ' ') END AS b FROM part)""")(
    lambda s, d: t(s, d, "part").select("p_partkey", F.split("p_name", " ").alias("a"), F.when(F.col("p_size") % 4 == 0, F.array().cast("array<string>")).otherwise(
        F.split(F.concat_ws(" ", "p_type", F.split_part("p_name", F.lit(" "), F.lit(1))), " ")).alias("b")).select("p_partkey", V.jaccard("a", "b").alias("similarity")))


# The whole build


def build_all(s: SparkSession, d: str) -> dict[str, DataFrame]:
    """The sense layer over a set of tables, step by step; every step is a table that later ones read."""
    keywords, papers = S.keywords(s, d), S.pub_keywords(s, d)
    own = keywords.select(F.concat("id", F.lit("#0")).alias("sense_id"), F.col("id").alias("keyword_id"), "label", "source", F.col("source").alias("discipline"), F.lit(0.8).alias("confidence"))
    authored = C.pub_senses(papers)
    return {
        "disciplines": S.disciplines(s, d),
        "lenses": s.createDataFrame([(x.lens_id,) for x in _lenses(s, d)], "lens_id string"),
        "senses": own,
        "polysemous_labels": C.polysemy(own).select("label").distinct(),
        "hierarchy_edges": J.hierarchy_edges(keywords, own),
        "label_alignment": J.label_alignment(own),
        "pub_senses": authored,
        "category_senses": C.unpivot_fields(S.pubs(s, d), "pub", ["category", "journal"]).select("field", "value").distinct(),
        "vocabulary_gap": C.missing_labels(t(s, d, "part").select(F.col("p_brand").alias("label")).distinct(), authored),
    }


def _build_stats(s: SparkSession, d: str) -> DataFrame:
    return reduce(DataFrame.unionByName, (df.agg(F.count("*").alias("n")).select(F.lit(step).alias("step"), "n") for step, df in build_all(s, d).items()))


query("build_all", "kw pubkw pubs disc", f"""SELECT 'disciplines' AS step, count(*) AS n FROM disc UNION ALL SELECT 'lenses', 3 * count(*) + {3 * len(LENS_PAIRS)} + 1 FROM disc UNION ALL SELECT 'senses', count(*) FROM kw
  UNION ALL SELECT 'polysemous_labels', count(*) FROM (SELECT label FROM kw GROUP BY 1 HAVING count(DISTINCT source) >= 2)
  UNION ALL SELECT 'hierarchy_edges', count(*) FROM (SELECT DISTINCT id, parent_id FROM kw WHERE parent_id IN (SELECT id FROM kw))
  UNION ALL SELECT 'label_alignment', count(*) FROM (SELECT DISTINCT lower(label) AS l, source FROM kw) a JOIN (SELECT DISTINCT lower(label) AS l, source FROM kw) b ON a.l = b.l AND a.source < b.source
  UNION ALL SELECT 'pub_senses', count(DISTINCT label) FROM pubkw UNION ALL SELECT 'category_senses', count(DISTINCT category) + count(DISTINCT journal) FROM pubs
  UNION ALL SELECT 'vocabulary_gap', count(DISTINCT p_brand) FROM part WHERE lower(p_brand) NOT IN (SELECT lower(label) FROM pubkw)""")(_build_stats)
