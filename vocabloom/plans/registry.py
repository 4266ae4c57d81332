"""All queries over the driver's tables, with their SQL.

A query is a library operator applied to the stand-in tables of :mod:`vocabloom.plans.standins`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vocabloom.operators import edges as J
from vocabloom.operators import flows as A
from vocabloom.operators import hierarchy as G
from vocabloom.operators import lenses as L
from vocabloom.operators import normalize as N
from vocabloom.operators import quality as Q
from vocabloom.operators import senses as C
from vocabloom.operators import text as T
from vocabloom.operators import validation as V
from vocabloom.plans import standins as S
from vocabloom.plans.standins import t, with_ctes

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}

#: Weights of the example lens over part types.
LENS = {"ECONOMY": 0.95, "STANDARD": 0.4, "PROMO": 0.25}
LENS_SQL = "CASE discipline WHEN 'ECONOMY' THEN 0.95 WHEN 'STANDARD' THEN 0.4 WHEN 'PROMO' THEN 0.25 ELSE 0.1 END"
BOOST_SQL = "CASE tier WHEN 1 THEN 2.0 WHEN 2 THEN 1.5 WHEN 3 THEN 1.0 ELSE 0.5 END"
SCORE_SQL = f"round(({LENS_SQL})::DOUBLE * confidence * ({BOOST_SQL})::DOUBLE, 6)"
TYPED_SQL = "CASE WHEN {0} THEN 'equivalent_sense' ELSE 'cross_domain_bridge' END AS relationship_type, CASE WHEN {0} THEN 'toward' ELSE 'across' END AS direction"


def query(name: str, ctes: str = "", sql: str | None = None) -> Callable:
    def add(f: Callable) -> Callable:
        _QUERIES[name] = f
        if sql is not None:
            _SQL[name] = with_ctes(ctes, sql) if ctes else sql
        return f

    return add


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


# Search, replacement and quality

query("search_label", "kw", "SELECT id, label, source FROM kw WHERE label ILIKE '%00%' AND source = 'geo'")(
    lambda s, d: Q.search_label(S.keywords(s, d), "00", "geo").select("id", "label", "source"))
query("by_source", "kw", "SELECT id, label FROM kw WHERE source = 'catalog'")(
    lambda s, d: Q.by_source(S.keywords(s, d), "catalog").select("id", "label"))
query("upsert_replace", "kw", "SELECT * FROM kw WHERE source <> 'catalog' UNION ALL SELECT * FROM kw WHERE source = 'catalog' AND level < 2")(
    lambda s, d: Q.upsert_replace(S.keywords(s, d), S.keywords(s, d).where("source = 'catalog' AND level < 2")))
query("upsert_stats", "kw", """SELECT source, count(*) FILTER (level < 2) AS inserted, count(*) AS previous,
  count(*) FILTER (level < 2) - count(*) AS delta FROM kw WHERE source = 'catalog' GROUP BY 1""")(
    lambda s, d: Q.upsert_stats(S.keywords(s, d), S.keywords(s, d).where("source = 'catalog' AND level < 2")))
query("overwrite_raw", "kw", "SELECT id, label, CAST(NULL AS VARCHAR) AS parent_id, source, CAST(NULL AS INT) AS level FROM kw")(
    lambda s, d: Q.overwrite_columns(S.keywords(s, d), S.keywords(s, d).select("id", "label", "source")))
query("validate_source", "kw", """SELECT a.source, count(*) AS row_count,
  CAST(sum(CASE WHEN a.parent_id IS NOT NULL AND b.id IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS orphan_parents,
  CAST(sum(CASE WHEN trim(coalesce(a.label, '')) = '' THEN 1 ELSE 0 END) AS BIGINT) AS empty_labels,
  count(*) - count(DISTINCT a.id) AS duplicate_ids,
  sum(CASE WHEN a.parent_id IS NOT NULL AND b.id IS NULL THEN 1 ELSE 0 END) + sum(CASE WHEN trim(coalesce(a.label, '')) = '' THEN 1 ELSE 0 END) + count(*) - count(DISTINCT a.id) = 0 AS valid
  FROM kw a LEFT JOIN (SELECT DISTINCT id, source FROM kw) b ON a.parent_id = b.id AND a.source = b.source GROUP BY 1""")(
    lambda s, d: Q.validate_source(S.keywords(s, d)))
query("source_stats", "kw", "SELECT source, count(*) AS n FROM kw GROUP BY 1")(lambda s, d: Q.source_stats(S.keywords(s, d)))
query("field_audit", "senses", """SELECT field, filled, round(filled / n, 6) AS share, round(filled / n, 6) >= 0.9 AS enough FROM (
  SELECT 'label' AS field, count(label) AS filled, count(*) AS n FROM senses UNION ALL SELECT 'level', count(level), count(*) FROM senses
  UNION ALL SELECT 'tier', count(tier), count(*) FROM senses)""")(
    lambda s, d: Q.field_audit(S.senses(s, d), ["label", "level", "tier"], 0.9))
query("coverage_stats", "pubs", """, p AS (SELECT *, CASE WHEN pub % 3 = 0 THEN NULL ELSE journal END AS j, CASE WHEN pub % 5 = 0 THEN ' ' ELSE category END AS c FROM pubs)
  SELECT status, count(*) AS n, round(count(j) / count(*), 6) AS share_j, round(count(*) FILTER (trim(c) <> '') / count(*), 6) AS share_c, min(year) AS first_year, max(year) AS last_year,
    count(*) FILTER (pub IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')) AS overlap, round(count(*) / (SELECT count(*) FROM pubs), 6) AS share FROM p GROUP BY ROLLUP (status)""")(
    lambda s, d: Q.coverage_stats(
        S.pubs(s, d).select("pub", "status", "year", F.when(F.col("pub") % 3 != 0, F.col("journal")).alias("j"), F.when(F.col("pub") % 5 == 0, " ").otherwise(F.col("category")).alias("c")),
        "status", ["j", "c"], "year", "pub", t(s, d, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("pub"))))
query("insert_new_edges", "senses rels", """SELECT DISTINCT source_sense_id, target_sense_id, relationship_type FROM rels
  WHERE NOT (relationship_type = 'equivalent_sense')""")(
    lambda s, d: (lambda r: Q.insert_new_edges(r.where("relationship_type = 'equivalent_sense'"), r.union(r), ["source_sense_id", "target_sense_id", "relationship_type"]))(
        S.rels(s, d).select("source_sense_id", "target_sense_id", "relationship_type")))
query("merge_priority", "", """SELECT label, source, priority FROM (SELECT *, row_number() OVER (PARTITION BY lower(label) ORDER BY priority, label) AS rn FROM (
  SELECT DISTINCT p_brand AS label, 'brand' AS source, 0 AS priority FROM part
  UNION ALL SELECT DISTINCT upper(p_brand), 'gap', 1 FROM part UNION ALL SELECT DISTINCT p_type, 'gap', 1 FROM part)) WHERE rn = 1""")(
    lambda s, d: Q.merge_priority(
        t(s, d, "part").select(F.col("p_brand").alias("label"), F.lit("brand").alias("source")).distinct(),
        t(s, d, "part").select(F.upper("p_brand").alias("label"), F.lit("gap").alias("source")).union(t(s, d, "part").select("p_type", F.lit("gap"))).distinct()))
query("resume_pending", "", "SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')")(
    lambda s, d: Q.pending(t(s, d, "orders").select("o_orderkey"), t(s, d, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey"))
query("true_orphans", "", """SELECT id, label, 'true_orphan:' || CASE WHEN length(label) <= 2 THEN 'short' ELSE 'numeric_code' END AS tag FROM (
  SELECT p_partkey AS id, CAST(p_size AS VARCHAR) || CASE WHEN p_size % 3 = 0 THEN '.10' WHEN p_size % 3 = 1 THEN '' ELSE ' kg' END AS label FROM part)
  WHERE length(label) <= 2 OR regexp_matches(label, '^[0-9.\\-]+$')""")(
    lambda s, d: Q.true_orphans(t(s, d, "part").select(
        F.col("p_partkey").alias("id"),
        F.concat(F.col("p_size").cast("string"), F.when(F.col("p_size") % 3 == 0, ".10").when(F.col("p_size") % 3 == 1, "").otherwise(" kg")).alias("label"))))
query("category_breakdown", "", """WITH d AS (SELECT CASE p_size % 4 WHEN 0 THEN [] WHEN 1 THEN ['A0' || p_size] WHEN 2 THEN ['A1', 'B' || p_size] ELSE ['Q1', 'Q2'] END AS trees, CASE WHEN p_size % 3 = 0 THEN NULL ELSE string_split(p_name, ' ') END AS words FROM part)
  SELECT substr(x, 1, 1) AS measure, count(*) AS n FROM (SELECT unnest(trees) AS x FROM d) GROUP BY 1 UNION ALL SELECT 'descriptors', count(*) FROM d UNION ALL SELECT 'multi_category', count(*) FROM d WHERE len(trees) = 2 AND trees[1] = 'A1'
  UNION ALL SELECT 'no_tree', count(*) FROM d WHERE len(trees) = 0 UNION ALL SELECT 'synonyms', CAST(sum(len(words)) AS BIGINT) FROM d""")(
    lambda s, d: Q.category_breakdown(t(s, d, "part").select(
        F.when(F.col("p_size") % 4 == 1, F.array(F.concat(F.lit("A0"), "p_size"))).when(F.col("p_size") % 4 == 2, F.array(F.lit("A1"), F.concat(F.lit("B"), "p_size")))
        .when(F.col("p_size") % 4 == 3, F.array(F.lit("Q1"), F.lit("Q2"))).alias("trees"), F.when(F.col("p_size") % 3 != 0, F.split("p_name", " ")).alias("words")), "trees", "words"))
query("category_gaps", "", """SELECT c.p_brand AS idx, count(*) AS categories, count(o.p_type) AS in_our_data, round(count(o.p_type) / count(*), 6) AS covered
  FROM (SELECT DISTINCT p_brand, p_type FROM part) c LEFT JOIN (SELECT DISTINCT p_type FROM part WHERE p_size = 1) o USING (p_type) GROUP BY 1""")(
    lambda s, d: Q.category_gaps(t(s, d, "part").select(F.col("p_brand").alias("idx"), "p_type").distinct(), t(s, d, "part").where("p_size = 1"), "p_type", "idx"))

# Hierarchies

query("graph_build", "kw", "SELECT id, max(r) AS has_record FROM (SELECT id, true AS r FROM kw UNION ALL SELECT parent_id, false FROM kw WHERE parent_id IS NOT NULL) GROUP BY 1")(
    lambda s, d: G.build_graph(S.keywords(s, d)))
query("roots", "kw", "SELECT id FROM kw WHERE parent_id IS NULL")(lambda s, d: G.roots(S.keywords(s, d)))
query("leaves", "kw", "SELECT id FROM kw WHERE id NOT IN (SELECT parent_id FROM kw WHERE parent_id IS NOT NULL)")(lambda s, d: G.leaves(S.keywords(s, d)))
query("ancestors", "kw closure", "SELECT id, ancestor, hops FROM closure")(lambda s, d: G.closure(S.keywords(s, d)))
query("full_path", "kw", """SELECT a.id, concat_ws(' > ', c.label, b.label, a.label) AS full_path FROM kw a
  LEFT JOIN kw b ON a.parent_id = b.id LEFT JOIN kw c ON b.parent_id = c.id""")(lambda s, d: G.full_paths(S.keywords(s, d)))
query("descendants", "kw closure", "SELECT id, hops FROM closure WHERE ancestor = 'R1'")(lambda s, d: G.descendants(S.keywords(s, d), "R1"))
query("children", "kw", "SELECT parent_id AS id, count(*) AS children FROM kw WHERE parent_id IS NOT NULL GROUP BY 1")(lambda s, d: G.children(S.keywords(s, d)))
query("siblings", "kw", "SELECT parent_id, id, count(*) OVER (PARTITION BY parent_id) - 1 AS siblings FROM kw WHERE parent_id IS NOT NULL")(lambda s, d: G.sibling_groups(S.keywords(s, d)))
query("subtree", "kw closure", "SELECT id, label, parent_id FROM kw WHERE id = 'R2' OR id IN (SELECT id FROM closure WHERE ancestor = 'R2')")(
    lambda s, d: G.subtree(S.keywords(s, d), "R2").select("id", "label", "parent_id"))
query("depth", "kw", "SELECT id, level AS depth FROM kw")(lambda s, d: G.depths(S.keywords(s, d)))
query("graph_stats", "kw", """SELECT count(*) AS nodes, max(level) AS max_depth, count(parent_id) AS edges, count(*) FILTER (parent_id IS NULL) AS roots,
  count(*) FILTER (id NOT IN (SELECT parent_id FROM kw WHERE parent_id IS NOT NULL)) AS leaves FROM kw""")(lambda s, d: G.graph_stats(S.keywords(s, d)))
query("depth_histogram", "kw", "SELECT level AS depth, count(*) AS n FROM kw GROUP BY 1")(lambda s, d: G.depth_histogram(S.keywords(s, d)))
query("lca", "kw", """SELECT a.id AS a, b.id AS b, CASE WHEN a.parent_id = b.parent_id THEN a.parent_id ELSE na.parent_id END AS ancestor
  FROM kw a JOIN kw b ON b.id = 'S' || substr(a.id, 2) JOIN kw na ON na.id = a.parent_id JOIN kw nb ON nb.id = b.parent_id
  WHERE a.id LIKE 'C%' AND (a.parent_id = b.parent_id OR na.parent_id = nb.parent_id)""")(
    lambda s, d: G.common_ancestors(S.keywords(s, d), t(s, d, "supplier").select(F.concat(F.lit("C"), "s_suppkey").alias("a"), F.concat(F.lit("S"), "s_suppkey").alias("b"))))
query("find_label", "kw", "SELECT id, label FROM kw WHERE contains(lower(label), 'an')")(lambda s, d: G.find_label(S.keywords(s, d), "AN").select("id", "label"))
query("reachable", "kw closure", "SELECT DISTINCT id, level FROM (SELECT id, hops AS level FROM closure WHERE ancestor IN ('R0', 'R3') UNION ALL SELECT id, 0 FROM kw WHERE id IN ('R0', 'R3'))")(
    lambda s, d: G.reach(S.keywords(s, d).where("parent_id IS NOT NULL").select(F.col("parent_id").alias("src"), F.col("id").alias("dst")), S.keywords(s, d).where("id IN ('R0', 'R3')")))
query("bfs_levels", "kw", "SELECT level, count(*) AS n FROM kw GROUP BY 1")(
    lambda s, d: G.reach(S.keywords(s, d).where("parent_id IS NOT NULL").select(F.col("parent_id").alias("src"), F.col("id").alias("dst")), G.roots(S.keywords(s, d))).groupBy("level").agg(F.count("*").alias("n")))
query("filtered_parent", "kw", """SELECT a.id, CASE WHEN a.level = 2 THEN b.parent_id WHEN a.level = 1 THEN a.parent_id END AS parent FROM kw a LEFT JOIN kw b ON a.parent_id = b.id""")(
    lambda s, d: G.filtered_parent(S.keywords(s, d).withColumn("rank", F.when(F.col("level") == 0, "top").otherwise("no rank")), ["top"]))
query("orphans", "senses rels", "SELECT sense_id FROM senses WHERE sense_id NOT IN (SELECT source_sense_id FROM rels WHERE confidence > 0.5 UNION ALL SELECT target_sense_id FROM rels WHERE confidence > 0.5)")(
    lambda s, d: G.unconnected(S.senses(s, d).select("sense_id"), S.rels(s, d).where("confidence > 0.5")))
query("density", "senses rels", """SELECT relationship_type, provenance, count(*) AS n, round(count(*) / (SELECT count(*) FROM senses), 6) AS per_sense FROM (
  SELECT *, CASE WHEN confidence > 0.5 THEN 'label' ELSE 'guess' END AS provenance FROM rels) GROUP BY 1, 2""")(
    lambda s, d: G.density(S.senses(s, d), S.rels(s, d).withColumn("provenance", F.when(F.col("confidence") > 0.5, "label").otherwise("guess")), ["relationship_type", "provenance"]))
query("degree", "senses rels", "SELECT sense_id, count(*) AS degree FROM (SELECT source_sense_id AS sense_id FROM rels UNION ALL SELECT target_sense_id FROM rels WHERE target_sense_id <> source_sense_id) GROUP BY 1")(
    lambda s, d: G.degrees(S.rels(s, d)))

# Senses

RULES = [("economy", ["economy"]), ("premium", ["promo", "standard"]), ("metal", ["steel", "brass", "tin"])]
query("classify_source", "", "SELECT p_partkey, CASE WHEN p_type = 'ECONOMY' THEN 'economy' WHEN p_type IN ('PROMO', 'STANDARD') THEN 'premium' ELSE 'other' END AS class FROM part")(
    lambda s, d: t(s, d, "part").select("p_partkey", C.classify("p_type", RULES, "other").alias("class")))
query("classify_text", "", """SELECT doc_id, CASE WHEN regexp_matches(lower(text), 'license|copyright') THEN 'legal' WHEN regexp_matches(lower(text), 'idiot|stupid|loser') THEN 'abuse' ELSE 'general' END AS class FROM documents""")(
    lambda s, d: t(s, d, "documents").select("doc_id", C.classify("text", [("legal", ["license", "copyright"]), ("abuse", ["idiot", "stupid", "loser"])], "general").alias("class")))
query("senses", "senses", "SELECT * FROM senses")(lambda s, d: S.senses(s, d))
query("sense_tiers", "senses disc", "SELECT sense_id, coalesce(d.tier, 4) AS resolution_tier FROM senses s LEFT JOIN disc d ON s.discipline = d.discipline_id AND d.tier <= 3")(
    lambda s, d: C.with_tier(S.senses(s, d), S.disciplines(s, d).where("tier <= 3")).select("sense_id", "resolution_tier"))
query("polysemy", "senses", """SELECT s.sense_id, s.label, sources, s.label || ' (' || split_part(source, ' ', 1) || ')' AS disambiguation,
  CASE WHEN sources >= 3 THEN 0.7 ELSE 0.75 END::DOUBLE AS polysemy_confidence FROM senses s JOIN (SELECT label, count(DISTINCT source) AS sources FROM senses GROUP BY 1) g USING (label) WHERE sources >= 2""")(
    lambda s, d: C.polysemy(S.senses(s, d)))
query("secondary_disciplines", "senses", """SELECT s.sense_id, coalesce(string_agg(f.discipline, ',' ORDER BY f.discipline), '') AS secondary FROM senses s
  LEFT JOIN (SELECT label, discipline, min(sense_id) AS first_id FROM senses GROUP BY 1, 2) f ON f.label = s.label AND f.discipline <> s.discipline AND f.first_id >= s.sense_id GROUP BY 1""")(
    lambda s, d: C.secondary_disciplines(S.senses(s, d)))
query("pub_senses", "pubkw", """SELECT label, count(DISTINCT pub) AS pubs, CAST(sum(CASE WHEN kind = 'R' THEN 1 ELSE 0 END) AS BIGINT) AS kind_r,
  CAST(sum(CASE WHEN kind <> 'R' THEN 1 ELSE 0 END) AS BIGINT) AS kind_other, round(least(0.95::DOUBLE, 0.5 + count(DISTINCT pub) / 100), 6) AS pub_confidence FROM pubkw GROUP BY 1""")(
    lambda s, d: C.pub_senses(S.pub_keywords(s, d)))
_CLASS = "SELECT lower(label) AS l, discipline, min(sense_id) AS first, count(*) AS n FROM senses WHERE CAST(keyword_id AS INT) % 2 = {0} GROUP BY 1, 2"
query("label_links", "senses", f"""SELECT a.first AS source_sense_id, b.first AS target_sense_id, {TYPED_SQL.format('a.discipline = b.discipline')}, a.n * b.n AS pairs
  FROM ({_CLASS.format(1)}) a JOIN ({_CLASS.format(0)}) b ON a.l = b.l""")(
    lambda s, d: J.label_links(*(S.senses(s, d).where(F.col("keyword_id").cast("int") % 2 == k) for k in (1, 0))))
query("category_senses", "", "SELECT value, count(*) AS n FROM (SELECT DISTINCT o_orderkey, unnest([o_orderpriority, o_orderstatus]) AS value FROM orders) GROUP BY 1")(
    lambda s, d: C.unpivot_fields(t(s, d, "orders"), "o_orderkey", ["o_orderpriority", "o_orderstatus"]).groupBy("value").agg(F.count("*").alias("n")))
query("modal_category", "pubs", """SELECT journal, category, n, mentions FROM (SELECT journal, category, count(*) AS n FROM pubs GROUP BY 1, 2 QUALIFY row_number() OVER (PARTITION BY journal ORDER BY count(*) DESC, category) = 1)
  JOIN (SELECT journal, count(*) AS mentions FROM pubs GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20) USING (journal)""")(
    lambda s, d: C.top_modal(S.pubs(s, d), "journal", "category", 20))
query("agency_senses", "", """SELECT label, count(*) AS mentions, CASE WHEN contains(lower(label), 'economy') THEN 'economy' WHEN contains(lower(label), 'promo') OR contains(lower(label), 'standard') THEN 'premium' ELSE 'other' END AS discipline
  FROM (SELECT unnest([p_type, p_brand]) AS label FROM part) GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 25""")(
    lambda s, d: C.agency_senses(t(s, d, "part").select(F.concat("p_type", F.lit(" , "), "p_brand", F.lit(",")).alias("names")), "names", 25, RULES, "other"))
query("vocab_gap", "senses", "SELECT DISTINCT p_brand AS label FROM part WHERE lower(p_brand) NOT IN (SELECT lower(label) FROM senses)")(
    lambda s, d: C.missing_labels(t(s, d, "part").select(F.col("p_brand").alias("label")).distinct(), S.senses(s, d)))
query("new_pub_senses", "pubkw", """SELECT label, count(DISTINCT pub) AS pubs, round(avg(relevance), 6) AS avg_relevance, round(least(avg(relevance) * 0.8, 0.9), 6) AS new_confidence
  FROM pubkw WHERE relevance >= 0.3 AND lower(label) NOT IN (SELECT lower(p_name || ' ' || p_brand) FROM part WHERE p_size < 25) GROUP BY 1""")(
    lambda s, d: C.new_pub_senses(S.pub_keywords(s, d), t(s, d, "part").where("p_size < 25").select(F.concat_ws(" ", "p_name", "p_brand").alias("label")), 0.3))
query("majority_vote", "senses rels", """SELECT sense_id, discipline, votes FROM (SELECT e.sense_id, s.discipline, count(*) AS votes,
    row_number() OVER (PARTITION BY e.sense_id ORDER BY count(*) DESC, s.discipline) AS rn
  FROM (SELECT source_sense_id AS sense_id, target_sense_id AS n FROM rels UNION ALL SELECT target_sense_id, source_sense_id FROM rels) e JOIN senses s ON s.sense_id = e.n GROUP BY 1, 2) WHERE rn = 1""")(
    lambda s, d: C.majority_vote(S.senses(s, d), S.rels(s, d)))
query("field_provenance", "", """SELECT value, string_agg(DISTINCT field, ',' ORDER BY field) AS fields, count(DISTINCT p_partkey) AS n FROM (
  SELECT p_partkey, p_type AS value, 'p_type' AS field FROM part UNION ALL SELECT p_partkey, p_brand, 'p_brand' FROM part) GROUP BY 1""")(
    lambda s, d: C.field_provenance(t(s, d, "part"), "p_partkey", ["p_type", "p_brand"]))
query("meta_senses", "", "SELECT DISTINCT field, value FROM (SELECT 'p_type' AS field, p_type AS value FROM part UNION ALL SELECT 'p_brand', p_brand FROM part UNION ALL SELECT 'p_size', CAST(p_size AS VARCHAR) FROM part)")(
    lambda s, d: C.unpivot_fields(t(s, d, "part"), "p_partkey", ["p_type", "p_brand", "p_size"]).select("field", "value").distinct())

# Relationships

query("alignment_edges", "senses", f"""SELECT DISTINCT a.sense_id AS source_sense_id, b.sense_id AS target_sense_id, {TYPED_SQL.format('a.discipline = b.discipline')}
  FROM senses a JOIN senses b ON CAST(b.keyword_id AS INT) = CAST(a.keyword_id AS INT) + 7""")(
    lambda s, d: J.alignment_edges(t(s, d, "part").select(F.col("p_partkey").cast("string").alias("source_id"), (F.col("p_partkey") + 7).cast("string").alias("target_id")), S.senses(s, d)))
query("label_alignment", "senses", """SELECT a.key, a.source, b.source AS target, CASE WHEN g.n >= 3 THEN 0.9 ELSE 0.75 END::DOUBLE AS confidence,
  CASE WHEN g.n >= 3 THEN 'label_match_3plus' ELSE 'label_match_2' END AS method FROM (SELECT DISTINCT lower(label) AS key, source FROM senses) a
  JOIN (SELECT DISTINCT lower(label) AS key, source FROM senses) b ON a.key = b.key AND a.source < b.source JOIN (SELECT lower(label) AS key, count(DISTINCT source) AS n FROM senses GROUP BY 1) g ON g.key = a.key""")(
    lambda s, d: J.label_alignment(S.senses(s, d)))
query("hierarchy_edges", "kw", "SELECT id || '#0' AS source_sense_id, parent_id || '#0' AS target_sense_id FROM kw WHERE parent_id IS NOT NULL")(
    lambda s, d: (lambda k: J.hierarchy_edges(k, k.select(F.col("id").alias("keyword_id"), F.concat("id", F.lit("#0")).alias("sense_id"))))(S.keywords(s, d)))
query("containment", "", """SELECT DISTINCT a.label AS narrower, b.w AS broader FROM (SELECT DISTINCT p_name AS label, unnest(string_split(lower(p_name), ' ')) AS word FROM part WHERE contains(p_name, ' ')) a
  JOIN (SELECT DISTINCT split_part(p_name, ' ', 1) AS w FROM part) b ON a.word = lower(b.w) AND length(b.w) >= 4 AND NOT contains(b.w, ' ')""")(
    lambda s, d: J.containment(t(s, d, "part").select(F.col("p_name").alias("label")).union(t(s, d, "part").select(F.split_part("p_name", F.lit(" "), F.lit(1))).distinct()).distinct()))
PAIRS = "(SELECT a.label AS a, b.label AS b, count(*) AS pubs FROM (SELECT DISTINCT pub, label FROM pubkw WHERE relevance >= {0}) a JOIN (SELECT DISTINCT pub, label FROM pubkw WHERE relevance >= {0}) b ON a.pub = b.pub AND a.label < b.label GROUP BY 1, 2 HAVING count(*) >= {1})"
query("cooccurrence", "pubkw", f"SELECT a, b, pubs FROM {PAIRS.format(0.3, 2)}")(lambda s, d: J.cooccurrence(S.pub_keywords(s, d), 2, 0.3))
for _name, _per, _step in (("cooccurrence_sets", 2, 0.02), ("cooccurrence_single", 1, 0.01)):
    query(_name, "senses fine pubkw", f""", best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY confidence DESC, sense_id) AS rn FROM fine) WHERE rn <= {_per})
      SELECT x.sense_id AS source_sense_id, y.sense_id AS target_sense_id, pubs, round(least(0.9::DOUBLE, 0.5 + pubs * {_step}::DOUBLE), 6) AS edge_confidence, {"'across'" if _per == 1 else "CASE WHEN x.discipline = y.discipline THEN 'toward' ELSE 'across' END"} AS direction
      FROM {PAIRS.format(0, 3)} p JOIN best x ON x.label = p.a JOIN best y ON y.label = p.b""")(
        lambda s, d, n=_per, step=_step: J.cooccurrence_edges(J.cooccurrence(S.pub_keywords(s, d), 3), S.fine_senses(s, d), F.least(F.lit(0.9), 0.5 + F.col("pubs") * step), n, "across" if n == 1 else None))
POLY = """, sn AS (SELECT * FROM senses {0}), c AS (SELECT label, discipline, min(sense_id) AS first, count(*) AS n FROM sn GROUP BY 1, 2)
  SELECT first AS source_sense_id, sense_id AS target_sense_id, 'equivalent_sense' AS relationship_type, 'toward' AS direction, n AS pairs FROM sn JOIN c USING (label, discipline) WHERE sense_id <> first
  UNION ALL SELECT a.first, b.first, 'cross_domain_bridge', 'across', a.n * b.n FROM c a JOIN c b ON a.label = b.label AND a.first < b.first"""
query("polysemy_edges", "senses", POLY.format(""))(lambda s, d: J.polysemy_edges(S.senses(s, d)))
query("polysemy_edges_v2", "senses", POLY.format("WHERE label IN (SELECT label FROM senses GROUP BY 1 HAVING count(DISTINCT source) >= 2)"))(lambda s, d: J.polysemy_edges(S.senses(s, d), 2))
query("category_pairs", "pubs", "SELECT category, status, count(*) AS pubs FROM pubs GROUP BY 1, 2 HAVING count(*) >= 5")(lambda s, d: J.category_pairs(S.pubs(s, d), "category", "status", 5))
query("doi_bridge", "", "SELECT o_orderkey AS our_id, o_orderkey + 1 AS work_id, '10.1/a' || o_orderkey AS doi FROM orders WHERE o_orderkey % 2 = 0")(
    lambda s, d: J.doi_bridge(t(s, d, "orders").select(F.col("o_orderkey").alias("our_id"), F.concat(F.lit("https://doi.org/10.1/A"), "o_orderkey").alias("doi")),
                              t(s, d, "orders").select((F.col("o_orderkey") + 1).alias("work_id"), F.when(F.col("o_orderkey") % 2 == 0, F.concat(F.lit("10.1/a"), "o_orderkey")).otherwise("").alias("doi"))))
query("citation_edges", "cites pubs", "SELECT citing, cited, cited IN (SELECT pub FROM pubs WHERE status = 'F') AS in_corpus FROM cites")(
    lambda s, d: J.citation_edges(S.cites(s, d), S.pubs(s, d).where("status = 'F'")))
TREE_SQL = """, centre AS (SELECT max(citing) AS c FROM cites WHERE citing IN (SELECT cited FROM cites)), x AS (SELECT 'root' AS side, cited AS pub FROM cites, centre WHERE citing = c UNION ALL SELECT 'branch', citing FROM cites, centre WHERE cited = c),
  tree AS (SELECT side, x.pub, coalesce(p.year, w.year) AS year, coalesce(p.cited_by, w.cited_by) AS cited_by, CASE WHEN p.pub IS NOT NULL THEN 0 WHEN w.pub IS NOT NULL THEN 1 END AS found
    FROM x LEFT JOIN (SELECT * FROM pubs WHERE status = 'F') p ON p.pub = x.pub LEFT JOIN (SELECT * FROM pubs WHERE pub % 2 = 0) w ON w.pub = x.pub)"""


def _centre(c: DataFrame) -> Column:
    return c.join(c.select(F.col("cited").alias("citing")), "citing", "left_semi").agg(F.max("citing")).scalar()


def _tree(s: SparkSession, d: str) -> DataFrame:
    """The tree of a work, known from its own corpus (finished orders) or from another table (even ones)."""
    return J.citation_tree(S.cites(s, d), _centre(S.cites(s, d)), S.pubs(s, d).where("status = 'F'"), S.pubs(s, d).where("pub % 2 = 0"))


query("citation_tree", "cites pubs", TREE_SQL + " SELECT * FROM tree")(_tree)
query("citation_list", "cites pubs", TREE_SQL + """ SELECT side, row_number() OVER (ORDER BY year NULLS FIRST, pub) AS place, pub, year, cited_by FROM tree WHERE side = 'root'
  UNION ALL SELECT side, row_number() OVER (ORDER BY cited_by DESC NULLS LAST, pub) AS place, pub, year, cited_by FROM tree WHERE side = 'branch' QUALIFY place <= 20""")(
    lambda s, d: J.citation_list(_tree(s, d), 20))
query("citation_totals", "cites pubs", TREE_SQL + " SELECT side, count(*) AS works, count(found) AS known, min(year) AS first_year, max(year) AS last_year FROM tree GROUP BY 1")(lambda s, d: J.citation_totals(_tree(s, d)))
query("citation_tree_2hop", "cites pubs", """, mid AS (SELECT min(cited) AS m FROM cites WHERE cited IN (SELECT citing FROM cites)),
  one AS (SELECT 'root' AS side, cited AS via FROM cites, mid WHERE citing = m UNION ALL SELECT 'branch', citing FROM cites, mid WHERE cited = m)
  SELECT o.side, via, CASE o.side WHEN 'root' THEN r.cited ELSE b.citing END AS pub, p.cited_by FROM one o LEFT JOIN cites r ON o.side = 'root' AND r.citing = via LEFT JOIN cites b ON o.side = 'branch' AND b.cited = via
  LEFT JOIN pubs p ON p.pub = CASE o.side WHEN 'root' THEN r.cited ELSE b.citing END WHERE CASE o.side WHEN 'root' THEN r.cited ELSE b.citing END IS NOT NULL""")(
    lambda s, d: (lambda c: J.citation_tree_2hop(c, S.pubs(s, d), c.join(c.select(F.col("citing").alias("cited")), "cited", "left_semi").agg(F.min("cited")).scalar(), 50, 20))(S.cites(s, d)))
query("year_anomaly", "cites pubs", """SELECT cited AS citing, citing AS cited, a.year AS citing_year, b.year AS cited_year FROM cites JOIN pubs a ON a.pub = cited JOIN pubs b ON b.pub = citing WHERE b.year > a.year""")(
    lambda s, d: J.year_anomalies(S.cites(s, d).select(F.col("cited").alias("citing"), F.col("citing").alias("cited")), S.pubs(s, d)))
query("year_anomaly_counts", "cites pubs", """SELECT citing % 4 AS level, count(*) AS citations, count(*) FILTER (a.year > b.year) AS anomalies FROM (SELECT citing, CASE WHEN citing % 4 = 3 THEN cited ELSE citing END AS x, CASE WHEN citing % 4 = 3 THEN citing ELSE cited END AS y FROM cites) c
  JOIN pubs a ON a.pub = y JOIN pubs b ON b.pub = x GROUP BY 1""")(
    lambda s, d: (lambda c: J.anomaly_counts(c.select(
        F.when(F.col("citing") % 4 == 3, F.col("cited")).otherwise(F.col("citing")).alias("citing"), F.when(F.col("citing") % 4 == 3, F.col("citing")).otherwise(F.col("cited")).alias("cited"),
        (F.col("citing") % 4).alias("level")), S.pubs(s, d)))(S.cites(s, d)))
query("tfidf_edges", "", """WITH words AS (SELECT item_id, list_filter(regexp_split_to_array(lower(text), '[^a-z0-9]+'), lambda x: length(x) > 1 AND x NOT IN ('the', 'and', 'of')) AS ws FROM benchmark),
  g AS (SELECT item_id, unnest(list_concat(ws, list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]))) AS term FROM words),
  tf AS (SELECT item_id, term, count(*) AS tf FROM g GROUP BY 1, 2), n AS (SELECT count(*) AS n FROM benchmark),
  df AS (SELECT term, count(*) AS df FROM tf GROUP BY 1), w AS (SELECT item_id, tf.term, tf * (ln((1 + n) / (1 + df)) + 1) AS w FROM tf JOIN df USING (term), n WHERE df <= greatest(n * 0.5, 2)),
  nw AS (SELECT item_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY item_id)) AS w FROM w),
  c AS (SELECT a.item_id AS a, b.item_id AS b, round(sum(a.w * b.w), 6) AS cosine FROM nw a JOIN nw b ON a.term = b.term AND a.item_id <> b.item_id GROUP BY 1, 2)
  SELECT a, b, cosine, rank FROM (SELECT *, row_number() OVER (PARTITION BY a ORDER BY cosine DESC, b) AS rank FROM c WHERE cosine >= 0.1) WHERE rank <= 20 ORDER BY cosine DESC, a, b LIMIT 30000""")(
    lambda s, d: J.tfidf_edges(J.tfidf(t(s, d, "benchmark"), "item_id", "text", stops=["the", "and", "of"]), "item_id", 0.1, 20, 30_000))

# Lenses

query("disciplines", "disc", "SELECT * FROM disc")(lambda s, d: S.disciplines(s, d))
LENS_PAIRS = [("ECONOMY", "STANDARD", "Economy-Standard"), ("PROMO", "ECONOMY", "Promo-Economy")]
LENSES_SQL = """roles AS (SELECT * FROM (VALUES ('director', 100000, 'Director'), ('program_mgr', 10000, 'Program Manager'), ('researcher', 1000, 'Researcher')) r(role, altitude, title)),
  pairs AS (SELECT * FROM (VALUES ('ECONOMY', 'STANDARD', 'Economy-Standard'), ('PROMO', 'ECONOMY', 'Promo-Economy')) p(a, b, label)),
  lw AS (SELECT 'hat:' || l.discipline_id || ':' || role AS lens_id, l.discipline_id || ' ' || title AS name, role, altitude, l.discipline_id AS discipline, x.discipline_id AS of,
      CASE WHEN l.discipline_id = x.discipline_id THEN 0.95 WHEN l.tier = x.tier THEN 0.4 WHEN abs(l.tier - x.tier) = 1 THEN 0.25 ELSE 0.1 END::DOUBLE AS weight FROM disc l, disc x, roles
    UNION ALL SELECT 'hat:' || a || '+' || b || ':' || role, label || ' ' || title, role, altitude, a, x.discipline_id, CASE x.discipline_id WHEN a THEN 0.9 WHEN b THEN 0.85 ELSE 0.1 END::DOUBLE FROM pairs, disc x, roles
    UNION ALL SELECT 'hat:neutral', 'Neutral Lens', 'neutral', 10000, NULL, discipline_id, 1.0::DOUBLE FROM disc),
  lens AS (SELECT lens_id, name, role, altitude, discipline, string_agg(of || '=' || CAST(weight AS VARCHAR), ',' ORDER BY of) AS weights FROM lw GROUP BY ALL)"""


def _lenses(s: SparkSession, d: str) -> list[L.Lens]:
    return L.template_lenses(L.discipline_rows(S.disciplines(s, d)), LENS_PAIRS)


def _spelled(weights: str) -> Column:
    return F.array_join(F.transform(F.array_sort(F.map_entries(weights)), lambda x: F.concat(x["key"], F.lit("="), x["value"].cast("string"))), ",")


query("template_lenses", "disc", f", {LENSES_SQL} SELECT * FROM lens")(
    lambda s, d: L.lens_table(s, _lenses(s, d)).drop("secondary").withColumn("weights", _spelled("weights")))
query("lens_list", "disc", f", {LENSES_SQL} SELECT lens_id, name, role, discipline, altitude FROM lens WHERE role = 'program_mgr'")(
    lambda s, d: L.list_lenses(L.lens_table(s, _lenses(s, d)), role="program_mgr"))
query("compose_lens", "disc", f""", {LENSES_SQL}, asked AS (SELECT p_partkey, p_brand, CASE WHEN p_size % 11 = 0 THEN p_brand ELSE p_type END AS discipline,
    CASE p_size % 4 WHEN 0 THEN 'director' WHEN 1 THEN 'program_mgr' WHEN 2 THEN 'researcher' ELSE 'guest' END AS role FROM part)
  SELECT p_partkey, coalesce(l.lens_id, 'composed:' || d.discipline_id || ':' || a.role) AS lens_id, coalesce(l.name, d.discipline_id || ' Guest') AS name,
    coalesce(l.altitude, CASE WHEN d.discipline_id IS NOT NULL THEN 1000 END) AS altitude, coalesce(l.weights, d.discipline_id || '=0.95') AS weights, p_brand || '=1.0' AS interests
  FROM asked a LEFT JOIN lens l ON l.lens_id = 'hat:' || a.discipline || ':' || a.role LEFT JOIN disc d ON d.discipline_id = a.discipline""")(
    lambda s, d: L.compose_lenses(t(s, d, "part").select(
        "p_partkey", F.when(F.col("p_size") % 11 == 0, F.col("p_brand")).otherwise(F.col("p_type")).alias("discipline"),
        F.element_at(F.array(*map(F.lit, ("director", "program_mgr", "researcher", "guest"))), F.col("p_size") % 4 + 1).alias("role"), F.array("p_brand").alias("interests")),
        _lenses(s, d), L.discipline_rows(S.disciplines(s, d))).select("p_partkey", "lens_id", "name", "altitude", _spelled("weights").alias("weights"), _spelled("interest_weights").alias("interests")))


def _score_sql(default: float, bonus: str = "0.0") -> str:
    own = LENS_SQL.replace("0.1 END", f"{default} END")
    other = LENS_SQL.replace("CASE discipline", "CASE x").replace("0.1 END", "0.0 END")
    return f"round(greatest(({own})::DOUBLE, coalesce(list_max(list_transform(secondary, lambda x: ({other})::DOUBLE * 0.7::DOUBLE)), 0.0::DOUBLE)) * coalesce(nullif(confidence, 0), 0.5) * ({BOOST_SQL})::DOUBLE + ({bonus})::DOUBLE, 6)"


query("lens_query", "senses lsenses", f"""SELECT sense_id, label, discipline, {_score_sql(0.1)} AS score, list_has_any(secondary, ['ECONOMY', 'STANDARD', 'PROMO']) AS is_bridge
  FROM lsenses WHERE level IS NULL OR level <= 4 ORDER BY 4 DESC, 1 LIMIT 50""")(
    lambda s, d: L.lens_query(S.lens_senses(s, d), LENS, 50, altitude=10000).select("sense_id", "label", "discipline", "score", "is_bridge"))
query("lens_query_search", "senses lsenses", f"""SELECT sense_id, {_score_sql(0.1)} AS score FROM lsenses WHERE contains(lower(label), 'gear') AND (level IS NULL OR level <= 2) ORDER BY 2 DESC, 1 LIMIT 50""")(
    lambda s, d: L.lens_query(S.lens_senses(s, d), LENS, 50, search="GEAR", altitude=100000).select("sense_id", "score"))
DEG = "deg AS (SELECT sense_id, count(*) AS degree FROM (SELECT source_sense_id AS sense_id FROM rels UNION ALL SELECT target_sense_id FROM rels) GROUP BY 1)"
BONUS_SQL = "CASE WHEN in_abstracts THEN 0.1 ELSE 0.0 END::DOUBLE + CASE WHEN in_titles THEN 0.1 ELSE 0.0 END::DOUBLE"
for _name, _where, _more in (
    ("lens_query_full", "TRUE", {}),
    ("lens_query_full_search", "contains(lower(label), 'e') AND source = 'Brand#3' AND (level IS NULL OR level <= 2)", {"search": "E", "source": "Brand#3", "altitude": 100000, "least_score": 0.3}),
):
    query(_name, "senses lsenses rels", f""", {DEG} SELECT s.sense_id, score, bridge_to, coalesce(degree, 0) AS rel_count FROM (SELECT * FROM (
      SELECT sense_id, {_score_sql(0.05, BONUS_SQL)} AS score, array_to_string(list_filter(secondary, lambda x: x IN ('ECONOMY', 'STANDARD', 'PROMO') AND x <> discipline), ',') AS bridge_to
      FROM lsenses WHERE discipline IN ('ECONOMY', 'STANDARD', 'PROMO') AND {_where}) WHERE score >= {_more.get('least_score', 0)} ORDER BY 2 DESC, 1 LIMIT 40) s LEFT JOIN deg USING (sense_id)""")(
        lambda s, d, more=_more: L.lens_query_full(S.lens_senses(s, d), LENS, G.degrees(S.rels(s, d)), 40, **more).select("sense_id", "score", F.array_join("bridge_to", ",").alias("bridge_to"), "rel_count"))
query("discipline_query", "senses", "SELECT sense_id, label, confidence FROM senses WHERE discipline = 'PROMO' ORDER BY confidence DESC, label, sense_id LIMIT 50")(
    lambda s, d: L.discipline_query(S.senses(s, d), "PROMO", 50).select("sense_id", "label", "confidence"))
query("bridges", "senses", """SELECT sense_id FROM senses s WHERE (discipline = 'PROMO' AND EXISTS (SELECT 1 FROM (SELECT label, discipline, min(sense_id) AS f FROM senses GROUP BY 1, 2) x WHERE x.label = s.label AND x.discipline = 'ECONOMY' AND f >= s.sense_id))
  OR (discipline = 'ECONOMY' AND EXISTS (SELECT 1 FROM (SELECT label, discipline, min(sense_id) AS f FROM senses GROUP BY 1, 2) x WHERE x.label = s.label AND x.discipline = 'PROMO' AND f >= s.sense_id))""")(
    lambda s, d: L.bridges(S.senses(s, d).join(C.secondary_disciplines(S.senses(s, d)), "sense_id").withColumn("secondary", F.split("secondary", ",")), "PROMO", "ECONOMY").select("sense_id"))
query("lens_summary", "senses lsenses", """SELECT source, count(*) FILTER (discipline IN ('LARGE', 'ECONOMY') OR list_has_any(secondary, ['LARGE', 'ECONOMY'])) AS visible,
  count(*) FILTER (discipline IN ('LARGE', 'ECONOMY')) AS by_primary, count(*) FILTER (discipline IN ('LARGE', 'ECONOMY') AND len(secondary) > 0) AS bridges FROM lsenses GROUP BY ROLLUP (source)""")(
    lambda s, d: L.lens_summary(S.lens_senses(s, d), ["LARGE", "ECONOMY"]))
NEAR_SQL = """, want AS (SELECT {0} AS l FROM fine), exact AS (SELECT sense_id FROM fine, want WHERE lower(label) = lower(l)),
  c AS (SELECT sense_id FROM exact UNION ALL SELECT sense_id FROM (SELECT sense_id FROM fine, want WHERE contains(lower(label), lower(l)) ORDER BY confidence DESC, sense_id LIMIT 10) WHERE NOT EXISTS (SELECT 1 FROM exact)),
  e AS (SELECT target_sense_id AS n, confidence AS ec FROM rels WHERE source_sense_id IN (SELECT sense_id FROM c)
    UNION ALL SELECT source_sense_id, confidence FROM rels WHERE target_sense_id IN (SELECT sense_id FROM c) AND source_sense_id NOT IN (SELECT sense_id FROM c)),
  b AS (SELECT n, label, discipline, ec FROM e JOIN fine x ON x.sense_id = n QUALIFY row_number() OVER (PARTITION BY lower(label) ORDER BY ec DESC, n) = 1)"""
for _name, _sql, _label in (
    ("explore", "min(label)", lambda f: f.agg(F.min("label")).scalar()),
    ("explore_similar", "split_part(min(label), '#', 1)", lambda f: f.agg(F.split_part(F.min("label"), F.lit("#"), F.lit(1))).scalar()),
):
    query(_name, "senses fine rels", NEAR_SQL.format(_sql) + f" SELECT n AS neighbour, label, discipline, round(({LENS_SQL.replace('0.1 END', '0.05 END')})::DOUBLE * coalesce(nullif(ec, 0), 0.5), 6) AS score FROM b ORDER BY 4 DESC, 1 LIMIT 15")(
        lambda s, d, label=_label: L.explore(S.fine_senses(s, d), S.rels(s, d), label(S.fine_senses(s, d)), LENS, 15))
query("compare_lenses", "senses fine rels disc", NEAR_SQL.format("split_part(min(label), '#', 1)") + f""", {LENSES_SQL},
  w AS (SELECT lens_id, n, label, b.discipline, round(weight * coalesce(nullif(ec, 0), 0.5), 6) AS score FROM b JOIN lw ON of = b.discipline),
  best AS (SELECT *, row_number() OVER (PARTITION BY lens_id ORDER BY score DESC, n) AS place FROM w QUALIFY place <= 15),
  spread AS (SELECT lens_id, discipline, count(*) AS k, row_number() OVER (PARTITION BY lens_id ORDER BY count(*) DESC, discipline) AS place FROM best GROUP BY 1, 2)
  SELECT lens_id, 'neighbour' AS kind, place, label AS name, score AS value FROM best WHERE place <= 5
  UNION ALL SELECT lens_id, 'discipline', place, discipline, k::DOUBLE FROM spread WHERE place <= 5
  UNION ALL SELECT lens_id, 'senses', 0, NULL, (SELECT count(*) FROM c)::DOUBLE FROM lens
  UNION ALL SELECT lens_id, 'connections', 0, NULL, (SELECT count(*) FROM e)::DOUBLE FROM lens""")(
    lambda s, d: L.compare_lenses(S.fine_senses(s, d), S.rels(s, d), S.fine_senses(s, d).agg(F.split_part(F.min("label"), F.lit("#"), F.lit(1))).scalar(), _lenses(s, d)))
for _name, _where, _search in (("papers_through_lens", "TRUE", None), ("papers_through_lens_search", "pub IN (SELECT pub FROM pubkw WHERE contains(lower(label), 'gear'))", "Gear")):
    query(_name, "senses fine pubkw", f""", j AS (SELECT pub, sense_id, discipline, relevance * confidence AS rc FROM pubkw p JOIN fine f ON lower(p.label) = lower(f.label)
        WHERE relevance >= 0.3 AND discipline IN ('ECONOMY', 'STANDARD', 'PROMO') AND {_where}),
      g AS (SELECT pub, count(DISTINCT sense_id) AS senses, sum(rc) AS raw FROM j GROUP BY 1 HAVING count(DISTINCT sense_id) >= 2),
      w AS (SELECT pub, string_agg(discipline, ',' ORDER BY discipline) AS disciplines, avg(({LENS_SQL})::DOUBLE) AS m FROM (SELECT DISTINCT pub, discipline FROM j) GROUP BY 1)
      SELECT pub, senses, disciplines, round(raw * m, 6) AS score FROM g JOIN w USING (pub) ORDER BY 4 DESC, 1 LIMIT 50""")(
        lambda s, d, search=_search: L.papers_through_lens(S.pub_keywords(s, d), S.fine_senses(s, d), LENS, 0.3, 2, 50, search))

# Validation


def _linked(s: SparkSession, d: str) -> DataFrame:
    """Edges from each sense to those with the six next keyword ids."""
    side = lambda c: S.senses(s, d).select(F.col("sense_id").alias(c), F.col("keyword_id").cast("int").alias("_k"))
    return side("source_sense_id").withColumn("_k", F.explode(F.sequence(F.col("_k") + 1, F.col("_k") + 6))).join(side("target_sense_id"), "_k").select("source_sense_id", "target_sense_id")


query("stratified_sample", "senses", "SELECT sense_id, discipline, confidence FROM senses QUALIFY row_number() OVER (PARTITION BY discipline, floor(confidence * 3) ORDER BY md5('1:' || sense_id), sense_id) <= 5")(
    lambda s, d: V.stratified_sample(S.senses(s, d), [F.col("discipline"), F.floor(F.col("confidence") * 3)], "sense_id", 5, order=F.md5(F.concat(F.lit("1:"), "sense_id"))).select("sense_id", "discipline", "confidence"))
query("quota_sample", "senses", """, q AS (SELECT *, CASE WHEN confidence >= 0.7 THEN 2 WHEN confidence >= 0.4 THEN 1 ELSE 0 END AS bucket FROM senses),
  k AS (SELECT floor(100 / count(*)) AS quota FROM (SELECT DISTINCT discipline, bucket FROM q)), p AS (SELECT *, row_number() OVER (PARTITION BY discipline, bucket ORDER BY sense_id) AS place FROM q)
  SELECT sense_id, discipline, confidence FROM p, k ORDER BY place > quota, sense_id LIMIT 100""")(
    lambda s, d: V.quota_sample(S.senses(s, d), [F.col("discipline"), F.when(F.col("confidence") >= 0.7, 2).when(F.col("confidence") >= 0.4, 1).otherwise(0)], "sense_id", 100, F.col("sense_id")).select("sense_id", "discipline", "confidence"))
query("edge_sample", "senses rels", "SELECT * FROM rels WHERE ('0x' || substr(md5(source_sense_id || ' ' || target_sense_id), 1, 8))::BIGINT % 1000000 < 100000")(
    lambda s, d: V.edge_sample(S.rels(s, d), ["source_sense_id", "target_sense_id"], 0.1, hashed=F.conv(F.substring(F.md5(F.concat_ws(" ", "source_sense_id", "target_sense_id")), 1, 8), 16, 10).cast("long")))
query("kappa", "", """WITH c AS (SELECT quality AS a, toxic AS b, count(*) AS n FROM labels GROUP BY 1, 2), s AS (SELECT sum(n) AS n, sum(n) FILTER (a = b) AS agree FROM c),
  e AS (SELECT sum(na * nb) AS e FROM (SELECT a, sum(n) AS na FROM c GROUP BY 1) x JOIN (SELECT b, sum(n) AS nb FROM c GROUP BY 1) y ON a = b)
  SELECT CAST(n AS BIGINT) AS n, round(agree / n, 6) AS observed, round(e / (n * n), 6) AS expected, round((agree / n - e / (n * n)) / (1 - e / (n * n)), 6) AS kappa FROM s, e""")(
    lambda s, d: V.kappa(t(s, d, "labels"), "quality", "toxic"))
query("prf", "", """WITH p AS (SELECT p_type AS t, CASE WHEN p_size % 5 = 0 THEN 'PROMO' ELSE p_type END AS p FROM part), c AS (SELECT t AS category FROM p UNION SELECT p FROM p),
  m AS (SELECT category, count(*) FILTER (t = category AND p = category) AS tp, count(*) FILTER (p = category) AS pp, count(*) FILTER (t = category) AS sup FROM c, p GROUP BY 1)
  SELECT category, round(CASE WHEN pp > 0 THEN tp / pp ELSE 0 END, 6) AS precision, round(CASE WHEN sup > 0 THEN tp / sup ELSE 0 END, 6) AS recall,
  round(CASE WHEN tp > 0 THEN 2 * (tp / pp) * (tp / sup) / (tp / pp + tp / sup) ELSE 0 END, 6) AS f1, sup AS support FROM m""")(
    lambda s, d: V.per_category(t(s, d, "part").select(F.col("p_type").alias("truth"), F.when(F.col("p_size") % 5 == 0, "PROMO").otherwise(F.col("p_type")).alias("predicted")), "truth", "predicted"))
query("sensitivity", "senses rels", """, b AS (SELECT discipline, sense_id, count(*) AS k FROM senses JOIN rels ON source_sense_id = sense_id GROUP BY 1, 2),
  a AS (SELECT discipline, sense_id, count(*) AS k FROM senses JOIN rels ON source_sense_id = sense_id WHERE CAST(split_part(source_sense_id, '@', 1) AS INT) % 10 <> 3 GROUP BY 1, 2),
  tb AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY discipline ORDER BY k DESC, sense_id) AS r FROM b) WHERE r <= 50), ta AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY discipline ORDER BY k DESC, sense_id) AS r FROM a) WHERE r <= 50)
  SELECT discipline, round(count(*) FILTER (tb.sense_id IS NOT NULL AND ta.sense_id IS NOT NULL) / count(*), 6) AS jaccard FROM tb FULL JOIN ta USING (discipline, sense_id) GROUP BY 1""")(
    lambda s, d: (lambda top: V.top_set_jaccard(top(S.rels(s, d)), top(S.rels(s, d).where(F.split_part("source_sense_id", F.lit("@"), F.lit(1)).cast("int") % 10 != 3)), "discipline", "sense_id"))(
        lambda r: V.top_by(S.senses(s, d).join(r.select(F.col("source_sense_id").alias("sense_id")), "sense_id").groupBy("discipline", "sense_id").agg(F.count("*").alias("k")), ["discipline"], [F.desc("k"), "sense_id"], 50)))
query("npmi", "pubkw", f""", one AS (SELECT label, count(DISTINCT pub) AS n FROM pubkw GROUP BY 1), tot AS (SELECT count(DISTINCT pub) AS t FROM pubkw)
  SELECT p.a, p.b, p.pubs, round(ln((p.pubs / t) / ((x.n / t) * (y.n / t))) / -ln(p.pubs / t), 6) AS npmi FROM {PAIRS.format(0, 3)} p JOIN one x ON x.label = p.a JOIN one y ON y.label = p.b, tot""")(
    lambda s, d: (lambda k: V.npmi(J.cooccurrence(k, 3), k.groupBy("label").agg(F.countDistinct("pub").alias("pubs")), k.agg(F.countDistinct("pub")).scalar()))(S.pub_keywords(s, d)))
query("lens_divergence", "senses disc", f""", {LENSES_SQL}, sc AS (SELECT lens_id AS lens, label, round(sum(weight * confidence), 6) AS v FROM senses s JOIN lw ON of = s.discipline WHERE role = 'researcher' GROUP BY 1, 2),
  r AS (SELECT lens, label, rank() OVER (PARTITION BY lens ORDER BY v) + (count(*) OVER (PARTITION BY lens, v) - 1) / 2 AS r FROM sc)
  SELECT x.lens AS a, y.lens AS b, round(corr(x.r, y.r), 6) AS spearman FROM r x JOIN r y ON x.label = y.label AND x.lens < y.lens GROUP BY 1, 2""")(
    lambda s, d: V.spearman(S.senses(s, d).withColumn("_lens", F.explode(F.array(*(F.struct(F.lit(x.lens_id).alias("lens"), L.weight_map(x.weights).alias("w")) for x in _lenses(s, d) if x.role == "researcher")))).select(
        "label", "confidence", "_lens.lens", F.element_at("_lens.w", F.col("discipline")).alias("weight")).groupBy("lens", "label").agg(F.round(F.sum(F.col("weight") * F.col("confidence")), 6).alias("v")), "lens", "label", "v"))
query("paper_sets", "pubkw", "SELECT pub, string_agg(DISTINCT label, '|' ORDER BY label) AS labels FROM pubkw GROUP BY 1")(
    lambda s, d: S.pub_keywords(s, d).groupBy("pub").agg(F.array_join(F.array_sort(F.collect_set("label")), "|").alias("labels")))
_SETS = "sets AS (SELECT pub, list_distinct(list(label)) AS items FROM pubkw GROUP BY 1)"
query("citation_coherence", "pubkw cites", f""", {_SETS}
  SELECT citing AS a, cited AS b, round(len(list_intersect(x.items, y.items)) / len(list_distinct(list_concat(x.items, y.items))), 6) AS similarity FROM cites JOIN sets x ON x.pub = citing JOIN sets y ON y.pub = cited""")(
    lambda s, d: V.linked_similarity(S.pub_keywords(s, d).groupBy("pub").agg(F.collect_set("label").alias("items")), S.cites(s, d).select(F.col("citing").alias("a"), F.col("cited").alias("b"))))
query("coherence_summary", "pubkw cites", f""", {_SETS}, l AS (SELECT 'citing' AS kind, citing AS a, cited AS b FROM cites UNION ALL SELECT 'random', citing, (SELECT max(o_orderkey) FROM orders) - citing FROM cites)
  SELECT kind, count(*) AS pairs, round(avg(s), 6) AS mean, round(median(s), 6) AS median FROM (
    SELECT kind, round(len(list_intersect(x.items, y.items)) / len(list_distinct(list_concat(x.items, y.items))), 6) AS s FROM l JOIN sets x ON x.pub = a JOIN sets y ON y.pub = b) GROUP BY 1""")(
    lambda s, d: V.similarity_summary(S.pub_keywords(s, d).groupBy("pub").agg(F.collect_set("label").alias("items")), {
        "citing": S.cites(s, d).select(F.col("citing").alias("a"), F.col("cited").alias("b")),
        "random": S.cites(s, d).select(F.col("citing").alias("a"), (t(s, d, "orders").agg(F.max("o_orderkey")).scalar() - F.col("citing")).alias("b"))}))
query("neighbourhood_coherence", "senses fine pubkw", """, e AS (SELECT a.sense_id AS s, b.sense_id AS n FROM senses a JOIN senses b ON CAST(b.keyword_id AS INT) BETWEEN CAST(a.keyword_id AS INT) + 1 AND CAST(a.keyword_id AS INT) + 6),
  c AS (SELECT s FROM e GROUP BY 1 HAVING count(*) >= 5), near AS (SELECT DISTINCT s, lower(label) AS label FROM e JOIN fine ON sense_id = n WHERE s IN (SELECT s FROM c) AND s IN (SELECT sense_id FROM senses WHERE confidence >= 0.5)),
  p AS (SELECT *, row_number() OVER (PARTITION BY s ORDER BY label) AS r FROM near QUALIFY r <= 20), k AS (SELECT DISTINCT pub, lower(label) AS label FROM pubkw),
  one AS (SELECT label, count(*) AS n FROM k GROUP BY 1), tot AS (SELECT count(DISTINCT pub) AS t FROM k),
  pr AS (SELECT x.s, x.label AS a, y.label AS b FROM p x JOIN p y ON x.s = y.s AND y.r > x.r AND y.r <= x.r + 4),
  m AS (SELECT a, b, count(*) AS n FROM (SELECT DISTINCT a, b FROM pr) JOIN k x ON x.label = a JOIN k y ON y.label = b AND x.pub = y.pub GROUP BY 1, 2),
  sc AS (SELECT m.a, m.b, round(ln((m.n / t) / ((x.n / t) * (y.n / t))) / -ln(m.n / t), 6) AS v FROM m JOIN one x ON x.label = m.a JOIN one y ON y.label = m.b, tot)
  SELECT z.s AS sense_id, z.neighbours, coalesce(q.pairs, 0) AS pairs, coalesce(q.v, 0) AS npmi FROM (SELECT s, count(*) AS neighbours FROM p GROUP BY 1 HAVING count(*) >= 3) z
  LEFT JOIN (SELECT s, count(*) AS pairs, round(avg(v), 4) AS v FROM pr JOIN sc USING (a, b) GROUP BY 1) q ON q.s = z.s""")(
    lambda s, d: V.neighbourhood_coherence(S.fine_senses(s, d), _linked(s, d), S.pub_keywords(s, d)))
query("mann_whitney", "", """WITH c AS (SELECT p_retailprice AS v, count(*) AS t, count(*) FILTER (p_type = 'PROMO') AS g FROM part GROUP BY 1),
  r AS (SELECT *, coalesce(sum(t) OVER (ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + (t + 1) / 2 AS rk FROM c),
  s AS (SELECT sum(g * rk)::DOUBLE AS r, sum(g)::DOUBLE AS n1, sum(t)::DOUBLE AS n, sum(t::DOUBLE ** 3 - t) AS ties FROM r)
  SELECT round(r - n1 * (n1 + 1) / 2, 3) AS u, round((r - n1 * (n1 + 1) / 2 - n1 * (n - n1) / 2) / sqrt(n1 * (n - n1) / 12 * (n + 1 - ties / (n * (n - 1)))), 6) AS z FROM s""")(
    lambda s, d: V.mann_whitney(t(s, d, "part").select((F.col("p_type") == "PROMO").alias("g"), "p_retailprice"), "g", "p_retailprice"))

# Texts

VOCABULARY = ["license", "the public", "of the", "under the", "apache license", "the terms of the", "sub"]
_GRAMS = """tok AS (SELECT {0} AS id, list_filter(regexp_split_to_array(lower({1}), '[^a-z0-9\\-]+'), lambda x: x <> '') AS ts FROM {2}),
  g AS (SELECT id, unnest(list_distinct(flatten(list_transform(range(1, {3}), lambda n: list_transform(range(1, len(ts) - n + 2), lambda i: array_to_string(ts[i:i + n - 1], ' ')))))) AS gram FROM tok)
  SELECT label, {4} FROM g JOIN v ON label = gram GROUP BY 1 HAVING count(*) >= {5}"""
query("vocab_in_text", "", f"""WITH v AS (SELECT label FROM (SELECT lower(split_part(p_name, ' ', 1)) AS label FROM part UNION SELECT lower(p_name) FROM part UNION SELECT unnest({VOCABULARY}))
    WHERE CASE WHEN contains(label, ' ') THEN length(label) > 5 ELSE length(label) > 3 END), {_GRAMS.format('doc_id', 'text', 'documents', 5, 'count(*) AS documents', 5)}""")(
    lambda s, d: T.vocabulary_matches(t(s, d, "documents"), "doc_id", "text", t(s, d, "part").select(F.explode(F.array(F.split_part("p_name", F.lit(" "), F.lit(1)), F.col("p_name"))).alias("label")).select(
        F.lower("label").alias("label")).union(s.createDataFrame([(x,) for x in VOCABULARY], "label string")).distinct(), 4, 5))
query("vocab_in_title", "", f"""WITH v AS (SELECT DISTINCT lower(p_name) AS label FROM part WHERE length(p_name) > 5),
  {_GRAMS.format('p_partkey', "p_type || ': ' || p_name", 'part', 3, "'title_freq:' || count(*) AS tag", 3)}""")(
    lambda s, d: T.frequency_tags(T.vocabulary_matches(t(s, d, "part").select("p_partkey", F.concat_ws(": ", "p_type", "p_name").alias("title")), "p_partkey", "title",
        t(s, d, "part").select(F.lower("p_name").alias("label")).distinct(), 2, 3, single=False), "title"))
query("pub_frequency", "pubkw", "SELECT label, 'pub_freq:' || count(DISTINCT pub) AS tag FROM pubkw GROUP BY 1")(
    lambda s, d: S.pub_keywords(s, d).groupBy("label").agg(F.concat(F.lit("pub_freq:"), F.countDistinct("pub").cast("string")).alias("tag")))
query("new_terms", "", """WITH tok AS (SELECT item_id, list_filter(regexp_split_to_array(lower(text), '[^a-z0-9\\-]+'), lambda x: x NOT IN ('', 'the', 'and', 'of')) AS ts FROM benchmark),
  g AS (SELECT item_id, unnest(flatten(list_transform(range(1, 4), lambda n: list_transform(range(1, len(ts) - n + 2), lambda i: array_to_string(ts[i:i + n - 1], ' '))))) AS gram FROM tok),
  c AS (SELECT gram, count(DISTINCT item_id) AS documents, count(*) AS tf FROM g WHERE length(gram) > 2 GROUP BY 1), n AS (SELECT count(*) AS n FROM benchmark),
  f AS (SELECT * FROM c, n WHERE documents >= 3 AND documents <= n * 0.7 ORDER BY tf DESC, gram LIMIT 20000)
  SELECT gram, documents, round(tf * (ln((1 + n) / (1 + documents)) + 1), 6) AS score FROM f WHERE gram NOT IN (SELECT lower(p_name) FROM part UNION SELECT 'that') ORDER BY 3 DESC, 1 LIMIT 100""")(
    lambda s, d: T.new_terms(t(s, d, "benchmark"), "item_id", "text", t(s, d, "part").select(F.col("p_name").alias("label")).union(s.createDataFrame([("that",)], "label string")), 3, 0.7, 100, ["the", "and", "of"]))
def _funded(s: SparkSession, d: str) -> DataFrame:
    """Whole texts, each with an acknowledgement at its end."""
    k, number, longer = F.col("doc_id") % 4, (100000 + F.col("doc_id")).cast("string"), (1000000 + F.col("doc_id")).cast("string")
    more = F.when(k == 0, F.concat(F.lit(" Funded by NSF "), longer)).when(k == 1, F.concat(F.lit(" (NIH R01-GM-"), number, F.lit(")"))).when(
        k == 2, F.concat(F.lit(" contract DE-FE"), longer)).otherwise(F.concat(F.lit(" grant agreement no. "), number, F.lit(" and EP/K"), number, F.lit("/1")))
    return t(s, d, "documents").select("doc_id", F.concat(F.coalesce("text", F.lit("")), more).alias("text"))


_GRANT_PARTS = " UNION ALL ".join(f"""SELECT doc_id, {k} AS k, '{name}' AS pattern_name, '{agency}' AS agency, i, w[i] AS whole,
    {"regexp_replace(w[i], '[^A-Z0-9]', '', 'g')" if agency == 'NIH' else f"regexp_extract(w[i], '{pattern}', 1)"} AS number,
    list_sum(list_transform(parts[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(w[1:i - 1], lambda x: length(x))), 0) AS start
  FROM (SELECT doc_id, w, parts, unnest(range(1, len(w) + 1)) AS i FROM (SELECT doc_id, regexp_extract_all(text, '{pattern}', 0) AS w, string_split_regex(text, '{pattern}') AS parts FROM funded))"""
    for k, (name, agency, pattern) in enumerate(T.GRANTS))
query("grants", "", f"""WITH funded AS (SELECT doc_id, coalesce(text, '') || CASE doc_id % 4 WHEN 0 THEN ' Funded by NSF ' || (1000000 + doc_id) WHEN 1 THEN ' (NIH R01-GM-' || (100000 + doc_id) || ')'
    WHEN 2 THEN ' contract DE-FE' || (1000000 + doc_id) ELSE ' grant agreement no. ' || (100000 + doc_id) || ' and EP/K' || (100000 + doc_id) || '/1' END AS text FROM documents)
  SELECT doc_id, number, agency, pattern_name, CAST(start AS BIGINT) AS start, CAST(start + length(whole) AS BIGINT) AS "end" FROM ({_GRANT_PARTS})
  QUALIFY row_number() OVER (PARTITION BY doc_id, upper(regexp_replace(number, '[ -]', '', 'g')) ORDER BY k, start) = 1""")(
    lambda s, d: T.grants(_funded(s, d), "doc_id", "text").withColumn("start", F.col("start").cast("long")).withColumn("end", F.col("end").cast("long")))
query("field_counts", "pubs", "SELECT journal, count(*) AS n FROM pubs GROUP BY 1")(lambda s, d: T.field_counts(S.pubs(s, d), "journal"))
query("markup_labels", "", "SELECT page_id FROM pages WHERE regexp_matches(html, '</?[a-zA-Z]+[^>]*>|&[a-z]+;')")(lambda s, d: T.markup_labels(t(s, d, "pages"), "html").select("page_id"))
query("html_clean", "", "SELECT page_id, md5(trim(regexp_replace(html, '</?[a-zA-Z]+[^>]*>', '', 'g'))) AS clean_md5 FROM pages")(
    lambda s, d: t(s, d, "pages").select("page_id", F.md5(N.clean_markup("html")).alias("clean_md5")))
_JOURNALS = "j AS (SELECT *, CASE p_size % 3 WHEN 0 THEN [] WHEN 1 THEN [p_brand] ELSE [p_brand, p_type] END AS issn FROM part)"


def _journals(s: SparkSession, d: str) -> DataFrame:
    issn = F.when(F.col("p_size") % 3 == 1, F.array("p_brand")).when(F.col("p_size") % 3 == 2, F.array("p_brand", "p_type")).otherwise(F.array().cast("array<string>"))
    journals = t(s, d, "part").select("p_partkey", issn.alias("issn"), F.col("p_name").alias("title"), F.array("p_type", "p_name").alias("subjects"))
    return T.distinct_journals(journals, ["p_partkey"])


query("journal_dedup", "", f"""WITH {_JOURNALS} SELECT min(p_partkey) AS p_partkey, CASE WHEN len(issn) > 0 THEN array_to_string(issn, '|') ELSE p_name END AS journal_key FROM j GROUP BY 2""")(
    lambda s, d: _journals(s, d).select("p_partkey", "journal_key"))
query("journal_subjects", "", f"""WITH {_JOURNALS}, f AS (SELECT * FROM j QUALIFY row_number() OVER (PARTITION BY CASE WHEN len(issn) > 0 THEN array_to_string(issn, '|') ELSE p_name END ORDER BY p_partkey) = 1)
  SELECT subject, count(*) AS journals FROM (SELECT unnest([p_type, p_name]) AS subject FROM f) GROUP BY 1""")(lambda s, d: T.subject_counts(_journals(s, d)))

# Projections

query("path_build", "", "SELECT p_partkey, CASE WHEN p_size % 5 = 0 THEN p_type WHEN p_size % 7 = 0 THEN p_type || ' > ' || p_brand ELSE p_type || ' > ' || p_brand || ' > ' || p_name END AS path FROM part")(
    lambda s, d: t(s, d, "part").withColumn("b", F.when(F.col("p_size") % 5 == 0, "NOT APPLICABLE").otherwise(F.col("p_brand"))).withColumn("c", F.when(F.col("p_size") % 7 == 0, " ").otherwise(F.col("p_name"))).select(
        "p_partkey", N.path_of(["p_type", "b", "c"]).alias("path")))
query("synthetic_ancestors", "", "SELECT substr(sha256(path), 1, 16) AS id, path, parts FROM (SELECT DISTINCT p_type AS path, 1 AS parts FROM part UNION SELECT DISTINCT p_type || ' > ' || p_brand, 2 FROM part)")(
    lambda s, d: N.synthetic_ancestors(t(s, d, "part").select(F.concat_ws(" > ", "p_type", "p_brand", "p_name").alias("path"))))
query("parent_by_path", "kw", """SELECT id, path, parent_id FROM (SELECT a.id, concat_ws(' > ', c.label, b.label, a.label) AS path, a.parent_id FROM kw a LEFT JOIN kw b ON a.parent_id = b.id LEFT JOIN kw c ON b.parent_id = c.id)""")(
    lambda s, d: N.parent_by_path(G.full_paths(S.keywords(s, d)).withColumnRenamed("full_path", "path")))
query("alias_list", "", "SELECT p_partkey, p_brand || CASE WHEN p_size % 2 = 0 THEN '' ELSE ',' || p_type END AS aliases FROM part")(
    lambda s, d: t(s, d, "part").withColumn("x", F.when(F.col("p_size") % 2 == 0, "NOT PROVIDED").otherwise(F.col("p_type"))).select("p_partkey", F.array_join(N.alias_list("p_name", ["p_brand", "p_name", "x", "p_brand"]), ",").alias("aliases")))
query("split_comma", "", "SELECT o_orderkey, o_orderstatus || '|' || o_orderpriority AS parts FROM orders")(
    lambda s, d: t(s, d, "orders").withColumn("x", F.concat(F.lit(" "), "o_orderstatus", F.lit(" ,, "), "o_orderpriority", F.lit(","))).select("o_orderkey", F.array_join(N.split_list("x"), "|").alias("parts")))
query("vocab_normalize", "", "SELECT DISTINCT p_name AS raw, lower(p_name) AS term FROM part")(
    lambda s, d: t(s, d, "part").select(F.col("p_name").alias("raw"), F.concat("p_name", F.lit("()")).alias("x")).distinct().select("raw", N.vocabulary_term("x").alias("term")))
query("null_tokens", "", "SELECT p_partkey, CASE WHEN p_size % 3 <> 0 THEN p_brand END AS brand FROM part")(
    lambda s, d: t(s, d, "part").withColumn("x", F.when(F.col("p_size") % 3 == 0, "#N/A").otherwise(F.col("p_brand"))).select("p_partkey", N.null_tokens("x").alias("brand")))
query("doi_normalize", "", "SELECT o_orderkey, '10.5/x' || o_orderkey AS doi FROM orders")(
    lambda s, d: t(s, d, "orders").withColumn("x", F.concat(F.lit("http://dx.doi.org/10.5/X"), "o_orderkey")).select("o_orderkey", N.doi_key("x").alias("doi")))
query("uri_vocab", "", "SELECT page_id, CASE WHEN contains(url, 'example.com') THEN 'Com' WHEN contains(url, 'example.org') THEN 'Org' ELSE 'Unknown (' || split_part(split_part(url, '://', 2), '/', 1) || ')' END AS vocabulary FROM pages")(
    lambda s, d: t(s, d, "pages").select("page_id", N.uri_vocabulary("url", {"example.com": "Com", "example.org": "Org"}).alias("vocabulary")))
query("path_columns", "", "SELECT p_partkey, p_type AS category, p_brand AS topic, CAST(NULL AS VARCHAR) AS term FROM part")(
    lambda s, d: t(s, d, "part").withColumn("x", F.concat_ws(" > ", "p_type", "p_brand")).select("p_partkey", *N.path_columns("x", ["category", "topic", "term"])))
query("backfill", "", "SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderkey % 3 = 0 THEN 'NEW' ELSE o_orderpriority END AS o_orderpriority FROM orders")(
    lambda s, d: N.backfill(t(s, d, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority"), t(s, d, "orders").where("o_orderkey % 3 = 0").select("o_orderkey", F.lit("NEW").alias("o_orderpriority")), "o_orderkey", ["o_orderpriority"]))
query("dedup_anti_load", "", "SELECT o_custkey, min(o_orderkey) AS o_orderkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0) GROUP BY 1")(
    lambda s, d: N.load_new(t(s, d, "orders").select("o_custkey", "o_orderkey"), "o_custkey", ["o_orderkey"], t(s, d, "customer").where("c_acctbal < 0").select(F.col("c_custkey").alias("o_custkey"))))
query("tree_facts", "", "SELECT p_partkey, 1 AS depth, 'A' || p_size || ',B.' || p_size AS parents, 'A (Anatomy)' AS category FROM part")(
    lambda s, d: t(s, d, "part").withColumn("x", F.array(F.concat(F.lit("A"), "p_size", F.lit(".1")), F.concat(F.lit("B."), "p_size", F.lit(".22")))).select("p_partkey", *N.tree_facts("x")))

# Charts

query("source_flow", "senses lsenses", """SELECT source, discipline, max(labels) AS labels FROM (SELECT source, discipline, count(DISTINCT label) AS labels FROM senses GROUP BY 1, 2
  UNION ALL SELECT source, d, count(DISTINCT label) FROM (SELECT source, unnest(secondary) AS d, label FROM lsenses) GROUP BY 1, 2) GROUP BY 1, 2""")(
    lambda s, d: A.source_flow(S.senses(s, d), S.lens_senses(s, d).select("source", F.explode("secondary").alias("discipline"), "label")))
_SHARED = "SELECT x.{0} AS a, y.{0} AS b, count(*) AS labels FROM (SELECT DISTINCT lower(label) AS l, {0} FROM senses) x JOIN (SELECT DISTINCT lower(label) AS l, {0} FROM senses) y ON x.l = y.l AND x.{0} < y.{0} GROUP BY 1, 2"
query("discipline_links", "senses", _SHARED.format("discipline"))(lambda s, d: A.shared_labels(S.senses(s, d), "discipline"))
query("source_links", "senses", _SHARED.format("source"))(lambda s, d: A.shared_labels(S.senses(s, d), "source"))
query("subcategories", "senses", """SELECT source, sub, n, place FROM (SELECT discipline AS source, split_part(label, ' ', 2) AS sub, count(*) AS n, row_number() OVER (PARTITION BY discipline ORDER BY count(*) DESC, split_part(label, ' ', 2)) AS place
  FROM senses WHERE split_part(label, ' ', 2) <> '' GROUP BY 1, 2 HAVING count(*) >= 50) WHERE place <= 3""")(
    lambda s, d: A.subcategories(S.senses(s, d).select(F.col("discipline").alias("source"), F.concat_ws(" > ", "source", F.replace("label", F.lit(" "), F.lit(" > "))).alias("path")), "path", "source", 3, 50, 3))
query("polysemy_counts", "senses", "SELECT CAST(sum(CASE WHEN dn > 1 THEN 1 ELSE 0 END) AS BIGINT) AS multi_discipline, CAST(sum(CASE WHEN sn > 1 THEN 1 ELSE 0 END) AS BIGINT) AS multi_source, count(*) AS labels FROM (SELECT lower(label) AS l, count(DISTINCT discipline) AS dn, count(DISTINCT source) AS sn FROM senses GROUP BY 1)")(
    lambda s, d: A.polysemy_counts(S.senses(s, d)))
query("flow_matrix", "senses", f", x AS ({_SHARED.format('discipline')}) SELECT a, b, labels FROM x UNION ALL SELECT b, a, labels FROM x")(
    lambda s, d: A.symmetric(A.shared_labels(S.senses(s, d), "discipline")))
query("top_per_group", "senses rels", """, deg AS (SELECT sense_id, count(*) AS degree FROM (SELECT source_sense_id AS sense_id FROM rels UNION ALL SELECT target_sense_id FROM rels) GROUP BY 1)
  SELECT discipline, label, edges, place FROM (SELECT discipline, label, CAST(sum(degree) AS BIGINT) AS edges, row_number() OVER (PARTITION BY discipline ORDER BY sum(degree) DESC, label) AS place FROM senses JOIN deg USING (sense_id) GROUP BY 1, 2) WHERE place <= 100""")(
    lambda s, d: A.top_labels(S.senses(s, d), G.degrees(S.rels(s, d)), 100))
query("cross_edges", "senses rels", """SELECT DISTINCT least(a.discipline || '/' || a.label, b.discipline || '/' || b.label) AS a, greatest(a.discipline || '/' || a.label, b.discipline || '/' || b.label) AS b
  FROM rels JOIN senses a ON a.sense_id = source_sense_id JOIN senses b ON b.sense_id = target_sense_id WHERE a.discipline <> b.discipline""")(lambda s, d: A.cross_edges(S.rels(s, d), S.senses(s, d)))
query("lens_members", "senses fine disc", f""", {LENSES_SQL}, m AS (SELECT label, min_by(discipline, sense_id) AS discipline FROM fine GROUP BY 1)
  SELECT lens_id, discipline, count(*) AS members FROM m JOIN (SELECT lens_id, of AS discipline FROM lw WHERE weight >= 0.25) USING (discipline) GROUP BY 1, 2""")(
    lambda s, d: L.lens_members(S.fine_senses(s, d), _lenses(s, d), 0.25))
query("program_flow", "pubs", "SELECT journal, category, count(*) AS n, round(count(*) / sum(count(*)) OVER (PARTITION BY journal), 6) AS share FROM pubs GROUP BY 1, 2")(
    lambda s, d: C.share_of_group(S.pubs(s, d), "journal", "category"))
query("radial_layout", "senses", """, sec AS (SELECT discipline, row_number() OVER (ORDER BY discipline) - 1 AS sector, count(*) OVER () AS k FROM (SELECT DISTINCT discipline FROM senses)),
  p AS (SELECT *, row_number() OVER (PARTITION BY discipline ORDER BY confidence DESC, sense_id) AS place FROM senses QUALIFY place <= 100),
  a AS (SELECT p.sense_id, p.discipline, 2 * 3.141592653589793::DOUBLE * (sector + place / 101) / k AS angle, least(tanh((coalesce(level, 0) + 1) / 2), 0.97::DOUBLE) AS r FROM p JOIN sec USING (discipline))
  SELECT sense_id, discipline, round(r * cos(angle), 6) AS x, round(r * sin(angle), 6) AS y FROM a""")(lambda s, d: A.radial_layout(S.senses(s, d), 100))
