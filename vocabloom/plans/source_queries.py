"""Queries of the file readers, concept, vector and remaining graph operators.

The readers get lines and records that Spark makes from the driver's tables; the SQL states what they must find.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vocabloom.operators import concepts as K
from vocabloom.operators import edges as J
from vocabloom.operators import flows as A
from vocabloom.operators import normalize as N
from vocabloom.operators import senses as C
from vocabloom.operators import validation as V
from vocabloom.operators import vectors as E
from vocabloom.functions.frame import first_by
from vocabloom.plans import standins as S
from vocabloom.plans.registry import query
from vocabloom.plans.standins import t
from vocabloom.sources import scans

CSV_HEADER = '"Category","Class","Type","Short_Name","UUID"'
VOCAB = "http://vocab/"


def fmt(pattern: str, *columns) -> F.Column:
    """``pattern`` with each ``%s`` replaced by a column."""
    parts = pattern.split("%s")
    out = [F.lit(parts[0])]
    for c, text in zip(columns, parts[1:], strict=True):
        out += [(F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(text)]
    return F.concat(*out)


def csv_lines(s: SparkSession, d: str) -> DataFrame:
    rows = t(s, d, "part").select(fmt('"%s","%s","%s","%s","u%s"', "p_type", "p_brand", "p_name", F.when(F.col("p_size") % 2 == 0, "").otherwise(F.col("p_brand")), "p_partkey").alias("value"))
    return rows.union(rows.limit(1).select(F.lit(CSV_HEADER)))


def nt_lines(s: SparkSession, d: str) -> DataFrame:
    """Label, definition, parent and match lines of every keyword, and one line that is no triple."""
    k = S.keywords(s, d)
    head = "<" + VOCAB + "%s> <" + scans.SKOS
    return k.select(F.explode(F.array(
        fmt(head + 'prefLabel> "autre"@fr .', "id"), fmt(head + 'prefLabel> "%s"@en .', "id", "label"), fmt(head + 'note> "a \\"%s\\" note" .', "id", "source"),
        fmt(head + "broader> <" + VOCAB + "%s> .", "id", "parent_id"), fmt(head + "exactMatch> <http://other/%s> .", "id", "id"), fmt(head + "closeMatch> <http://near/%s> .", "id", "level"),
        fmt("<%s> no triple", "id"),
    )).alias("value"))


def triples(s: SparkSession, d: str) -> DataFrame:
    return scans.skos_triples(scans.parse_triples(nt_lines(s, d).where("value IS NOT NULL")))


query("scan_csv", "", "SELECT p_type || ' > ' || p_brand || ' > ' || p_name AS path, min('u' || p_partkey) AS id, 2 AS level FROM part GROUP BY 1")(
    lambda s, d: (lambda r: first_by(r.select(N.path_of(scans.hierarchy_columns(scans.split_header(CSV_HEADER))).alias("path"), F.col("UUID").alias("id")), ["path"], ["id"]))(
        scans.parse_csv(csv_lines(s, d), CSV_HEADER)).withColumn("level", F.size(F.split("path", " > ")) - 1))
query("scan_ntriples", "kw", f"""SELECT '{VOCAB}' || id AS subject, p AS predicate, o AS object, l AS lang FROM (
  SELECT id, 'prefLabel' AS p, 'autre' AS o, 'fr' AS l FROM kw UNION ALL SELECT id, 'prefLabel', label, 'en' FROM kw UNION ALL SELECT id, 'note', 'a "' || source || '" note', NULL FROM kw
  UNION ALL SELECT id, 'broader', '{VOCAB}' || parent_id, NULL FROM kw WHERE parent_id IS NOT NULL UNION ALL SELECT id, 'exactMatch', 'http://other/' || id, NULL FROM kw
  UNION ALL SELECT id, 'closeMatch', 'http://near/' || level, NULL FROM kw)""")(lambda s, d: triples(s, d).drop("pos"))
query("triples_to_concepts", "kw", f"SELECT '{VOCAB}' || id AS subject, label, 'a \"' || source || '\" note' AS definition, coalesce('{VOCAB}' || parent_id, '') AS broader FROM kw")(
    lambda s, d: K.triples_to_concepts(triples(s, d)).select("subject", "label", "definition", F.array_join("broader", ",").alias("broader")))
query("skos_matches", "kw", f"""SELECT '{VOCAB}' || id AS source_id, 'http://other/' || id AS target_id, 'exact' AS match_type, 1.0::DOUBLE AS confidence FROM kw
  UNION ALL SELECT '{VOCAB}' || id, 'http://near/' || level, 'close', 0.9::DOUBLE FROM kw""")(lambda s, d: K.skos_matches(triples(s, d)))


def skos_records(s: SparkSession, d: str) -> DataFrame:
    ns = '<skos:Concept xmlns:skos="http://www.w3.org/2004/02/skos/core#" xmlns:rdf="http://www.w3.org/1999/02/22-rdf-syntax-ns#" rdf:about="http://vocab/%s">'
    return S.keywords(s, d).select(fmt(
        ns + '<skos:prefLabel xml:lang="fr">autre</skos:prefLabel>%s<skos:scopeNote xml:lang="en">note of %s</skos:scopeNote>%s</skos:Concept>',
        "id", F.when(F.col("level") < 2, fmt('<skos:prefLabel xml:lang="en">%s</skos:prefLabel>', "label")).otherwise(""), "source",
        F.coalesce(fmt('<skos:broader rdf:resource="http://vocab/%s"/>', "parent_id"), F.lit(""))).alias("value"))


query("scan_skos_xml", "kw", f"SELECT '{VOCAB}' || id AS uri, coalesce('{VOCAB}' || parent_id, '') AS broader, CASE WHEN level < 2 THEN 2 ELSE 1 END AS labels FROM kw")(
    lambda s, d: scans.parse_skos(skos_records(s, d)).select("uri", F.array_join("broader", ",").alias("broader"), F.size("pref_labels").alias("labels")))
query("language_pick", "kw", f"SELECT '{VOCAB}' || id AS uri, CASE WHEN level < 2 THEN label END AS english, 'autre' AS french, CASE WHEN level < 2 THEN label ELSE 'autre' END AS any_label FROM kw")(
    lambda s, d: scans.parse_skos(skos_records(s, d)).select("uri", K.text_in("pref_labels", "en").alias("english"), K.text_in("pref_labels", "fr").alias("french"), K.text_any("pref_labels", "uri").alias("any_label")))
query("definition_fallback", "kw", f"SELECT '{VOCAB}' || id AS uri, 'note of ' || source AS definition FROM kw")(
    lambda s, d: scans.parse_skos(skos_records(s, d)).select("uri", F.coalesce(K.text_in("definitions", "en"), K.text_in("notes", "en")).alias("definition")))
query("scan_nodes", "kw", "SELECT id AS tax_id, parent_id, 'rank' || level AS rank FROM kw")(
    lambda s, d: scans.parse_nodes(S.keywords(s, d).select(fmt("%s\t|\t%s\t|\trank%s\t|\tx\t|", "id", F.coalesce("parent_id", "id"), "level").alias("value"))))
query("scan_names", "kw", "SELECT id AS tax_id, label, 'common ' || label AS common_name, 'common ' || label || ',old ' || label AS aliases FROM kw")(
    lambda s, d: scans.parse_names(S.keywords(s, d).select(F.explode(F.array(*(
        fmt("%s\t|\t" + p + "%s\t|\t\t|\t" + kind + "\t|", "id", "label") for p, kind in (("", "scientific name"), ("common ", "genbank common name"), ("old ", "synonym"), ("by ", "authority"))
    ))).alias("value"))).withColumn("aliases", F.array_join("aliases", ",")))


def descriptors(s: SparkSession, d: str) -> DataFrame:
    """A descriptor for each part below one for each type: A<size>, then A<size>.<part>."""
    return t(s, d, "part").select(fmt(
        '<DescriptorRecord><DescriptorUI>D%s</DescriptorUI><DescriptorName><String>%s</String></DescriptorName><TreeNumberList><TreeNumber>A%s.%s</TreeNumber>%s</TreeNumberList><ConceptList>'
        '<Concept PreferredConceptYN="Y"><ScopeNote> note %s </ScopeNote><TermList><Term><String>%s</String></Term><Term><String>syn %s</String></Term></TermList></Concept></ConceptList></DescriptorRecord>',
        "p_partkey", "p_name", "p_size", "p_partkey", F.when(F.col("p_partkey") <= 50, fmt("<TreeNumber>A%s</TreeNumber>", "p_partkey")).otherwise(""), "p_type", "p_name", "p_partkey").alias("value"))


query("scan_descriptor_xml", "", "SELECT 'D' || p_partkey AS ui, p_name AS heading, 'note ' || p_type AS scope_note, 'syn ' || p_partkey AS synonyms, CASE WHEN p_partkey <= 50 THEN 2 ELSE 1 END AS trees FROM part")(
    lambda s, d: scans.parse_descriptors(descriptors(s, d)).select("ui", "heading", "scope_note", F.array_join("synonyms", ",").alias("synonyms"), F.size("tree_numbers").alias("trees")))
query("tree_parents", "", "SELECT 'D' || p_partkey AS ui, 'D' || p_size AS parent_ui FROM part")(lambda s, d: K.tree_parents(scans.parse_descriptors(descriptors(s, d))))
query("scan_descriptor_json", "", "SELECT 'D' || p_partkey AS ui, p_name AS heading, p_type || ',' || p_brand AS trees FROM part")(
    lambda s, d: scans.parse_json(t(s, d, "part").select(fmt('{"ui":"D%s","heading":"%s","tree_numbers":["%s","%s"]}', "p_partkey", "p_name", "p_type", "p_brand").alias("value")),
                                  "ui STRING, heading STRING, tree_numbers ARRAY<STRING>").select("ui", "heading", F.array_join("tree_numbers", ",").alias("trees")))


def entities(s: SparkSession, d: str) -> DataFrame:
    line = '{"id":"https://api/T%s","display_name":"%s","domain":{"id":"https://api/1","display_name":"%s"},"field":{"id":"https://api/2","display_name":"F"},"subfield":{"id":"https://api/S%s","display_name":"%s"},"keywords":["%s","%s","K%s"]}'
    return scans.parse_json(t(s, d, "part").select(fmt(line, F.lpad(F.col("p_partkey").cast("string"), 9, "0"), "p_name", "p_type", "p_size", "p_brand", "p_name", F.upper("p_brand"), F.col("p_partkey") % 300).alias("value")), scans.ENTITY_JSON)


query("scan_entities_json", "", "SELECT 'T' || lpad(p_partkey::VARCHAR, 9, '0') AS id, p_name AS label, 'S' || p_size AS parent_id, p_type || ' > F > ' || p_brand || ' > ' || p_name AS full_path, 3 AS level FROM part")(
    lambda s, d: K.entity_rows(entities(s, d), "topic"))
query("entity_path", "", "SELECT DISTINCT 'S' || p_size AS id, p_brand AS label, '2' AS parent_id, p_type || ' > F > ' || p_brand AS full_path, 2 AS level FROM part")(
    lambda s, d: K.entity_rows(entities(s, d).select("subfield.id", "subfield.display_name", "domain", "field"), "subfield").distinct())
query("topic_keywords", "", """SELECT k AS label, 'T' || lpad(min(p)::VARCHAR, 9, '0') AS parent_id, 4 AS level FROM (
  SELECT upper(p_brand) AS k, p_partkey AS p FROM part UNION ALL SELECT 'K' || (p_partkey % 300), p_partkey FROM part) GROUP BY 1""")(
    lambda s, d: K.topic_keywords(entities(s, d)).drop("id"))


def works(s: SparkSession, d: str) -> DataFrame:
    """A work for each order line's order, made twice, with the parts as topics."""
    topic = fmt('{"id":"https://api/T%s","display_name":"part %s"}', "l_partkey", "l_partkey")
    per = t(s, d, "lineitem").groupBy("l_orderkey").agg(F.array_join(F.array_sort(F.collect_set(topic)), ",").alias("topics"))
    one = per.select(fmt('{"id":"https://api/W%s","display_name":"work %s","topics":[%s],"keywords":[{"display_name":"k%s"}]}', "l_orderkey", "l_orderkey", "topics", F.col("l_orderkey") % 7).alias("value"))
    return scans.parse_json(one.union(one), scans.WORK_JSON)


query("work_summary", "", """SELECT 'W' || l_orderkey AS work_id, 'work ' || l_orderkey AS title, string_agg(DISTINCT 'T' || l_partkey, ';' ORDER BY 'T' || l_partkey) AS topic_ids, 'k' || (l_orderkey % 7) AS keywords
  FROM lineitem GROUP BY l_orderkey""")(lambda s, d: scans.work_summary(works(s, d)).withColumn("topic_ids", F.array_join(F.array_sort(F.split("topic_ids", ";")), ";")).drop("topics"))
query("slim_records", "", "SELECT '10.1/a' || o_orderkey AS doi, 'order ' || o_orderkey AS title, CASE WHEN o_orderkey % 2 = 0 THEN 1900 ELSE year(o_orderdate) END AS year FROM orders")(
    lambda s, d: scans.slim_records(scans.parse_json((lambda x: x.union(x))(t(s, d, "orders").select(fmt(
        '{"DOI":"10.1/A%s","title":["order %s"],%s"issued":{"date-parts":[[%s,1]]}}', "o_orderkey", "o_orderkey",
        F.when(F.col("o_orderkey") % 2 == 0, '"published-online":{"date-parts":[[1900]]},').otherwise(""), F.year("o_orderdate")).alias("value"))), scans.RECORD_JSON)))
query("json_documents", "kw", """SELECT CASE WHEN level = 0 THEN '' ELSE parent_id END AS parent_id, '{"children":[' || string_agg('{"id":"' || id || '","label":"' || label || '"}', ',' ORDER BY id) || ']}' AS document
  FROM kw GROUP BY 1""")(
    lambda s, d: scans.json_documents(S.keywords(s, d).select(F.coalesce("parent_id", F.lit("")).alias("parent_id"), "id", "label"), "parent_id", "id", "children"))


def experts(s: SparkSession, d: str) -> DataFrame:
    """Brands as experts that map types to sizes."""
    p = t(s, d, "part").groupBy("p_brand", "p_type").agg(F.collect_list(fmt('{"source":"s%s","confidence":0.%s}', F.col("p_size") % 10, 1 + F.col("p_partkey") % 9)).alias("m"))
    c = p.groupBy("p_brand").agg(F.array_join(F.collect_list(fmt('{"name":"%s","source_mappings":[%s]}', "p_type", F.array_join("m", ","))), ",").alias("c"))
    return scans.parse_json(c.select(fmt('{"expert":"%s","categories":[%s]}', "p_brand", "c").alias("value")), "expert STRING, categories ARRAY<STRUCT<name: STRING, source_mappings: ARRAY<STRUCT<source: STRING, confidence: DOUBLE>>>>")


MAPPED = "SELECT p_brand AS expert, p_type AS category, 's' || (p_size % 10) AS source, (1 + p_partkey % 9) / 10 AS confidence FROM part"
query("nested_explode", "", MAPPED)(lambda s, d: scans.explode_mappings(experts(s, d)))
query("consensus", "", f"SELECT category, source, count(*) AS experts, round(1 - exp(sum(ln(1 - c))), 6) AS confidence FROM (SELECT category, source, expert, max(confidence) AS c FROM ({MAPPED}) GROUP BY 1, 2, 3) GROUP BY 1, 2")(
    lambda s, d: V.consensus(scans.explode_mappings(experts(s, d))))
query("two_level_hierarchy", "", """SELECT DISTINCT 'group-' || p_type AS id, lower(p_type) AS label, CAST(NULL AS VARCHAR) AS parent_id, CAST(NULL AS VARCHAR) AS alias, 0 AS level FROM part
  UNION ALL SELECT 'code-' || p_partkey, p_name, 'group-' || p_type, CAST(p_partkey AS VARCHAR), 1 FROM part""")(
    lambda s, d: K.two_level_hierarchy(t(s, d, "part").select(F.col("p_partkey").cast("string").alias("code"), F.col("p_name").alias("label"), F.col("p_type").alias("group_id")),
                                       t(s, d, "part").select(F.col("p_type").alias("group_id"), F.lower("p_type").alias("label")).distinct()))
query("concept_enrichment", "", "SELECT p_partkey, p_name || ' [Ref: ' || p_brand || '] | ' || p_type AS definition FROM part")(
    lambda s, d: scans.parse_json(t(s, d, "part").select(fmt('{"p_partkey":%s,"definitions":[{"text":"%s","reference":"%s"},{"text":""},{"text":"%s","reference":""}]}', "p_partkey", "p_name", "p_brand", "p_type").alias("value")),
                                  "p_partkey LONG, definitions ARRAY<STRUCT<text: STRING, reference: STRING>>").select("p_partkey", K.concept_definition("definitions").alias("definition")))
query("enrichment_stats", "", """SELECT CAST(sum(CASE WHEN p_size > 5 AND p_partkey % 3 = 0 THEN 1 ELSE 0 END) AS BIGINT) AS enriched, CAST(sum(CASE WHEN p_size > 5 AND p_partkey % 6 = 0 THEN 1 ELSE 0 END) AS BIGINT) AS with_definition,
  CAST(sum(CASE WHEN p_size > 5 AND p_partkey % 3 = 0 THEN 1 ELSE 0 END) AS BIGINT) AS with_aliases, CAST(sum(CASE WHEN p_size > 5 AND p_partkey % 3 <> 0 THEN 1 ELSE 0 END) AS BIGINT) AS failed,
  CAST(sum(CASE WHEN p_size > 5 THEN 0 ELSE 1 END) AS BIGINT) AS skipped FROM part""")(
    lambda s, d: K.enrichment_stats(t(s, d, "part").select(F.col("p_partkey").alias("id"), F.when(F.col("p_size") > 5, F.col("p_name")).alias("uri")),
                                    t(s, d, "part").where("p_partkey % 3 = 0").select(F.col("p_partkey").alias("id"), F.when(F.col("p_partkey") % 6 == 0, F.col("p_name")).otherwise("").alias("definition"), F.array("p_brand").alias("aliases"))))

# Senses, edges, vectors, statistics

LAB = """lab AS (SELECT l_orderkey AS pub, l_returnflag AS category, p_name AS a, p_brand AS b, p_type AS c FROM lineitem JOIN part ON l_partkey = p_partkey),
  counted AS (SELECT label, count(DISTINCT pub) AS pubs, min(category) AS category FROM (SELECT pub, category, unnest([a, b, c]) AS label FROM lab) WHERE length(label) > 2 GROUP BY 1)"""


def lab_rows(s: SparkSession, d: str) -> DataFrame:
    return t(s, d, "lineitem").join(t(s, d, "part"), F.col("l_partkey") == F.col("p_partkey")).select(F.col("l_orderkey").alias("pub"), F.col("l_returnflag").alias("category"), "p_name", "p_brand", "p_type")


query("lab_senses", "senses", f", {LAB} SELECT label, pubs, category, lower(label) IN (SELECT lower(label) FROM senses) AS matching FROM counted")(
    lambda s, d: C.lab_senses(lab_rows(s, d), "pub", ["p_name", "p_brand", "p_type"], "category", S.senses(s, d)))
query("lab_links", "senses", f""", {LAB} SELECT label, sense_id AS target_sense_id, place FROM counted JOIN (SELECT sense_id, lower(label) AS l, row_number() OVER (PARTITION BY lower(label) ORDER BY sense_id) AS place FROM senses) ON l = lower(label) WHERE place <= 3""")(
    lambda s, d: C.lab_links(C.lab_senses(lab_rows(s, d), "pub", ["p_name", "p_brand", "p_type"], "category", S.senses(s, d)), S.senses(s, d)))
query("entity_resolution", "", """WITH n AS (SELECT DISTINCT unnest([p_name, upper(p_name), replace(p_name, ' ', '-')]) AS name FROM part), k AS (SELECT name, regexp_replace(lower(name), '[^a-z0-9]', '', 'g') AS key FROM n)
  SELECT name, coalesce(g.canonical, o.own) AS canonical FROM k JOIN (SELECT key, min(name COLLATE C) AS own FROM k GROUP BY 1) o USING (key)
  LEFT JOIN (SELECT regexp_replace(lower(p_name), '[^a-z0-9]', '', 'g') AS key, min(p_type) AS canonical FROM part WHERE p_name LIKE 'a%' GROUP BY 1) g USING (key)""".replace(" COLLATE C", ""))(
    lambda s, d: C.resolve_entities(t(s, d, "part").select(F.explode(F.array("p_name", F.upper("p_name"), F.replace("p_name", F.lit(" "), F.lit("-")))).alias("name")),
                                    t(s, d, "part").where("p_name LIKE 'a%'").select(F.col("p_name").alias("variant"), F.col("p_type").alias("canonical"))))
query("orphan_links", "senses", """, o AS (SELECT sense_id AS s, discipline, CASE WHEN keyword_id::INT % 6 = 0 THEN 'abc' WHEN keyword_id::INT % 3 = 0 THEN 'abc x' WHEN keyword_id::INT % 3 = 1 THEN split_part(label, ' ', 1) ELSE discipline END AS l FROM senses WHERE level IS NULL),
  c AS (SELECT sense_id, label, discipline, confidence FROM senses WHERE level IS NOT NULL UNION ALL SELECT sense_id || 'x', split_part(label, ' ', 2), discipline, confidence FROM senses WHERE level = 0),
  best AS (SELECT l, t FROM (SELECT lower(label) AS l, sense_id AS t, row_number() OVER (PARTITION BY lower(label) ORDER BY confidence DESC, sense_id) AS rn FROM c) WHERE rn = 1),
  f AS (SELECT s, t, 1 AS strategy, l AS tl FROM (SELECT s FROM o WHERE lower(l) = 'abc'), best WHERE l = (SELECT min(lower(label)) FROM senses WHERE level IS NOT NULL)
    UNION ALL SELECT s, t, 2, l FROM (SELECT s FROM o WHERE lower(l) LIKE '% abc %' OR lower(l) LIKE 'abc %' OR lower(l) LIKE '% abc'), best WHERE l = (SELECT min(lower(label)) FROM senses WHERE level IS NOT NULL)
    UNION ALL SELECT s, t, 3, w FROM (SELECT s, unnest(string_split(lower(l), ' ')) AS w FROM o) x JOIN best ON best.l = w WHERE length(w) > 3
    UNION ALL SELECT s, t, 4, tl FROM o JOIN (SELECT w, t, tl FROM (SELECT *, row_number() OVER (PARTITION BY w ORDER BY length(tl) DESC, tl) AS rn FROM (SELECT DISTINCT unnest(string_split(l, ' ')) AS w, t, l AS tl FROM best)) WHERE rn = 1) b ON lower(o.l) = b.w
    UNION ALL SELECT s, t, 5, tl FROM o JOIN (SELECT discipline, sense_id AS t, lower(label) AS tl, row_number() OVER (PARTITION BY discipline ORDER BY confidence DESC, sense_id) AS rn FROM c) y ON y.discipline = o.discipline AND rn = 1)
  SELECT s AS source_sense_id, t AS target_sense_id, strategy, CASE strategy WHEN 1 THEN 0.85 WHEN 2 THEN 0.7 WHEN 3 THEN 0.6 WHEN 4 THEN 0.55 ELSE 0.3 END::DOUBLE AS confidence FROM (
    SELECT *, row_number() OVER (PARTITION BY s ORDER BY strategy, length(tl) DESC, tl, t) AS rn FROM f WHERE s <> t) WHERE rn = 1""")(
    lambda s, d: (lambda x: J.orphan_links(
        x.where("level IS NULL").withColumn("label", F.when(F.col("keyword_id").cast("int") % 6 == 0, "abc").when(F.col("keyword_id").cast("int") % 3 == 0, "abc x").when(F.col("keyword_id").cast("int") % 3 == 1, F.split_part("label", F.lit(" "), F.lit(1))).otherwise(F.col("discipline"))),
        x.where("level IS NOT NULL").select("sense_id", "label", "discipline", "confidence").union(x.where("level = 0").select(F.concat("sense_id", F.lit("x")), F.split_part("label", F.lit(" "), F.lit(2)), "discipline", "confidence")),
        x.where("level IS NOT NULL").agg(F.min(F.lower("label")).alias("full")).select(F.lit("ABC").alias("short"), "full")))(S.senses(s, d)))
COSINE = "SELECT a.vec_id AS source, b.vec_id AS target, round(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 6) AS cosine FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0"
query("embedding_edges", "", f"SELECT * FROM ({COSINE}) WHERE cosine >= 0.25")(
    lambda s, d: (lambda e: E.similar(e.where("vec_id % 100 = 0"), e, "vec_id", "embedding", 0.25))(t(s, d, "embeddings")))
query("nearest_neighbor", "", f"SELECT source, target, cosine FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY cosine DESC, target) AS rn FROM ({COSINE}) WHERE cosine >= 0.1) WHERE rn = 1")(
    lambda s, d: (lambda e: E.nearest(e.where("vec_id % 100 = 0"), e, "vec_id", "embedding", 0.1))(t(s, d, "embeddings")))
query("centroid_assign", "", """WITH e AS (SELECT vec_id, label, unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) AS i FROM embeddings), c AS (SELECT label, i, avg(v) AS m FROM e GROUP BY 1, 2),
  s AS (SELECT e.vec_id, c.label, round(sum(v * m) / sqrt(sum(m * m)), 9) AS s FROM e JOIN c USING (i) GROUP BY 1, 2)
  SELECT vec_id, label AS assigned FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY s DESC, label) AS rn FROM s) WHERE rn = 1""")(
    lambda s, d: E.centroid_assign(t(s, d, "embeddings"), "vec_id", "embedding", "label"))
query("pca3")(lambda s, d: E.principal_components(t(s, d, "embeddings"), "vec_id", "embedding"))
query("coverage", "senses", """, sh AS (SELECT p_type AS discipline, count(*) / (SELECT count(*) FROM part) AS share FROM part WHERE p_type <> 'PROMO' GROUP BY 1)
  SELECT s.discipline, labels, round(share * 500, 6) AS expected, round(least(1.0::DOUBLE, labels / (share * 500)), 6) AS coverage FROM (SELECT discipline, count(DISTINCT label) AS labels FROM senses GROUP BY 1) s LEFT JOIN sh USING (discipline)""".replace(
    "round(least(1.0::DOUBLE, labels / (share * 500)), 6)", "CASE WHEN share IS NOT NULL THEN round(least(1.0::DOUBLE, labels / (share * 500)), 6) END"))(
    lambda s, d: (lambda p: V.coverage(S.senses(s, d), p.where("p_type <> 'PROMO'").groupBy(F.col("p_type").alias("discipline")).agg(F.count("*").alias("n")).crossJoin(p.agg(F.count("*").alias("all"))).select(
        "discipline", (F.col("n") / F.col("all")).alias("share")), 500.0))(t(s, d, "part")))
query("scorecard", "senses rels", """, e AS (SELECT source_sense_id AS id FROM rels UNION SELECT target_sense_id FROM rels), n AS (SELECT count(*) AS n, count(level) AS lv, avg(confidence) AS cf, count(DISTINCT lower(label)) AS lb, count(DISTINCT source) AS sr,
  count(*) FILTER (sense_id IN (SELECT id FROM e)) AS o FROM senses), r AS (SELECT count(*) AS r FROM rels)
  SELECT metric, round(value, 6) AS value FROM (SELECT unnest(['senses', 'edges', 'edges_per_sense', 'connected', 'with_level', 'with_discipline', 'mean_confidence', 'unique_ids', 'unique_edges', 'labels', 'sources']) AS metric,
  unnest([n::DOUBLE, r::DOUBLE, r / n, o / n, lv / n, 1.0::DOUBLE, cf, 1.0::DOUBLE, 1.0::DOUBLE, lb::DOUBLE, sr::DOUBLE]) AS value FROM n, r)""")(
    lambda s, d: V.scorecard(S.senses(s, d), S.rels(s, d)))
query("paper_position", "pubkw", """, ix AS (SELECT lower(label) AS l, avg(x) AS x, avg(y) AS y FROM (SELECT p_name AS label, p_size::DOUBLE AS x, p_retailprice AS y FROM part WHERE p_size < 40
    UNION ALL SELECT p_name || ' ' || p_brand, p_size, p_retailprice FROM part WHERE p_size < 9 UNION ALL SELECT split_part(p_name, ' ', 1), p_size, p_retailprice FROM part WHERE p_size = 7) GROUP BY 1),
  tp AS (SELECT DISTINCT lower(label) AS topic FROM pubkw), wd AS (SELECT topic, unnest(string_split(topic, ' ')) AS l, generate_subscripts(string_split(topic, ' '), 1) AS pos FROM tp),
  hit AS (SELECT topic, x, y, row_number() OVER (PARTITION BY topic ORDER BY pos) AS rn FROM (SELECT topic, topic AS l, -1 AS pos FROM tp UNION ALL SELECT topic, l, pos FROM wd WHERE length(l) > 3) JOIN ix USING (l))
  SELECT pub, round(coalesce(avg(x), (SELECT avg(x) FROM ix)), 6) AS x, round(coalesce(avg(y), (SELECT avg(y) FROM ix)), 6) AS y, count(x) AS matched FROM pubkw LEFT JOIN hit ON topic = lower(label) AND rn = 1 GROUP BY 1""")(
    lambda s, d: A.paper_positions(S.pub_keywords(s, d).select("pub", F.col("label").alias("topic")), (lambda p: p.where("p_size < 40").select(F.col("p_name").alias("label"), F.col("p_size").cast("double").alias("x"), F.col("p_retailprice").alias("y")).union(
        p.where("p_size < 9").select(F.concat_ws(" ", "p_name", "p_brand"), "p_size", "p_retailprice")).union(p.where("p_size = 7").select(F.split_part("p_name", F.lit(" "), F.lit(1)), "p_size", "p_retailprice")).groupBy(
        F.lower("label").alias("label")).agg(F.avg("x").alias("x"), F.avg("y").alias("y")))(t(s, d, "part"))))
