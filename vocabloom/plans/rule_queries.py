"""Queries of the rule tables: disciplines of keywords, and the senses that depend on them.

Labels, paths and categories are made from the parts' names and, in turn, from the texts of the rules themselves, so that every rule holds somewhere and
several hold for most labels.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vocabloom.functions.automaton import Rule
from vocabloom.operators import rule_tables as R
from vocabloom.operators import senses as C
from vocabloom.operators import vectors as V
from vocabloom.plans import standins as S
from vocabloom.plans.registry import query
from vocabloom.plans.standins import t

_KEYWORDS, _SOURCES = R.keyword_rules(), R.source_rules()


def _texts(rules: list[Rule], *names: str) -> list[str]:
    return [r.text for r in rules if r.field in names and r.text]


_LABELS = _texts(_KEYWORDS, "label")
_CATEGORIES = _texts(_KEYWORDS, "category", "category_low")
_SCOPES = ["OpenAlex", "NASA GCMD", "DOE OSTI", "Library of Congress", "UNESCO Thesaurus", "NCBI Taxonomy", "MeSH", "another"]
_PARTS = ["", "none", *_texts(_SOURCES, "part1", "part2", "topic")]
_WORDS = _texts(_SOURCES, "path", "label")
_KINDS = ["sciencekeywords", "sciencekeywords", *_texts(_SOURCES, "kind", "letter"), "X"]


def _pick(values: list[str], at: str) -> Column:
    return F.get(F.array(*map(F.lit, values)), F.expr(f"CAST(({at}) % {len(values)} AS INT)"))


def _quoted(text: str | None) -> str:
    return "NULL" if text is None else "'" + text.replace("'", "''") + "'"


def _sql_pick(values: list[str], at: str) -> str:
    return f"([{', '.join(map(_quoted, values))}])[CAST(({at}) % {len(values)} AS INT) + 1]"


def _sql_rules(rules: list[Rule]) -> str:
    rows = ", ".join(f"({at}, {_quoted(r.name)}, {_quoted(r.kind)}, {_quoted(r.field)}, {_quoted(r.text)}, {_quoted(r.scope)})" for at, r in enumerate(rules))
    return f"rules AS (SELECT * FROM (VALUES {rows}) AS v(place, name, kind, field, text, scope))"


def _sql_first(rules: list[Rule], rows: str, key: str, scope: str, fields: dict[str, str]) -> str:
    """CTEs that end with ``found`` (key, place, name): the first rule of each row, tried one by one."""
    each = " UNION ALL ".join(f"SELECT {key}, {scope} AS s, {_quoted(f)} AS field, {sql} AS value FROM {rows}" for f, sql in fields.items())
    return f"""{_sql_rules(rules)}, vals AS (SELECT * FROM ({each}) WHERE value IS NOT NULL),
      hits AS (SELECT v.{key}, place FROM vals v JOIN rules r ON r.field = v.field AND (r.scope IS NULL OR r.scope = v.s)
                 AND CASE r.kind WHEN 'is' THEN v.value = r.text WHEN 'has' THEN contains(v.value, r.text) ELSE v.value <> '' END
               UNION ALL SELECT {key}, place FROM {rows} JOIN rules r ON r.field IS NULL AND (r.scope IS NULL OR r.scope = {scope})),
      found AS (SELECT {key}, place, name FROM (SELECT {key}, min(place) AS place FROM hits GROUP BY 1) JOIN rules USING (place))"""


def _labels(spark: SparkSession, d: str) -> DataFrame:
    """Part labels of one or two rule texts, with a category."""
    a, b = _pick(_LABELS, "p_partkey"), _pick(_LABELS, "p_partkey * 7 + 3")
    return t(spark, d, "part").select(
        "p_partkey", F.when(F.expr("p_partkey % 3 = 0"), a).when(F.expr("p_partkey % 3 = 1"), F.concat(F.upper("p_name"), F.lit(" "), a, F.lit("x"), b)).otherwise(F.col("p_name")).alias("label"),
        F.when(F.expr("p_partkey % 11 > 0"), F.concat(F.when(F.expr("p_partkey % 2 = 0"), "Old ").otherwise(""), _pick(_CATEGORIES, "p_partkey * 5 + 1"))).alias("category"),
    )


_LABELS_SQL = f"""labels AS (SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN {_sql_pick(_LABELS, 'p_partkey')} WHEN 1 THEN upper(p_name) || ' ' || {_sql_pick(_LABELS, 'p_partkey')} || 'x' || {_sql_pick(_LABELS, 'p_partkey * 7 + 3')} ELSE p_name END AS label,
  CASE WHEN p_partkey % 11 > 0 THEN CASE WHEN p_partkey % 2 = 0 THEN 'Old ' ELSE '' END || {_sql_pick(_CATEGORIES, 'p_partkey * 5 + 1')} END AS category FROM part)"""
_KEYWORD_FIELDS = {"label": "lower(trim(label))", "category": "category", "category_low": "lower(category)"}

query("keyword_disciplines", "", f"WITH {_LABELS_SQL}, {_sql_first(_KEYWORDS, 'labels', 'p_partkey', 'NULL', _KEYWORD_FIELDS)} SELECT p_partkey, label, category, name AS discipline FROM labels JOIN found USING (p_partkey)")(
    lambda s, d: C.keyword_disciplines(_labels(s, d)).select("p_partkey", "label", "category", "discipline"))


def _sourced(spark: SparkSession, d: str) -> DataFrame:
    word = lambda at: _pick(_WORDS, at)
    return t(spark, d, "part").select(
        "p_partkey", _pick(_SCOPES, "p_partkey").alias("source"),
        F.when(F.expr("p_partkey % 13 > 0"), F.concat(_pick(_PARTS, "p_partkey * 3 + 1"), F.lit(" > "), _pick(_PARTS, "p_partkey * 5 + 2"), F.lit(" > "), F.initcap(word("p_partkey * 11")), F.lit(" "), "p_name")).alias("path"),
        F.concat("p_name", F.lit(" "), F.upper(word("p_partkey * 7 + 3"))).alias("label"), F.when(F.expr("p_partkey % 17 > 0"), _pick(_KINDS, "p_partkey * 3 + p_size")).alias("kind"),
    )


_SOURCED_SQL = f"""src AS (SELECT p_partkey, {_sql_pick(_SCOPES, 'p_partkey')} AS source,
    CASE WHEN p_partkey % 13 > 0 THEN lower({_sql_pick(_PARTS, 'p_partkey * 3 + 1')} || ' > ' || {_sql_pick(_PARTS, 'p_partkey * 5 + 2')} || ' > ' || {_sql_pick(_WORDS, 'p_partkey * 11')} || ' ' || p_name) END AS path,
    CASE WHEN p_partkey % 13 > 0 THEN list_filter([{_sql_pick(_PARTS, 'p_partkey * 3 + 1')}, {_sql_pick(_PARTS, 'p_partkey * 5 + 2')}, p_name], lambda x: x <> '') ELSE [] END AS parts,
    lower(p_name || ' ' || {_sql_pick(_WORDS, 'p_partkey * 7 + 3')}) AS label, CASE WHEN p_partkey % 17 > 0 THEN {_sql_pick(_KINDS, 'p_partkey * 3 + p_size')} END AS kind FROM part)"""
# A path's third part begins with a rule's word, so it is no field's value; with fewer parts before it, it is the second or first one and still none.
_SOURCE_FIELDS = {
    "part1": "parts[1]", "part2": "parts[2]", "topic": "CASE WHEN kind = 'sciencekeywords' THEN parts[2] END", "path": "path", "label": "label", "kind": "kind", "letter": "kind[1]",
}
query("source_disciplines", "", f"WITH {_SOURCED_SQL}, {_sql_first(_SOURCES, 'src', 'p_partkey', 'source', _SOURCE_FIELDS)} SELECT p_partkey, source, name AS discipline FROM src JOIN found USING (p_partkey)")(
    lambda s, d: C.source_disciplines(_sourced(s, d)).select("p_partkey", "source", "discipline"))


# Senses of publication keywords, categories and other fields


def _mentions(spark: SparkSession, d: str) -> DataFrame:
    lines = t(spark, d, "lineitem").select(F.col("l_orderkey").alias("pub"), F.col("l_partkey").alias("p_partkey"), F.when(F.col("l_returnflag") == "R", "author").otherwise("plus").alias("kind"), "l_linenumber")
    labels = _labels(spark, d).select("p_partkey", "label", F.col("category"))
    return lines.join(labels, "p_partkey").select("pub", F.concat(F.lit(" "), "label").alias("label"), "kind", F.when(F.col("pub") % 2 == 0, F.concat(F.lit("c"), (F.col("pub") % 5).cast("string"))).alias("category"))


def _tiers(spark: SparkSession) -> DataFrame:
    names = sorted({r.name for r in _KEYWORDS})
    return spark.createDataFrame([(n, 1 + k % 4) for k, n in enumerate(names) if k != 2], "discipline_id string, tier int")


_TIERS_SQL = "tiers AS (SELECT * FROM (VALUES " + ", ".join(f"('{n}', {1 + k % 4})" for k, n in enumerate(sorted({r.name for r in _KEYWORDS})) if k != 2) + ") AS v(discipline, tier))"
_KNOWN = "known AS (SELECT lower(label) AS l FROM labels WHERE p_partkey % 5 = 0)"

query("publication_senses", "", f"""WITH {_LABELS_SQL}, {_TIERS_SQL}, {_KNOWN},
  m AS (SELECT l_orderkey AS pub, lower(trim(label)) AS label, CASE WHEN l_returnflag = 'R' THEN 'author' ELSE 'plus' END AS kind, CASE WHEN l_orderkey % 2 = 0 THEN 'c' || (l_orderkey % 5) END AS category FROM lineitem JOIN labels ON l_partkey = p_partkey),
  g AS (SELECT label, count(DISTINCT pub) AS pubs, count(*) FILTER (kind = 'author') AS author, count(*) FILTER (kind = 'plus') AS plus, min_by(category, pub) FILTER (category IS NOT NULL) AS category,
        'wos:' || substr(replace(label, ' ', '_'), 1, 60) || '@WoS_publication#0' AS sense_id FROM m WHERE label <> '' GROUP BY label),
  u AS (SELECT * FROM g QUALIFY row_number() OVER (PARTITION BY sense_id ORDER BY label) = 1),
  {_sql_first(_KEYWORDS, 'u', 'sense_id', 'NULL', _KEYWORD_FIELDS)}
  SELECT sense_id, 'wos:' || label AS keyword_id, 'WoS_publication' AS source, label, category, name AS discipline, coalesce(tier, 4) AS resolution_tier, pubs, author, plus,
    array_to_string(list_filter([CASE WHEN author > 0 THEN 'author_keyword' END, CASE WHEN plus > 0 THEN 'keywords_plus' END, CASE WHEN pubs >= 10 THEN 'high_frequency' END, CASE WHEN label IN (SELECT l FROM known) THEN 'pillar_overlap' END], lambda x: x IS NOT NULL), ',') AS tags,
    round(least(0.95::DOUBLE, 0.5 + pubs / 100), 6) AS confidence FROM u JOIN found USING (sense_id) LEFT JOIN tiers ON discipline = name""")(
    lambda s, d: C.publication_senses(_mentions(s, d), _labels(s, d).where("p_partkey % 5 = 0").select(F.concat("p_partkey", F.lit("#0")).alias("sense_id"), "label"), _tiers(s)))

_CATEGORIES_SQL = ", ".join(f"({_quoted(c)}, {_quoted(n)})" for n, some in R.CATEGORIES for c in some)
query("category_sense_rows", "", f"""WITH {_LABELS_SQL}, {_TIERS_SQL}, cats AS (SELECT * FROM (VALUES {_CATEGORIES_SQL}) AS v(label, name)),
  p AS (SELECT DISTINCT p_partkey, trim(unnest([category, {_sql_pick(_CATEGORIES, 'p_partkey')}])) AS label FROM labels), g AS (SELECT label, count(*) AS pubs FROM p WHERE label <> '' GROUP BY 1),
  n AS (SELECT *, 'woscat:' || substr(replace(replace(lower(label), ',', ''), ' ', '_'), 1, 60) || '@WoS_category#0' AS sense_id FROM g QUALIFY row_number() OVER (PARTITION BY sense_id ORDER BY label) = 1)
  SELECT sense_id, 'woscat:' || label AS keyword_id, 'WoS_category' AS source, label, coalesce(name, 'math_physics') AS discipline, coalesce(tier, 4) AS resolution_tier, pubs, 0.9::DOUBLE AS confidence
  FROM n LEFT JOIN cats USING (label) LEFT JOIN tiers ON discipline = coalesce(name, 'math_physics')""")(
    lambda s, d: C.category_senses(_labels(s, d).withColumn("second", _pick(_CATEGORIES, "p_partkey")), "p_partkey", ["category", "second"], _tiers(s)))

_GROUPS = [(["category", "label"], "wosnlcat", "WoS_natlab_cat", 0.6, None), (["p_type"], "wosnlpub", "WoS_natlab_publisher", 0.5, 3), (["p_brand", "p_size"], "wosnldt", "WoS_natlab_doctype", 0.4, 4)]
query("field_sense_rows", "", f"""WITH {_LABELS_SQL}, {_TIERS_SQL}, {_KNOWN},
  v AS (SELECT 0 AS g, trim(unnest([category, label])) AS label FROM labels UNION SELECT 1, p_type FROM part UNION SELECT 2, unnest([p_brand, CAST(p_size AS VARCHAR)]) FROM part),
  f AS (SELECT DISTINCT g, label FROM v WHERE length(label) > 2 AND lower(label) NOT IN (SELECT l FROM known)),
  n AS (SELECT *, label AS category, CASE g WHEN 0 THEN 'wosnlcat:' || substr(replace(replace(lower(label), ',', ''), ' ', '_'), 1, 60) || '@WoS_natlab_cat#0' WHEN 1 THEN 'wosnlpub:' || substr(replace(lower(label), ' ', '_'), 1, 60) || '@WoS_natlab_publisher#0'
          ELSE 'wosnldt:' || substr(replace(lower(label), ' ', '_'), 1, 60) || '@WoS_natlab_doctype#0' END AS sense_id FROM f QUALIFY row_number() OVER (PARTITION BY sense_id ORDER BY label) = 1),
  {_sql_first(_KEYWORDS, 'n', 'sense_id', 'NULL', _KEYWORD_FIELDS)}
  SELECT sense_id, CASE g WHEN 0 THEN 'WoS_natlab_cat' WHEN 1 THEN 'WoS_natlab_publisher' ELSE 'WoS_natlab_doctype' END AS source, label, CASE g WHEN 0 THEN name ELSE 'policy_economics' END AS discipline,
    CASE g WHEN 0 THEN coalesce(tier, 4) WHEN 1 THEN 3 ELSE 4 END AS resolution_tier, CASE g WHEN 0 THEN 0.6 WHEN 1 THEN 0.5 ELSE 0.4 END::DOUBLE AS confidence FROM n JOIN found USING (sense_id) LEFT JOIN tiers ON discipline = name""")(
    lambda s, d: C.field_senses(_labels(s, d).join(t(s, d, "part").select("p_partkey", "p_type", "p_brand", F.col("p_size").cast("string").alias("p_size")), "p_partkey"), "p_partkey", _GROUPS,
                                _labels(s, d).where("p_partkey % 5 = 0").select(F.concat("p_partkey", F.lit("#0")).alias("sense_id"), "label"), _tiers(s)))

# Sub-categories: a third of the labels hold the words of one

_SUBS = R.sub_category_rules([("steel_parts", ["steel"])])
_SUB_TEXTS = [r.text for r in _SUBS]


def _sub_labels(s: SparkSession, d: str) -> DataFrame:
    return t(s, d, "part").select(F.col("p_partkey").alias("vec_id"), F.when(F.expr("p_partkey % 3 = 0"), F.concat(F.upper(_pick(_SUB_TEXTS, "p_partkey * 5")), F.lit(" "), "p_name")).otherwise(F.col("p_name")).alias("label"))


query("sub_categories", "", f"""WITH l AS (SELECT p_partkey AS vec_id, lower(CASE WHEN p_partkey % 3 = 0 THEN {_sql_pick(_SUB_TEXTS, 'p_partkey * 5')} || ' ' || p_name ELSE p_name END) AS label FROM part),
  {_sql_first(_SUBS, 'l', 'vec_id', 'NULL', {'label': 'label'})},
  e AS (SELECT vec_id, name, embedding::DOUBLE[] AS v FROM embeddings JOIN l USING (vec_id) LEFT JOIN found USING (vec_id)),
  m AS (SELECT name, list(m ORDER BY i) AS m FROM (SELECT name, i, avg(x) AS m FROM (SELECT name, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM e WHERE name IS NOT NULL) GROUP BY 1, 2) GROUP BY 1),
  c AS (SELECT vec_id, m.name, round(list_cosine_similarity(v, m), 6) AS cosine FROM e CROSS JOIN m WHERE e.name IS NULL)
  SELECT vec_id, name AS sub_category, 'pattern' AS strategy, CAST(NULL AS DOUBLE) AS cosine FROM found
  UNION ALL SELECT vec_id, name, 'centroid', cosine FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY cosine DESC, name) AS rn FROM c) WHERE rn = 1 AND cosine >= 0.1""")(
    lambda s, d: V.sub_categories(_sub_labels(s, d), t(s, d, "embeddings"), "vec_id", "embedding", _SUBS, 0.1))
