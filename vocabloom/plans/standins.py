"""Keyword, sense, publication and citation tables derived from the driver's star schema.

Each function returns a DataFrame; :data:`SQL` has the same derivations as DuckDB CTEs, so that an
oracle can start from them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def senses(spark: SparkSession, d: str) -> DataFrame:
    """A sense per part: label p_name, source p_brand, discipline p_type."""
    key = F.col("p_partkey").cast("string")
    return t(spark, d, "part").select(
        F.concat(key, F.lit("@"), F.replace("p_brand", F.lit(" "), F.lit("_")), F.lit("#0")).alias("sense_id"),
        key.alias("keyword_id"), F.col("p_name").alias("label"), F.col("p_brand").alias("source"), F.col("p_type").alias("discipline"),
        F.round((F.col("p_retailprice") - 900) / 100, 5).alias("confidence"),
        F.when(F.col("p_size") % 10 != 0, F.col("p_size") % 7).alias("level"), (1 + F.col("p_size") % 4).alias("tier"),
    )


def lens_senses(spark: SparkSession, d: str) -> DataFrame:
    """Senses with secondary disciplines and tags."""
    size, own = F.col("p_size"), F.col("p_type")
    more = t(spark, d, "part").select(
        F.col("p_partkey").cast("string").alias("keyword_id"),
        F.when((size % 3 == 0) & (own != "PROMO"), F.array(F.lit("PROMO"))).when((size % 5 == 0) & (own != "ECONOMY"), F.array(F.lit("ECONOMY"), F.lit("LARGE")))
        .otherwise(F.array().cast("array<string>")).alias("secondary"),
        F.concat(
            F.when(size % 2 == 0, F.array(F.concat(F.lit("abstract_freq:"), size.cast("string")))).otherwise(F.array().cast("array<string>")),
            F.when(size % 7 == 0, F.array(F.lit("title_freq:3"), F.lit("pub_freq:2"))).otherwise(F.array().cast("array<string>")),
        ).alias("tags"),
    )
    return senses(spark, d).join(more, "keyword_id")


def fine_senses(spark: SparkSession, d: str) -> DataFrame:
    return senses(spark, d).withColumn("label", F.concat_ws(" ", "label", "source"))


def keywords(spark: SparkSession, d: str) -> DataFrame:
    """Two forests: regions down to customers and suppliers, and part types down to parts."""
    s = F.lit
    def rows(df, id_, label, parent, source, level):
        return df.select(id_.alias("id"), label.alias("label"), parent.cast("string").alias("parent_id"), s(source).alias("source"), s(level).alias("level"))

    def key(p, c):
        return F.concat(s(p), F.col(c).cast("string"))

    part = t(spark, d, "part")
    brand = F.concat(s("B:"), F.col("p_type"), s("/"), F.col("p_brand"))
    return reduce(DataFrame.union, [
        rows(t(spark, d, "region"), key("R", "r_regionkey"), F.col("r_name"), s(None), "geo", 0),
        rows(t(spark, d, "nation"), key("N", "n_nationkey"), F.col("n_name"), key("R", "n_regionkey"), "geo", 1),
        rows(t(spark, d, "customer"), key("C", "c_custkey"), F.col("c_name"), key("N", "c_nationkey"), "geo", 2),
        rows(t(spark, d, "supplier"), key("S", "s_suppkey"), F.col("s_name"), key("N", "s_nationkey"), "geo", 2),
        rows(part.select("p_type").distinct(), key("T:", "p_type"), F.col("p_type"), s(None), "catalog", 0),
        rows(part.select("p_type", "p_brand").distinct(), brand, F.col("p_brand"), key("T:", "p_type"), "catalog", 1),
        rows(part, key("P", "p_partkey"), F.col("p_name"), brand, "catalog", 2),
    ])


def pub_keywords(spark: SparkSession, d: str) -> DataFrame:
    part = t(spark, d, "part").select("p_partkey", F.concat_ws(" ", "p_name", "p_brand").alias("label"))
    return t(spark, d, "lineitem").join(part, F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("l_orderkey").alias("pub"), "label", (F.col("l_quantity") / 50).alias("relevance"), F.col("l_returnflag").alias("kind")
    )


def pubs(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "orders").select(
        F.col("o_orderkey").alias("pub"), F.year("o_orderdate").alias("year"), F.floor(F.col("o_totalprice") / 1000).alias("cited_by"),
        F.concat(F.lit("J"), (F.col("o_custkey") % 50).cast("string")).alias("journal"), F.col("o_orderpriority").alias("category"), F.col("o_orderstatus").alias("status"),
    )


def cites(spark: SparkSession, d: str) -> DataFrame:
    """An order cites the one before it of the same customer."""
    w = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    return t(spark, d, "orders").select(F.col("o_orderkey").alias("citing"), F.lag("o_orderkey").over(w).alias("cited")).where("cited IS NOT NULL")


def rels(spark: SparkSession, d: str) -> DataFrame:
    """Each sense is linked to the next one of its label."""
    w = Window.partitionBy("label").orderBy("sense_id")
    s = senses(spark, d).select("sense_id", "discipline", F.lead("sense_id").over(w).alias("n"), F.lead("discipline").over(w).alias("nd"), F.lead("confidence").over(w).alias("nc")).where("n IS NOT NULL")
    return s.select(
        F.col("sense_id").alias("source_sense_id"), F.col("n").alias("target_sense_id"),
        F.when(F.col("discipline") == F.col("nd"), "equivalent_sense").otherwise("cross_domain_bridge").alias("relationship_type"), F.col("nc").alias("confidence"),
    )


def disciplines(spark: SparkSession, d: str) -> DataFrame:
    """The part types with a tier each."""
    return t(spark, d, "part").groupBy(F.col("p_type").alias("discipline_id")).agg((1 + F.min("p_size") % 4 + F.length("p_type") % 3).cast("int").alias("tier"))


SQL = {
    "senses": """senses AS (
      SELECT CAST(p_partkey AS VARCHAR) || '@' || replace(p_brand, ' ', '_') || '#0' AS sense_id,
             CAST(p_partkey AS VARCHAR) AS keyword_id, p_name AS label, p_brand AS source, p_type AS discipline,
             round((p_retailprice - 900) / 100, 5) AS confidence,
             CASE WHEN p_size % 10 <> 0 THEN p_size % 7 END AS level, 1 + p_size % 4 AS tier
      FROM part)""",
    "lsenses": """lsenses AS (
      SELECT s.*, CASE WHEN p_size % 3 = 0 AND p_type <> 'PROMO' THEN ['PROMO'] WHEN p_size % 5 = 0 AND p_type <> 'ECONOMY' THEN ['ECONOMY', 'LARGE'] ELSE [] END AS secondary,
             p_size % 2 = 0 AS in_abstracts, p_size % 7 = 0 AS in_titles FROM senses s JOIN part ON CAST(p_partkey AS VARCHAR) = keyword_id)""",
    "fine": "fine AS (SELECT * REPLACE (label || ' ' || source AS label) FROM senses)",
    "kw": """kw AS (
      SELECT 'R' || r_regionkey AS id, r_name AS label, CAST(NULL AS VARCHAR) AS parent_id, 'geo' AS source, 0 AS level FROM region
      UNION ALL SELECT 'N' || n_nationkey, n_name, 'R' || n_regionkey, 'geo', 1 FROM nation
      UNION ALL SELECT 'C' || c_custkey, c_name, 'N' || c_nationkey, 'geo', 2 FROM customer
      UNION ALL SELECT 'S' || s_suppkey, s_name, 'N' || s_nationkey, 'geo', 2 FROM supplier
      UNION ALL SELECT DISTINCT 'T:' || p_type, p_type, NULL, 'catalog', 0 FROM part
      UNION ALL SELECT DISTINCT 'B:' || p_type || '/' || p_brand, p_brand, 'T:' || p_type, 'catalog', 1 FROM part
      UNION ALL SELECT 'P' || p_partkey, p_name, 'B:' || p_type || '/' || p_brand, 'catalog', 2 FROM part)""",
    "closure": """closure AS (
      SELECT id, parent_id AS ancestor, 1 AS hops FROM kw WHERE parent_id IS NOT NULL
      UNION ALL SELECT c.id, k.parent_id, c.hops + 1 FROM closure c JOIN kw k ON k.id = c.ancestor WHERE k.parent_id IS NOT NULL)""",
    "pubkw": """pubkw AS (
      SELECT l_orderkey AS pub, p_name || ' ' || p_brand AS label, l_quantity / 50 AS relevance, l_returnflag AS kind
      FROM lineitem JOIN part ON l_partkey = p_partkey)""",
    "pubs": """pubs AS (
      SELECT o_orderkey AS pub, year(o_orderdate) AS year, CAST(floor(o_totalprice / 1000) AS BIGINT) AS cited_by,
             'J' || (o_custkey % 50) AS journal, o_orderpriority AS category, o_orderstatus AS status FROM orders)""",
    "cites": """cites AS (
      SELECT * FROM (SELECT o_orderkey AS citing, lag(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS cited FROM orders)
      WHERE cited IS NOT NULL)""",
    "rels": """rels AS (
      SELECT sense_id AS source_sense_id, n AS target_sense_id,
             CASE WHEN discipline = nd THEN 'equivalent_sense' ELSE 'cross_domain_bridge' END AS relationship_type, nc AS confidence
      FROM (SELECT sense_id, discipline, lead(sense_id) OVER w AS n, lead(discipline) OVER w AS nd, lead(confidence) OVER w AS nc
            FROM senses WINDOW w AS (PARTITION BY label ORDER BY sense_id)) WHERE n IS NOT NULL)""",
    "disc": """disc AS (
      SELECT p_type AS discipline_id, CAST(1 + min(p_size) % 4 + length(p_type) % 3 AS INT) AS tier FROM part GROUP BY 1)""",
}


def with_ctes(names: str, body: str) -> str:
    return "WITH RECURSIVE " + ",\n".join(SQL[n] for n in names.split()) + "\n" + body
