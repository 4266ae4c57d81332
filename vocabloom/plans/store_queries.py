"""Queries that write: stored tables replaced by source, a streamed harvest; and consensus of experts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vocabloom.functions.frame import scratch_path
from vocabloom.operators import consensus as E
from vocabloom.plans import standins as S
from vocabloom.plans.registry import query
from vocabloom.plans.standins import t
from vocabloom.sources import scans
from vocabloom.sources.store import KeywordTable
from vocabloom.streaming.batches import EdgeSink, harvest, reference_edges, works_stream

_SCHEMA = "id string, label string, parent_id string, source string, level int"
_LESS = "SELECT * FROM kw WHERE source <> 'catalog' UNION ALL SELECT * FROM kw WHERE source = 'catalog' AND level < 2"


def _stored(s: SparkSession, d: str) -> tuple[KeywordTable, DataFrame]:
    """A new stored table of all keywords, of which one source was then replaced; with the statistics of that."""
    table = KeywordTable(s, scratch_path(s, "keywords"), _SCHEMA)
    table.upsert(S.keywords(s, d))
    return table, table.upsert(S.keywords(s, d).where("source = 'catalog' AND level < 2"))


query("stored_upsert", "kw", _LESS)(lambda s, d: _stored(s, d)[0].rows())
query("stored_upsert_stats", "kw", """SELECT source, count(*) FILTER (level < 2) AS inserted, count(*) AS previous, count(*) FILTER (level < 2) - count(*) AS delta FROM kw WHERE source = 'catalog' GROUP BY 1""")(
    lambda s, d: _stored(s, d)[1])
query("stored_sources", "kw", f"SELECT source, count(*) AS n FROM ({_LESS}) GROUP BY 1")(lambda s, d: _stored(s, d)[0].stats())


def _harvested(s: SparkSession, d: str) -> DataFrame:
    """Citations of works that come as JSON files, a few a batch; every work comes twice."""
    folder = scratch_path(s, "works")
    works = S.cites(s, d).select(F.concat(F.lit("https://works/W"), "citing").alias("id"), F.array(F.concat(F.lit("https://works/W"), "cited")).alias("referenced_works"))
    works.union(works).repartition(6).write.json(folder)
    sink = EdgeSink(s, scratch_path(s, "edges"), "citing string, cited string", ["citing", "cited"])
    harvest(works_stream(s, folder, 2), reference_edges, sink, scratch_path(s, "harvest"))
    return sink.edges()


query("harvested_edges", "cites", "SELECT 'W' || citing AS citing, 'W' || cited AS cited FROM cites")(_harvested)


def _votes(s: SparkSession, d: str) -> DataFrame:
    """Five experts on the type of each part; the first two err seldom, the others often and towards one type."""
    k = F.col("p_partkey")
    wrong = F.when(F.col("p_type") == "PROMO", "ECONOMY").otherwise("PROMO")
    says = [F.when(F.pmod(F.xxhash64("p_partkey", F.lit(r)), F.lit(100)) < share, wrong).otherwise(F.col("p_type")) for r, share in enumerate((5, 8, 45, 45, 45))]
    each = F.explode(F.array(*(F.struct(F.lit(f"e{r}").alias("rater"), x.alias("label")) for r, x in enumerate(says))))
    return t(s, d, "part").select(k.alias("item"), each.alias("v")).select("item", "v.rater", "v.label")


query("expert_consensus")(lambda s, d: E.best_class(E.consensus(_votes(s, d), rounds=5)[0]))  # iterative; a test compares it with plain sums


# Files with a version in their first line


def _versioned(s: SparkSession, d: str) -> DataFrame:
    """Keyword files of two versions, written from the parts and read again, with the columns of their paths."""
    paths = []
    for version, size in (("23.7", 25), ("24.1", 26)):
        some = t(s, d, "part").where("p_size < 25" if size == 25 else "p_size >= 25")
        body = some.select(F.concat(F.lit('"'), F.concat_ws('","', "p_type", "p_brand", "p_name", F.col("p_partkey").cast("string")), F.lit('"')).alias("value"), (F.col("p_partkey") + 10).alias("at"))
        head = s.createDataFrame([(f'"Keyword Version: {version}","Revision: 1"', 1), ("Category,Topic,Term,UUID", 2)], "value string, at long")
        paths.append(scratch_path(s, "keyword-file"))
        head.union(body).coalesce(1).sortWithinPartitions("at").select("value").write.text(paths[-1])
    return scans.read_versioned_csv(s, paths)


query("versioned_keywords", "", """SELECT p_type AS "Category", p_brand AS "Topic", p_name AS "Term", CAST(p_partkey AS VARCHAR) AS "UUID", 'Keyword Version: ' || CASE WHEN p_size < 25 THEN '23.7' ELSE '24.1' END AS version FROM part""")(
    lambda s, d: _versioned(s, d).drop("file"))
