"""Exact deduplication against a persistent digest index.

The index is a folder with a Parquet table, bucketed and sorted by digest, and the number of its
buckets, which whoever opens the index later takes from there. A batch of new documents is
reduced to its digest groups, sort-merge anti-joined with the index, and what is new is
appended, so a later batch never reshuffles what is already indexed.

A digest with more than a :data:`HEAVY`-th of a batch's rows is heavy; there are fewer than HEAVY of them,
so their index rows are broadcast, and no task gets such a group. All other rows are sort-merge joined.

Defined results: a null text counts as empty, and all texts without a visible character are
one group. Rows that repeat a doc_id stay separate rows; of rows that tie in length and
doc_id exactly one is kept. A null doc_id loses every tie. An empty batch returns no rows.
The first batch with a text settles its group for good: rows of later batches are never kept, however
long their text, and report the keep_id and the group_size of that first batch.
Only ``doc_id`` and ``text`` are read, so other columns and their names do not matter.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vocabloom.llm._common import scratch_path, staged, table, unused

BLANKS = " \t\n\x0b\x0c\r"
#: Stands for a null doc_id in joins.
NO_ID = -(2**63)
HEAVY = 1000


def _whole(docs: DataFrame) -> Column:
    return F.coalesce(docs["text"].cast("string"), F.lit(""))


def text_digest(text: Column) -> Column:
    """Digest of a text without its white space."""
    return F.sha2(F.translate(text, BLANKS, ""), 256)


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, digest of the text without white space, code points of the original text."""
    text = _whole(docs)
    return docs.select(
        docs["doc_id"].cast("long").alias("doc_id"), text_digest(text).alias("digest"), F.char_length(text).cast("long").alias("chars")
    )


class DigestIndex:
    """A digest index at ``path``; opening an existing path continues it with its own number of buckets."""

    def __init__(self, spark: SparkSession, path: str, buckets: int | None = None):
        self.spark, self.path = spark, path
        meta = f"{path}/meta"
        try:
            stored = spark.read.schema("buckets int").parquet(meta).first()["buckets"]
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            stored = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
            spark.range(1).select(F.lit(stored).alias("buckets")).coalesce(1).write.parquet(meta)
        if buckets not in (None, stored):
            raise ValueError(f"the index at {path} has {stored} buckets, not {buckets}")
        self.buckets = stored
        self.name = "digest_index_" + hashlib.md5(path.encode()).hexdigest()
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name} "
            "(digest STRING, keep_id BIGINT, keep_chars BIGINT, group_size BIGINT, batch STRING) "
            f"USING parquet CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS "
            f"LOCATION '{path}/rows'"
        )

    def rows(self) -> DataFrame:
        return self.spark.table(self.name)

    def add(self, groups: DataFrame, batch: str) -> None:
        """Appends those of ``groups`` (from :func:`digest_groups`) whose digest is not indexed yet.

        Adding a batch again, after a failure, changes nothing.
        """
        fresh = groups.join(self.rows().select("digest").hint("merge"), "digest", "left_anti").select(
            "digest", "keep_id", "keep_chars", "group_size", F.lit(batch).alias("batch")
        )
        staged(fresh, "digest-new").repartition(self.buckets, "digest").write.insertInto(self.name)
        self.spark.catalog.refreshTable(self.name)

    def decide(self, rows: DataFrame, groups: DataFrame, batch: str) -> DataFrame:
        """One row per row: keep_id, group_size and kept; kept is true for the first row of a group of this batch."""
        counted = rows.groupBy("digest", "doc_id", "chars").agg(F.count("*").alias("copies"))
        known = self.rows().withColumnRenamed("batch", "from_batch")
        total = groups.agg(F.sum("group_size")).first()[0] or 0
        heavy = F.broadcast(groups.where(F.col("group_size") * HEAVY > total).select("digest"))
        joined = counted.join(heavy, "digest", "left_anti").join(known.hint("merge"), "digest").unionByName(
            counted.join(F.broadcast(known.join(heavy, "digest")), "digest")
        )
        is_best = (
            F.col("doc_id").eqNullSafe(F.col("keep_id"))
            & (F.col("chars") == F.col("keep_chars"))
            & (F.col("from_batch") == batch)
        )
        return joined.select(
            "doc_id", "keep_id", "group_size", "chars", is_best.alias("best"), "digest",
            F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy"),
        ).select(
            "doc_id", "keep_id", "group_size", (F.col("best") & (F.col("copy") == 1)).alias("kept"),
            F.col("digest").alias("text_sha256"),
        )


def digest_groups(rows: DataFrame) -> DataFrame:
    """digest, group_size, keep_id and keep_chars of each digest of ``rows`` (from :func:`digests`).

    Counting is combined before the shuffle, so a group of copies of any size costs one row for each task.
    """
    best = F.max(F.struct("chars", F.bitwise_not("doc_id").alias("back")))  # the complement falls as the id grows, without an overflow
    return rows.groupBy("digest").agg(best.alias("best"), F.count("*").alias("group_size")).select(
        "digest", "group_size", F.bitwise_not("best.back").alias("keep_id"), F.col("best.chars").alias("keep_chars")
    )


def exact_dedup(docs: DataFrame, index: DigestIndex | None = None, batch: str | None = None) -> DataFrame:
    """Adds ``docs`` to ``index`` (a new one if none is given) and returns one decision per row.

    With an index of one's own the batch needs a name that no other batch has; a batch that is
    repeated under its name gets its decisions again.
    """
    spark = docs.sparkSession
    if index and not batch:
        raise ValueError("a batch that continues an index needs a name")
    index, batch = index or DigestIndex(spark, scratch_path(spark, "digest-index")), batch or uuid.uuid4().hex
    rows = staged(digests(docs), "digests")
    groups = staged(digest_groups(rows), "digest-groups")
    index.add(groups, batch)
    return index.decide(rows, groups, batch)


def keep_first_copies(docs: DataFrame) -> DataFrame:
    """The documents without the exact copies; all columns stay.

    Of the rows that share the kept row's doc_id and digest (repeated rows, also those without an id) the longest stays.
    """
    names = [unused(docs, n) for n in ("_own_key", "_own_digest", "_own_copy")]
    key, digest, copy = names
    kept_key, kept_digest = unused(docs, "_kept_key"), unused(docs, "_kept_digest")
    kept = exact_dedup(docs).where("kept").select(F.coalesce("doc_id", F.lit(NO_ID)).alias(kept_key), F.col("text_sha256").alias(kept_digest))
    text = _whole(docs)
    keyed = docs.withColumn(key, F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID))).withColumn(
        digest, text_digest(text)
    )
    order = [F.desc(F.char_length(text)), F.xxhash64(text)]
    return (
        keyed.join(kept.hint("merge"), (keyed[key] == F.col(kept_key)) & (keyed[digest] == F.col(kept_digest)), "left_semi")
        .withColumn(copy, F.row_number().over(Window.partitionBy(key, digest).orderBy(*order)))
        .where(F.col(copy) == 1)
        .select(*docs.columns)
    )


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


OP10_SQL = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents),
g AS (
  SELECT *, first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n DESC, doc_id) AS keep_id,
         count(*) OVER (PARTITION BY text_sha256) AS group_size FROM d)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM g
"""
