"""A stored keyword table: sources replaced one by one, with a commit that readers see whole or not at all.

The rows of a source lie in folders of their own, one for each time that it was replaced (``rows/source=.../batch=...``). A commit is one small row in ``log`` that names
the batch that now counts for a source, with its statistics; it is written after the rows, as one file of its own. Readers take for each source
the batch of its last commit. A write that fails leaves rows that no commit names: nothing changes, and a repeated write replaces them.
Old batches go with :meth:`KeywordTable.vacuum`.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

LOG = "source string, batch string, number long, inserted long, previous long, delta long"


class KeywordTable:
    """A table at ``path`` with the columns ``schema`` (among them the string ``source``); ``key`` is unique within a source's batch, or the write fails."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType | str, key: str | None = "id"):
        self.spark, self.path, self.key = spark, path.rstrip("/"), key
        self.schema = spark.createDataFrame([], schema).schema
        if "source" not in self.schema.names:
            raise ValueError("a stored table has a column source")

    def log(self) -> DataFrame:
        """Every commit: source, batch, number, inserted, previous and delta."""
        try:
            return self.spark.read.schema(LOG).parquet(f"{self.path}/log")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], LOG)

    def current(self) -> DataFrame:
        """The last commit of each source; the log has a row for each replacement of a source, not for each keyword."""
        last = Window.partitionBy("source").orderBy(F.desc("number"))
        return self.log().withColumn("_rn", F.row_number().over(last)).where("_rn = 1").drop("_rn")

    def rows(self, source: str | None = None) -> DataFrame:
        """The stored rows that count (of one source). Only the folders of their batches are read."""
        now = self.current() if source is None else self.current().where(F.col("source") == source)
        batches = [r["batch"] for r in now.where("inserted > 0").collect()]  # one for each source
        if not batches:
            return self.spark.createDataFrame([], self.schema)
        stored = T.StructType([*(f for f in self.schema if f.name != "source"), self.schema["source"], T.StructField("batch", T.StringType())])
        read = self.spark.read.schema(stored).option("basePath", f"{self.path}/rows").parquet(f"{self.path}/rows")
        return read.where(F.col("batch").isin(batches)).select(*self.schema.names)

    def upsert(self, records: DataFrame) -> DataFrame:
        """Replaces the sources that ``records`` has and returns their statistics (source, inserted, previous, delta); other sources stay.

        Missing columns are null, others are left out. Without rows nothing happens. A null source or a repeated key fails before anything is committed.
        """
        rows = records.select(*(F.col(f.name).cast(f.dataType).alias(f.name) if f.name in records.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in self.schema))
        if not rows.where("source IS NULL").isEmpty():
            raise ValueError("rows without a source")
        batch = uuid.uuid4().hex
        rows.withColumn("batch", F.concat(F.lit(f"{batch}-"), F.md5("source"))).repartition("source", F.pmod(F.xxhash64(*self.schema.names), F.lit(64))).write.partitionBy("source", "batch").option("compression", "zstd").mode("append").parquet(f"{self.path}/rows")
        return self._commit(batch)

    def _commit(self, batch: str) -> DataFrame:
        stored = T.StructType([*(f for f in self.schema if f.name != "source"), self.schema["source"], T.StructField("batch", T.StringType())])
        new = self.spark.read.schema(stored).parquet(f"{self.path}/rows").where(F.col("batch").startswith(batch))
        if self.key and not new.groupBy("source", self.key).count().where("count > 1").isEmpty():
            raise ValueError(f"a source has a {self.key} twice")
        counted = new.groupBy("source", "batch").agg(F.count("*").alias("inserted"))
        before = self.current().select("source", F.col("inserted").alias("previous"), F.col("number").alias("_last"))
        entry = counted.join(before, "source", "left").select(
            "source", "batch", (F.coalesce("_last", F.lit(0)) + 1).alias("number"), "inserted", F.coalesce("previous", F.lit(0)).alias("previous"),
            (F.col("inserted") - F.coalesce("previous", F.lit(0))).alias("delta"),
        )
        made = entry.collect()  # one for each source of the batch
        done = self.spark.createDataFrame(made, LOG)
        if made:
            done.coalesce(1).write.mode("append").parquet(f"{self.path}/log")  # one file: readers see the batch's sources together
        return done.drop("batch", "number")

    def replace_all(self, records: DataFrame) -> DataFrame:
        """Replaces the whole table; sources that ``records`` lacks are then empty. Without rows nothing happens."""
        old = self.current().select("source")
        done = self.upsert(records)
        if done.isEmpty():
            return done
        gone = self.current().join(old, "source", "left_semi").join(done.select("source"), "source", "left_anti").where("inserted > 0")
        empty = gone.select("source", F.lit(uuid.uuid4().hex).alias("batch"), (F.col("number") + 1).alias("number"), F.lit(0).cast("long").alias("inserted"), F.col("inserted").alias("previous"), (-F.col("inserted")).alias("delta"))
        entries = self.spark.createDataFrame(empty.collect(), LOG)
        entries.coalesce(1).write.mode("append").parquet(f"{self.path}/log")
        return done.unionByName(entries.drop("batch", "number"))

    def stats(self) -> DataFrame:
        """(source, n) of the rows that count, from the log alone."""
        return self.current().where("inserted > 0").select("source", F.col("inserted").alias("n"))

    def vacuum(self) -> int:
        """Removes the folders of batches that no longer count and returns their number."""
        counts = {r["batch"] for r in self.current().collect()}
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        root = jvm.org.apache.hadoop.fs.Path(f"{self.path}/rows")
        files, removed = root.getFileSystem(conf), 0
        for status in files.globStatus(jvm.org.apache.hadoop.fs.Path(f"{self.path}/rows/source=*/batch=*")) or []:
            if status.getPath().getName().removeprefix("batch=") not in counts:
                files.delete(status.getPath(), True)
                removed += 1
        return removed
