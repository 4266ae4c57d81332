"""Resumable batches: edges harvested from files as they come, each once, whatever breaks in between.

A Structured Streaming job reads what is new since its last checkpoint. Each batch inserts the edges that are not there yet under the batch's number, and a batch that is
run again after a failure replaces what it had written before, so no edge is lost and none is there twice.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vocabloom.operators.quality import insert_new_edges


class EdgeSink:
    """Edges at ``path``, unique in ``key``, in folders by the batch that brought them."""

    def __init__(self, spark: SparkSession, path: str, schema: str, key: list[str]):
        self.spark, self.path, self.key = spark, path.rstrip("/"), key
        self.schema = spark.createDataFrame([], schema).schema

    def edges(self, before: int | None = None) -> DataFrame:
        """The edges (of the batches ``before`` a number)."""
        try:
            stored = self.spark.read.schema(self.schema.add("batch", "long") if "batch" not in self.schema.names else self.schema).parquet(self.path)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], self.schema)
        return (stored if before is None else stored.where(F.col("batch") < before)).select(*[c for c in self.schema.names if c != "batch"])

    def insert(self, new: DataFrame, batch: int) -> None:
        """Writes the edges of ``new`` that no earlier batch has. The same batch written again replaces itself: its folder is overwritten, others stay."""
        names = [c for c in self.schema.names if c != "batch"]
        fresh = insert_new_edges(self.edges(batch), new.select(*names), self.key)
        fresh.write.mode("overwrite").parquet(f"{self.path}/batch={batch}")


def harvest(files: DataFrame, edges_of: Callable[[DataFrame], DataFrame], sink: EdgeSink, checkpoint: str) -> None:
    """Runs everything that is new in the stream ``files`` through ``edges_of`` into ``sink``, and ends when it has caught up.

    Run again with the same ``checkpoint`` it goes on after the last batch that was finished.
    """

    def take(batch: DataFrame, number: int) -> None:
        sink.insert(edges_of(batch), number)

    query = files.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def works_stream(spark: SparkSession, folder: str, files_per_batch: int = 100) -> DataFrame:
    """Works (id, referenced_works) from JSON-lines files that appear in ``folder``, so many files a batch."""
    return spark.readStream.schema("id string, referenced_works array<string>").option("maxFilesPerTrigger", files_per_batch).json(folder)


def reference_edges(works: DataFrame) -> DataFrame:
    """(citing, cited) of works; ids lose their address."""
    tail = lambda c: F.substring_index(c, "/", -1)
    return works.where("id IS NOT NULL").select(tail(F.col("id")).alias("citing"), F.explode("referenced_works").alias("_r")).select("citing", tail(F.col("_r")).alias("cited")).where("cited <> ''").distinct()
