"""Helpers that the corpus operators share: scratch tables, ranks and word batches."""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vocabloom.functions.frame import scratch_path

BATCH_BYTES = 8 << 20
#: Spark's setting by which a query's shuffle files go at its end.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_PACKAGE_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def ship(spark: SparkSession) -> SparkSession:
    """Lets Python workers import this package where the cluster has not installed it, and keeps
    the Arrow batches that they get small, since a row may be a long text."""
    most = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(most) == "67108864b":  # Spark's own value; a session's setting stays
        spark.conf.set(most, f"{BATCH_BYTES}b")
    env = spark.sparkContext.environment
    paths = env.get("PYTHONPATH", "").split(":")
    if _PACKAGE_ROOT not in paths:
        env["PYTHONPATH"] = ":".join([_PACKAGE_ROOT, *filter(None, paths)])
    return spark


def filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    """The store that holds ``uri``, and the path in it; for tasks that write or read files themselves."""
    return pafs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (pafs.LocalFileSystem(), uri)


def staged(df: DataFrame, name: str) -> DataFrame:
    """Cuts lineage: writes to the shared folder and reads back, so that lost executors cost nothing. Shuffle files go when the table
    is written; else they would stay until the driver happens to collect its garbage."""
    path, conf = scratch_path(df.sparkSession, name), df.sparkSession.conf
    was = conf.get(CLEANUP)
    conf.set(CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        conf.set(CLEANUP, was)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def gapless(df: DataFrame, group: str, order: list, name: str, column: str = "slot") -> DataFrame:
    """Numbers the rows of each ``group`` from 0 in ``order``, without a task that holds a group.

    Rows are range-sorted over all tasks and staged with their place in the task; the counts
    of each (task, group) give the start of its run. That table has at most one row for each
    task and one more for each group, so it is small enough to broadcast.
    """
    placed = staged(
        df.repartitionByRange(F.col(group), *order)
        .sortWithinPartitions(F.col(group), *order)
        .withColumn("_task", F.spark_partition_id())
        .withColumn("_at", F.monotonically_increasing_id()),
        name,
    )
    runs = placed.groupBy("_task", F.col(group).alias("_group")).agg(
        F.min("_at").alias("_first"), F.count("*").alias("_rows")
    )
    before = Window.partitionBy("_group").orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    starts = runs.select(
        "_task", "_group", "_first", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start")
    ).withColumnRenamed("_task", "_task2")
    return placed.join(
        F.broadcast(starts), (F.col("_task") == F.col("_task2")) & F.col(group).eqNullSafe(F.col("_group"))
    ).withColumn(column, F.col("_at") - F.col("_first") + F.col("_start")).drop(
        "_task", "_task2", "_at", "_first", "_start", "_group"
    )


def text_slices(batch: pa.RecordBatch, column: str, max_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Cuts a batch into runs of rows with about ``max_bytes`` of text; a longer text is a run of its own."""
    if batch.num_rows == 0:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes.astype(np.int64))
    start = 0
    while start < batch.num_rows:
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + max_bytes, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions of ragged runs laid end to end: run k covers starts[k] .. starts[k]+lengths[k]-1."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    shift = np.repeat(starts - (np.cumsum(lengths) - lengths), lengths)
    return shift + np.arange(total, dtype=np.int64)


def unused(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it until ``df`` has no such column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def add_columns(batch: pa.RecordBatch, keep: list[str], **new: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [*(batch.column(c) for c in keep), *new.values()], names=[*keep, *new]
    )
