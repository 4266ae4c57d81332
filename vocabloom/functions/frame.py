"""Small helpers for operators: lineage cuts, average ranks, first rows of groups."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_own_dirs: dict[str, str] = {}
_PACKAGE_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def with_package(spark: SparkSession) -> SparkSession:
    """Lets Python workers import this package where the cluster has not installed it."""
    env = spark.sparkContext.environment
    paths = env.get("PYTHONPATH", "").split(":")
    if _PACKAGE_ROOT not in paths:
        env["PYTHONPATH"] = ":".join([_PACKAGE_ROOT, *filter(None, paths)])
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``; on one machine without it, a new temporary folder."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("a cluster needs spark.checkpoint.dir, a folder that all of its machines share")
    app = spark.sparkContext.applicationId
    if app not in _own_dirs:
        _own_dirs[app] = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    return _own_dirs[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """Writes ``df`` to the checkpoint folder, so that a loop's plan stays short and survives lost executors."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint()


def written(df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` as a table to the shared folder and reads it back. A loop's table then has no past: a checkpoint keeps what is known
    about its columns, and that knowledge grows with every round."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def first_by(df: DataFrame, keys: list, order: list) -> DataFrame:
    """The first row of each group in ``order``."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def top_by(df: DataFrame, keys: list, order: list, n: int, name: str = "rank") -> DataFrame:
    """The first ``n`` rows of each group in ``order``, with their place."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(name, F.row_number().over(w)).where(F.col(name) <= n)


def sum_before(df: DataFrame, order: list[str], value: str, name: str = "before") -> DataFrame:
    """Adds the sum of ``value`` over all earlier rows in ``order``, without a task that has all rows: tasks add up their own
    range, and one start for each task is broadcast."""
    placed = checkpointed(df.repartitionByRange(*order).withColumn("_task", F.spark_partition_id()))
    own = Window.partitionBy("_task").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)  # one row a task
    starts = placed.groupBy(F.col("_task").alias("_at")).agg(F.sum(value).alias("_sum")).select("_at", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_start"))
    summed = placed.withColumn("_own", F.coalesce(F.sum(value).over(own), F.lit(0)))
    return summed.join(F.broadcast(starts), F.col("_task") == F.col("_at")).withColumn(name, F.col("_start") + F.col("_own")).drop("_task", "_at", "_start", "_own")


def average_ranks(df: DataFrame, group: str, value: str, name: str) -> DataFrame:
    """``df`` with the rank of ``value`` within ``group`` (a few different ones), ties sharing their mean rank.

    Only different values are ranked, over all tasks.
    """
    counts = sum_before(df.groupBy(group, value).agg(F.count("*").alias("_t")), [group, value], "_t")
    first = counts.groupBy(F.col(group).alias("_g")).agg(F.min("before").alias("_first"))
    ranks = counts.join(F.broadcast(first), F.col(group).eqNullSafe(F.col("_g"))).select(
        F.col(group).alias("_g"), F.col(value).alias("_v"), (F.col("before") - F.col("_first") + (F.col("_t") + 1) / 2.0).alias(name)
    )
    return df.join(ranks, F.col(group).eqNullSafe(F.col("_g")) & F.col(value).eqNullSafe(F.col("_v"))).drop("_g", "_v")
