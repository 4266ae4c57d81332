"""Parquet as an exchange format for keywords."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def export_parquet(keywords: DataFrame, folder: str, source: str | None = None) -> str:
    """Writes the keywords (of one source) below ``folder`` and returns where."""
    path = f"{folder}/{source or 'all_keywords'}.parquet"
    (keywords if source is None else keywords.where(F.col("source") == source)).write.mode("overwrite").option("compression", "snappy").parquet(path)
    return path


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
