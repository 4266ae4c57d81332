"""The corpus pipeline: what is kept of ``documents``, and how it is packed.

Every stage takes (spark, docs, sf_dir) and works on all that the stage before it kept; the first
four return the columns of documents. :func:`run` writes each stage to the shared folder
and reads it again, as a driver of the stages would.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vocabloom.llm._common import staged, table
from vocabloom.llm.curve_packing import pack
from vocabloom.llm.exact_dedup import keep_first_copies
from vocabloom.llm.language_id import keep_identified
from vocabloom.llm.simhash_neardup import keep_one_of_each
from vocabloom.llm.toxicity import keep_civil


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in no identified language (null, or without a letter) go."""
    return keep_identified(docs)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted to be toxic go; the labels are those of ``sf_dir``."""
    return keep_civil(docs, table(spark, sf_dir, "labels"))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the longest original, then the smallest doc_id, stays."""
    return keep_first_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near copies the smallest doc_id stays."""
    return keep_one_of_each(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences."""
    return pack(docs)


STAGES = [
    ("language_id", identify_language),
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_exact_copies),
    ("simhash_neardup", drop_near_copies),
    ("packing", pack_sequences),
]

#: The models and the tokenizer cannot be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = staged(docs, f"stage-{name}")
    return docs
