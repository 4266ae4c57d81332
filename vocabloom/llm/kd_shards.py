"""Sharding by a k-d tree over document metadata.

Documents with equal texts are one group and stay together. Every group has integer
coordinates (text size, source, language, age by document id) and a weight in bytes. Each
tree node splits its groups at the weighted median, or at the fraction that its number of leaves asks for,
along its widest dimension; ties along a dimension are split by the hash of the text, so shards come out even
however coarse the metadata is, and a group is never split. All nodes of a level that have more than
NODE_GROUPS groups are split at once: groups are range-sorted by node and coordinate, tasks add up the weights before each
group, and one start for each task and node makes them the node's. A node of fewer groups goes through the same
splits in one task. A group carries its node, so no tree is kept anywhere, and thousands of leaves cost a few levels
more; the driver sees one row for each node that is split, or task. Groups that outweigh a fair share get shards of
their own first (there are fewer of them than shards), and the tree divides the rest.

The law is ``bytes``: shard sizes are near equal (as near as the largest groups allow).

Defined results: a null text has size 8 and the CRC of the empty text, and is in one group with the
empty text. Null metadata is a value of its own. Rows that repeat a doc_id stay rows. An empty table gives no rows.
With more shards than groups some shards are empty. Only ``doc_id``, ``text``, ``source`` and ``lang`` are read; the
last two may be missing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vocabloom.llm._common import gapless, ship, staged, table

COORD_BITS, TIE_BITS = 20, 40
DIMENSIONS = ("d_size", "d_source", "d_lang", "d_age")
TEXT_KEY = ("size", "text_crc32", "text_hash")
#: Groups up to which one task finishes a node (some 100 bytes each).
NODE_GROUPS = 65_536
#: Groups of a shard of their own (some 40 bytes each) up to which their table is broadcast.
MOST_BROADCAST = 100_000


def _before(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds to each group the weight of its node's groups before it in its task."""
    node, total = None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        first, weight = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("first", "weight"))
        starts = np.flatnonzero(np.concatenate([[True], first[1:] != first[:-1]]))
        upto = np.cumsum(weight) - weight
        shift = -upto[starts]
        if first[0] == node:
            shift[0] += total
        before = upto + np.repeat(shift, np.diff(np.concatenate([starts, [len(first)]])))
        node, total = first[-1], int(before[-1] + weight[-1])
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(before)], names=[*batch.schema.names, "before"])


def _columns(batch: pa.RecordBatch, *names: str) -> list[np.ndarray]:
    return [batch.column(c).to_numpy(zero_copy_only=False) for c in names]


def _keyed(groups: DataFrame, nodes: list) -> DataFrame:
    """Adds the weight of a group's node, if that is one of ``nodes``, and the group's place along the node's widest dimension."""
    nodes = sorted((r["first"], r["weight"], int(np.argmax(r["spans"]))) for r in nodes)
    node, node_weight, dim = (np.array(c, np.int64) for c in zip(*nodes))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first, tie, *coordinates = _columns(batch, "first", "tie", *DIMENSIONS)
            at = np.minimum(np.searchsorted(node, first), len(node) - 1)
            split = node[at] == first
            along = np.choose(np.where(split, dim[at], 0), coordinates)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(node_weight[at], mask=~split), pa.array(along << TIE_BITS | tie)], names=[*batch.schema.names, "node_weight", "place"]
            )

    return groups.mapInArrow(each, T.StructType([*groups.schema.fields, T.StructField("node_weight", T.LongType()), T.StructField("place", T.LongType())]))


def _split_level(groups: DataFrame, nodes: list) -> DataFrame:
    """``groups`` with the nodes (first leaf and number of leaves) of the next level; ``nodes`` are the ones to split."""
    order = ["first", "place", *TEXT_KEY]
    placed = _keyed(groups, nodes).repartitionByRange(*order).sortWithinPartitions(*order).withColumn("task", F.spark_partition_id().cast("long"))
    summed = staged(placed.mapInArrow(_before, T.StructType([*placed.schema.fields, T.StructField("before", T.LongType())])), "shard-level")
    sums = sorted(summed.groupBy("first", "task").agg(F.sum("weight").alias("sum")).collect())
    upto: dict[int, int] = {}
    start = []
    for r in sums:
        start.append(upto.get(r["first"], 0))
        upto[r["first"]] = start[-1] + r["sum"]
    # A run is the part of a node in a task; there are at most as many as tasks and nodes together.
    run, start = np.array([r["first"] << 32 | r["task"] for r in sums], np.int64), np.array(start, np.int64)
    names = groups.columns

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first, leaves, task, before, weight = _columns(batch, "first", "leaves", "task", "before", "weight")
            total = batch.column("node_weight")
            split, half = total.is_valid().to_numpy(zero_copy_only=False), leaves // 2
            middle = start[np.searchsorted(run, first << 32 | task)] + before + weight / 2
            left = middle <= total.fill_null(0).to_numpy(zero_copy_only=False) * half / leaves
            moved = {
                "first": np.where(split & ~left, first + half, first), "leaves": np.where(split, np.where(left, half, leaves - half), leaves)
            }
            yield pa.RecordBatch.from_arrays([pa.array(moved[c]) if c in moved else batch.column(c) for c in names], names=names)

    return summed.mapInArrow(route, groups.schema)


def _finish(pdf: pd.DataFrame) -> pd.DataFrame:
    """The leaves of one node, which has at most :data:`NODE_GROUPS` groups."""
    weight, tie = pdf["weight"].to_numpy(), pdf["tie"].to_numpy()
    coordinates = [pdf[d].to_numpy() for d in DIMENSIONS]
    key = [pdf[c].to_numpy() for c in reversed(TEXT_KEY)]
    leaf = np.zeros(len(pdf), np.int64)
    todo = [(np.arange(len(pdf)), int(pdf["first"].iloc[0]), int(pdf["leaves"].iloc[0]))]
    while todo:
        rows, first, leaves = todo.pop()
        if leaves == 1 or not len(rows):
            leaf[rows] = first
            continue
        along = coordinates[int(np.argmax([np.ptp(c[rows]) for c in coordinates]))]
        rows = rows[np.lexsort([*(k[rows] for k in key), along[rows] << TIE_BITS | tie[rows]])]
        w, half = weight[rows], leaves // 2
        left = np.cumsum(w) - w + w / 2 <= w.sum() * half / leaves
        todo += [(rows[left], first, half), (rows[~left], first + half, leaves - half)]
    return pdf[list(TEXT_KEY)].assign(first=leaf)


def assign(groups: DataFrame, shards: int, node_groups: int | None = None) -> DataFrame:
    """``groups`` (from :func:`text_groups`) with the number of their shard."""
    spark, node_groups = ship(groups.sparkSession), node_groups or NODE_GROUPS
    total = groups.agg(F.sum("weight")).first()[0] or 0
    # Fewer groups than shards can weigh more than a fair share.
    large = groups.where(F.col("weight") * shards > total).orderBy(F.desc("weight"), *TEXT_KEY).limit(shards).select(*TEXT_KEY, "weight").collect()
    alone = []
    for r in large:
        if shards - len(alone) < 2 or r["weight"] * (shards - len(alone)) <= total:
            break
        alone.append(r)
        total -= r["weight"]
    leaves = shards - len(alone)
    own = spark.createDataFrame([(*(r[c] for c in TEXT_KEY), i) for i, r in enumerate(alone)], "size long, text_crc32 long, text_hash long, first long")
    rest = groups.join(F.broadcast(own) if len(alone) <= MOST_BROADCAST else own, list(TEXT_KEY), "left_anti") if alone else groups
    rest = rest.withColumn("first", F.lit(len(alone)).cast("long")).withColumn("leaves", F.lit(leaves).cast("long"))
    while leaves > 1:
        nodes = rest.where("leaves > 1").groupBy("first").agg(
            F.count("*").alias("n"), F.sum("weight").alias("weight"), F.array(*(F.max(d) - F.min(d) for d in DIMENSIONS)).alias("spans")
        ).where(F.col("n") > node_groups).collect()
        if not nodes:
            break
        rest = _split_level(rest, nodes)
    whole = rest.where("leaves = 1").select(*TEXT_KEY, "first").unionByName(
        rest.where("leaves > 1").groupBy("first").applyInPandas(_finish, "size long, text_crc32 long, text_hash long, first long")
    )
    return (whole.unionByName(own) if alone else whole).select(*TEXT_KEY, F.col("first").cast("int").alias("shard"))


def _rows(docs: DataFrame) -> DataFrame:
    has = set(docs.columns)
    text = F.col("text").cast("string")
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 8).cast("long").alias("size"),
        F.crc32(F.encode(F.coalesce(text, F.lit("")), "utf-8")).alias("text_crc32"),
        F.xxhash64(F.coalesce(text, F.lit(""))).alias("text_hash"),
        *((F.col(c).cast("string") if c in has else F.lit(None).cast("string")).alias(c) for c in ("source", "lang")),
    )


def text_groups(rows: DataFrame) -> DataFrame:
    """Weight, coordinates and tie-breaking hash of each different text of ``rows``."""
    merged = rows.groupBy(*TEXT_KEY).agg(
        F.sum("size").alias("weight"), F.min("doc_id").alias("first_id"), F.min("source").alias("source"), F.min("lang").alias("lang")
    )
    ids = rows.agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).first()
    top, base = (1 << COORD_BITS) - 1, ids["lo"] or 0
    span = max(1, (ids["hi"] or 0) - base)

    def hashed(name: str) -> Column:
        return F.pmod(F.xxhash64(name), F.lit(top)).cast("long")

    return merged.select(
        *TEXT_KEY, "weight",
        F.least(F.lit(top), F.floor(F.log2(F.col("size").cast("double")) / 40 * top)).cast("long").alias("d_size"),
        hashed("source").alias("d_source"), hashed("lang").alias("d_lang"),
        F.coalesce(F.floor((F.col("first_id") - base).cast("double") / span * top), F.lit(0)).cast("long").alias("d_age"),
        F.shiftrightunsigned(F.xxhash64("text_hash", "text_crc32"), 64 - TIE_BITS).alias("tie"),
    )


def shard(docs: DataFrame, shards: int | None = None, target_bytes: int | None = None) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard for every row.

    Give the number of shards, or the bytes that a shard should have.
    """
    rows = staged(_rows(docs), "shard-rows")
    groups = staged(text_groups(rows), "shard-groups")
    if shards is None:
        total = groups.agg(F.sum("weight")).first()[0] or 0
        shards = max(1, -(-total // (target_bytes or 1 << 30)))
    placed = rows.join(assign(groups, shards), list(TEXT_KEY)).select("doc_id", "size", "text_crc32", "shard")
    return gapless(placed, "shard", [F.asc("doc_id"), F.asc("text_crc32")], "shard-slots").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op7_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(table(spark, sf_dir, "documents"), shards=24)
