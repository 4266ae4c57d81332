"""Document fingerprints: SimHash with Spark functions only, and permuted block tables to search them.

A term is a run of up to three words (shorter runs at the end of a text, so that any text
with a word has a term); its weight is its number of occurrences. Each occurrence votes with
the 64 bits of its hash; bit j of the fingerprint is 1 if more than half the votes have it.
Votes are counted two bits to a long (32 sums, each lane up to 2^32 occurrences), so the
whole count is one hash aggregation that combines before its shuffle.

Defined results: a null text counts as empty; a text without a word has fingerprint zero. Rows
that repeat doc_id and text are rows of the result each, and one document in the order of
documents; rows that share only the doc_id are ordered by their text's hash. A null doc_id
comes last. Empty tables give no rows. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vocabloom.llm._common import gapless, staged, table

LANES = 0x0000000100000001
NO_ID = -(2**63)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _terms(text: Column) -> Column:
    words = F.filter(F.split(F.lower(text), r"\s+"), lambda w: w != "")
    return words


def simhash(texts: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """``keys`` and fp for each distinct key; rows of one key are one bag of terms."""
    words = texts.select(*keys, _terms(F.col(text)).alias("_w"))
    zipped = F.arrays_zip(
        F.col("_w").alias("x"),
        F.slice("_w", F.lit(2), F.greatest(F.size("_w") - 1, F.lit(0))).alias("y"),
        F.slice("_w", F.lit(3), F.greatest(F.size("_w") - 2, F.lit(0))).alias("z"),
    )
    hashed = words.select(*keys, F.explode_outer(zipped).alias("_t")).select(
        *keys, F.when(F.col("_t").isNotNull(), F.xxhash64("_t.x", "_t.y", "_t.z")).alias("_term")
    )
    lanes = [
        F.sum(F.shiftrightunsigned("_term", g).bitwiseAND(F.lit(LANES))).alias(f"_s{g}") for g in range(32)
    ]
    votes = hashed.groupBy(*keys).agg(F.count("_term").alias("_n"), *lanes)
    fp = F.lit(0).cast("long")
    for g in range(32):
        low = F.col(f"_s{g}").bitwiseAND(F.lit(0xFFFFFFFF))
        high = F.shiftrightunsigned(f"_s{g}", 32)
        fp = fp.bitwiseOR(F.when(low * 2 > F.col("_n"), F.lit(1 << g)).otherwise(F.lit(0)).cast("long"))
        fp = fp.bitwiseOR(
            F.when(high * 2 > F.col("_n"), F.lit(_signed(1 << (g + 32)))).otherwise(F.lit(0)).cast("long")
        )
    return votes.select(*keys, fp.alias("fp"))


def block_masks(radius: int, blocks: int) -> list[int]:
    """One mask for each table: all ways to leave out ``radius`` of the blocks."""
    ends = [64 * i // blocks for i in range(blocks + 1)]
    block = [((1 << ends[i + 1]) - 1) ^ ((1 << ends[i]) - 1) for i in range(blocks)]
    kept = itertools.combinations(block, blocks - radius)
    return [_signed(sum(c)) for c in kept]


def within_radius(queries: DataFrame, prints: DataFrame, radius: int = 3, expected_rows: int = 0) -> DataFrame:
    """All pairs (query, fp) of fingerprints with at most ``radius`` differing bits.

    Two such fingerprints agree in all but ``radius`` blocks, so they meet in the table that
    leaves those out. More blocks make longer keys: their number follows ``expected_rows`` so
    that a key has few chance meetings. A pair counts in the first table that holds it.
    """
    blocks = radius + 1
    while blocks < radius + 4 and expected_rows >> (64 * (blocks - radius) // blocks) > 16:
        blocks += 1
    masks = block_masks(radius, blocks)

    def tables(df: DataFrame, name: str) -> DataFrame:
        keyed = F.array(*(
            F.struct(F.lit(i).alias("t"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for i, m in enumerate(masks)
        ))
        return df.select(F.col("fp").alias(name), F.explode(keyed).alias("e")).select(name, "e.t", "e.key")

    joined = tables(queries.select("fp").distinct(), "query").join(
        tables(prints.select("fp").distinct(), "fp"), ["t", "key"]
    )
    differ = F.col("query").bitwiseXOR(F.col("fp"))
    first = F.lit(len(masks))
    for i in reversed(range(len(masks))):
        first = F.when(differ.bitwiseAND(F.lit(masks[i])) == 0, F.lit(i)).otherwise(first)
    return joined.where((F.bit_count(differ) <= radius) & (first == F.col("t"))).select("query", "fp")


def likeness(a: Column, b: Column) -> Column:
    return 1 - F.bit_count(a.bitwiseXOR(b)) / F.lit(64.0)


def _as_hex(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def with_edits(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Texts with their edited texts, and the order of documents (rank, next_rank).

    The edit replaces the last half of a text by the start of the next document, so only the
    needed starts are shuffled to their receivers, beside one shuffle of the texts (both joins
    read the same columns, so the second takes the first one's exchange again).
    """
    rows = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("_k"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    ).withColumn("_h", F.xxhash64("text"))
    light = rows.groupBy("_k", "_h").agg(F.max(F.char_length("text")).cast("long").alias("n"))
    order = staged(
        gapless(light.withColumn("_all", F.lit(0)), "_all", [F.desc("_k"), F.asc("_h")], "order", "rank").drop("_all"),
        "ranked",
    )
    n = order.count()
    order = order.withColumn("next_rank", (F.col("rank") + 1) % F.lit(max(n, 1)))
    needs = order.select("next_rank", F.col("_k").alias("_tk"), F.col("_h").alias("_th"), F.floor(F.col("n") / 2).alias("take")).join(
        order.select(F.col("rank").alias("next_rank"), "_k", "_h"), "next_rank"
    ).drop("next_rank")
    pieces = (
        rows.join(needs.hint("merge"), ["_k", "_h"])
        .select(F.col("_tk").alias("_k"), F.col("_th").alias("_h"), F.expr("left(text, int(take))").alias("piece"))
        .dropDuplicates(["_k", "_h"])
    )
    texts = rows.join(pieces.hint("merge"), ["_k", "_h"]).withColumn("n", F.char_length("text").cast("long"))
    edited = F.concat(F.expr("left(text, int(n - floor(n / 2)))"), F.col("piece"))
    own_id = F.when(F.col("_k") != NO_ID, F.col("_k"))
    return texts.withColumn("edited", edited).withColumn("doc_id", own_id).drop("piece"), order


def fingerprint_report(docs: DataFrame, radius: int = 3, every: int = 100) -> DataFrame:
    """Fingerprints of every text and its edited text, and for one id in ``every`` the
    number of other fingerprints within ``radius``, found in the block tables."""
    texts, order = with_edits(docs)
    both = texts.select(
        "doc_id", "_k", "_h", "n", F.unhex(F.sha2("edited", 256)).alias("_sha"),
        F.explode(F.array(
            F.struct(F.lit(0).alias("edit"), F.col("text").alias("body")),
            F.struct(F.lit(1).alias("edit"), F.col("edited").alias("body")),
        )).alias("v"),
    ).select("doc_id", "_k", "_h", "n", "_sha", "v.edit", "v.body")
    prints = simhash(both, ["_k", "_h", "n", "_sha", "edit"], "body")
    wide = staged(
        prints.groupBy("_k", "_h", "n", "_sha").agg(
            F.max(F.when(F.col("edit") == 0, F.col("fp"))).alias("fp"),
            F.max(F.when(F.col("edit") == 1, F.col("fp"))).alias("edited_fp"),
        ),
        "prints",
    )
    ranked = wide.join(order.drop("n"), ["_k", "_h"])
    following = ranked.select(F.col("rank").alias("next_rank"), F.col("fp").alias("next_fp"))
    queries = wide.where((F.col("_k") % every == 0) & (F.col("_k") != NO_ID))
    found = within_radius(queries, wide, radius, wide.count()).groupBy(F.col("query").alias("_q")).agg(
        (F.count("*") - 1).alias("near_fingerprints")
    )
    copies = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("_k"),
        F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("_h"),
    )
    asked = F.when((F.col("_k") % every == 0) & (F.col("_k") != NO_ID), F.col("fp"))
    return (
        copies.join(ranked.join(following, "next_rank"), ["_k", "_h"])
        .withColumn("_q", asked)
        .join(found, "_q", "left")
        .select(
            "doc_id", F.col("n").alias("n_chars"), F.lower(F.hex("_sha")).alias("edited_sha256"),
            _as_hex(F.col("fp")).alias("fingerprint"), _as_hex(F.col("edited_fp")).alias("edited_fingerprint"),
            likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"),
            likeness(F.col("fp"), F.col("next_fp")).alias("near_next"),
            "near_fingerprints",
        )
    )


def op5_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_report(table(spark, sf_dir, "documents"))
