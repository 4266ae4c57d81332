"""What queries shuffle, send and hold as their tables grow."""

import re

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from vocabloom.operators import cells, concepts, consensus, lifting, similarity, text, validation, vectors


def shuffled(spark):
    """Bytes that this session has shuffled so far."""
    seen = spark.sparkContext._jsc.sc().statusStore().executorList(True)
    return sum(seen.apply(i).totalShuffleWrite() for i in range(seen.size()))


def plans(spark, after=-1):
    """(number, plan) of the statements that this session has run since."""
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    seen = spark._jsparkSession.sharedState().statusStore().executionsList()
    return [(e.executionId(), e.physicalPlanDescription()) for e in map(seen.apply, range(seen.size())) if e.executionId() > after]


def test_blocks_and_index_find_the_same_pairs(spark):
    rng = np.random.default_rng(3)
    words = np.array([f"wort{k}" for k in range(60)])
    texts = [" ".join(rng.choice(words, int(rng.integers(1, 60)))) for _ in range(300)] + ["", None]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string").repartition(3)
    found, terms = similarity.tfidf_vectors(df, "id", "text", 500)
    assert terms == sorted(terms) and len(terms) == 500
    rows = {r["id"]: dict(zip(r["t"], r["w"])) for r in found.collect()}
    want = {}
    for a in rows:
        for b in rows:
            c = round(sum(x * rows[b].get(t, 0) for t, x in rows[a].items()), 6) if a < b else 0
            if c >= 0.4:
                want[a, b] = c
    for kind in ("bigint", "string"):
        own = found.withColumn("id", F.format_string("k%04d", "id") if kind == "string" else F.col("id"))
        of = lambda k: int(k[1:]) if kind == "string" else k  # noqa: E731, B023
        for tiles in (True, False, None):
            got = {(of(r.a), of(r.b)): r.cosine for r in similarity.vector_pairs(own, "id", 0.4, tiles).collect()}
            assert got.keys() == want.keys() and all(abs(got[p] - want[p]) < 2e-6 for p in want)


def test_blocks_of_any_size(spark, monkeypatch):
    """Products of many small blocks and of one, dense and sparse, are the same."""
    rng = np.random.default_rng(4)
    rows = [(k, sorted(rng.choice(30, 8, replace=False).tolist()), rng.random(8).tolist()) for k in range(400)]
    df = spark.createDataFrame([(k, t, (np.array(w) / np.linalg.norm(w)).tolist()) for k, t, w in rows], "id long, t array<int>, w array<double>")
    one = {tuple(r) for r in similarity.tile_pairs(df, "id", 0.6).collect()}
    monkeypatch.setattr(similarity, "BLOCK_ROWS", 64)
    monkeypatch.setattr(similarity, "DENSE", 200)
    many = {tuple(r) for r in similarity.tile_pairs(df, "id", 0.6).collect()}
    assert one and {x[:2] for x in one} == {x[:2] for x in many} and similarity.vector_blocks(df, "id").count() > 4


def test_rounded_cosines_are_held_against_the_threshold(spark):
    at = lambda c: [float(c), float((1 - c * c) ** 0.5)]
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, at(0.2499996)), (2, at(0.2499994)), (3, at(0.25))], "id long, v array<double>")
    got = {(r.target, r.cosine) for r in vectors.similar(df.where("id = 0"), df, "id", "v", 0.25).collect()}
    assert got == {(1, 0.25), (3, 0.25)}


def test_queries_of_many_cells_leave_in_small_batches(spark):
    df = spark.range(600).select("id", F.transform(F.sequence(F.lit(1), F.lit(6)), lambda k: F.sin((F.col("id") * k).cast("double"))).alias("v"))
    index = cells.CellIndex(df, "id", "v", cells=64)

    class Caught:
        dtypes = [("k", "bigint"), ("v", "array<double>")]

        def mapInPandas(self, f, schema):  # noqa: N802
            return f

    rows = pd.DataFrame({"k": range(600), "v": [np.eye(6)[k % 6] for k in range(600)]})
    given = list(index._routed(Caught(), None)(iter([rows])))
    assert sum(map(len, given)) == 600 * 64 and max(map(len, given)) <= cells.GIVEN


def test_tables_of_all_nodes_are_not_broadcast(spark):
    nodes = spark.range(1, 2000).select(F.col("id").cast("string").alias("id"), F.lit("x").alias("label"), F.floor(F.col("id") / 2).cast("string").alias("parent_id"), F.lit("s").alias("source"), F.lit(0).alias("level"))
    last = max((k for k, _ in plans(spark)), default=-1)
    pairs = spark.range(1, 500).select(F.col("id").cast("string").alias("a"), (F.col("id") + 900).cast("string").alias("b"))
    assert lifting.lowest_common(nodes, pairs).count() == 499
    assert len(ran := plans(spark, last)) > 5 and not [p for _, p in ran if "BroadcastHashJoin" in p]


def test_items_are_not_broadcast(spark):
    votes = spark.range(3000).select((F.col("id") % 1000).alias("item"), F.concat(F.lit("e"), F.floor(F.col("id") / 1000)).alias("rater"), (F.col("id") % 7).alias("label"))
    last = max((k for k, _ in plans(spark)), default=-1)
    beliefs, _ = consensus.consensus(votes, rounds=1)
    assert beliefs.count() == 3000
    ran = plans(spark, last)
    assert any(re.search(r"SortMergeJoin[^\n]*\nLeft keys \[1\]: \[item#", p) for _, p in ran)
    assert not any(re.search(r"BroadcastHashJoin[^\n]*\nLeft keys \[1\]: \[item#", p) for _, p in ran)


def test_descriptors_are_parsed_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def trees(k):
        seen.add(1)
        return [f"A{k // 10}.{k}"] + ([f"A{k}"] if k < 10 else [])

    trees = F.udf(trees, "array<string>").asNondeterministic()  # else Spark may call it again for a filter of its own

    rows = spark.range(100).select(F.col("id").cast("string").alias("ui"), trees("id").alias("tree_numbers"))
    assert len(concepts.tree_parents(rows).collect()) == 100 and seen.value == 100


def test_tokens_are_not_shuffled_for_a_small_vocabulary(spark):
    docs = spark.range(2000).select("id", F.concat_ws(" ", *(F.concat(F.lit("w"), F.hash("id", F.lit(k)).cast("string")) for k in range(60)), F.lit("under the")).alias("text"))
    labels = spark.createDataFrame([("under the",), ("absent",)], "label string").distinct()
    before = shuffled(spark)
    assert [tuple(r) for r in text.vocabulary_matches(docs, "id", "text", labels, 4, 5).collect()] == [("under the", 2000)]
    assert shuffled(spark) - before < 200_000  # the texts have 1.5 MB


def test_pairs_of_labels_come_from_publications(spark):
    """Labels of many publications each, hardly any two of which meet."""
    n = 60
    senses = spark.range(n).select(F.concat(F.lit("s"), "id").alias("sense_id"), F.format_string("label %03d", "id").alias("label"), F.lit(1.0).alias("confidence"))
    edges = spark.range(n).crossJoin(spark.range(1, 21).select(F.col("id").alias("k"))).select(F.concat(F.lit("s"), "id").alias("source_sense_id"), F.concat(F.lit("s"), (F.col("id") * 7 + F.col("k") * 11) % n).alias("target_sense_id"))
    pubs = spark.range(n * 400).select("id", (F.col("id") % n).alias("_l")).select(F.col("id").alias("pub"), F.format_string("label %03d", "_l").alias("label"))
    both = pubs.union(spark.createDataFrame([(0, "label 011"), (1, "label 012")], "pub long, label string"))
    before = shuffled(spark)
    assert validation.neighbourhood_coherence(senses, edges, both, ahead=19).count() == n
    assert shuffled(spark) - before < 2_500_000
