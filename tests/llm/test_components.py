"""Connected components against a plain walk, and the tasks that a round takes."""

import os
import time

import numpy as np

from vocabloom.llm.components import components


def plain(edges):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {x: find(x) for x in root}


def test_components_of_chains_stars_and_loops(spark):
    rng = np.random.default_rng(4)
    edges = [(k, k + 1) for k in range(0, 40)] + [(1000, k) for k in range(100, 160)] + [tuple(x) for x in rng.integers(200, 400, (120, 2)).tolist()]
    edges += [(b, a) for a, b in edges[:9]] + [(7, 7), (-(2**63), 5), (2**63 - 1, 2**63 - 2)]
    got = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert len(got) == len({r["node"] for r in got})
    assert {r["node"]: r["root"] for r in got} == plain([e for e in edges if e[0] != e[1]])


def test_rounds_make_each_join_once(spark):
    """The driver keeps something of every task, so a round over n partitions takes few of them."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    context = spark.sparkContext
    context.setJobGroup("rounds", "rounds")
    try:
        components(spark.createDataFrame([(5, k) for k in range(6, 300)], "a long, b long")).count()
        tracker = context.statusTracker()
        stages = {s for j in tracker.getJobIdsForGroup("rounds") for s in tracker.getJobInfo(j).stageIds}
        tasks = sum(tracker.getStageInfo(s).numCompletedTasks for s in stages)
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
        for k, v in before.items():
            spark.conf.set(k, v)
    assert tasks <= 16 * 32, tasks  # two rounds, the first edges and the result


def test_staged_leaves_no_shuffle_files(spark):
    from vocabloom.llm._common import CLEANUP, staged

    held = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()

    def shuffled():
        return {x for top in held for _, _, files in os.walk(top.getPath()) for x in files if x.startswith("shuffle_")}

    before, was = shuffled(), spark.conf.get(CLEANUP)
    counts = spark.range(1000).selectExpr("id % 7 AS k").groupBy("k").count()
    table = staged(counts, "counts")
    deadline = time.time() + 20
    while shuffled() - before and time.time() < deadline:
        time.sleep(0.2)
    assert not shuffled() - before and spark.conf.get(CLEANUP) == was
    assert table.count() == staged(counts, "counts").count() == 7
