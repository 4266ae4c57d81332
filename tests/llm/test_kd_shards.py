import numpy as np
import pytest
from pyspark.sql import functions as F

from vocabloom.llm import kd_shards

SCHEMA = "doc_id long, text string, source string, lang string"


@pytest.fixture(scope="module")
def corpus(spark):
    rng = np.random.default_rng(8)
    rows = [(i, "x" * int(rng.integers(0, 4000)) + str(i % 180), f"s{i % 3}", "en") for i in range(200)]
    rows += [(None, None, None, None), (5, "", "s1", None), (7, "twin", "s0", "de"), (7, "twin", "s0", "de")]
    return spark.createDataFrame(rows, SCHEMA).cache()


def brute_force(groups, first, leaves):
    """The k-d tree by plain recursion: {text key: leaf}."""
    if leaves == 1 or not groups:
        return {tuple(g[c] for c in kd_shards.TEXT_KEY): first for g in groups}
    spans = [max(g[d] for g in groups) - min(g[d] for g in groups) for d in kd_shards.DIMENSIONS]
    along = kd_shards.DIMENSIONS[spans.index(max(spans))]
    total, before, sides = sum(g["weight"] for g in groups), 0, ([], [])
    for g in sorted(groups, key=lambda g: (g[along], g["tie"], *(g[c] for c in kd_shards.TEXT_KEY))):
        sides[before + g["weight"] / 2 > total * (leaves // 2) / leaves].append(g)
        before += g["weight"]
    return brute_force(sides[0], first, leaves // 2) | brute_force(sides[1], first + leaves // 2, leaves - leaves // 2)


@pytest.mark.parametrize(("shards", "node_groups"), [(5, 20), (5, 10_000), (24, 30), (1, 10)])
def test_tree_is_the_plain_recursion(corpus, shards, node_groups):
    groups = kd_shards.text_groups(kd_shards._rows(corpus)).cache()
    rows = groups.collect()
    total = sum(g["weight"] for g in rows)
    assert all(g["weight"] * shards <= total for g in rows) or shards == 24
    alone = []
    for g in sorted(rows, key=lambda g: -g["weight"]):
        if g["weight"] * (shards - len(alone)) > total and shards - len(alone) > 1:
            alone.append(g)
            total -= g["weight"]
    got = {(r["size"], r["text_crc32"], r["text_hash"]): r["shard"] for r in kd_shards.assign(groups, shards, node_groups).collect()}
    want = brute_force([g for g in rows if g not in alone], len(alone), shards - len(alone))
    want |= {tuple(g[c] for c in kd_shards.TEXT_KEY): i for i, g in enumerate(alone)}
    assert got == want and len(got) == len(rows)


def test_many_leaves(corpus):
    """Hundreds of leaves, more leaves than groups: every row has a shard, equal texts share it, slots are gapless."""
    rows = kd_shards.shard(corpus, 700).collect()
    assert len(rows) == corpus.count() and all(0 <= r.shard < 700 for r in rows)
    slots, shard_of = {}, {}
    for r in rows:
        slots.setdefault(r.shard, []).append(r.slot)
        assert shard_of.setdefault((r.size, r.text_crc32), r.shard) == r.shard
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_a_heavy_group_has_a_shard_of_its_own(spark):
    """Half of the bytes are one text: it gets one shard, and the others are even."""
    rows = [(i, "hot" * 300) for i in range(100)] + [(1000 + i, f"{i:04d}" * 225) for i in range(100)]
    out = kd_shards.shard(spark.createDataFrame(rows, "doc_id long, text string"), 6).groupBy("shard").agg(F.sum("size").alias("b"), F.count("*").alias("n")).collect()
    assert sorted(r.n for r in out) == [20, 20, 20, 20, 20, 100]


def test_target_bytes(corpus):
    total = kd_shards.text_groups(kd_shards._rows(corpus)).agg(F.sum("weight")).first()[0]
    sizes = [r[1] for r in kd_shards.shard(corpus, target_bytes=total // 8 + 1).groupBy("shard").agg(F.sum("size")).collect()]
    assert len(sizes) == 8 and max(sizes) < 1.3 * total / 8
