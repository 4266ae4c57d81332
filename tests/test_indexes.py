"""The searches with an index against comparing everything with everything."""

import math
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from vocabloom.functions.pairs import tiled_pairs
from vocabloom.operators import cells, lifting, names, similarity
from vocabloom.operators.edges import cooccurrence


def test_tiles_have_each_pair_once(spark):
    rng = np.random.default_rng(4)
    groups = {"hot": range(300), "one": [7], "two": [7, 8], None: [1, 2], **{f"g{k}": sorted(set(rng.integers(0, 40, 12).tolist())) for k in range(20)}}
    df = spark.createDataFrame([(g, int(i), i * 0.5) for g, items in groups.items() for i in items], "g string, i long, x double")
    got = tiled_pairs(df, "g", "i", ["x"], slot=25).collect()
    want = {(g, a, b) for g, items in groups.items() if g is not None for a, b in combinations(map(int, sorted(items)), 2)}
    assert len(got) == len(want) and {(r["g"], r["a"], r["b"]) for r in got} == want
    assert all(r["x_a"] == r["a"] * 0.5 and r["x_b"] == r["b"] * 0.5 for r in got)


def test_a_publication_with_very_many_labels_is_dealt_out(spark):
    n = 3000
    df = spark.range(n).select(F.lit("p").alias("pub"), F.format_string("l%05d", "id").alias("label"), F.lit(1.0).alias("relevance"))
    pairs = cooccurrence(df, 1)
    assert pairs.count() == n * (n - 1) // 2
    tasks = tiled_pairs(df.repartition(8, "label"), "pub", "label", slot=100).groupBy(F.spark_partition_id()).count().collect()
    assert len(tasks) > 1 and max(r["count"] for r in tasks) < 0.6 * n * (n - 1) / 2


def plain_vectors(texts, features, stops):
    import re

    grams = []
    for t in texts:
        w = [x for x in re.split(r"[^\w]+", (t or "").lower()) if len(x) > 1 and x not in stops]
        grams.append(Counter(w + [f"{a} {b}" for a, b in zip(w, w[1:])]))
    total, df = Counter(), Counter()
    for g in grams:
        total.update(g)
        df.update(set(g))
    kept = sorted(total, key=lambda x: (-total[x], x.encode()))[:features]
    out = []
    for g in grams:
        v = {x: g[x] * (math.log((1 + len(texts)) / (1 + df[x])) + 1) for x in kept if x in g}
        norm = math.sqrt(sum(x * x for x in v.values()))
        out.append({k: x / norm for k, x in v.items()} if norm else {})
    return out


def test_similar_texts_equal_brute_force(spark):
    rng = np.random.default_rng(6)
    words = [f"wort{k}" for k in range(80)]
    weights = 1 / np.arange(1, 81)
    texts = [" ".join(rng.choice(words, 25, p=weights / weights.sum())) for _ in range(120)]
    texts += [t.replace("wort1 ", "wort2 ", 1) for t in texts[:20]] + ["", None, "the of", "Élan élan vital", "élan VITAL"]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "id long, text string").repartition(4)
    w = similarity.tfidf_weights(df, "id", "text", 60, ["the", "of"])
    want = plain_vectors(texts, 60, {"the", "of"})
    got = {}
    for r in w.collect():
        got.setdefault(r["id"], {})[r["term"]] = r["w"]
    assert set(got) == {k for k, v in enumerate(want) if v}
    assert all(got[k].keys() == want[k].keys() and all(math.isclose(got[k][t], x, rel_tol=1e-9) for t, x in want[k].items()) for k in got)
    dots = {(a, b): sum(x * want[b].get(t, 0) for t, x in want[a].items()) for a, b in combinations(range(len(texts)), 2)}
    for least in (0.4, 0.8):
        found = {(r["a"], r["b"]): r["cosine"] for r in similarity.all_pairs(w, "id", least).collect()}
        assert found == pytest.approx({p: c for p, c in dots.items() if round(c, 6) >= least}, abs=2e-6)
    assert len(found) <= similarity.candidate_pairs(w, "id", 0.8).count() < len(dots)
    near = similarity.nearest_texts(similarity.all_pairs(w, "id", 0.4), 3, 50).collect()
    assert len(near) == 50 and max(Counter(r["a"] for r in near).values()) <= 3


def test_few_pairs_are_candidates(spark):
    rng = np.random.default_rng(16)
    share = 1 / np.arange(1, 2001)
    texts = [" ".join(f"w{k}" for k in rng.choice(2000, 60, p=share / share.sum())) for _ in range(300)]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts + [t + " more" for t in texts[:30]])], "id long, text string")
    w = similarity.tfidf_weights(df, "id", "text")
    assert similarity.all_pairs(w, "id", 0.8).count() == 30
    assert similarity.candidate_pairs(w, "id", 0.8).count() < 0.02 * 330 * 329 / 2
    assert similarity.candidate_pairs(w, "id", 0.4).count() < 0.3 * 330 * 329 / 2


def test_text_edges(spark):
    rows = [("s2", "coal", "a dark rock that burns well", "x"), ("s1", "coal", "a dark rock that burns well", "x"), ("s3", "coke", "a dark rock that burns well indeed", "y"), ("s4", "gas", "short", "y"), ("s5", "gas", None, "y")]
    senses = spark.createDataFrame(rows, "sense_id string, label string, definition string, discipline string")
    got = {tuple(r) for r in similarity.text_edges(senses, 0.3).drop("confidence").collect()}
    assert got == {("s1", "s3", "related_to", "across"), ("s3", "s1", "related_to", "across")}
    known = spark.createDataFrame([("s1", "s3", "related_to")], "source_sense_id string, target_sense_id string, relationship_type string")
    assert [r["source_sense_id"] for r in similarity.text_edges(senses, 0.3, existing=known).collect()] == ["s3"]
    assert {r["sense_id"]: r["class"] for r in similarity.representatives(senses.where("label = 'coal'"), "sense_id", "definition").collect()} == {"s1": "s1", "s2": "s1"}


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(8)
    centres = rng.standard_normal((12, 16)) * 2
    m = centres[rng.integers(0, 12, 1500)] + rng.standard_normal((1500, 16)) * 0.6
    m = np.vstack([m, np.repeat(m[:1], 700, axis=0)])  # a third of all rows are one vector
    df = spark.createDataFrame([(k, x.tolist()) for k, x in enumerate(m)] + [(9001, None), (9002, [0.0] * 16), (9003, [math.nan] + [1.0] * 15), (9004, [1.0] * 15 + [None])], "id long, v array<double>")
    return m / np.linalg.norm(m, axis=1, keepdims=True), df.repartition(5)


def test_cell_search_is_exact_and_probes_recall(spark, vectors, monkeypatch):
    monkeypatch.setattr(cells, "BLOCK", 100)
    unit, df = vectors
    index = cells.CellIndex(df, "id", "v", 20)
    assert index.count == len(unit) and index.rows.count() == len(unit)
    assert index.blocks.agg(F.max("n")).first()[0] < 250 and index.blocks.agg(F.sum("n")).first()[0] == len(unit)
    asked = df.where("id % 50 = 0 OR id > 9000")
    cosines = unit[::50] @ unit.T
    for least in (0.95, 0.7, -1.0):
        got = {(r["source"], r["target"]) for r in index.search(asked, "id", "v", least).collect()}
        assert got == {(50 * int(i), int(j)) for i, j in zip(*np.nonzero(cosines >= least)) if 50 * i != j}
    exact = index.search(asked, "id", "v", 0.9)
    near = index.search(asked, "id", "v", 0.9, probes=4)
    assert cells.recall(near, exact) >= 0.9 and near.join(exact, ["source", "target"], "left_anti").isEmpty()
    visited = index.visits(cells.unit_rows(asked, "id", "v"), 0.9).count()
    assert visited < 0.7 * asked.count() * index.blocks.count()
    assert cells.CellIndex(df.limit(0), "id", "v").search(asked, "id", "v", 0.1).collect() == []


def test_nested_words_are_skipped(spark):
    pairs = spark.createDataFrame([(1, 2, 0.9), (2, 1, 0.9), (1, 3, 0.8), (2, 3, 0.7), (3, 4, 0.6)], "source long, target long, cosine double")
    labels = spark.createDataFrame([(1, "Gas flow"), (2, "flow"), (3, "oil well"), (4, None)], "k long, label string")
    assert {tuple(r) for r in cells.semantic_edges(pairs, labels).collect()} == {(1, 3, 0.8), (2, 3, 0.7)}
    assert {tuple(r) for r in cells.semantic_edges(pairs, labels, 1).collect()} == {(1, 3, 0.8)}


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def test_near_names_equal_all_pairs(spark):
    rng = np.random.default_rng(9)
    keys = {"".join(rng.choice(list("abc"), rng.integers(0, 9))) for _ in range(150)} | {"departmentofenergy", "departmentofenrgy", "departmentofennergy", "depratmentofenergy"}
    df = spark.createDataFrame([(k,) for k in [*keys, None]], "key string")
    for most in (0, 1, 2):
        got = {(r["a"], r["b"]): r["distance"] for r in names.near_names(df, "key", most).collect()}
        assert got == {(a, b): edits(a, b) for a, b in combinations(sorted(keys), 2) if edits(a, b) <= most}
    with pytest.raises(ValueError):
        names.near_names(df, "key", 3)


def test_groups_of_variants(spark):
    rows = [("US Dept. of Energy", 5), ("U.S. Dept of Energy", 2), ("US Dept of Enrgy", 1), ("US Dpt of Enrgy", 1), ("NSF", 9), ("NSA", 9), ("--", 1), (None, 3)]
    got = {r["name"]: r["canonical"] for r in names.variant_groups(spark.createDataFrame(rows, "name string, n long")).collect()}
    energy = "US Dept. of Energy"
    assert got == {"US Dept. of Energy": energy, "U.S. Dept of Energy": energy, "US Dept of Enrgy": energy, "US Dpt of Enrgy": energy, "NSF": "NSF", "NSA": "NSA", "--": "--"}


def test_connected(spark):
    rng = np.random.default_rng(10)
    edges = [tuple(map(int, rng.integers(0, 300, 2))) for _ in range(200)] + [(1000 + k, 1001 + k) for k in range(200)] + [(5000, 4000 + k) for k in range(100)] + [(7, 7)]
    root = {x: x for e in edges for x in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    got = {r["node"]: r["root"] for r in names.connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for e in edges if e[0] != e[1] for x in e}


def test_deep_trees(spark):
    rng = np.random.default_rng(11)
    parent = {k: int(rng.integers(max(0, k - 3), k)) for k in range(1, 400)} | {1000: 1001, 1001: 1002, 1002: 1000, 1003: 1002, 2000: 2001}

    def up(x):
        way = [x]
        while way[-1] in parent and len(way) < 1000:
            way.append(parent[way[-1]])
        return way

    df = spark.createDataFrame([(k, p) for k, p in parent.items()] + [(0, None), (5, 5)], "id long, parent_id long")
    got = {r["id"]: (r["depth"], r["root"]) for r in lifting.tree_depths(df).collect()}
    cyclic = {1000, 1001, 1002, 1003}
    assert got == {k: (None, None) if k in cyclic else (len(up(k)) - 1, up(k)[-1]) for k in {*parent, 0, 2001}}
    pairs = [tuple(map(int, rng.integers(0, 400, 2))) for _ in range(60)] + [(3, 3), (0, 399), (5, 2000), (1000, 3)]
    got = {(r["a"], r["b"]): r["ancestor"] for r in lifting.lowest_common(df, spark.createDataFrame(pairs, "a long, b long")).collect()}
    want = {}
    for a, b in pairs:
        if not {a, b} & cyclic and (both := [x for x in up(a) if x in up(b)]):
            want[a, b] = both[0]
    assert got == want


def test_a_chain_of_many_nodes(spark):
    n = 100_000
    chain = spark.range(n).select("id", F.when(F.col("id") > 0, F.col("id") - 1).alias("parent_id"))
    rungs = lifting.ladders(chain)
    assert rungs.count() == n and rungs.agg(F.max(F.size("up"))).first()[0] == 17
    assert rungs.where("depth <> id OR root <> 0").isEmpty()
    pairs = spark.createDataFrame([(99_999, 3), (70_000, 70_001), (12_345, 99_000)], "a long, b long")
    assert {tuple(r) for r in lifting.lowest_common(chain, pairs, rungs).collect()} == {(99_999, 3, 3), (70_000, 70_001, 70_000), (12_345, 99_000, 12_345)}


def test_bounds_are_never_less_than_the_cosines(spark, monkeypatch):
    """Pairs of a high cosine are found in the columns of bounds, whether few or many pairs are left to be computed."""
    monkeypatch.setattr(similarity, "HEADS", 10)
    monkeypatch.setattr(similarity, "GROUPS", 6)
    monkeypatch.setattr(similarity, "BOUND_ROWS", 60)
    rng = np.random.default_rng(21)
    rows = []
    for k in range(200):
        t = np.sort(rng.choice(90, 14, replace=False))
        rows.append((k, t.tolist(), rng.random(14)))
    rows += [(200 + k, rows[k][1], rows[k][2] + rng.random(14) * 0.1) for k in range(40)]
    rows = [(k, t, (w / np.linalg.norm(w)).tolist()) for k, t, w in rows]
    dense = np.zeros((len(rows), 90))
    for k, t, w in rows:
        dense[k, t] = w
    dots = dense @ dense.T

    def block(some):
        terms, at, w = (np.concatenate(x) for x in zip(*((t, np.full(14, i, np.int32), w) for i, (_, t, w) in enumerate(some))))
        order = np.argsort(terms, kind="stable")
        return len(some), terms[order], at[order], w[order]

    blocks = block(rows[:120]), block(rows[120:])
    assert (similarity.bounds(*blocks) >= dots[:120, 120:] - similarity.FLOATS).all()
    assert (similarity.bounds(*blocks) >= 0.9).mean() < 0.05
    df = spark.createDataFrame(rows, "id long, t array<int>, w array<double>").repartition(3)
    for few in (1.0, 0.0):
        monkeypatch.setattr(similarity, "FEW", few)
        found = {(r["a"], r["b"]): r["cosine"] for r in similarity.vector_pairs(df, "id", 0.9, tiles=True).collect()}
        assert found == pytest.approx({(a, b): dots[a, b] for a, b in combinations(range(len(rows)), 2) if round(dots[a, b], 6) >= 0.9}, abs=2e-6)
        assert len(found) >= 40


def test_nearest_texts_stop_at_a_high_cosine(spark, monkeypatch):
    """Where enough pairs are very near, pairs of the least cosine are never asked for; the rows are those of all pairs."""
    rng = np.random.default_rng(22)
    words = [f"wort{k}" for k in range(60)]
    texts = [" ".join(rng.choice(words, 40)) for _ in range(60)]
    texts += [f"{t} {words[k % 60]}" for t in texts[:25] for k in range(3)]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    vectors = similarity.tfidf_vectors(df, "id", "text")[0]
    every = [tuple(r) for n in (30, 269) for r in similarity.nearest_texts(similarity.vector_pairs(vectors, "id", 0.1), 2, n).collect()]
    asked, pairs = [], similarity._pairs_of
    monkeypatch.setattr(similarity, "_pairs_of", lambda v, key, least, tiles=None: (asked.append(least), pairs(v, key, least, tiles))[1])
    got = [tuple(r) for n in (30, 269) for r in similarity.nearest_vectors(vectors, "id", 0.1, 2, n).collect()]
    assert got == every
    assert asked in ([0.98, *similarity.FIRST_TRIES, 0.1], [0.98, 0.9, *similarity.FIRST_TRIES, 0.1])
    asked.clear()
    assert similarity.nearest_vectors(vectors, "id", 0.1, 2, 2 * len(texts)).count() == similarity.nearest_vectors(vectors, "id", 0.1, 2).count() and asked == [0.1, 0.1]  # no limit can be met early


def test_frequent_terms_are_those_of_all_pairs(spark, monkeypatch):
    """Pairs of rare words are never counted, and ties go to the first in order, whichever way is taken."""
    rng = np.random.default_rng(23)
    share = 1 / np.arange(1, 401)
    texts = [[f"w{k}" for k in rng.choice(400, 30, p=share / share.sum())] for _ in range(80)]
    total = Counter(x for w in texts for x in [*w, *(f"{a} {b}" for a, b in zip(w, w[1:]))])
    df = spark.createDataFrame([(w,) for w in texts], "_w array<string>").repartition(3)
    for features in (5, 60, 390, 10_000):
        want = sorted(total, key=lambda x: (-total[x], x))[:features]
        for most in (4, 0):
            monkeypatch.setattr(similarity, "MOST_WORDS", most)
            assert [r["term"] for r in similarity.frequent_terms(df, features).collect()] == want


def test_blocks_are_full(spark, monkeypatch):
    """Hardly a partition holds more than a block, so that few small blocks are left over, each of which would be multiplied with all others."""
    monkeypatch.setattr(similarity, "BLOCK_ROWS", 128)
    vectors = spark.range(2560).select("id", F.array(F.lit(1)).alias("t"), F.array(F.lit(1.0)).alias("w"))
    sizes = [r["n"] for r in similarity.vector_blocks(vectors, "id").select(F.size("keys").alias("n")).collect()]
    assert sum(sizes) == 2560 and max(sizes) <= 128
    assert len(sizes) <= 26
