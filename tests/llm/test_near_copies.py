import itertools

import numpy as np
import pytest

from vocabloom.llm import components, simhash_neardup


def roots_of(nodes, pairs):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("radius", [1, 2, 3])
def test_crowds_for_any_radius(spark, radius):
    """A crowd above the limit of a shard is linked like by brute force, for odd radii too."""
    rng = np.random.default_rng(radius)
    base = [int(x) for x in rng.integers(0, 2**62, 12)]
    points = {b ^ sum(1 << int(j) for j in rng.integers(0, 62, int(rng.integers(0, 4)))) for b in base for _ in range(8)} | {-(2**63), -(2**63) + 1}
    df = spark.createDataFrame([(p,) for p in points], "fp long")
    near = [(a, b) for a, b in itertools.combinations(points, 2) if ((a ^ b) & (2**64 - 1)).bit_count() <= radius]
    want = roots_of(points, near)
    for limits in ({"crowd_rows": 10}, {}):
        found = [(r.a, r.b) for r in simhash_neardup.links(df, radius, **limits).collect()]
        assert all(a in points and b in points for a, b in found)
        assert roots_of(points, found) == want


def test_components_with_a_hub(spark):
    edges = [(0, i) for i in range(1, 300)] + [(i, i + 1) for i in range(400, 430)] + [(7, 7), (-(2**63), 5)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = roots_of({n for e in edges for n in e}, [e for e in edges if e[0] != e[1]])
    assert got == {n: r for n, r in want.items() if n != 7 or r != 7}


def test_fingerprint_is_the_contract():
    """Bit by bit against a plain computation, for texts of no, one, two and many words."""
    import xxhash

    for text in ("", " \n", "One", "one TWO", "a b c", "Ä b\x0bC d e a b c d e", "x " * 500):
        words = ["".join(c.lower() if c.isascii() else c for c in w) for w in "".join(" " if c in " \t\n\x0b\x0c\r" else c for c in text).split(" ") if w]
        runs = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [" ".join(words)] if words else []
        hashes = [xxhash.xxh64_intdigest(r.encode(), seed=42) for r in runs]
        want = sum(1 << j for j in range(64) if 2 * sum(h >> j & 1 for h in hashes) > len(hashes)) if hashes else 0
        assert simhash_neardup.fingerprint(text.encode()) == want


def test_one_of_each_group_stays(spark):
    """Near copies of 0.8 and more of their five-word shingles go, also in large groups; texts that share a passage stay."""
    rng = np.random.default_rng(6)
    word = lambda: f"w{rng.integers(0, 5000)}"
    base = [[word() for _ in range(240)] for _ in range(12)]
    passage = [word() for _ in range(60)]
    rows, group = [], {}

    def add(words, of):
        group[len(rows)] = of
        rows.append((len(rows), " ".join(words)))

    for g, words in enumerate(base):
        add(words, g)
        for _ in range(40 if g == 0 else 2):
            copy = list(words)
            for at in rng.choice(240, 2, replace=False):
                copy[at] = word()
            add(copy, g)
    for i in range(60):  # a passage that many texts share makes no copies
        add(passage + [word() for _ in range(90)], f"p{i}")
    for text in ("", "  ", "one", "two words"):
        group[len(rows)] = text.strip()
        rows.append((len(rows), text))
    kept = {r.doc_id for r in simhash_neardup.keep_one_of_each(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    first = {}
    for i, g in group.items():
        first.setdefault(g, i)
    assert kept == set(first.values())


def test_the_trees_sample_is_chosen_in_tasks(spark):
    """The driver gets a sample of about the size asked for, and no more, from all tasks together."""
    points = spark.range(40000).selectExpr("xxhash64(id) AS fp").repartition(8)
    every = {r.fp & (2**64 - 1) for r in points.collect()}
    fps = simhash_neardup.sampled(points, 40000, 4000)
    assert 3500 < len(fps) < 4500 and len(set(fps.tolist())) == len(fps) and set(fps.tolist()) <= every
    assert len(simhash_neardup.sampled(points, 40000, 0)) == 0


def test_near_copies_without_a_common_passage(spark):
    """Texts of one passage each, a word of which an edit changes, and groups whose rarest passages they share with others."""
    import zlib

    rng = np.random.default_rng(8)
    plain = [w for w in (f"w{k}" for k in range(3000)) if zlib.crc32(w.encode()) % simhash_neardup.PASSAGE]
    stop = next(w for w in (f"z{k}" for k in range(999)) if zlib.crc32(w.encode()) % simhash_neardup.PASSAGE == 0)
    some = lambda n: [str(w) for w in rng.choice(plain, n)]
    texts = []
    for _ in range(30):
        words = some(60)
        texts += [words, [*words[:29], "other", *words[30:]], [*words[:20], *some(3), *words[25:]]]
    for k in range(12):  # 12 texts of other ends share each passage, so that near copies are seldom among its chosen members
        shared = [*some(20), stop]
        for _ in range(12):
            end = some(100)
            texts += [[*shared, *end], [*shared, *end[:50], f"x{k}", *end[51:]]]
    rows = [(i, " ".join(w)) for i, w in enumerate(texts)] + [(5000, None), (5001, " ")]
    sets = {i: set(simhash_neardup.shingles((t or "").encode(), 5).tolist()) for i, t in rows}
    near = [(a, b) for a, b in itertools.combinations(sets, 2) if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    kept = simhash_neardup.keep_one_of_each(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(roots_of(list(sets), near).values()))


def test_sketches_never_differ_more_than_sets():
    rng = np.random.default_rng(3)
    sets = [rng.integers(0, 2**63, n).astype(np.uint64) for n in (0, 1, 15, 16, 17, 140, 900, 3000)]
    sets += [np.concatenate([x[: len(x) * 9 // 10], rng.integers(0, 2**63, len(x) // 5).astype(np.uint64)]) for x in sets]
    sketches = [simhash_neardup.parities(np.unique(x)) for x in sets]
    a, b = np.array(list(itertools.product(range(len(sets)), repeat=2))).T
    real = np.array([len(set(sets[i].tolist()) ^ set(sets[j].tolist())) for i, j in zip(a, b)])
    got = simhash_neardup.differing(sketches, a, b)
    assert (got <= real).all() and (got[a == b] == 0).all()
    assert got[(a == 5) & (b == 13)][0] > 0.85 * real[(a == 5) & (b == 13)][0]


def test_nearly_similar_texts_do_not_make_all_pairs(spark):
    """A large group of edits of one text, most pairs of which are just below the similarity: candidates stay near the true pairs, and none of those is missed."""
    rng = np.random.default_rng(11)
    base = [f"w{k}" for k in range(150)]
    texts = []
    for i in range(160):
        words = list(base)
        for at in rng.choice(150, 3 + i % 3, replace=False):
            words[at] = f"x{i}y{at}"
        texts.append((i, " ".join(words)))
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    nodes = {r.doc_id: r.node for r in docs.select(*simhash_neardup._named(docs)).collect()}
    sets = {nodes[i]: set(simhash_neardup.shingles(t.encode(), 5).tolist()) for i, t in texts}
    near = {(max(a, b), min(a, b)) for a, b in itertools.combinations(sets, 2) if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])}
    roots = spark.createDataFrame([], "node long, root long")
    found = [(r.a, r.b) for r in simhash_neardup.remaining_pairs(docs, roots, 0.8, 5).collect()]
    assert len(found) == len(set(found)) and near <= set(found)
    assert 0 < len(near) < 2500 and len(found) < len(near) + 1500, (len(near), len(found))


@pytest.mark.parametrize("radius", [1, 2, 3])
def test_points_without_company_stay_out_of_the_tree(spark, radius):
    """Random points, which nothing is near, go; every point that has another one within the radius stays."""
    rng = np.random.default_rng(10 + radius)
    alone = {int(x) for x in rng.integers(-(2**63), 2**63, 4000)}
    base = [int(x) for x in rng.integers(-(2**63), 2**63, 40)]
    signed = lambda x: x - 2**64 if x >= 2**63 else x
    near = {signed((b & (2**64 - 1)) ^ sum(1 << int(j) for j in rng.choice(64, int(rng.integers(1, radius + 1)), replace=False))) for b in base for _ in range(3)} | set(base)
    kept = {r.fp for r in simhash_neardup.with_company(spark.createDataFrame([(p,) for p in alone | near], "fp long"), radius).collect()}
    assert near <= kept <= alone | near
    assert len(kept) < len(near) + 200


def test_the_tree_of_passages_gets_linear_work(spark, monkeypatch):
    """Of texts with no passage in common hardly a passage reaches the tree, which copies its points more often the more there are."""
    rng = np.random.default_rng(12)
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 5000, 120)) for _ in range(150)]
    texts += [t + " and one more end" for t in texts[:10]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    routed, links = [], simhash_neardup.links
    monkeypatch.setattr(simhash_neardup, "links", lambda points, **limits: (routed.append(points.count()), links(points, **limits))[1])
    assert {r.doc_id for r in simhash_neardup.keep_one_of_each(docs).collect()} == set(range(150))
    assert len(routed) == 1 and routed[0] < 60


def test_shingles_of_the_same_texts_count_once(spark):
    """Texts that share a passage meet once for all of its shingles, and every pair of the similarity is still found."""
    h = np.array([1, 1, 2, 2, 3, 3, 3])
    node = np.array([7, 9, 7, 9, 7, 9, 11])
    company = simhash_neardup.same_company(h, node)
    assert len(set(company[:4].tolist())) == 1 and len(set(company.tolist())) == 2 and len(simhash_neardup.same_company(h[:0], node[:0])) == 0


def test_nothing_that_grows_is_broadcast(spark):
    """A crowd's balls are 65 times its points, which Spark's estimate of the join does not know; the driver would hold them all."""
    docs = spark.createDataFrame([(k, f"text {k % 7}") for k in range(40)], "doc_id long, text string")
    crowd = simhash_neardup.crowd_links(spark.createDataFrame([(1 << k,) for k in range(60)], "fp long"), 2)
    for df in (crowd, simhash_neardup.neighbours_components(docs)):
        df.collect()
        assert "Broadcast" not in df._jdf.queryExecution().executedPlan().toString()
    assert len({r.b for r in crowd.collect()}) >= 1
