import math

import pytest
from pyspark.sql import functions as F

from vocabloom.operators import edges, flows, hierarchy, lenses, normalize, quality, text, validation


@pytest.fixture(scope="module")
def tree(spark):
    rows = [
        ("root", "Science", None, 0), ("phys", "Physics", "root", 1), ("chem", "Chemistry", "root", 1), ("qm", "Quantum Mechanics", "phys", 2),
        ("thermo", "Thermodynamics", "phys", 2), ("orgchem", "Organic Chemistry", "chem", 2), ("qft", "Quantum Field Theory", "qm", 3),
    ]
    return spark.createDataFrame(rows, "id string, label string, parent_id string, level int")


def ids(df, c="id"):
    return {r[c] for r in df.collect()}


def test_tree(spark, tree):
    assert ids(hierarchy.roots(tree)) == {"root"}
    assert ids(hierarchy.leaves(tree)) == {"qft", "thermo", "orgchem"}
    up = hierarchy.closure(tree).where("id = 'qft'").orderBy("hops").collect()
    assert [r["ancestor"] for r in up] == ["qm", "phys", "root"]
    paths = {r["id"]: r["full_path"] for r in hierarchy.full_paths(tree).collect()}
    assert paths["qft"] == "Science > Physics > Quantum Mechanics > Quantum Field Theory"
    assert ids(hierarchy.descendants(tree, "phys")) == {"qm", "thermo", "qft"}
    assert ids(hierarchy.siblings(tree).where("id = 'qm'"), "sibling") == {"thermo"}
    assert {r["id"]: r["depth"] for r in hierarchy.depths(tree).collect()}["qft"] == 3
    pairs = spark.createDataFrame([("qm", "thermo"), ("qft", "orgchem"), ("qm", "qft")], "a string, b string")
    assert {(r.a, r.b): r.ancestor for r in hierarchy.common_ancestors(tree, pairs).collect()} == {
        ("qm", "thermo"): "phys", ("qft", "orgchem"): "root", ("qm", "qft"): "qm"}
    assert ids(hierarchy.find_label(tree, "quantum")) == {"qm", "qft"}
    assert hierarchy.subtree(tree, "phys").count() == 4
    stats = hierarchy.graph_stats(tree).first()
    assert (stats.nodes, stats.edges, stats.roots, stats.leaves, stats.max_depth) == (7, 6, 1, 3, 3)
    assert {r.depth: r.n for r in hierarchy.depth_histogram(tree).collect()} == {0: 1, 1: 2, 2: 3, 3: 1}


def test_cycles_and_two_parents_end(spark):
    g = spark.createDataFrame([("x", "y"), ("y", "x"), ("c", "a"), ("c", "b"), ("a", "r"), ("b", "r")], "id string, parent_id string")
    c = {(r.id, r.ancestor): r.hops for r in hierarchy.closure(g).collect()}
    assert c == {("x", "y"): 1, ("y", "x"): 1, ("c", "a"): 1, ("c", "b"): 1, ("a", "r"): 1, ("b", "r"): 1, ("c", "r"): 2}


def test_keyword_store(spark):
    schema = "id string, label string, parent_id string, source string"
    stored = spark.createDataFrame([("a1", "Aerosols", None, "A"), ("b1", "Clouds", None, "B")], schema)
    new = spark.createDataFrame([("a2", "Aerosol Optical Depth", None, "A"), ("a3", "Child", "missing", "A")], schema)
    merged = quality.upsert_replace(stored, new)
    assert {r.source: r.n for r in quality.source_stats(merged).collect()} == {"A": 2, "B": 1}
    assert quality.search_label(merged, "aerosol").count() == 1
    v = {r.source: r for r in quality.validate_source(merged).collect()}
    assert v["A"].orphan_parents == 1 and not v["A"].valid and v["B"].valid
    assert quality.validate_source(stored.limit(0)).count() == 0


def test_lens_formula(spark):
    s = spark.createDataFrame([("s", "B", ["A"], 0.8, 2)], "sense_id string, discipline string, secondary array<string>, confidence double, tier int")
    assert lenses.lens_scores(s, {"A": 0.95, "B": 0.4}).first()["score"] == pytest.approx(0.798)


@pytest.mark.parametrize(
    ("given", "agencies"),
    [
        ("Funded by NSF 1234567", ["NSF"]), ("NIH grant R01-CA-234567", ["NIH"]), ("Contract DE-AC02-05CH11231", ["DOE"]), ("NASA grant NNX14AH35G", ["NASA"]),
        ("EPSRC grant EP/A123456/1", ["EPSRC"]), ("", []), (None, []), ("Grant 1234567 and grant 1234567 again", ["NSF"]),
        ("Funded by NSF 1234567 and NIH R01GM654321 and DOE DE-AC02-05CH11231", ["DOE", "NIH", "NSF"]),
    ],
)
def test_grants(spark, given, agencies):
    df = spark.createDataFrame([(1, given)], "doc_id long, text string")
    assert sorted(r.agency for r in text.grants(df, "doc_id", "text").collect()) == agencies


def test_statistics(spark):
    r = spark.createDataFrame([(1, 1)] * 20 + [(1, 0)] * 5 + [(0, 1)] * 10 + [(0, 0)] * 15, "a int, b int")
    assert validation.kappa(r, "a", "b").first()["kappa"] == pytest.approx(0.4)
    u = spark.createDataFrame([(True, 3.0), (True, 4.0), (False, 1.0), (False, 3.0)], "g boolean, v double")
    assert validation.mann_whitney(u, "g", "v").first()["u"] == 3.5


def test_samples_and_layout(spark):
    rows = [(f"s{i:02d}", "ab"[i % 2], i / 40, i % 5 if i % 3 else None) for i in range(40)]
    s = spark.createDataFrame(rows, "sense_id string, discipline string, confidence double, level int")
    sample = validation.stratified_sample(s, [F.col("discipline")], "sense_id", 5)
    hashes = {r.sense_id: r.h for r in s.select("sense_id", F.xxhash64("sense_id", F.lit(1)).alias("h")).collect()}
    want = {x for d in "ab" for x in sorted((r[0] for r in rows if r[1] == d), key=lambda i: (hashes[i], i))[:5]}
    assert {r.sense_id for r in sample.collect()} == want
    assert ids(validation.edge_sample(s, ["sense_id"], 0.3), "sense_id") == {i for i, h in hashes.items() if h % 1_000_000 < 300_000}
    got = {r.sense_id: (r.x, r.y) for r in flows.radial_layout(s, 10).collect()}
    for sector, d in enumerate("ab"):
        best = sorted((r for r in rows if r[1] == d), key=lambda r: (-r[2], r[0]))[:10]
        for place, (sense, _, _, level) in enumerate(best, 1):
            angle, radius = 2 * math.pi * (sector + place / 11) / 2, min(math.tanh(((level or 0) + 1) / 2), 0.97)
            assert got.pop(sense) == pytest.approx((radius * math.cos(angle), radius * math.sin(angle)), abs=1e-6)
    assert not got and flows.radial_layout(s.limit(0), 10).count() == 0


def test_projections(spark):
    df = spark.createDataFrame([("A", "B", "", "x"), ("A", None, "C", "y"), ("A", "Not Applicable", "C", "z"), ("A", "B", "C", "w")], "a string, b string, c string, k string")
    got = {r.k: r.p for r in df.select("k", normalize.path_of(["a", "b", "c"]).alias("p")).collect()}
    assert got == {"x": "A > B", "y": "A", "z": "A", "w": "A > B > C"}
    paths = spark.createDataFrame([("A > B > C",), ("A",)], "path string")
    assert {r.path for r in normalize.synthetic_ancestors(paths).collect()} == {"A > B"}


def test_containment(spark):
    df = spark.createDataFrame([("solar energy",), ("energy",), ("new",), ("new solar",)], "label string")
    assert {(r.narrower, r.broader) for r in edges.containment(df).collect()} == {("solar energy", "energy")}


def test_registry(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert "lens_query" in entry.queries()


def test_walks_deeper_than_a_hundred_hops(spark):
    n = 103
    chain = spark.createDataFrame([(i, i - 1 if i else None) for i in range(n)], "id long, parent_id long").coalesce(1)
    top = hierarchy.closure(chain).where(f"id = {n - 1} AND ancestor = 0").collect()
    assert [r.hops for r in top] == [n - 1]
    edges = chain.where("parent_id IS NOT NULL").selectExpr("parent_id AS src", "id AS dst")
    assert hierarchy.reach(edges, chain.where("id = 0")).agg(F.max("level")).first()[0] == n - 1
