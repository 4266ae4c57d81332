import pytest
from pyspark.sql import functions as F

from vocabloom.operators import hierarchy, lenses, normalize, senses, text
from vocabloom.sources import parquet

FOURTEEN = [(f"d{i}", f"Discipline {i}", 1 + i % 4) for i in range(14)]
EIGHTEEN = [(f"d{i % 14}", f"d{(i + 1 + i // 14) % 14}", f"Pair {i}") for i in range(18)]


def test_template_lenses(spark):
    made = lenses.template_lenses(FOURTEEN, EIGHTEEN)
    assert len(made) == 97 and len({x.lens_id for x in made}) == 97
    one = next(x for x in made if x.lens_id == "hat:d0:director")
    assert (one.weights["d0"], one.weights["d4"], one.weights["d1"], one.weights["d2"], one.altitude) == (0.95, 0.4, 0.25, 0.1, 100000)
    pair = next(x for x in made if x.lens_id == "hat:d0+d1:researcher")
    assert (pair.weights["d0"], pair.weights["d1"], pair.weights["d5"], pair.secondary) == (0.9, 0.85, 0.1, ("d1",))
    table = lenses.lens_table(spark, made)
    assert lenses.list_lenses(table, role="researcher", discipline="d0").count() == 3  # its own and two pairs
    assert set(made[-1].weights.values()) == {1.0}


def test_composed_lenses(spark):
    made = lenses.template_lenses(FOURTEEN)
    assert lenses.compose_lens(made, FOURTEEN, "d3").lens_id == "hat:d3:researcher"
    guest = lenses.compose_lens(made, FOURTEEN, "d3", "lab_guest", ["robots"], "org:L0:x")
    assert (guest.lens_id, guest.name, guest.altitude, guest.weights, guest.interests, guest.org_node) == (
        "composed:d3:lab_guest", "Discipline 3 Lab Guest", 1000, {"d3": 0.95}, {"robots": 1.0}, "org:L0:x")
    with pytest.raises(ValueError, match="d99"):
        lenses.compose_lens(made, FOURTEEN, "d99", "guest")
    asked = spark.createDataFrame([("d3", "lab_guest", ["robots"]), ("d3", "director", []), ("d99", "director", None)], "discipline string, role string, interests array<string>")
    got = {(r.discipline, r.role): r for r in lenses.compose_lenses(asked, made, FOURTEEN).collect()}
    assert got["d3", "lab_guest"].name == guest.name and got["d3", "lab_guest"].weights == guest.weights
    assert got["d3", "director"].lens_id == "hat:d3:director" and got["d99", "director"].lens_id is None


def test_full_lens_query(spark):
    rows = [
        ("a", "Robot arm", "S", "x", ["y", "z"], 0.8, None, 1, ["abstract_freq:3", "pub_freq:9"]), ("b", "Robot leg", "S", "x", [], None, 5, 4, None),
        ("c", "Gear", "T", "y", ["x"], 0.9, 1, 2, []), ("e", "Robot eye", "S", "q", None, 1.0, 1, 1, None),
    ]
    s = spark.createDataFrame(rows, "sense_id string, label string, source string, discipline string, secondary array<string>, confidence double, level int, tier int, tags array<string>")
    degree = spark.createDataFrame([("a", 7)], "sense_id string, degree long")
    weights = {"x": 0.9, "y": 0.5, "q": 0.1}
    got = lenses.lens_query_full(s, weights, degree, 10).collect()
    assert [(r.sense_id, r.score, r.bridge_to, r.rel_count) for r in got] == [("a", 1.59, ["y"], 7), ("c", 0.8505, ["x"], 0), ("b", 0.225, [], 0)]
    assert [r.sense_id for r in lenses.lens_query_full(s, weights, degree, 10, search="ROBOT", source="S", altitude=10000).collect()] == ["a"]
    assert [r.sense_id for r in lenses.lens_query_full(s, weights, degree, 10, candidates=1).collect()] == ["c"]
    assert [r.sense_id for r in lenses.lens_query_full(s, {"q": 0.1}, degree, 1, least_score=0.15).collect()] == ["a"]
    total = {r.source: r for r in lenses.lens_summary(s, ["y"]).collect()}
    assert (total[None].visible, total[None].by_primary, total[None].bridges, total["S"].visible) == (2, 1, 1, 1)


def test_explore_falls_back_to_similar_labels(spark):
    s = spark.createDataFrame([(f"s{i}", f"gear {i}", "x" if i % 2 else "y", "S", i / 20) for i in range(12)] + [("n", "Node", "x", "S", 1.0)],
                              "sense_id string, label string, discipline string, source string, confidence double")
    edges = spark.createDataFrame([(f"s{i}", "n", 0.5) for i in range(12)] + [("n", "n", 0.1)], "source_sense_id string, target_sense_id string, confidence double")
    assert {r.sense_id for r in lenses.centre_senses(s, "GEAR").collect()} == {f"s{i}" for i in range(2, 12)}
    assert {r.sense_id for r in lenses.centre_senses(s, "gear 1").collect()} == {"s1"}
    best = lenses.explore(s, edges, "gear", {"x": 0.8}, 5).collect()
    assert [(r.neighbour, r.score) for r in best] == [("n", 0.4)]
    made = [lenses.Lens("l1", "L", "r", 1000, "x", {"x": 0.8}), lenses.Lens("l2", "M", "r", 1000, "y", {})]
    rows = {(r.lens_id, r.kind): r.value for r in lenses.compare_lenses(s, edges, "gear", made).collect()}
    assert rows["l1", "neighbour"] == 0.4 and rows["l2", "neighbour"] == 0.025 and rows["l1", "senses"] == rows["l2", "connections"] == 10.0


def test_trees(spark):
    nodes = spark.createDataFrame(
        [("r", "Root", None, "domain"), ("b", "Beta", "r", "no rank"), ("a", "Alpha", "r", "phylum"), ("c", "Cee", "b", "species"), ("c", "Cee", "a", "species"), ("r", "Root", "c", "domain")],
        "id string, label string, parent_id string, rank string")
    rows = hierarchy.tree_rows(nodes.where("coalesce(parent_id, '') <> 'c'"), "r").orderBy("path").collect()
    assert [(r.id, r.depth) for r in rows] == [("r", 0), ("a", 1), ("c", 2), ("b", 1), ("c", 2)]
    assert {r.id for r in hierarchy.tree_rows(nodes, "r", 1).collect()} == {"r", "a", "b"}
    chain = spark.createDataFrame([("k", "Kay", None, "kingdom"), ("n", "En", "k", "no rank"), ("s", "Es", "n", "species")], "id string, label string, parent_id string, rank string")
    got = {r.id: (r.path, r.lineage) for r in hierarchy.lineages(chain, ["kingdom", "species"]).collect()}
    assert got == {"k": ("Kay", ""), "n": ("Kay", "Kay"), "s": ("Kay > Es", "Kay; En")}
    assert {r.id: r.level for r in hierarchy.rank_filter(chain, ["species", "kingdom"]).collect()} == {"s": 0, "k": 1}
    capped = spark.createDataFrame([("x", 9, [], []), ("y", 2, ["x", "z"], ["x", "z", "y"]), ("z", 6, None, None)], "id string, level int, parents array<string>, refs array<string>")
    assert {r.id: (r.parent_id, r.refs) for r in hierarchy.depth_capped(capped, 6).collect()} == {"y": ("z", ["z", "y"]), "z": (None, [])}


def test_envelope(spark):
    rows = spark.createDataFrame([("P & Q", "S", "Turbines", "Blade"), ("P & Q", "S", "Turbines", None), ("P & Q", "T", "Turbines", "Blade"), ("P & Q", None, "X", "Y")], "p string, s string, t string, u string")
    got = {r.envelope_id: r for r in hierarchy.envelope(rows, "org", "v1", [("p", "program"), ("s", "sub"), ("t", "tech")], ("u", "part"), ["Turbines"]).collect()}
    assert {k: r.pub_count for k, r in got.items()} == {"org:L0:p_and_q": 4, "org:L1:s": 2, "org:L1:t": 1, "org:L2:turbines": 2, "org:L3:turbines_blade": 2}
    assert got["org:L3:turbines_blade"].full_path == "P & Q > S > Turbines > Blade" and got["org:L3:turbines_blade"].parent_id == "org:L2:turbines"


def test_ingest(spark, tmp_path):
    wide = spark.createDataFrame([("u1", " a, ,b ", "12", 2), ("u1", "c", "x", 1), (None, "d", "1", 1), ("u2", " ", "1.5", 1)], "UT string, DE string, TC string, k int")
    got = {r.key: r for r in normalize.rename_dedup(wide, {"UT": "key", "DE": "words", "TC": "cited"}, "UT", ["k"], ["words"], ["cited"]).collect()}
    assert (got["u1"].words, got["u1"].cited, got["u2"].words, got["u2"].cited) == (["c"], None, None, None) and len(got) == 2
    whole, failed = normalize.assemble({"a": lambda: wide.select("UT"), "b": lambda: spark.read.parquet(str(tmp_path / "none")), "c": lambda: wide.select("k")}, "v2")
    assert failed == ["b"] and whole.count() == 8 and whole.columns == ["UT", "k", "version"]
    kw = spark.createDataFrame([("1", "A"), ("2", "B")], "id string, source string")
    assert parquet.read_parquet(spark, parquet.export_parquet(kw, str(tmp_path), "A")).collect() == kw.where("source = 'A'").collect()
    merged = normalize.alias_merge(spark.createDataFrame([(1, ["x", "y"], "old"), (2, None, "kept")], "id int, aliases array<string>, definition string"),
                                   spark.createDataFrame([(1, ["z", "x"], "new")], "id int, aliases array<string>, definition string"), "id")
    assert {r.id: (r.aliases, r.definition) for r in merged.collect()} == {1: (["x", "y", "z"], "new"), 2: ([], "kept")}


def test_grant_spans(spark):
    own = "Supported by NSF Award No. 7654321, FEDERAL R21 - AB - 123456; DE-SC0012345; 80NSSC21K1234. DFG: 123456789. NSERC grant 12345-2020. Award number: AB-1234/5. funded by them (ZX-99999)."
    df = spark.createDataFrame([(1, own), (2, "7654321 then 7654321"), (3, None), (4, "")], "doc_id long, text string")
    rows = text.grants(df, "doc_id", "text").orderBy("doc_id", "start").collect()
    found = [(r.number, r.pattern_name) for r in rows if r.doc_id == 1]
    assert found == [("7654321", "NSF Award"), ("R21AB123456", "NIH Grant"), ("DE-SC0012345", "DOE Award"), ("80NSSC21K1234", "NASA Award"), ("123456789", "DFG Project"),
                     ("12345-2020", "NSERC Grant"), ("AB-1234/5", "Generic Grant"), ("ZX-99999", "Funded Reference")]
    for r in rows:
        if r.doc_id == 1:
            assert r.number.replace("-", "") in own[r.start : r.end].replace(" ", "").replace("-", "")
    assert [(r.start, r.end) for r in rows if r.doc_id == 2] == [(0, 7)] and len(rows) == 9


def test_vocabulary(spark):
    docs = spark.createDataFrame([(1, "Solar energy and wind-power. solar ENERGY"), (2, "wind-power, the sun"), (3, None)], "doc_id long, text string")
    labels = spark.createDataFrame([("solar energy",), ("wind-power",), ("sun",), ("and wind-power",), ("energy and wind-power solar",)], "label string")
    got = {r.label: r.documents for r in text.vocabulary_matches(docs, "doc_id", "text", labels, 4, 1).collect()}
    assert got == {"solar energy": 1, "wind-power": 2, "and wind-power": 1, "energy and wind-power solar": 1}
    assert {r.label for r in text.vocabulary_matches(docs, "doc_id", "text", labels, 2, 1, single=False).collect()} == {"solar energy", "and wind-power"}
    tagged = text.add_tags(spark.createDataFrame([("Sun", ["a"]), ("Moon", ["b"]), ("Sun", None)], "label string, tags array<string>"), spark.createDataFrame([("sun", "pub_freq:2")], "label string, tag string"))
    assert sorted((r.label, r.tags) for r in tagged.where("tags IS NOT NULL").collect()) == [("Moon", ["b"]), ("Sun", ["a", "pub_freq:2"])]


def test_classes(spark):
    df = spark.createDataFrame([("Coal", None), ("shale (gas)", "X"), ("other", "Physics"), ("other", "Big Physics"), (None, None)], "label string, category string")
    rule = senses.classify_keyword("label", "category", {"coal": ["coal"]}, [("gas", ["(gas)"])], {"Physics": "phys"}, [("phys2", ["physics"])], "rest")
    assert [r[0] for r in df.select(rule).collect()] == ["coal", "gas", "phys", "phys2", "rest"]
    subjects = spark.createDataFrame([("A", "M", "S"), ("B", "N", "S")], "subject string, main string, sub string")
    gaps = spark.createDataFrame([("a", "M", "Z"), ("Energy & Fuels", "M", "Z"), ("C", "M", "Z"), ("D", "Q", "Z")], "subject string, main string, sub string")
    got = {r.subject: r.discipline for r in normalize.category_lookup(subjects, gaps, {("M", "S"): "ms"}, {"M": "m"}, {"fossil": ["energy & fuels"]}, "general").collect()}
    assert got == {"A": "ms", "B": "general", "Energy & Fuels": "fossil", "C": "m", "D": "general"}
    s = spark.createDataFrame([("Nature", "journal", "x"), ("nature", "lab", "x")], "label string, source string, discipline string")
    pubs = spark.createDataFrame([("Nature ", "P"), ("Nature", "P"), ("Nature", "Q"), (None, "Q")], "journal string, category string")
    found = senses.journal_disciplines(pubs, lambda label, category: F.concat(F.lit("of "), category))
    assert {r.source: r.discipline for r in senses.update_disciplines(s, found, ["journal"]).collect()} == {"journal": "of P", "lab": "x"}


def test_quota_sample(spark):
    """Each stratum gives its quota, a small one all it has, and the rest is filled in order."""
    from vocabloom.operators import validation

    df = spark.createDataFrame([(i, "a") for i in range(20)] + [(100 + i, "b") for i in range(2)] + [(200 + i, None) for i in range(9)], "k long, g string")
    got = [r.k for r in validation.quota_sample(df, [F.col("g")], "k", 16, F.col("k")).collect()]
    assert sorted(got) == [*range(9), 100, 101, *range(200, 205)] and len(validation.quota_sample(df, [F.col("g")], "k", 99).collect()) == 31
