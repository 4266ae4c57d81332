import numpy as np
import pytest
from pyspark.sql import functions as F

from vocabloom.operators import concepts, edges, flows, senses, validation, vectors
from vocabloom.sources import scans


def lines(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def test_keyword_csv(spark, tmp_path):
    f = tmp_path / "k.csv"
    f.write_text('"Keyword Version: 23.7"\n"Category","Topic","Term","UUID"\n"EARTH SCIENCE","ATMOSPHERE","A, B","u1"\n\n"EARTH SCIENCE","","","u2"\n')
    got = {r.UUID: (r.Category, r.Topic, r.Term) for r in scans.read_csv(spark, str(f)).collect()}
    assert got["u1"] == ("EARTH SCIENCE", "ATMOSPHERE", "A, B") and set(got) == {"u1", "u2"}
    assert scans.hierarchy_columns(["Category", "Short_Name", "Long_Name", "UUID"]) == ["Category"]
    f.write_text("one line\n")
    assert scans.read_csv(spark, str(f)).count() == 0


def test_triples(spark):
    s = "http://www.w3.org/2004/02/skos/core#"
    given = lines(
        spark, f'<http://x/1> <{s}prefLabel> "Wissenschaft"@de .', f'<http://x/1> <{s}prefLabel> "Science \\"x\\" \\\\"@en .', f'<http://x/1> <{s}note> "a note" .',
        f'<http://x/1> <{s}scopeNote> "a scope" .', f"<http://x/2> <{s}broader> <http://x/1> .", f'<http://x/2> <{s}prefLabel> "Astronomy"@en .', f"<http://x/2> <{s}exactMatch> <http://y/2> .",
        "broken", "", None, '<http://x/1> <http://other> "z" .',
    )
    t = scans.skos_triples(scans.parse_triples(given))
    got = {r.subject: r for r in concepts.triples_to_concepts(t).collect()}
    assert got["http://x/1"].label == 'Science "x" \\' and got["http://x/1"].definition == "a scope"
    assert got["http://x/2"].broader == ["http://x/1"] and got["http://x/2"].definition is None
    assert [tuple(r) for r in concepts.skos_matches(t.union(t)).collect()] == [("http://x/2", "http://y/2", "exact", 1.0)]


def test_skos_file(spark, tmp_path):
    f = tmp_path / "v.rdf"
    f.write_text(
        '<rdf:RDF xmlns:rdf="http://www.w3.org/1999/02/22-rdf-syntax-ns#" xmlns:skos="http://www.w3.org/2004/02/skos/core#">'
        '<skos:Concept rdf:about="http://v/1"><skos:prefLabel xml:lang="en">Education</skos:prefLabel><skos:prefLabel xml:lang="es">Educación</skos:prefLabel></skos:Concept>'
        '<skos:Concept rdf:about="http://v/2"><skos:prefLabel xml:lang="fr">Seul</skos:prefLabel><skos:broader rdf:resource="http://v/1"/></skos:Concept></rdf:RDF>'
    )
    c = scans.read_skos(spark, str(f))
    got = {r.uri: tuple(r) for r in c.select("uri", concepts.text_in("pref_labels", "en"), concepts.text_any("pref_labels", "uri"), F.array_join("broader", ",")).collect()}
    assert got == {"http://v/1": ("http://v/1", "Education", "Education", ""), "http://v/2": ("http://v/2", None, "Seul", "http://v/1")}


def test_dumps(spark):
    n = scans.parse_nodes(lines(spark, "1\t|\t1\t|\tno rank\t|\tx\t|", "2\t|\t1\t|\tphylum\t|\tx\t|", "bad", None))
    assert {(r.tax_id, r.parent_id, r["rank"]) for r in n.collect()} == {("1", None, "no rank"), ("2", "1", "phylum")}
    names = scans.parse_names(lines(spark, "2\t|\tBacteria\t|\t\t|\tscientific name\t|", "2\t|\tMonera\t|\t\t|\tsynonym\t|", "3\t|\tX\t|\t\t|\tsynonym\t|"))
    assert [(r.tax_id, r.label, r.aliases) for r in names.collect()] == [("2", "Bacteria", ["Monera"])]


def test_entities_and_records(spark):
    topic = '{"id":"https://o/T1","display_name":"Marine","domain":{"id":"d/1","display_name":"Life"},"field":{"id":"f/12","display_name":"Eco"},"subfield":{"id":"s/5","display_name":"Aqua"},"keywords":["coral reefs","marine"," "]}'
    other = '{"id":"https://o/T2","display_name":"Reefs","keywords":["Coral Reefs"]}'
    e = scans.parse_json(lines(spark, topic, other, "no json", None), scans.ENTITY_JSON)
    rows = {r.id: r for r in concepts.entity_rows(e, "topic").collect()}
    assert rows["T1"].full_path == "Life > Eco > Aqua > Marine" and rows["T1"].parent_id == "5" and rows["T1"].level == 3
    assert [(r.label, r.parent_id) for r in concepts.topic_keywords(e).collect()] == [("coral reefs", "T1")]
    r = scans.parse_json(lines(spark, '{"DOI":"10.1/A","title":["t"],"issued":{"date-parts":[[2001,2]]}}', '{"DOI":"10.1/a","title":["t"],"issued":{"date-parts":[[2001,2]]}}', "{}"), scans.RECORD_JSON)
    assert [tuple(x) for x in scans.slim_records(r).collect()] == [("10.1/a", "t", 2001)]
    w = scans.parse_json(lines(spark, '{"id":"a/W1","display_name":"w","topics":[{"id":"a/T1","display_name":"x"},{"id":"a/T2","display_name":"y"}]}'), scans.WORK_JSON)
    assert scans.work_summary(w.union(w)).first()["topic_ids"] == "T1;T2" and scans.work_summary(w.union(w)).count() == 1


def test_vectors(spark):
    rng = np.random.default_rng(1)
    m = rng.normal(size=(60, 6))
    rows = [(i, v.tolist(), i % 3) for i, v in enumerate(m)] + [(98, [0.0] * 6, 0), (99, None, None)]
    df = spark.createDataFrame(rows, "id long, v array<double>, label int")
    u = m / np.linalg.norm(m, axis=1, keepdims=True)
    c = u @ u.T
    want = {(i, j) for i in range(60) for j in range(60) if i != j and i % 10 == 0 and c[i, j] >= 0.3}
    got = vectors.similar(df.where("id % 10 = 0"), df, "id", "v", 0.3)
    assert {(r.source, r.target) for r in got.collect()} == want
    best = {r.source: r.target for r in vectors.nearest(df.where("id % 10 = 0"), df, "id", "v", -1.0).collect()}
    assert best == {i: int(np.argmax(np.where(np.arange(60) == i, -9, c[i]))) for i in range(0, 60, 10)}
    p = np.array([r.coordinates for r in vectors.principal_components(df.where("id < 60"), "id", "v").orderBy("id").collect()])
    _, _, vt = np.linalg.svd(m - m.mean(0))
    np.testing.assert_allclose(np.abs(p), np.abs(m @ vt[:3].T), atol=1e-8)
    for f in (vectors.similar, vectors.nearest):
        assert f(df.limit(0), df.limit(0), "id", "v", 0.3).count() == 0
    assert vectors.principal_components(df.limit(0), "id", "v").count() == 0
    assert vectors.centroid_assign(df.where("id < 60"), "id", "v", "label").count() == 60


def test_links_entities_and_positions(spark):
    s = spark.createDataFrame([("s1", "artificial intelligence", "cs", 0.9), ("s2", "energy", "eng", 0.8), ("s3", "solar cell", "eng", 0.95)], "sense_id string, label string, discipline string, confidence double")
    o = spark.createDataFrame([("o1", "AI", "cs"), ("o2", "green energy", "eng"), ("o3", "solar", "bio"), ("o4", "zzz", "eng"), ("o5", "zzz", "bio"), ("o6", "AI tools", "bio")], "sense_id string, label string, discipline string")
    ab = spark.createDataFrame([("ai", "Artificial Intelligence")], "short string, full string")
    got = {r.source_sense_id: (r.target_sense_id, r.confidence) for r in edges.orphan_links(o, s, ab).collect()}
    assert got == {"o1": ("s1", 0.85), "o2": ("s2", 0.6), "o3": ("s3", 0.55), "o4": ("s3", 0.3), "o6": ("s1", 0.7)}
    names = spark.createDataFrame([("N.S.F.",), ("nsf",), ("D O E",), (None,)], "name string")
    known = spark.createDataFrame([("DOE", "Department of Energy")], "variant string, canonical string")
    assert {tuple(r) for r in senses.resolve_entities(names, known).collect()} == {("N.S.F.", "N.S.F."), ("nsf", "N.S.F."), ("D O E", "Department of Energy")}
    ix = spark.createDataFrame([("energy", 1.0, 1.0), ("solar cell", 3.0, 5.0)], "label string, x double, y double")
    tp = spark.createDataFrame([(1, "Solar cell"), (1, "wind energy"), (2, "none")], "pub int, topic string")
    assert {tuple(r) for r in flows.paper_positions(tp, ix).collect()} == {(1, 2.0, 3.0, 2), (2, 2.0, 3.0, 0)}
    e = spark.createDataFrame([("a", "c", "s", 0.5), ("b", "c", "s", 0.5), ("b", "c", "s", 0.1), ("a", "d", "s", 1.0)], "expert string, category string, source string, confidence double")
    assert {(r.category, r.experts): r.confidence for r in validation.consensus(e).collect()} == pytest.approx({("c", 2): 0.75, ("d", 1): 1.0})
