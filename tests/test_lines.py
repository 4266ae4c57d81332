"""Lines of files in a repeatable order, versions of keyword files, and broken lines with their reasons."""

from vocabloom.operators.concepts import triples_to_concepts
from vocabloom.sources import scans

SKOS = scans.SKOS


def test_first_labels_are_the_same_however_files_are_split(spark, tmp_path):
    lines = [[f'<http://x/{k % 7}> <{SKOS}prefLabel> "label {f} {k}"@fr .' for k in range(200)] for f in range(3)]
    for f, some in enumerate(lines):
        (tmp_path / f"{f}.nt").write_text("\n".join(some) + "\n")
    paths = [str(tmp_path / f"{f}.nt") for f in (2, 0, 1)]
    found, most = [], "spark.sql.files.maxPartitionBytes"
    before, cost = spark.conf.get(most), spark.conf.get("spark.sql.files.openCostInBytes")
    try:
        for size in ("1000", "3500", "128m"):
            spark.conf.set(most, size)
            spark.conf.set("spark.sql.files.openCostInBytes", "100")
            triples = scans.skos_triples(scans.parse_triples(scans.read_lines(spark, paths)))
            found.append({r["subject"]: r["label"] for r in triples_to_concepts(triples).collect()})
    finally:
        spark.conf.set(most, before)
        spark.conf.set("spark.sql.files.openCostInBytes", cost)
    assert found[0] == found[1] == found[2] == {f"http://x/{k}": f"label 0 {k}" for k in range(7)}


def test_versions(spark, tmp_path):
    texts = {"a": '"Keyword Version: 23.7","Revision: x"\n"Category","Topic","UUID"\n"E","O","1"\n"E","","2"\n', "b": "Hits: 3\nCategory,UUID\n\"F\",\"3\"\n", "c": "Keyword Version: 9\nCategory,UUID\n"}
    paths = []
    for name, text in texts.items():
        (tmp_path / name).write_text(text)
        paths.append(str(tmp_path / name))
    got = {r["UUID"]: (r["Category"], r["Topic"] or None, r["version"]) for r in scans.read_versioned_csv(spark, paths).collect()}
    assert got == {"1": ("E", "O", "Keyword Version: 23.7"), "2": ("E", None, "Keyword Version: 23.7"), "3": ("F", None, None)}
    of_file = {r["file"].rpartition("/")[2]: r["version"] for r in scans.file_versions(scans.read_lines(spark, paths)).collect()}
    assert of_file == {"a": "Keyword Version: 23.7", "b": None, "c": "Keyword Version: 9"}
    assert scans.read_versioned_csv(spark, paths[2:]).collect() == []


def test_broken_lines_have_reasons(spark, tmp_path):
    lines = {
        '<a> <b> <c> .': None, '<a> <b> "x \\" y"@en .': None, "# remark": None, "": None, '<a> <b> "x"': "end", '<a> <b> "x .': "object", "<a> b <c> .": "predicate", "a <b> <c> .": "subject", '<a> <b> "x" "y" .': "end",
    }
    (tmp_path / "x.nt").write_text("\n".join(lines))
    read = scans.read_lines(spark, str(tmp_path / "x.nt"))
    assert {r["value"]: r["reason"] for r in scans.broken_triples(read).collect()} == {k: v for k, v in lines.items() if v}
    assert scans.parse_triples(read).count() == 2
