"""The stored table and the resumable harvest, broken on purpose in between."""

import json

import pytest
from pyspark.sql import functions as F

from vocabloom.sources.store import KeywordTable
from vocabloom.streaming.batches import EdgeSink, harvest, reference_edges, works_stream

SCHEMA = "id string, label string, parent_id string, source string, aliases array<string>"


def records(spark, source, *ids):
    return spark.createDataFrame([(i, f"label {i}", source) for i in ids], "id string, label string, source string")


def rows_of(df):
    return sorted((r["source"], r["id"]) for r in df.collect())


def test_upsert_is_scoped_and_counts(spark, tmp_path):
    table = KeywordTable(spark, str(tmp_path / "kw"), SCHEMA)
    assert table.rows().collect() == [] and table.upsert(records(spark, "A")).collect() == []
    first = table.upsert(records(spark, "A", "a1").unionByName(records(spark, "B/x y", "b1")))
    assert {tuple(r) for r in first.collect()} == {("A", 1, 0, 1), ("B/x y", 1, 0, 1)}
    again = table.upsert(records(spark, "A", "a2", "a3"))
    assert [tuple(r) for r in again.collect()] == [("A", 2, 1, 1)]
    assert rows_of(table.rows()) == [("A", "a2"), ("A", "a3"), ("B/x y", "b1")]
    assert rows_of(table.rows("B/x y")) == [("B/x y", "b1")] and table.rows().schema == table.schema
    assert {tuple(r) for r in table.stats().collect()} == {("A", 2), ("B/x y", 1)}
    assert table.vacuum() == 1 and table.vacuum() == 0 and rows_of(table.rows()) == [("A", "a2"), ("A", "a3"), ("B/x y", "b1")]
    assert rows_of(KeywordTable(spark, str(tmp_path / "kw"), SCHEMA).rows("A")) == [("A", "a2"), ("A", "a3")]


def test_a_failed_write_changes_nothing(spark, tmp_path):
    table = KeywordTable(spark, str(tmp_path / "kw"), SCHEMA)
    table.upsert(records(spark, "A", "a1"))
    broken = records(spark, "A", "a2", "a3").withColumn("label", F.when(F.col("id") == "a3", F.raise_error(F.lit("stop"))).otherwise("x"))
    with pytest.raises(Exception, match="stop"):
        table.upsert(broken)
    with pytest.raises(ValueError, match="twice"):
        table.upsert(records(spark, "A", "a4", "a4"))
    with pytest.raises(ValueError, match="without a source"):
        table.upsert(records(spark, None, "a5"))
    assert rows_of(table.rows()) == [("A", "a1")] and table.log().count() == 1
    assert [tuple(r) for r in table.upsert(records(spark, "A", "a2", "a3")).collect()] == [("A", 2, 1, 1)]
    assert rows_of(table.rows()) == [("A", "a2"), ("A", "a3")]


def test_whole_table_replacement(spark, tmp_path):
    table = KeywordTable(spark, str(tmp_path / "kw"), SCHEMA)
    table.upsert(records(spark, "A", "a1").unionByName(records(spark, "B", "b1", "b2")))
    done = table.replace_all(records(spark, "A", "a2").withColumn("extra", F.lit(1)))
    assert {tuple(r) for r in done.collect()} == {("A", 1, 1, 0), ("B", 0, 2, -2)}
    assert rows_of(table.rows()) == [("A", "a2")]
    assert [tuple(r) for r in table.upsert(records(spark, "B", "b3")).collect()] == [("B", 1, 0, 1)]


def test_harvest_goes_on_where_it_broke(spark, tmp_path):
    works = tmp_path / "works"
    works.mkdir()

    def add(name, *rows):
        (works / name).write_text("\n".join(json.dumps({"id": f"https://x/W{i}", "referenced_works": [f"https://x/W{r}" for r in refs]}) for i, refs in rows))

    add("1.json", (1, [2, 3]), (2, [3]))
    add("2.json", (1, [2, 4]), (5, []))
    sink = EdgeSink(spark, str(tmp_path / "edges"), "citing string, cited string", ["citing", "cited"])
    runs = []

    def breaks_after_writing(batch, number, insert=sink.insert):
        insert(batch, number)
        runs.append(number)
        if len(runs) == 2:
            raise RuntimeError("lost between the write and the checkpoint")

    sink.insert = breaks_after_writing
    stream = lambda: works_stream(spark, str(works), 1)
    with pytest.raises(Exception, match="lost"):
        harvest(stream(), reference_edges, sink, str(tmp_path / "check"))
    add("3.json", (6, [1]), (2, [3]))
    harvest(stream(), reference_edges, sink, str(tmp_path / "check"))
    assert runs == [0, 1, 1, 2]  # the broken batch ran twice
    got = sorted(tuple(r) for r in sink.edges().collect())
    assert got == [("W1", "W2"), ("W1", "W3"), ("W1", "W4"), ("W2", "W3"), ("W6", "W1")]
    harvest(stream(), reference_edges, sink, str(tmp_path / "check"))
    assert len(runs) == 4 and sink.edges().count() == 5
