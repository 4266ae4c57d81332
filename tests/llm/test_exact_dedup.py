import pytest

from vocabloom.llm import exact_dedup

SCHEMA = "doc_id long, text string"


def test_reopened_with_other_partitions(spark, tmp_path):
    """An index keeps its own number of buckets, whatever the session that opens it."""
    path = str(tmp_path / "index")
    first = spark.createDataFrame([(i, f"text {i}") for i in range(200)], SCHEMA)
    again = spark.createDataFrame([(1000 + i, f"text  {i}") for i in range(200)], SCHEMA)
    index = exact_dedup.DigestIndex(spark, path, 8)
    assert exact_dedup.exact_dedup(first, index, "a").where("kept").count() == 200
    spark.sql(f"DROP TABLE {index.name}")  # a session with another catalog
    was = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", 3)
    try:
        index = exact_dedup.DigestIndex(spark, path)
        assert index.buckets == 8
        assert exact_dedup.exact_dedup(again, index, "b").where("kept").count() == 0
        assert index.rows().count() == 200 == index.rows().select("digest").distinct().count()
        with pytest.raises(ValueError, match="8 buckets"):
            exact_dedup.DigestIndex(spark, path, 3)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", was)


def test_failed_and_repeated_append(spark, tmp_path, monkeypatch):
    """A batch whose append failed, or that is added twice, is decided like one that was added once."""
    docs = spark.createDataFrame([(2, "b  b"), (1, "bb"), (3, "c"), (3, "c"), (None, "d")], SCHEMA)
    index = exact_dedup.DigestIndex(spark, str(tmp_path / "index"), 2)
    kept = exact_dedup.staged

    def broken(df, name):
        if name == "digest-new":
            raise RuntimeError("lost")
        return kept(df, name)

    monkeypatch.setattr(exact_dedup, "staged", broken)
    with pytest.raises(RuntimeError, match="lost"):
        exact_dedup.exact_dedup(docs, index, "a")
    monkeypatch.undo()
    want = [(None, True, 1), (1, False, 2), (2, True, 2), (3, False, 2), (3, True, 2)]
    for _ in "ab":
        rows = exact_dedup.exact_dedup(docs, index, "a").collect()
        assert sorted(((r.doc_id, r.kept, r.group_size) for r in rows), key=lambda r: (r[0] or 0, r[1])) == want
    assert index.rows().count() == 3
    with pytest.raises(ValueError, match="name"):
        exact_dedup.exact_dedup(docs, index)


def test_later_batch(spark, tmp_path):
    """The first batch settles a group: a longer text that comes later is not kept and the size stays."""
    index = exact_dedup.DigestIndex(spark, str(tmp_path / "index"), 2)
    exact_dedup.exact_dedup(spark.createDataFrame([(5, "ab")], SCHEMA), index, "a")
    later = exact_dedup.exact_dedup(spark.createDataFrame([(1, "a    b"), (2, "ab")], SCHEMA), index, "b").collect()
    assert all((r.keep_id, r.group_size, r.kept) == (5, 1, False) for r in later)


def test_heavy_groups(spark):
    """Groups above and below a thousandth of the rows, and rows that repeat id and text."""
    rows = [(i, "hot") for i in range(400)] + [(7, "hot")] * 3 + [(1000 + i, f"cold {i}") for i in range(1500)] + [(2000 + i, f"twin {i // 2}") for i in range(600)]
    out = exact_dedup.exact_dedup(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(out) == len(rows)
    hot = [r for r in out if r.keep_id == 0]
    assert len(hot) == 403 and {r.group_size for r in hot} == {403} and [r.doc_id for r in hot if r.kept] == [0]
    assert sum(r.kept for r in out) == 1 + 1500 + 300
