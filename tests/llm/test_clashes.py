"""Names, ids and sessions that stages must bear."""

import os
import subprocess
import sys
from pathlib import Path

from vocabloom.llm.exact_dedup import exact_dedup, keep_first_copies
from vocabloom.llm.licences import sample_paragraphs
from vocabloom.llm.simhash_neardup import keep_one_of_each

LEAST = -(2**63)


def test_columns_of_the_stages_own_names(spark):
    text = " ".join(f"w{k}" for k in range(60))
    rows = [(1, text, 1, 2, 3, 4), (2, text + " x", 1, 2, 3, 4), (3, "other", None, None, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, _gone int, _kept_key int, _kept_digest int, _id int")
    assert {r["doc_id"] for r in keep_one_of_each(df).collect()} == {1, 3}
    assert {r["doc_id"] for r in keep_first_copies(df).collect()} == {1, 2, 3}
    assert keep_first_copies(df).columns == df.columns
    assert sorted(sample_paragraphs(df)) == sorted([text, text + " x", "other"])


def test_smallest_id(spark):
    df = spark.createDataFrame([(LEAST, "a b"), (5, "ab"), (7, "ba"), (None, "ab ")], "doc_id long, text string")
    got = {r["doc_id"]: (r["keep_id"], r["kept"]) for r in exact_dedup(df).collect()}
    assert got == {LEAST: (LEAST, True), 5: (LEAST, False), 7: (7, True), None: (LEAST, False)}


def test_a_repeated_id_gives_one_sampled_text(spark):
    df = spark.createDataFrame([(1, f"line {k}\nmore") for k in range(500)] + [(2, "two")], "doc_id long, text string")
    assert sorted(sample_paragraphs(df, 2)) == ["line 0", "more", "two"]


def test_a_stage_first_in_a_session(tmp_path):
    root = Path(__file__).resolve().parents[2]
    code = (
        f"import sys; sys.path.insert(0, {str(root)!r})\n"
        "from pyspark.sql import SparkSession\n"
        "s = SparkSession.builder.master('local[2]').config('spark.sql.shuffle.partitions', '2').config('spark.ui.enabled', 'false').getOrCreate()\n"
        "from vocabloom.llm.simhash_neardup import keep_one_of_each\n"
        "d = s.createDataFrame([(1, 'a b'), (2, 'a c')], 'doc_id long, text string')\n"
        "print('kept', keep_one_of_each(d).count())\n"
    )
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=170)
    assert "kept 2" in done.stdout, done.stderr[-2000:]
