"""Common lines: the operator against a plain count, and the perfect hash against a dictionary."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from vocabloom.llm import line_dedup
from vocabloom.llm.line_dedup import BLANKS, Shard, drop_common_lines


def plain(texts, least):
    keys = lambda t: [x.strip(BLANKS).lower() for x in (t or "").encode().split(b"\n")]
    seen = {}
    for t in texts:
        for k in set(keys(t)):
            seen[k] = seen.get(k, 0) + 1
    out = []
    for t in texts:
        lines = (t or "").encode().split(b"\n")
        kept = [x for x, k in zip(lines, keys(t)) if not k or seen[k] < least]
        out.append((len(lines), len(lines) - len(kept), hashlib.sha256(b"\n".join(kept)).hexdigest()))
    return out


def rows(df):
    return sorted(tuple(r) for r in df.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256)).collect())


def test_equals_plain_count(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "CHUNK_BYTES", 300)
    rng = np.random.default_rng(3)
    pool = ["Share THIS page", " share this page\t", "é ", " é", "", "  ", "x" * 5000, "ÀB", "Àb", *(f"line {k}" for k in range(60))]
    texts = ["\n".join(rng.choice(pool, rng.integers(1, 9))) for _ in range(200)] + [None, "", "\n\n", "Share this page"]
    df = spark.createDataFrame([(k, t, "c", b"h") for k, t in enumerate(texts)], "doc_id long, text string, chunk string, hits binary").repartition(5)
    for least in (1, 3, 10):
        assert rows(drop_common_lines(df, least)) == sorted((k, *x) for k, x in enumerate(plain(texts, least)))


def test_repeats_nulls_and_empty_table(spark):
    texts = [(1, "a\na\na"), (1, "a"), (None, "a\nb"), (None, None)]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    got = sorted(map(tuple, drop_common_lines(df, 3).collect()), key=repr)
    assert got == sorted([(1, "", 3, 3), (1, "", 1, 1), (None, "b", 2, 1), (None, "", 1, 0)], key=repr)
    assert drop_common_lines(df, 4).where("n_dropped > 0").isEmpty()  # three documents have it, one of them thrice
    assert drop_common_lines(df.limit(0)).collect() == []


@pytest.mark.parametrize("n", [0, 1, 2, 50_000])
def test_perfect_hash_is_minimal(n):
    words = np.random.default_rng(n).integers(0, 2**63, (n, 2), dtype=np.int64).astype(np.uint64)
    words = np.unique(words, axis=0)
    counts = np.arange(1, len(words) + 1)
    shard = Shard.build(words, counts)
    assert sorted(shard.places(words).tolist()) == list(range(len(words)))
    again = Shard.of_row({k: v.to_pylist()[0] for k, v in shard.row().items()})
    assert (again.probe(words) == counts).all()
    strangers = words ^ np.uint64(1 << 20)
    known = {tuple(w) for w in words.tolist()}
    assert all(c == 0 for w, c in zip(strangers.tolist(), again.probe(strangers).tolist()) if tuple(w) not in known)
    assert n < 1000 or len(again.bits) < 5 * n
