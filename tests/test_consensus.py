"""Consensus of experts against plain sums; samples by quota; grants with Unicode blanks."""

from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from vocabloom.operators import consensus, quality, text, validation


def plain(votes, rounds, smooth):
    labels = sorted({v[2] for v in votes})
    items = sorted({v[0] for v in votes})
    belief = {i: defaultdict(float) for i in items}
    for i, _, x in votes:
        belief[i][x] += 1
    belief = {i: {c: n / sum(b.values()) for c, n in b.items()} for i, b in belief.items()}
    confusion = None
    for _ in range(rounds):
        w = defaultdict(lambda: defaultdict(float))
        for i, r, x in votes:
            for c, p in belief[i].items():
                w[r, c][x] += p
        prior = {c: sum(b.get(c, 0) for b in belief.values()) for c in labels}
        confusion = {(r, c, x): (w[r, c].get(x, 0) + smooth) / (sum(w[r, c].values()) + smooth * len(labels)) for r, c in w for x in labels}
        new = {}
        for i in items:
            logs = {c: np.log(prior[c]) + sum(np.log(confusion[r, c, x]) for j, r, x in votes if j == i) for c in belief[i]}
            e = {c: np.exp(v - max(logs.values())) for c, v in logs.items()}
            new[i] = {c: v / sum(e.values()) for c, v in e.items()}
        belief = new
    return belief, confusion


def test_consensus_equals_plain_sums(spark):
    rng = np.random.default_rng(3)
    truth = rng.choice(["a", "b", "c"], 60, p=[0.6, 0.3, 0.1])
    good = lambda t: t if rng.random() < 0.9 else "b"
    bad = lambda t: t if rng.random() < 0.4 else "a"
    votes = [(i, r, f(str(t))) for i, t in enumerate(truth) for r, f in (("good", good), ("bad", bad), ("worse", bad)) if rng.random() < 0.9]
    votes += votes[:3]  # a vote that is cast twice counts twice
    df = spark.createDataFrame([*votes, (None, "good", "a"), (1, None, "a"), (1, "good", None)], "item long, rater string, label string")
    beliefs, confusions = consensus.consensus(df, 3)
    want, confusion = plain(votes, 3, consensus.SMOOTH)
    got = {(r["item"], r["class"]): r["p"] for r in beliefs.collect()}
    assert got == pytest.approx({(i, c): p for i, b in want.items() for c, p in b.items()}, abs=1e-9)
    for r in confusions.collect():
        assert r["p"] == pytest.approx(confusion[r["rater"], r["class"], r["label"]], rel=1e-9)
    skill = {r["rater"]: r["skill"] for r in consensus.skills(confusions).collect()}
    assert skill["good"] > skill["bad"] and skill["good"] > skill["worse"]
    assert consensus.best_class(beliefs).count() == len(want)
    assert consensus.best_class(consensus.consensus(df.limit(0), 1)[0]).collect() == []


def test_one_stratum_with_all_rows_is_sampled_as_a_plain_order(spark):
    df = spark.range(5000).select("id", F.when(F.col("id") < 4990, "a").otherwise("b").alias("s"))
    for n in (7, 30):
        got = {r["id"] for r in validation.quota_sample(df, [F.col("s")], "id", n, -F.col("id")).collect()}
        quota = n // 2
        b = list(range(4999, 4989, -1))[:quota]
        a = list(range(4989, -1, -1))[:quota]
        rest = [i for i in range(4999, -1, -1) if i not in a and i not in b][: n - len(a) - len(b)]
        assert got == {*a, *b, *rest}


@pytest.mark.parametrize("given, want", [
    ("grant no. 123456 was", [("123456", "EU", 0, 16)]),
    ("Deutſche Forschungsgemeinschaft: 1234567", [("1234567", "NSF", 33, 40)]),
    ("project ٤٤٤٤٤٤ ends", [("٤" * 6, "EU", 0, 14)]),
    ("R01 GM 123456; R01-GM-123456", [("R01GM123456", "NIH", 0, 13)]),
    ("\U0001d4b3 DE-FE0031234", [("DE-FE0031234", "DOE", 2, 14)]), ("no number at all", []), ("", []),
])
def test_grants_beyond_ascii(spark, given, want):
    rows = text.grants(spark.createDataFrame([(1, given), (2, None)], "doc_id long, text string"), "doc_id", "text").collect()
    assert [(r["number"], r["agency"], r["start"], r["end"]) for r in rows] == want


def test_a_source_is_in_order_of_its_paths(spark):
    df = spark.createDataFrame([("1", "b", "A > b", "s"), ("2", "a", "B > a", "s"), ("3", "c", "A > a", "s"), ("4", "x", "0", "t")], "id string, label string, full_path string, source string")
    assert [r["id"] for r in quality.by_source(df, "s").collect()] == ["3", "1", "2"]
    assert [r["id"] for r in quality.by_source(df.drop("full_path"), "s").collect()] == ["2", "1", "3"]
