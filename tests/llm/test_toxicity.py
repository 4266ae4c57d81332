import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from vocabloom.llm import toxicity


@pytest.fixture(scope="module")
def corpus(spark):
    rows = [(i, f"The wörd{i} river{i * 7 % 11}, 日本{i} the" + (" 'Snark!' grim" if i % 5 == 0 else " stone")) for i in range(60)] + [(99, None), (98, "")]
    marks = [(i, int(i % 5 == 0)) for i in range(60)] + [(99, 1), (98, 0), (5, 0), (6, None)]
    return (
        spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(marks, "doc_id long, toxic int"), rows,
    )


def brute_force(rows):
    """Words, and the models' log ratio of each, by the formula of the module."""
    count = {}
    for i, text in rows:
        for w in {x.strip(toxicity.EDGES) for x in (text or "").lower().split()} - {""}:
            count.setdefault(w, [0, 0])[int(i % 5 == 0)] += 1
    n, kinds = ([sum(c[k] for c in count.values()) for k in (0, 1)], [sum(c[k] > 0 for c in count.values()) for k in (0, 1)])
    every, evidence = sum(n), {}

    def probability(c, k, share):
        prior = toxicity.DISCOUNT * kinds[k] + toxicity.TRUST * every
        return (max(c - toxicity.DISCOUNT, 0) + prior * share) / (n[k] + toxicity.TRUST * every)

    for w, c in count.items():
        share = sum(c) / every
        neutral = probability(0, 1, share) / probability(0, 0, share)
        evidence[w] = math.log(probability(c[1], 1, share) / probability(c[0], 0, share) / neutral)
    return count, evidence


def test_models_are_the_formula(corpus):
    """Every word of every labelled row counts, whatever the bound on the rows of the curve, and its evidence is the models' ratio."""
    docs, labels, rows = corpus
    model = toxicity.fit(docs, labels, F.lit(True), per_class=2)
    curve = {r[0] for r in docs.where(F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(4)) == 0).select("doc_id").collect()}
    count, evidence = brute_force([r for r in rows if r[0] not in curve and r[0] < 60])
    table = toxicity.load(model.path)
    assert len(table.keys) == len(count) == len(evidence) > 80
    for text in ("the river1 snark", "(Snark) stone unseen", "", "!!"):
        words = [w.strip(toxicity.EDGES) for w in text.lower().split()]
        each = np.array([evidence.get(w, 0.0) for w in words])
        got = toxicity.text_evidence(table, pa.array([text]))[0]
        strong = np.clip(each - toxicity.STRONG, 0, toxicity.STRONGEST)
        assert got == pytest.approx([each.sum() / max(1, len(words)), strong.sum() / max(1, len(words))], abs=1e-5)


def test_probabilities_sum_to_one(corpus):
    _, _, rows = corpus
    count, _ = brute_force(rows)
    every = sum(map(sum, count.values()))
    for k in (0, 1):
        n, kinds = sum(c[k] for c in count.values()), sum(c[k] > 0 for c in count.values())
        prior = toxicity.DISCOUNT * kinds + toxicity.TRUST * every
        total = sum(max(c[k] - toxicity.DISCOUNT, 0) + prior * sum(c) / every for c in count.values()) / (n + toxicity.TRUST * every)
        assert total == pytest.approx(1)


def test_score_does_not_grow_with_length(corpus):
    """A text said twice has the score of the text; equal texts have equal scores, whatever batch they are in."""
    docs, labels, _ = corpus
    model = toxicity.fit(docs, labels, F.lit(True))
    once = pa.array(["snark river1 the grim", "the stone river2"])
    twice = pa.array([t.as_py() + " " + t.as_py() for t in once])
    assert toxicity.score_texts(model, once) == pytest.approx(toxicity.score_texts(model, twice))
    many = toxicity.score_texts(model, pa.array([once[0].as_py(), "x" * 100_000, None, once[0].as_py()]))
    assert many[0] == many[3] == pytest.approx(toxicity.score_texts(model, once)[0])
