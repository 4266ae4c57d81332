"""Whitening: exact sums, the eigensolver and the scores against numpy and Python integers."""

from fractions import Fraction
from math import floor, inf, nan

import numpy as np
import pytest

from vocabloom.llm.whitening import contour, gram, inertia, leading, whitened


def plain(vectors, k):
    """By vector: deviation and absolute scores; then explained."""
    x = [tuple(floor(256 * float(np.float32(c))) for c in v) for v in vectors]
    fit = sorted(set(x))
    n, d = len(fit), len(fit[0])
    sums = [sum(v[i] for v in fit) for i in range(d)]
    y = np.array([[float(Fraction(n * v[i] - sums[i], n)) for i in range(d)] for v in fit])
    values, axes = np.linalg.eigh(y.T @ y / n)
    values, axes = values[::-1][:k], axes[:, ::-1][:, :k]
    of = {v: (sum((n * c - s) ** 2 for c, s in zip(v, sums)), np.abs(row @ axes / np.sqrt(values))) for v, row in zip(fit, y)}
    return n, [of[v] for v in x], values / (y**2).mean(axis=0).sum()


def table(spark, vectors):
    return spark.createDataFrame([(k, v, 0, 0.5) for k, v in enumerate(vectors)], "vec_id long, embedding array<float>, x int, n double").repartition(3)


@pytest.mark.parametrize("offset", [0.0, 40_000.0])
def test_equals_plain_components(spark, offset):
    rng = np.random.default_rng(5)
    vectors = ((rng.standard_normal((300, 12)) * np.linspace(3, 0.5, 12)) @ rng.standard_normal((12, 12)) + offset).astype(np.float32).tolist()
    vectors += [vectors[0]] * 200  # a frequent vector counts once
    n, want, explained = plain(vectors, 4)
    got = whitened(table(spark, vectors)).collect()
    assert len(got) == 4 * len(vectors)
    for r in got:
        deviation, scores = want[r["vec_id"]]
        c = r["component"] - 1
        assert (r["n"], r["deviation"], int(r["deviation_exact"])) == (n, deviation, deviation)
        assert abs(r["whitened"]) == pytest.approx(scores[c], abs=1e-7 * (1 + scores[c]))
        assert r["explained"] == pytest.approx(explained[c], rel=1e-9) and r["identity_error"] < 1e-9
    signs = {(r["component"], r["whitened"] > 0) for r in got if r["vec_id"] in (0, 300)}
    assert len(signs) == 4  # one sign of a component for all rows


def test_rows_that_go_and_rows_without_variance(spark):
    good = [[1.0, 2.0], [3.0, -1.0], [0.5, 0.25]]
    odd = [None, [], [1.0, None], [nan, 1.0], [inf, 0.0], [1.0, 2.0, 3.0]]
    got = whitened(table(spark, good + odd)).collect()
    assert {r["vec_id"] for r in got} == {0, 1, 2} and {r["component"] for r in got} == {1, 2}
    for vectors in ([[1.0, 2.0]] * 3, [[0.0]]):
        got = whitened(table(spark, vectors)).collect()
        assert len(got) == len(vectors) * len(vectors[0])
        assert all(r["whitened"] is None and r["explained"] is None and r["identity_error"] is None and r["deviation"] == 0 for r in got)
    line = whitened(table(spark, [[1.0, 1.0], [2.0, 2.0], [3.0, 3.0]])).collect()
    assert all((r["whitened"] is None) == (r["component"] == 2) for r in line)
    assert whitened(table(spark, odd[:1])).collect() == []
    assert whitened(table(spark, good).limit(0)).collect() == []


def test_huge_entries(spark):
    vectors = [[1e15, -1e30], [-1e15, 1e30], [2.5e15, 3e38], [0.0, 0.0]]
    got = whitened(table(spark, vectors)).collect()
    x = [[min(max(floor(256 * float(np.float32(c))), -(2**63)), 2**63 - 1) for c in v] for v in vectors]
    sums = [sum(c) for c in zip(*x)]
    for r in got:
        want = sum((4 * c - s) ** 2 for c, s in zip(x[r["vec_id"]], sums))
        assert int(r["deviation_exact"]) == want and r["deviation"] is None and r["identity_error"] < 1e-4


def test_gram_is_exact():
    rng = np.random.default_rng(1)
    for bits in (5, 19, 30, 61):
        y = rng.integers(-(2**bits), 2**bits, (50, 4))
        assert (gram(y) == y.astype(object).T @ y.astype(object)).all()


def test_inertia_and_contour():
    rng = np.random.default_rng(2)
    for d in (1, 2, 7, 30):
        a = rng.standard_normal((d, d))
        a = a + a.T
        values = np.linalg.eigvalsh(a)
        for s in [*(values[:-1] + values[1:]) / 2, -100.0, 100.0]:
            assert inertia(a - s * np.eye(d)) == (values > s).sum()
    assert inertia(np.array([[0.0, 1.0], [1.0, 0.0]])) == 1 and inertia(np.zeros((3, 3))) == 0
    q, _ = np.linalg.qr(rng.standard_normal((40, 40)))
    spectrum = np.sort(np.concatenate([[5, 4, 4, 4, 3.999999], rng.uniform(0, 3.9, 35)]))[::-1]
    matrix = (q * spectrum) @ q.T
    matrix = (matrix + matrix.T) / 2
    values, axes = leading(matrix, 3)
    assert np.allclose(values, spectrum[:3], atol=1e-13) and np.allclose(matrix @ axes, axes * values, atol=1e-12)
    values, _ = contour(matrix, 3.99, 5.5, 5)
    assert np.allclose(values, spectrum[:5], atol=1e-13)
    with pytest.raises(ArithmeticError):
        contour(matrix, 3.99, 5.5, 4)
