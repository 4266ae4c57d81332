"""Whitening of embeddings by the leading principal components, which a contour-integral eigensolver finds.

Entries become whole numbers, so Spark adds up an exact Gram matrix over the distinct vectors: each task centres its rows at a
whole number near the mean and multiplies blocks of them, and sums of entries are added by SQL. What reaches the driver is a
matrix of dimension x dimension. There :func:`leading` counts eigenvalues by the inertia of shifted matrices,
brackets the interval that holds the wanted ones, projects onto it by a quadrature of solves with complex shifts (FEAST),
extracts the components by Rayleigh-Ritz, and checks their number against the inertia count. Scores are a product in every task.

Defined results: rows with a null vector, or with a null or non-finite entry, go; so do rows of another length than the
commonest (of equals the greatest) one, and empty vectors. A null id is an id. An entry whose 256-fold lies beyond 64 bits becomes the nearest
64-bit number. Rows that repeat are scored each; n counts a vector once. Components without variance (one vector, constant or fewer
dimensions) have a null score; explained is null where nothing varies. deviation is null where it passes 64 bits; deviation_exact has its digits then too.
An empty table gives no rows. Only ``vec_id`` and ``embedding`` are read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vocabloom.llm._common import ship, staged, table

#: Components, and factor of an entry before it is rounded down.
COMPONENTS, SCALE = 4, 256
#: The driver holds one matrix of so many rows and columns at most (8 MB).
MOST_DIMS = 1024
#: Rows multiplied at once; bits of a limb, so that a block's sums of products of limbs stay below 2^53.
ROWS, LIMB = 4096, 20
#: Points of the quadrature on the upper half of the contour, rounds of it, and halvings of a bracket.
POINTS, ROUNDS, BISECTIONS = 8, 40, 24


def _whole(vector: Column) -> Column:
    """Entries times SCALE, rounded down, as 64-bit numbers."""
    return F.transform(vector, lambda x: F.floor(F.lit(float(SCALE)) * x))


def quantised(rows: DataFrame, key: str, vector: str) -> DataFrame:
    """(key, x) of the rows whose vector is whole: not null, no null or non-finite entry, and of the commonest length."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    v = rows[vector].cast("array<double>")
    good = rows.select(rows[key].alias(key), v.alias("_v")).where(F.col("_v").isNotNull() & (F.size("_v") > 0) & F.forall("_v", finite))
    length = good.groupBy(F.size("_v").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    return good.where(F.size("_v") == (length["d"] if length else 0)).select(key, _whole(F.col("_v")).alias("x"))


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, d)


def gram(y: np.ndarray) -> np.ndarray:
    """The exact product of y's transpose with y, as Python integers. y is cut into limbs of LIMB bits whose products doubles hold exactly."""
    limbs = []
    while np.abs(y).max(initial=0) >= 1 << LIMB:
        limbs.append((y & ((1 << LIMB) - 1)).astype(np.float64))
        y = y >> LIMB
    limbs.append(y.astype(np.float64))
    total = np.zeros((y.shape[1], y.shape[1]), object)
    for i, a in enumerate(limbs):
        for j, b in enumerate(limbs):
            total += (a.T @ b).astype(np.int64).astype(object) * (1 << LIMB * (i + j))
    return total


def moments(fit: DataFrame, d: int, sums: list[int], n: int) -> tuple[list[int], np.ndarray]:
    """The whole centre m of each dimension, and n * V * n, exact, for the distinct vectors ``fit``: a matrix of Python integers.

    With y = x - m it is n * sum(y y') - sum(y) sum(y)'. A task adds up its own part; halves of 64 bits are summed over the tasks.
    """
    centre = [(2 * s + n) // (2 * n) for s in sums]

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, any_rows = np.zeros((d, d), object), False
        for batch in batches:
            x = _matrix(batch.column("x"), d)
            for at in range(0, len(x), ROWS):
                block = x[at : at + ROWS]
                wide = np.abs(block.astype(np.float64)).max() + max(map(abs, centre)) >= 2.0**62
                total += gram(block.astype(object) - np.array(centre, object) if wide else block - np.array(centre, np.int64))
                any_rows = True
        i, j = np.triu_indices(d)
        values = total[i, j] if any_rows else np.zeros(0, object)
        for at in range(0, len(values), 1 << 14):
            some = values[at : at + (1 << 14)].tolist()
            yield pa.RecordBatch.from_arrays(
                [pa.array(i[at : at + len(some)]), pa.array(j[at : at + len(some)]), pa.array([v >> 64 for v in some], pa.decimal128(38)), pa.array([v & (2**64 - 1) for v in some], pa.decimal128(38))],
                names=["i", "j", "high", "low"],
            )

    added = fit.select("x").mapInArrow(parts, "i long, j long, high decimal(38,0), low decimal(38,0)").groupBy("i", "j").agg(F.sum("high").alias("high"), F.sum("low").alias("low"))
    rest = [s - n * m for s, m in zip(sums, centre)]
    out = np.zeros((d, d), object)
    for batch in added.toArrow().to_batches():  # d * (d + 1) / 2 rows
        for i, j, high, low in zip(*(c.to_pylist() for c in batch.columns)):
            out[i, j] = out[j, i] = n * ((int(high) << 64) + int(low)) - rest[i] * rest[j]
    return centre, out


def inertia(matrix: np.ndarray) -> int:
    """Positive eigenvalues of a symmetric matrix, by the signs of the pivots (of one or two rows) of its factorisation."""
    a, positive = matrix.copy(), 0
    while len(a):
        column = np.abs(a[:, 0])
        column[0] = 0
        r = int(column.argmax()) if len(a) > 1 else 0
        most, pivot = column[r], abs(a[0, 0])
        if most == 0 or pivot >= 0.6403882 * most:
            one = 0
        else:
            other = np.abs(a[:, r])
            other[r] = 0
            one = 0 if pivot * other.max() >= 0.6403882 * most**2 else r if abs(a[r, r]) >= 0.6403882 * other.max() else None
        if one is not None:
            a[[0, one]] = a[[one, 0]]
            a[:, [0, one]] = a[:, [one, 0]]
            p = a[0, 0]
            positive += p > 0
            a = a[1:, 1:] - (np.outer(a[1:, 0], a[0, 1:]) / p if p else 0)
        else:  # a pivot of two rows has one eigenvalue of each sign
            a[[1, r]] = a[[r, 1]]
            a[:, [1, r]] = a[:, [r, 1]]
            positive += 1
            a = a[2:, 2:] - a[2:, :2] @ np.linalg.solve(a[:2, :2], a[:2, 2:])
    return int(positive)


def contour(matrix: np.ndarray, low: float, high: float, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` eigenpairs in (low, high) of a symmetric matrix, in falling order.

    A random block is filtered by a Gauss-Legendre quadrature of the resolvent along the circle over the interval, and Rayleigh-Ritz
    takes the filtered block apart, until the residuals are those of rounding.
    """
    d, middle, radius = len(matrix), (low + high) / 2, (high - low) / 2
    nodes, weights = np.polynomial.legendre.leggauss(POINTS)
    turns = np.exp(0.5j * np.pi * (1 - nodes))  # the upper half; the lower one is its mirror image
    block = np.random.default_rng(7).standard_normal((d, min(d, 3 * count + 16)))
    for _ in range(ROUNDS):
        filtered = sum((w * radius * t * np.linalg.solve((middle + radius * t) * np.eye(d) - matrix, block)).real for t, w in zip(turns, weights))
        q, _ = np.linalg.qr(filtered)
        values, small = np.linalg.eigh(q.T @ matrix @ q)
        block = q @ small
        inside = np.flatnonzero((values > low) & (values < high))
        residual = np.linalg.norm(matrix @ block[:, inside] - block[:, inside] * values[inside], axis=0)
        if len(inside) == count and residual.max(initial=0) <= d * 2.0**-54 * max(abs(low), abs(high)):
            break
    if len(inside) != count:
        raise ArithmeticError(f"the contour holds {len(inside)} eigenvalues, the inertia count is {count}")
    order = inside[np.argsort(-values[inside])]
    return values[order], block[:, order]


def _bracket(above: Callable[[float], int], j: int, low: float, high: float) -> tuple[float, float]:
    """Bounds of the j-th largest eigenvalue, a 2^BISECTIONS-th of (low, high) apart."""
    for _ in range(BISECTIONS):
        middle = (low + high) / 2
        low, high = (middle, high) if above(middle) >= j else (low, middle)
    return low, high


def leading(matrix: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues of a positive semidefinite matrix, and their unit vectors, by :func:`contour`.

    Bisection by inertia counts brackets the first eigenvalue, the k-th one and the first below it that is not too close to be told
    apart; the contour passes halfway between the last two, and so encloses a known number of eigenvalues.
    """
    d, norm = len(matrix), float(np.abs(matrix).sum(axis=1).max()) or 1.0  # no eigenvalue is larger
    scale = norm * _bracket(lambda s: inertia(matrix / norm - s * np.eye(d)), 1, -0.125, 1.0 + 2.0**-20)[1]
    scale = scale if scale > 0 else norm
    scaled = matrix / scale

    def above(s: float) -> int:
        return inertia(scaled - s * np.eye(d))

    count, edge = k, -0.125
    low, _ = _bracket(above, k, -0.125, 1.0 + 2.0**-20)
    while (count := above(low)) < d:
        below, next_ = _bracket(above, count + 1, -0.125, low)
        if next_ < low:
            edge = (next_ + low) / 2
            break
        low = below
    values, vectors = contour(scaled, edge, 1.0 + max(0.0625, (1 - edge) / 16), count)
    return values[:k] * scale, vectors[:, :k]


def whitened(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = COMPONENTS) -> DataFrame:
    """For each row and component: key, component, n, deviation, deviation_exact, whitened, explained, identity_error."""
    spark = ship(rows.sparkSession)
    schema = f"{key} {dict(rows.dtypes)[key]}, component int, n long, deviation long, deviation_exact string, whitened double, explained double, identity_error double"
    x = staged(quantised(rows, key, vector), "whole-vectors")
    fit = staged(x.select("x").distinct(), "fit-vectors")
    each = fit.select(F.posexplode("x").alias("i", "c")).groupBy("i").agg(F.sum(F.col("c").cast("decimal(38,0)")).alias("s"), F.count("*").alias("n")).orderBy("i")
    found = each.limit(MOST_DIMS + 1).collect()
    if not found:
        return spark.createDataFrame([], schema)
    if len(found) > MOST_DIMS:
        raise ValueError(f"vectors of more than {MOST_DIMS} dimensions")
    d, n, sums = len(found), found[0]["n"], [int(r["s"]) for r in found]
    centre, exact = moments(fit, d, sums, n)
    v = np.array([[float(Fraction(e, n * n)) for e in line] for line in exact])
    total = float(Fraction(sum(exact[i, i] for i in range(d)), n * n))
    k = min(k, d)
    values, axes = leading(v, k)
    real = values > total * d * 2.0**-50
    roots = np.where(real, np.sqrt(np.where(real, values, 1)), 1)
    shift = np.array([float(Fraction(s - n * m, n)) for s, m in zip(sums, centre)])
    middle = np.array(centre, object)

    def centred(block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """x - centre as whole numbers, and x - S / n."""
        wide = np.abs(block.astype(np.float64)).max(initial=0) + float(np.abs(middle).max()) >= 2.0**62
        y = block.astype(object) - middle if wide else block - middle.astype(np.int64)
        return y, y.astype(np.float64) - shift

    def second(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, mean = np.zeros((k, k)), np.zeros(k)
        for batch in batches:
            scores = centred(_matrix(batch.column("x"), d))[1] @ axes / roots
            w, mean = w + scores.T @ scores, mean + scores.sum(axis=0)
        i, j = np.indices((k, k + 1))
        yield pa.RecordBatch.from_arrays([pa.array(i.ravel()), pa.array(j.ravel()), pa.array(np.hstack([w, mean[:, None]]).ravel())], names=["i", "j", "s"])

    sums_of = {(r["i"], r["j"]): r["s"] / n for r in fit.mapInArrow(second, "i long, j long, s double").groupBy("i", "j").agg(F.sum("s").alias("s")).collect()}  # k * (k + 1) rows
    error = max((abs(sums_of[i, j] - sums_of[i, k] * sums_of[j, k] - (i == j)) for i in range(k) for j in range(k) if real[i] and real[j]), default=None)
    rest = np.array([s - n * m for s, m in zip(sums, centre)], object)
    explained = [float(e) / total if total else None for e in values]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            block = _matrix(batch.column("x"), d)
            y, fine = centred(block)
            near = np.abs(fine).max(axis=1, initial=0) * n
            if y.dtype != object and near.max(initial=0) ** 2 * d < 2.0**62:
                off = n * y - rest.astype(np.int64)
                deviation = (off * off).sum(axis=1).tolist()
            else:
                off = n * y.astype(object) - rest
                deviation = (off * off).sum(axis=1).tolist()
            scores = fine @ axes / roots
            rows_ = len(block)
            at, component = np.repeat(np.arange(rows_), k), np.tile(np.arange(k), rows_)
            long = pa.array([x if x < 2**63 else None for x in deviation], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(key).take(pa.array(at)), pa.array(component + 1, pa.int32()), pa.array(np.full(rows_ * k, n)), long.take(pa.array(at)), pa.array([str(x) for x in deviation]).take(pa.array(at)),
                    pa.array(scores.ravel(), mask=~real[component]), pa.array([explained[c] for c in component.tolist()], pa.float64()), pa.array([error] * (rows_ * k), pa.float64()),
                ],
                names=[key, "component", "n", "deviation", "deviation_exact", "whitened", "explained", "identity_error"],
            )

    return x.mapInArrow(score, schema)


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitened(table(spark, sf_dir, "embeddings"))
