"""A cell index of vectors: exact search by angle bounds, and approximate search in the nearest cells.

K-means over a bounded sample gives the centres. Every row goes to the cell of its nearest centre and keeps its angle to it; a cell is cut by angle into
blocks of a bounded number of rows. A query visits a block only if the triangle inequality of angles lets a row in it be near enough, or, in
the approximate search, only the blocks of its nearest cells. Rows are never copied for queries; queries are copied once for each block that they visit.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vocabloom.functions.frame import checkpointed, top_by, with_package

#: Rows of a block, rows of the sample for each centre, and centres at most (every task holds them all).
BLOCK, SAMPLE, MOST_CELLS = 4096, 32, 1024
#: Rows of queries multiplied with a block at once, and rows with vectors that a task gives out at once.
QUERIES, GIVEN = 256, 2048
#: Slack of angles for rounding.
SLACK = 1e-6


def unit_rows(rows: DataFrame, key: str, vector: str) -> DataFrame:
    """(k, v): vectors of length one; null and zero vectors, and those with a null or non-finite entry, have no place in the index."""
    v = rows.where(F.col(vector).isNotNull()).select(F.col(key).alias("k"), F.col(vector).cast("array<double>").alias("v"))
    length = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
    return v.withColumn("_n", length).where((F.col("_n") > 0) & (F.col("_n") < float("inf"))).select("k", F.transform("v", lambda x: x / F.col("_n")).alias("v"))


def _matrix(vectors: pd.Series) -> np.ndarray:
    return np.array(vectors.tolist(), dtype=np.float64)


class CellIndex:
    """Rows in cells: ``rows`` (block, cell, k, v, angle) and ``blocks`` (cell, block, low, high, n), the range of angles of each block to the centre.

    Vectors have one length. Repeated rows stay separate.
    """

    def __init__(self, rows: DataFrame, key: str, vector: str, cells: int | None = None, rounds: int = 8, seed: int = 1):
        """``cells`` is the root of the number of rows by default. Centres are fitted on at most ``SAMPLE`` rows for each, in the order of a hash."""
        with_package(rows.sparkSession)
        units = checkpointed(unit_rows(rows, key, vector))
        self.count, self.kind = units.count(), dict(units.dtypes)["k"]
        cells = max(1, min(MOST_CELLS, cells or int(self.count**0.5)))
        sample = units.orderBy(F.xxhash64("k", F.lit(seed)), "k").limit(SAMPLE * cells).select("v").toPandas()
        self.centres = _centres(_matrix(sample["v"]), min(cells, len(sample)), rounds) if len(sample) else np.zeros((0, 0))
        placed = checkpointed(self._routed(units, 1))
        cell = placed.groupBy(F.col("cell").alias("_c")).agg(F.count("*").alias("_n"), F.min("angle").alias("_l"), F.max("angle").alias("_h"))
        self.ranges = {r["_c"]: (r["_l"], r["_h"]) for r in cell.collect()}  # a row for each cell
        parts = F.ceil(F.col("_n") / F.lit(BLOCK))
        wide = F.greatest(F.col("_h") - F.col("_l"), F.lit(1e-12))
        ranged = placed.join(F.broadcast(cell), F.col("cell") == F.col("_c")).select(  # a row for each cell
            "cell", "k", "v", "angle", F.least(parts - 1, F.floor((F.col("angle") - F.col("_l")) / wide * parts)).alias("_part")
        )
        sizes = ranged.groupBy("cell", "_part").agg(F.ceil(F.count("*") / F.lit(BLOCK)).alias("_g")).select(
            F.bitwise_not(F.bitwise_not("cell")).alias("_c"), F.bitwise_not(F.bitwise_not("_part")).alias("_p"), "_g"  # an exchange of its own, so that Spark can split a large part
        )
        slot = F.pmod(F.xxhash64("k", F.xxhash64("v")), "_g")
        dealt = ranged.join(sizes, (F.col("cell") == F.col("_c")) & (F.col("_part") == F.col("_p")))
        self.rows = checkpointed(dealt.select(F.xxhash64("cell", "_part", slot).alias("block"), "cell", "k", "v", "angle"))
        self.blocks = checkpointed(self.rows.groupBy("cell", "block").agg(F.min("angle").alias("low"), F.max("angle").alias("high"), F.count("*").alias("n")))

    def _routed(self, units: DataFrame, nearest: int | None, reach: float | None = None) -> DataFrame:
        """(k, v, cell, angle): a row for each of the ``nearest`` cells (of all, where none is given) of each vector, with ``reach`` only for cells with a row so near."""
        centres, d = self.centres, len(self.centres)
        many = d if nearest is None else min(nearest, d)
        low, high = (np.array([self.ranges.get(c, (np.inf, -np.inf))[i] for c in range(d)]) for i in (0, 1)) if reach is not None else (None, None)

        def near(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for x in (batch.iloc[k : k + QUERIES] for batch in batches for k in range(0, len(batch), QUERIES)):
                if not d:
                    continue
                angles = np.arccos(np.clip(_matrix(x["v"]) @ centres.T, -1, 1))
                chosen = np.zeros(angles.shape, bool)
                np.put_along_axis(chosen, np.argsort(angles, axis=1, kind="stable")[:, :many], True, axis=1)
                if reach is not None:
                    chosen &= (angles - reach <= high) & (angles + reach >= low)
                row, cell = np.nonzero(chosen)
                for k in range(0, len(row), GIVEN):  # a query may go to every cell, each time with its vector
                    r, c = row[k : k + GIVEN], cell[k : k + GIVEN]
                    yield x.iloc[r].assign(cell=c, angle=angles[r, c])

        return units.mapInPandas(near, f"k {dict(units.dtypes)['k']}, v array<double>, cell int, angle double")

    def visits(self, queries: DataFrame, least: float, probes: int | None = None) -> DataFrame:
        """(block, k, v): the blocks that each query (k, v) visits; with ``probes`` only those of so many nearest cells.

        A row whose angle to a centre is r is at least |q - r| away from a query whose angle to it is q.
        """
        reach = float(np.arccos(min(1.0, max(-1.0, least)))) + SLACK
        near = self._routed(queries, probes, reach).join(self.blocks, "cell")
        return near.where((F.col("angle") - reach <= F.col("high")) & (F.col("angle") + reach >= F.col("low"))).select("block", "k", "v")

    def search(self, queries: DataFrame, key: str, vector: str, least: float, probes: int | None = None, places: int | None = None) -> DataFrame:
        """(source, target, cosine): the rows at or above ``least`` of each query but the query itself; exact, or with ``probes`` those of the
        nearest cells only. With ``places`` cosines are rounded to so many, and the rounded ones are held against ``least``."""
        if places is not None:
            found = self.search(queries, key, vector, least - 0.6 * 10.0**-places, probes)
            return found.withColumn("cosine", F.round("cosine", places)).where(F.col("cosine") >= least)
        asked = checkpointed(unit_rows(queries, key, vector))
        q = self.visits(asked, least, probes).withColumn("_q", F.lit(1))
        met = self.rows.select("block", "k", "v", F.lit(0).alias("_q")).unionByName(q.select("block", "k", "v", "_q"))
        ordered = met.repartition("block").sortWithinPartitions("block", "_q")  # a block's rows come before its queries

        def product(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            block, keys, rows, held = None, [], None, []
            for batch in batches:
                marks = batch["block"].to_numpy()
                cuts = np.flatnonzero(np.concatenate([[True], (marks[1:] != marks[:-1]) | (batch["_q"].to_numpy()[1:] != batch["_q"].to_numpy()[:-1])])).tolist() if len(batch) else []
                for start, end in zip(cuts, [*cuts[1:], len(batch)]):
                    some = batch.iloc[start:end]
                    if some["block"].iloc[0] != block:
                        block, held, rows = some["block"].iloc[0], [], None
                    if some["_q"].iloc[0] == 0:
                        held.append((some["k"].to_numpy(), _matrix(some["v"])))
                        continue
                    if rows is None:
                        keys, rows = np.concatenate([x for x, _ in held]), np.concatenate([m for _, m in held])
                    for at in range(0, len(some), QUERIES):
                        k, c = some["k"].to_numpy()[at : at + QUERIES], _matrix(some["v"].iloc[at : at + QUERIES]) @ rows.T
                        i, j = np.nonzero((c >= least) & (k[:, None] != keys[None, :]))
                        yield pd.DataFrame({"source": k[i], "target": keys[j], "cosine": c[i, j]})

        return ordered.mapInPandas(product, f"source {self.kind}, target {self.kind}, cosine double")


def _centres(sample: np.ndarray, cells: int, rounds: int) -> np.ndarray:
    """Unit centres by k-means on the angle; the first ones are far apart from each other."""
    centres = sample[:1]
    nearest = sample @ centres[0]
    while len(centres) < cells:
        far = int(nearest.argmin())
        centres = np.vstack([centres, sample[far]])
        nearest = np.maximum(nearest, sample @ sample[far])
    for _ in range(rounds):
        of = (sample @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, of, sample)
        length = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(length > 0, sums / np.where(length > 0, length, 1), centres)
    return centres


def recall(found: DataFrame, wanted: DataFrame) -> float:
    """The share of ``wanted`` (source, target) that ``found`` has; 1 where nothing is wanted."""
    row = wanted.join(found.select("source", "target").distinct().withColumn("_hit", F.lit(1)), ["source", "target"], "left").agg(F.count("*").alias("n"), F.count("_hit").alias("hits")).first()
    return row["hits"] / row["n"] if row["n"] else 1.0


def without_subsets(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """``pairs`` (source, target, ...) but those where all words of one label are among the words of the other; ``labels`` has k and label.

    A key without a label has no words and goes with all others.
    """
    words = labels.select("k", F.array_distinct(F.filter(F.split(F.lower("label"), " "), lambda x: x != "")).alias("words"))
    a, b = (words.select(F.col("k").alias(c), F.col("words").alias(f"_{c}")) for c in ("source", "target"))
    both = pairs.join(a, "source", "left").join(b, "target", "left")
    none = F.array().cast("array<string>")
    x, y = F.coalesce("_source", none), F.coalesce("_target", none)
    inside = (F.size(F.array_except(x, y)) == 0) | (F.size(F.array_except(y, x)) == 0)
    return both.where(~inside).select(*pairs.columns)


def semantic_edges(found: DataFrame, labels: DataFrame, most: int | None = 50_000) -> DataFrame:
    """(source, target, cosine): the ``most`` most similar pairs without those of nested words, each pair of two keys once."""
    pairs = found.select(F.least("source", "target").alias("source"), F.greatest("source", "target").alias("target"), F.round("cosine", 6).alias("cosine")).distinct()
    kept = without_subsets(pairs, labels)
    return kept if most is None else kept.orderBy(F.desc("cosine"), "source", "target").limit(most)


def nearest_rows(found: DataFrame, most: int = 1) -> DataFrame:
    """(source, target, cosine): the ``most`` most similar rows of each query, the smallest key of equals."""
    return top_by(found.withColumn("cosine", F.round("cosine", 6)), ["source"], [F.desc("cosine"), "target"], most).drop("rank")
