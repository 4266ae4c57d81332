"""Similar texts: TF-IDF weights, and all pairs of at least a given cosine without comparing all pairs.

Where few pairs share anything the search keeps an index of the rare and heavy terms of each text only. In one order of all terms, the frequent ones first, a text's terms stay out of the index
as long as even the heaviest text could not reach the threshold by them alone. Two texts that reach it share an indexed term of both; pairs
that could not reach it by what they share in the index are dropped, and the others are compared by their whole vectors.

Where texts are written in one small vocabulary the index would give out most pairs, and each with two vectors. There blocks of texts are multiplied with each
other instead (:func:`tile_pairs`): every pair is computed where two blocks meet, and only the pairs that are alike leave a task. Both ways find the same pairs;
a sample tells which is cheaper.

For a high cosine, blocks are first multiplied in a few columns that bound the cosines from above, and only pairs that the bounds leave are computed
(:func:`bounds`). The nearest of all texts are searched that way (:func:`nearest_vectors`): a lower cosine is tried only if a higher one gives too few.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vocabloom.functions.frame import checkpointed, top_by, with_package, written
from vocabloom.functions.pairs import tiled_pairs

#: Slack of bounds for sums of doubles in another order.
SLACK = 1e-9
#: Texts and entries of a block at most, and products of a term in two blocks from which it is multiplied densely.
BLOCK_ROWS, BLOCK_ENTRIES, DENSE = 3072, 1 << 20, 20_000
#: Cosine from which pairs are bounded first, texts of a block then, columns of the bounds for a frequent term each and for all others together, slack for sums
#: of floats, and the share of a tile's pairs up to which the pairs left are computed one by one, so many at once.
BOUNDED, BOUND_ROWS, HEADS, GROUPS, FLOATS, FEW, DOTS = 0.7, 4096, 256, 256, 1e-4, 0.002, 4096
#: Words whose pairs are counted by numbers, at most so many for each of the terms wanted.
MOST_WORDS = 4
#: Cosines at which the nearest of all texts are searched before the least one.
FIRST_TRIES = (0.98, 0.9, 0.7)
#: Texts of the sample that tells how many pairs the index gives out, and the share of all pairs above which blocks are cheaper.
PROBE, PROBE_SHARE = 2000, 0.01


def representatives(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, class): the smallest key of each different text, for every row; null texts are one class."""
    digest = F.sha2(F.coalesce(F.col(text).cast("string"), F.lit("")), 256)
    first = docs.groupBy(digest.alias("_d")).agg(F.min(key).alias("class"))
    return docs.select(key, digest.alias("_own")).join(first, F.col("_own") == F.col("_d")).select(key, "class")


def tfidf_weights(docs: DataFrame, key: str, text: str, features: int = 10_000, stops: list[str] = ()) -> DataFrame:
    """(key, term, w): unit vectors of tf * (ln((1 + n) / (1 + df)) + 1) over words of two characters or more and pairs of neighbouring ones, stop words taken out first.

    Of all terms the ``features`` most frequent in all texts count (of equals the first in order); that list is of bounded size and is broadcast. n is
    the number of rows of ``docs``, also of those without a term.
    """
    vectors, terms = tfidf_vectors(docs, key, text, features, stops)
    names = docs.sparkSession.createDataFrame(list(enumerate(terms)), "_n int, term string")  # ``features`` rows
    each = vectors.select(key, F.explode(F.arrays_zip("t", "w")).alias("_e")).select(key, F.col("_e.t").alias("_t"), F.col("_e.w").alias("w"))
    return each.join(F.broadcast(names), F.col("_t") == F.col("_n")).select(key, "term", "w")


def tfidf_vectors(docs: DataFrame, key: str, text: str, features: int = 10_000, stops: list[str] = ()) -> tuple[DataFrame, list[str]]:
    """The vectors of :func:`tfidf_weights` as (key, t, w), t being numbers of terms in order, and the terms; texts without a term have none.

    Texts are cut into words once, and vectors are made where the words are read. Only counts of different terms are shuffled.
    """
    with_package(docs.sparkSession)
    words = F.filter(F.split(F.lower(F.col(text)), r"[^\p{L}\p{N}_]+"), lambda x: (F.length(x) > 1) & ~x.isin(["", *stops]))
    every = written(docs.select(F.col(key), words.alias("_w")), "words")  # texts are read and cut once
    n, said = every.count(), every.where("size(_w) > 0")
    terms = sorted(r["term"] for r in frequent_terms(said, features).collect())  # ``features`` rows
    names = pa.array(sorted({w for t in terms for w in t.split(" ")}), pa.string())
    place = {w: k for k, w in enumerate(names.to_pylist())}
    coded = np.array([(-1 if " " not in t else place[t.split(" ")[0]]) * (len(names) + 1) + place[t.split(" ")[-1]] for t in terms], np.int64)
    order = np.argsort(coded)
    sorted_codes = coded[order]
    kind = dict(docs.dtypes)[key]

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, codes = _grams(batch.column("_w"), names)
            at = np.minimum(np.searchsorted(sorted_codes, codes), max(0, len(sorted_codes) - 1))
            known = np.flatnonzero(sorted_codes[at] == codes) if len(terms) else at[:0]
            both, tf = np.unique((row[known] << 32) | order[at[known]], return_counts=True)
            of, starts = np.unique(both >> 32, return_index=True)
            ends = pa.array(np.append(starts, len(both)), pa.int32())
            lists = [pa.ListArray.from_arrays(ends, pa.array(x, pa.int32())) for x in (both & 0xFFFFFFFF, tf)]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(of)), *lists], names=[key, "t", "tf"])

    held = written(said.mapInArrow(counted, f"`{key}` {kind}, t array<int>, tf array<int>"), "term-counts")
    df = np.zeros(len(terms))
    for r in held.select(F.explode("t").alias("t")).groupBy("t").agg(F.count("*").alias("df")).collect():  # ``features`` rows
        df[r["t"]] = r["df"]
    idf = np.log((1 + n) / (1 + df)) + 1

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            t, tf = batch.column("t"), batch.column("tf")
            row = np.repeat(np.arange(batch.num_rows), np.diff(t.offsets.to_numpy()))
            x = tf.flatten().to_numpy() * idf[t.flatten().to_numpy()]
            x = x / np.sqrt(np.bincount(row, weights=x * x, minlength=batch.num_rows))[row]
            ends = pa.array(t.offsets.to_numpy() - t.offsets[0].as_py(), pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0), t, pa.ListArray.from_arrays(ends, pa.array(x))], names=[key, "t", "w"])

    return held.mapInArrow(vectors, f"`{key}` {kind}, t array<int>, w array<double>"), terms


def _grams(texts: pa.ListArray, names: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(row, code) of each word that is in ``names`` and of each two neighbouring ones that both are; a word's code is that of a pair whose first one has the place -1."""
    ids = pc.fill_null(pc.index_in(texts.flatten(), value_set=names), -1).to_numpy(zero_copy_only=False).astype(np.int64)
    row = np.repeat(np.arange(len(texts)), np.diff(texts.offsets.to_numpy()))
    one, two = np.flatnonzero(ids >= 0), np.flatnonzero((row[1:] == row[:-1]) & (ids[1:] >= 0) & (ids[:-1] >= 0))
    return np.concatenate([row[one], row[two]]), np.concatenate([ids[one], ids[two + 1]]) + (len(names) + 1) * np.concatenate([np.full(len(one), -1), ids[two]])


def frequent_terms(texts: DataFrame, features: int) -> DataFrame:
    """(term): the ``features`` most frequent words and pairs of neighbouring words of ``texts`` (_w), of equals the first in order.

    A pair is no more frequent than its words. So only pairs of words that are as frequent as the last of ``features`` words are counted, by the words' numbers;
    where too many words are that frequent, all pairs.
    """
    spark = texts.sparkSession
    single = written(texts.select(F.explode("_w").alias("term")).groupBy("term").agg(F.count("*").alias("all")), "word-counts")
    often = single.orderBy(F.desc("all")).limit(features)  # a bounded list
    least = (often.agg(F.min("all").alias("least"), F.count("*").alias("n")).where(F.col("n") >= features).first() or [1])[0]
    some = single.where(F.col("all") >= least)
    if some.count() > MOST_WORDS * features:
        both = F.zip_with(F.slice("_w", F.lit(1), F.size("_w") - 1), F.slice("_w", F.lit(2), F.size("_w") - 1), lambda x, y: F.concat(x, F.lit(" "), y))
        double = texts.where("size(_w) > 1").select(F.explode(both).alias("term")).groupBy("term").agg(F.count("*").alias("all"))
        return single.union(double).orderBy(F.desc("all"), "term").limit(features).select("term")
    names = pa.array(sorted(r["term"] for r in some.select("term").collect()), pa.string())  # at most MOST_WORDS * ``features`` rows

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = _grams(batch.column("_w"), names)[1]
            codes, n = np.unique(codes[codes >= 0], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(codes), pa.array(n)], names=["code", "n"])

    counts = texts.select("_w").mapInArrow(pairs, "code long, n long").groupBy("code").agg(F.sum("n").alias("all")).where(F.col("all") >= least)
    named = F.broadcast(spark.createDataFrame(list(enumerate(names.to_pylist())), "k long, name string"))
    first, second = (named.select(F.col("k").alias(f"_{c}"), F.col("name").alias(c)) for c in "xy")
    base = F.lit(len(names) + 1)
    double = counts.join(first, F.expr(f"code div {len(names) + 1}") == F.col("_x")).join(second, F.col("code") % base == F.col("_y")).select(F.concat("x", F.lit(" "), "y").alias("term"), "all")
    return some.select("term", "all").union(double).orderBy(F.desc("all"), "term").limit(features).select("term")


def indexed_terms(weights: DataFrame, key: str, least: float) -> DataFrame:
    """(key, term, w, rest): the terms of each text that the index needs, and the length of the vector of its other ones.

    A text's frequent terms are left out as long as neither their heaviest weights anywhere (sum of w * max w) nor their own length reach ``least``.
    """
    of_term = weights.groupBy("term").agg(F.count("*").alias("_df"), F.max("w").alias("_most")).select(F.element_at(F.array("term"), F.lit(1)).alias("_t"), "_df", "_most")
    order = Window.partitionBy(key).orderBy(F.desc("_df"), "term").rowsBetween(Window.unboundedPreceding, 0)
    summed = weights.join(of_term, F.col("term") == F.col("_t")).select(
        key, "term", "w", F.sum(F.col("w") * F.col("_most")).over(order).alias("_bound"), F.sqrt(F.sum(F.col("w") * F.col("w")).over(order)).alias("_length")
    )
    reached = F.least("_bound", "_length") >= least - SLACK
    out = Window.partitionBy(key)
    return summed.select(key, "term", "w", reached.alias("_in"), F.coalesce(F.max(F.when(~reached, F.col("_length"))).over(out), F.lit(0.0)).alias("rest")).where("_in").drop("_in")


def candidate_pairs(weights: DataFrame, key: str, least: float) -> DataFrame:
    """(a, b): the pairs a < b that may have a cosine of ``least`` or more.

    What a pair shares outside both indexes is at most the longer one of the two vectors left out.
    """
    met = tiled_pairs(indexed_terms(weights, key, least), "term", key, ["w", "rest"])
    sums = met.groupBy("a", "b").agg(F.sum(F.col("w_a") * F.col("w_b")).alias("_s"), F.max(F.greatest("rest_a", "rest_b")).alias("_rest"))
    return sums.where(F.col("_s") + F.col("_rest") >= least - SLACK).select("a", "b")


def _dots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b, cosine) from the sorted term numbers and weights of both texts of each pair."""
    for batch in batches:
        keys, weights = [], []
        for t, w in (("t_a", "w_a"), ("t_b", "w_b")):
            lists = batch.column(t)
            sizes = np.diff(lists.offsets.to_numpy())
            keys.append((np.repeat(np.arange(batch.num_rows), sizes) << 32) | lists.flatten().to_numpy())
            weights.append(batch.column(w).flatten().to_numpy())
        _, i, j = np.intersect1d(*keys, assume_unique=True, return_indices=True)
        dot = np.bincount(keys[0][i] >> 32, weights=weights[0][i] * weights[1][j], minlength=batch.num_rows)
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(dot)], names=["a", "b", "cosine"])


def all_pairs(weights: DataFrame, key: str, least: float, tiles: bool | None = None) -> DataFrame:
    """(a, b, cosine), a < b: every pair of unit vectors (key, term, w) with a cosine of ``least`` or more, rounded to six places.

    ``tiles`` says whether blocks are multiplied or the index is asked; a sample decides by default.
    """
    weights = checkpointed(weights)
    terms = weights.select("term").distinct().select("term", F.xxhash64("term").alias("_h"))
    numbers = checkpointed(terms.select(F.element_at(F.array("term"), F.lit(1)).alias("_t"), (F.row_number().over(Window.partitionBy(F.pmod("_h", F.lit(1024))).orderBy("term")) * 1024 + F.pmod("_h", F.lit(1024))).cast("int").alias("_n")))
    vectors = weights.join(numbers, F.col("term") == F.col("_t")).groupBy(key).agg(F.array_sort(F.collect_list(F.struct("_n", "w"))).alias("v"))
    return vector_pairs(vectors.select(F.col(key), F.transform("v", lambda x: x["_n"]).alias("t"), F.transform("v", lambda x: x["w"]).alias("w")), key, least, tiles)


def vector_pairs(vectors: DataFrame, key: str, least: float, tiles: bool | None = None) -> DataFrame:
    """:func:`all_pairs` of vectors (key, t, w), t being different numbers in order."""
    return _pairs_of(written(vectors, "vectors"), key, least, tiles)


def _pairs_of(vectors: DataFrame, key: str, least: float, tiles: bool | None = None) -> DataFrame:
    """:func:`vector_pairs` of a table that is written already."""
    with_package(vectors.sparkSession)
    kind = dict(vectors.dtypes)[key]
    of = lambda some: some.select(key, F.explode(F.arrays_zip("t", "w")).alias("_e")).select(key, F.col("_e.t").alias("term"), F.col("_e.w").alias("w"))
    if tiles is None:
        n = vectors.count()
        some = vectors.where(F.pmod(F.xxhash64(F.col(key).cast("string"), F.lit(5)), F.lit(max(1, n))) < PROBE) if n > PROBE else vectors
        met = indexed_terms(of(some), key, least).groupBy("term").agg(F.count("*").alias("n")).agg(F.sum(F.col("n") * (F.col("n") - 1) / 2)).first()[0] or 0
        tiles = met > PROBE_SHARE * min(n, PROBE) ** 2 / 2
    if tiles:
        return tile_pairs(vectors, key, least)
    side = lambda k: vectors.select(F.col(key).alias(k), F.col("t").alias(f"t_{k}"), F.col("w").alias(f"w_{k}"))
    found = candidate_pairs(of(vectors), key, least).join(side("a"), "a").join(side("b"), "b").select("a", "b", "t_a", "w_a", "t_b", "w_b")
    return found.mapInArrow(_dots, f"a {kind}, b {kind}, cosine double").withColumn("cosine", F.round("cosine", 6)).where(F.col("cosine") >= least)


def vector_blocks(vectors: DataFrame, key: str, most: int | None = None) -> DataFrame:
    """(block, keys, terms, rows, weights): the vectors in blocks of at most ``most`` rows, each with its entries by term.

    A partition is dealt 7/8 of a block, so that hardly one holds more than a block and leaves a small one.
    """
    most = most or BLOCK_ROWS
    sizes = vectors.agg(F.count("*"), F.sum(F.size("t"))).first()
    parts = max(1, *(-(-8 * (have or 0) // (7 * fit)) if (have or 0) > fit else 1 for have, fit in zip(sizes, (most, BLOCK_ENTRIES))))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows, entries = [], 0, 0

        def block() -> pa.RecordBatch:
            keys, t, w = (pa.concat_arrays([x.column(c).combine_chunks() if isinstance(x.column(c), pa.ChunkedArray) else x.column(c) for x in held]) for c in (0, 1, 2))
            row = np.repeat(np.arange(len(keys), dtype=np.int32), np.diff(t.offsets.to_numpy()))
            t, w = t.flatten().to_numpy(), w.flatten().to_numpy()
            order = np.argsort(t, kind="stable")
            raw = [pa.array([x[order].tobytes()], pa.binary()) for x in (t.astype(np.int32), row, w)]
            return pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array([0, len(keys)], pa.int32()), keys), *raw], names=["keys", "terms", "rows", "weights"])

        for batch in batches:
            for start in range(0, batch.num_rows, 64):
                some = batch.slice(start, 64)
                held.append(some)
                rows, entries = rows + some.num_rows, entries + len(some.column(1).flatten())
                if rows >= most or entries >= BLOCK_ENTRIES:
                    yield block()
                    held, rows, entries = [], 0, 0
        if held:
            yield block()

    kind = dict(vectors.dtypes)[key]
    packed = vectors.select(key, "t", "w").repartition(parts, F.xxhash64(key)).mapInArrow(pack, f"keys array<{kind}>, terms binary, rows binary, weights binary")
    return written(packed.withColumn("block", F.monotonically_increasing_id()), "vector-blocks")


def _product(x: tuple, y: tuple) -> np.ndarray:
    """The dot products of two blocks (rows, terms, row of each entry, weights), entries by term."""
    (m, tx, rx, wx), (n, ty, ry, wy) = x, y
    out = np.zeros((m, n))
    terms, i, j = np.intersect1d(tx, ty, return_indices=True)
    ends = lambda t, k: (k, np.searchsorted(t, terms, side="right"))
    (xs, xe), (ys, ye) = ends(tx, i), ends(ty, j)
    dense = np.flatnonzero((xe - xs) * (ye - ys) > DENSE)
    for k in range(0, len(dense), 1024):
        some = dense[k : k + 1024]
        sides = []
        for size, s, e, r, w in ((m, xs, xe, rx, wx), (n, ys, ye, ry, wy)):
            a = np.zeros((size, len(some)))
            for c, at in enumerate(some.tolist()):
                a[r[s[at] : e[at]], c] = w[s[at] : e[at]]
            sides.append(a)
        out += sides[0] @ sides[1].T
    for at in np.setdiff1d(np.arange(len(terms)), dense).tolist():
        a, b = slice(xs[at], xe[at]), slice(ys[at], ye[at])
        out[rx[a][:, None], ry[b][None, :]] += wx[a][:, None] * wy[b][None, :]
    return out


def bounds(x: tuple, y: tuple) -> np.ndarray:
    """What the dot products of two blocks (as in :func:`_product`) are at most, but for ``FLOATS``.

    The most frequent terms of both blocks have a column each, the others share ``GROUPS`` columns, with the length of a row's weights there:
    what two rows have in common in a group is at most the product of their lengths in it.
    """
    firsts = [np.flatnonzero(np.concatenate([[True], t[1:] != t[:-1]])) if len(t) else np.zeros(0, np.int64) for _, t, _, _ in (x, y)]
    counts = [np.diff(np.concatenate([f, [len(b[1])]])) for f, b in zip(firsts, (x, y))]
    own = [b[1][f] for f, b in zip(firsts, (x, y))]
    terms = np.union1d(*own)
    places = [np.searchsorted(terms, o) for o in own]
    often = sum(np.bincount(p, weights=c, minlength=len(terms)) for p, c in zip(places, counts))
    column = np.empty(len(terms), np.int64)
    column[np.argsort(-often, kind="stable")] = np.where((at := np.arange(len(terms))) < HEADS, at, HEADS + at % GROUPS)
    sides = []
    for (n, _, rows, w), p, c in zip((x, y), places, counts):
        squares = np.bincount(rows.astype(np.int64) * (HEADS + GROUPS) + np.repeat(column[p], c), weights=w * w, minlength=n * (HEADS + GROUPS))
        sides.append(np.sqrt(squares).astype(np.float32).reshape(n, HEADS + GROUPS))
    return sides[0] @ sides[1].T


def _some_dots(x: tuple, y: tuple, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The dot products of rows ``i`` of block x with rows ``j`` of block y, pair by pair."""
    sides = []
    for (n, terms, rows, w), of in ((x, i), (y, j)):
        wanted = np.zeros(n, bool)
        wanted[of] = True
        some = np.flatnonzero(wanted[rows])
        some = some[np.argsort(rows[some], kind="stable")]  # by row, then by term
        sides.append((terms[some].astype(np.int64), w[some], np.searchsorted(rows[some], np.arange(n + 1))))
    out = np.zeros(len(i))
    for start in range(0, len(i), DOTS):
        pairs, keys, weights = slice(start, start + DOTS), [], []
        for (terms, w, at), of in zip(sides, (i, j)):
            sizes = at[of[pairs] + 1] - at[of[pairs]]
            ends = np.cumsum(sizes)
            entry = np.arange(ends[-1]) + np.repeat(at[of[pairs]] - ends + sizes, sizes)
            keys.append((np.repeat(np.arange(len(sizes)), sizes) << 32) | terms[entry])
            weights.append(w[entry])
        _, a, b = np.intersect1d(*keys, assume_unique=True, return_indices=True)
        out[pairs] = np.bincount(keys[0][a] >> 32, weights=weights[0][a] * weights[1][b], minlength=len(out[pairs]))
    return out


def _alike(x: tuple, y: tuple, least: float, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Rows of two blocks and their dot products, those of ``least`` or more; of one block with itself each pair once."""
    if least >= BOUNDED:
        close = bounds(x, y) >= least - FLOATS
        if same:
            close = np.triu(close, 1)
        i, j = np.divmod(np.flatnonzero(close), close.shape[1])
        if len(i) <= FEW * close.size:
            if len(i):
                dots = _some_dots(x, y, i, j)
                near = dots >= least - 1e-6
                yield i[near], j[near], dots[near]
            return
        del close, i, j
    dots = _product(x, y)
    if same:
        dots[np.tril_indices(len(dots))] = -1
    for start in range(0, len(dots), 256):
        i, j = np.nonzero(dots[start : start + 256] >= least - 1e-6)
        yield i + start, j, dots[i + start, j]


def tile_pairs(vectors: DataFrame, key: str, least: float) -> DataFrame:
    """:func:`vector_pairs` by products of blocks. Tasks read the blocks' files; no vector is shuffled again, and a task holds two blocks and their products."""
    blocks = vector_blocks(vectors, key, BOUND_ROWS if least >= BOUNDED else BLOCK_ROWS)
    kind = dict(vectors.dtypes)[key]
    side = lambda k: blocks.select(*(F.col(c).alias(f"{c}_{k}") for c in ("block", "keys", "terms", "rows", "weights")))
    tiles = side("x").hint("shuffle_replicate_nl").join(side("y"), F.col("block_x") <= F.col("block_y"))

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for tile in (batch.slice(k, 1) for k in range(batch.num_rows)):
                keys = [tile.column(f"keys_{k}").flatten() for k in "xy"]
                raw = lambda c, kind: np.frombuffer(tile.column(c)[0].as_buffer(), kind)  # noqa: E731, B023
                x, y = ((len(keys[k == "y"]), raw(f"terms_{k}", np.int32), raw(f"rows_{k}", np.int32), raw(f"weights_{k}", np.float64)) for k in "xy")
                for i, j, dots in _alike(x, y, least, tile.column("block_x")[0] == tile.column("block_y")[0]):
                    ends = [keys[0].take(pa.array(i)), keys[1].take(pa.array(j))]
                    yield pa.RecordBatch.from_arrays([*ends, pa.array(dots)], names=["a", "b", "cosine"])

    found = tiles.select(*(f"{c}_{k}" for k in "xy" for c in ("block", "keys", "terms", "rows", "weights"))).mapInArrow(products, f"a {kind}, b {kind}, cosine double")
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), F.round("cosine", 6).alias("cosine")).where(F.col("cosine") >= least)


def nearest_texts(pairs: DataFrame, most: int, n: int | None = None) -> DataFrame:
    """(a, b, cosine, rank): of :func:`all_pairs` the ``most`` nearest of each text, and of those the ``n`` nearest of all."""
    ways = F.array(F.struct(F.col("a").alias("a"), F.col("b").alias("b")), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))
    both = pairs.select(F.explode(ways).alias("_p"), "cosine").select("_p.a", "_p.b", "cosine")  # the pairs are found once
    near = top_by(both, ["a"], [F.desc("cosine"), "b"], most)
    return near if n is None else near.orderBy(F.desc("cosine"), "a", "b").limit(n)


def nearest_vectors(vectors: DataFrame, key: str, least: float, most: int, n: int | None = None) -> DataFrame:
    """:func:`nearest_texts` of all pairs of vectors (key, t, w) with a cosine of ``least`` or more.

    Where more rows are possible than the ``n`` wanted, pairs of a higher cosine are searched first. A row's rank depends on rows at least as near only, so if those have n
    rows within their ranks, they are the n nearest of all; else the next lower cosine is tried, ``least`` at the end.
    """
    vectors = written(vectors, "vectors")
    for high in FIRST_TRIES if n is not None and n < most * vectors.count() else ():
        if high > least:
            near = written(nearest_texts(_pairs_of(vectors, key, high), most), "nearest")
            if near.count() >= n:
                return near.orderBy(F.desc("cosine"), "a", "b").limit(n)
    return nearest_texts(_pairs_of(vectors, key, least), most, n)


def text_edges(senses: DataFrame, least: float = 0.4, most: int = 20, n: int | None = 30_000, features: int = 10_000, stops: list[str] = (), least_chars: int = 21, existing: DataFrame | None = None) -> DataFrame:
    """``related_to`` edges between senses (sense_id, label, definition, discipline) by label and definition; definitions of less than ``least_chars`` characters do not count.

    Senses of equal label and definition stand for the smallest of them. Edges that ``existing`` has, by source, target and type, are left out.
    """
    told = senses.where(F.length("definition") >= least_chars).withColumn("_text", F.concat("label", F.lit(". "), "definition"))
    first = told.groupBy("_text").agg(F.min(F.struct("sense_id", "discipline")).alias("s")).select("_text", "s.sense_id", "s.discipline")
    near = nearest_vectors(tfidf_vectors(first, "sense_id", "_text", features, stops)[0], "sense_id", least, most, n)
    of = lambda k, d: first.select(F.col("sense_id").alias(k), F.col("discipline").alias(d))
    direction: Column = F.when(F.col("_a") == F.col("_b"), "toward").otherwise("across")
    edges = near.join(of("a", "_a"), "a").join(of("b", "_b"), "b").select(
        F.col("a").alias("source_sense_id"), F.col("b").alias("target_sense_id"), F.lit("related_to").alias("relationship_type"), direction.alias("direction"), F.round("cosine", 3).alias("confidence")
    )
    if existing is None:
        return edges
    triple = ["source_sense_id", "target_sense_id", "relationship_type"]
    return edges.join(existing.select(*triple), triple, "left_anti")
