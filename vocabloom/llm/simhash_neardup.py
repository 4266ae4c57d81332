"""Near-duplicate search over SimHash fingerprints with vantage-point trees.

1. Every whole text gets a 64-bit fingerprint from its word shingles (:func:`fingerprints`).
2. Equal fingerprints are one point. A vantage-point tree, built from a bounded sample,
   cuts Hamming space into shards; a point just outside a ball (within the radius of
   its surface) goes to the inner side as well, so by the triangle inequality each linked
   pair meets in some shard.
3. Each shard searches exactly with a tree of its own and returns the links as a
   spanning forest: connected points stay connected, and a crowd of near copies costs one
   row a point instead of one a pair.
4. A crowd that no vantage point can split (a shard above ``crowd_rows``) is linked through
   the balls of half the radius around its points (:func:`crowd_links`), which gives the same
   components for any radius and is linear.
5. Star contraction joins the forests to components.

Defined results: a null or blank text has no words and fingerprint 0, and is linked like any
other. Rows that repeat a doc_id stay rows. A null doc_id is ignored as a component's name
unless the component has no other (then null). Empty tables give no rows. Only ``doc_id`` and
``text`` are read, so other columns do not matter.
"""

from __future__ import annotations

import functools
import itertools
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.dataset as ds
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vocabloom.llm._common import filesystem, scratch_path, ship, staged, table, unused
from vocabloom.llm.components import components

SEED = 42
#: Stands for a null doc_id in joins.
NO_ID = -(2**63)
#: Points that one task searches; a shard above CROWD_ROWS takes the linear way.
SHARD_ROWS, CROWD_ROWS = 8192, 65536
#: Sampled points for each shard of the top tree, and at most so many on the driver (8 bytes each).
SAMPLE_PER_SHARD, SAMPLE_MOST = 64, 1 << 20
LEAF = 768
#: Words of a passage, on average and at least; of its passages that others have a document meets the rarest ones, and of
#: each passage so many members. Bits in which fingerprints of near copies differ at most.
PASSAGE, LEAST_PASSAGE, RAREST, CENTRES, NEAR_BITS = 24, 8, 4, 3, 14
#: One text of so many is in the sample of usual shingles, of which so many are kept at most.
USUAL_SHARE, USUAL_MOST = 16, 1 << 20
#: Bits of a text's sketch at most; longer texts' pairs are ruled out less often.
SKETCH_MOST = 4096


def fingerprint(raw: bytes, words: int = 3) -> int:
    """Bit j is 1 if it is set in over half the hashes of the shingles, repeats included."""
    w = raw.lower().split()  # of bytes: only A-Z change, and only ASCII white space parts words
    if not w:
        return 0
    shingles = zip(*(w[i:] for i in range(words))) if len(w) >= words else [w]
    n = max(1, len(w) - words + 1)
    h = np.fromiter(map(functools.partial(xxhash.xxh64_intdigest, seed=SEED), map(b" ".join, shingles)), np.uint64, n)
    set_bits = np.zeros(64, np.int64)
    for i in range(0, n, 1 << 16):
        part = h[i : i + (1 << 16)].view(np.uint8).reshape(-1, 8)
        set_bits += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * set_bits > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, words: int = 3) -> DataFrame:
    """doc_id and fp (a long with the 64 bits) for every row."""
    ship(docs.sparkSession)

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            fps = [fingerprint(t.as_buffer().to_pybytes(), words) if t.is_valid else 0 for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.array(fps, np.uint64).view(np.int64))], names=["doc_id", "fp"]
            )

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(batches, "doc_id long, fp long")


def _distance(points: np.ndarray, centre: np.uint64) -> np.ndarray:
    return np.bitwise_count(points ^ centre)


def _split(points: np.ndarray, radius: int) -> tuple[np.uint64, int] | None:
    """The vantage point and ball with the least overlap among those that keep 30 % on either side."""
    best = None
    for centre in points[:: max(1, len(points) // 12)][:12]:
        upto = np.cumsum(np.bincount(_distance(points, centre), minlength=65 + radius)) / len(points)
        upto = np.concatenate([upto, np.ones(radius)])
        for ball in np.flatnonzero((upto[:65] >= 0.3) & (upto[:65] <= 0.7)):
            cost = max(upto[ball + radius], 1 - upto[ball]) + 0.5 * (upto[ball + radius] - upto[ball])
            if upto[ball + radius] < 0.9 and (best is None or cost < best[0]):
                best = cost, centre, int(ball)
    return best and best[1:]


def build_tree(sample: np.ndarray, shards: int, radius: int) -> list[tuple[int, int, int, int]]:
    """Nodes (centre, ball, inner, outer); a child that is negative is shard -1 - child."""
    nodes: list = []
    made = 0
    least = max(2, len(sample) // max(1, shards))

    def grow(points: np.ndarray) -> int:
        nonlocal made
        cut = _split(points, radius) if len(points) > least else None
        if cut is None:
            made += 1
            return -made
        at = len(nodes)
        nodes.append(None)
        d = _distance(points, cut[0])
        nodes[at] = (int(cut[0]), cut[1], grow(points[d <= cut[1]]), grow(points[d > cut[1]]))
        return at

    root = grow(sample)
    return nodes if root >= 0 else []


def route(points: np.ndarray, nodes: list, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """For all points the shards that must see them: positions in ``points`` and shard numbers."""
    where, shards, todo = [], [], [(0 if nodes else -1, np.arange(len(points)))]
    while todo:
        at, rows = todo.pop()
        if not len(rows):
            continue
        if at < 0:
            where.append(rows)
            shards.append(np.full(len(rows), -1 - at, np.int64))
            continue
        centre, ball, inner, outer = nodes[at]
        d = _distance(points[rows], np.uint64(centre))
        todo.append((inner, rows[d <= ball + radius]))
        todo.append((outer, rows[d > ball]))
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *where]), np.concatenate([none, *shards])


def forest(points: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that join exactly the distinct points that chains of near points join: (point, root)."""
    root = np.arange(len(points))

    def link(a: np.ndarray, b: np.ndarray) -> None:
        nonlocal root
        while len(a):
            low, high = np.minimum(root[a], root[b]), np.maximum(root[a], root[b])
            if (low == high).all():
                return
            np.minimum.at(root, high, low)
            while (up := root[root]).tolist() != root.tolist():
                root = up

    def search(rows: np.ndarray, depth: int) -> None:
        cut = _split(points[rows], radius) if len(rows) > LEAF and depth < 24 else None
        if cut:
            d = _distance(points[rows], cut[0])
            search(rows[d <= cut[1] + radius], depth + 1)
            search(rows[d > cut[1]], depth + 1)
            return
        for i in range(0, len(rows), 256):
            block = rows[i : i + 256]
            near = np.bitwise_count(points[block][:, None] ^ points[rows[i:]][None, :]) <= radius
            a, b = np.nonzero(near)
            keep = b > a
            link(block[a[keep]], rows[i:][b[keep]])

    search(np.arange(len(points)), 0)
    moved = np.flatnonzero(root != np.arange(len(points)))
    return points[moved], points[root[moved]]


def _flips(bits: int) -> list[tuple[int, int]]:
    """All masks of at most ``bits`` bits, as signed longs, each with its number of bits."""
    masks = {0}
    for _ in range(bits):
        masks |= {m | 1 << j for m in masks for j in range(64)}
    return [(m - (1 << 64) if m >> 63 else m, m.bit_count()) for m in sorted(masks)]


def with_company(points: DataFrame, radius: int = 2) -> DataFrame:
    """Those of the distinct fingerprints ``points`` (column fp) that may have another one within the radius, and few others.

    Two fingerprints that differ in ``radius`` bits have all but ``radius`` of radius + 2 blocks of their bits in common. A point has a row for each choice
    of so many blocks, and stays if another point has the same bits there. So a point without company costs six rows (radius 2) and never enters a tree,
    whose overlaps would copy it more often the more points there are.
    """
    ends = [64 * k // (radius + 2) for k in range(radius + 3)]
    blocks = [(1 << high) - (1 << low) for low, high in itertools.pairwise(ends)]
    masks = [sum(some) for some in itertools.combinations(blocks, 2)]
    keys = F.array(*(F.xxhash64(F.lit(k), F.col("fp").bitwiseAND(F.lit(m - (1 << 64) if m >> 63 else m))) for k, m in enumerate(masks)))
    each = points.select("fp", F.explode(keys).alias("_key"))
    return each.withColumn("_n", F.count("*").over(Window.partitionBy("_key"))).where("_n > 1").select("fp").distinct()


def crowd_links(points: DataFrame, radius: int) -> DataFrame:
    """Links (a, b) that join exactly the points that chains of near points join, one for each point and centre.

    Points within half the radius (rounded down) of a centre are near each other, and near all points within the other half (rounded up) of
    it; and two near points have such a centre. So it is enough to link all to one of the former.
    The join is never broadcast: what Spark knows of the points' size is that before they are exploded, and the driver would hold all of the balls.
    """
    flips = F.array(*(F.struct(F.lit(m).alias("mask"), F.lit(n <= radius // 2).alias("inner")) for m, n in _flips(radius - radius // 2)))
    balls = points.select("fp", F.explode(flips).alias("_f")).select("fp", "_f.inner", F.col("fp").bitwiseXOR(F.col("_f.mask")).alias("centre"))
    least = balls.where("inner").groupBy("centre").agg(F.min("fp").alias("b"))
    return balls.join(least.hint("merge"), "centre").where("fp <> b").select(F.col("fp").alias("a"), "b").distinct()


def sampled(points: DataFrame, n: int, most: int) -> np.ndarray:
    """About ``most`` of the ``n`` different fingerprints, in the order of a hash. Tasks choose them by another hash and pack them to 8 bytes each, so
    that the driver gets no more than that (an ordered limit would send it so many rows of every task)."""

    def pack(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            yield pa.RecordBatch.from_arrays([pa.array([batch.column("fp").to_numpy(zero_copy_only=False).tobytes()], pa.binary())], names=["packed"])

    chosen = points.where(F.pmod(F.xxhash64("fp"), F.lit(max(1, n))) < most).select("fp")
    packed = chosen.mapInArrow(pack, "packed binary").collect() if most else []
    fps = np.frombuffer(b"".join(bytes(r["packed"]) for r in packed), np.uint64)
    return fps[np.argsort(fps * np.uint64(0x9E3779B97F4A7C15))]


def links(points: DataFrame, radius: int = 2, shard_rows: int = SHARD_ROWS, crowd_rows: int = CROWD_ROWS) -> DataFrame:
    """Edges (a, b) between distinct fingerprints of ``points`` (column fp) that span the components."""
    spark = ship(points.sparkSession)
    n = points.count()
    shards = max(1, math.ceil(n / shard_rows))
    nodes = build_tree(sampled(points, n, min(SAMPLE_MOST, shards * SAMPLE_PER_SHARD) if shards > 1 else 0), shards, radius)

    def deal(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            fps = batch.column("fp").to_numpy(zero_copy_only=False)
            rows, shard = route(fps.view(np.uint64), nodes, radius)
            yield pa.RecordBatch.from_arrays([pa.array(fps[rows]), pa.array(shard)], names=["fp", "shard"])

    def search(pdf: pd.DataFrame) -> pd.DataFrame:
        a, b = forest(np.unique(pdf["fp"].to_numpy(np.int64).view(np.uint64)), radius)
        return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})

    dealt = staged(points.select("fp").mapInArrow(deal, "fp long, shard long"), "vp-shards")
    crowded = staged(dealt.groupBy("shard").count().where(F.col("count") > crowd_rows).select("shard"), "vp-crowds")
    if crowded.isEmpty():
        return dealt.groupBy("shard").applyInPandas(search, "a long, b long")
    crowded = F.broadcast(crowded)  # at most one row for crowd_rows points
    found = dealt.join(crowded, "shard", "left_anti").groupBy("shard").applyInPandas(search, "a long, b long")
    return found.union(crowd_links(dealt.join(crowded, "shard", "left_semi").select("fp").distinct(), radius))


def _roots(prints: DataFrame, radius: int, **limits: int) -> DataFrame:
    """fp, its component's root (a fingerprint) and component_id for each distinct fingerprint of ``prints``. Joins are never broadcast: files of many equal
    fingerprints are much smaller than their rows."""
    points = staged(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "points")
    roots = components(links(points, radius, **limits), "near-links")
    named = points.join(roots.hint("merge"), points["fp"] == roots["node"], "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root")
    )
    least = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return named.join(least.hint("merge"), "root").select(F.col("fp").alias("_fp"), "root", "component_id")


def neighbours_components(docs: DataFrame, radius: int = 2, words: int = 3, **limits: int) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id (its smallest doc_id) for every row."""
    prints = staged(fingerprints(docs, words), "fingerprints")
    return prints.join(_roots(prints, radius, **limits).hint("merge"), F.col("fp") == F.col("_fp")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def passages(words: list[bytes]) -> Iterator[list[bytes]]:
    """A text's words in passages of some PASSAGE words, which end at words of a certain hash, so that an edit changes its own passage only."""
    start = 0
    if not words:
        yield words
    for k, word in enumerate(words, 1):
        if k - start >= LEAST_PASSAGE and zlib.crc32(word) % PASSAGE == 0 or k == len(words):
            yield words[start:k]
            start = k


def shingles(raw: bytes, words: int) -> np.ndarray:
    """Hashes of the different word shingles of a text, in order."""
    w = raw.lower().split()
    runs = zip(*(w[i:] for i in range(words))) if len(w) >= words else [w]
    return np.unique(np.fromiter((xxhash.xxh64_intdigest(b" ".join(x), seed=SEED) for x in runs), np.uint64))


def _described(docs: DataFrame) -> DataFrame:
    """node (a hash of id and text), doc_id, text_hash, fp and the fingerprints of the passages of every row."""

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            fps, parts = [], []
            for t in batch.column("text"):
                raw = t.as_buffer().to_pybytes() if t.is_valid else b""
                fps.append(fingerprint(raw))
                parts.append(np.unique(np.array([fingerprint(b" ".join(p)) for p in passages(raw.lower().split())], np.uint64)).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [*map(batch.column, ("node", "doc_id", "text_hash")), pa.array(np.array(fps, np.uint64).view(np.int64)), pa.array(parts, pa.list_(pa.int64()))],
                names=["node", "doc_id", "text_hash", "fp", "passages"],
            )

    ship(docs.sparkSession)
    return docs.select(*_named(docs), docs["text"].cast("string").alias("text")).mapInArrow(batches, "node long, doc_id long, text_hash long, fp long, passages array<long>")


def _named(docs: DataFrame) -> list[Column]:
    key, text = docs["doc_id"].cast("long"), F.xxhash64(docs["text"].cast("string"))
    return [F.xxhash64(F.coalesce(key, F.lit(NO_ID)), text).alias("node"), key.alias("doc_id"), text.alias("text_hash")]


def _candidates(described: DataFrame, near_bits: int) -> DataFrame:
    """Pairs (a, b) of nodes that share one of their rarest passages and whose fingerprints differ in at most ``near_bits``.

    Passages whose fingerprints are linked within two bits are one. A node meets CENTRES members of each passage, chosen by hash, so
    a passage of many documents makes rows in proportion to them; pairs left out here are :func:`remaining_pairs`' to find.
    """
    each = staged(described.select("node", "fp", F.explode("passages").alias("_p")), "passages")
    points = staged(each.select(F.col("_p").alias("fp")).distinct(), "passage-points")
    roots = components(links(staged(with_company(points), "passage-company")), "passage-links")
    held = staged(
        each.join(roots.select(F.col("node").alias("_of"), "root"), F.col("_p") == F.col("_of"), "left").select("node", "fp", F.coalesce("root", "_p").alias("passage")).distinct(), "held"
    )
    centres = [F.min(F.struct(F.xxhash64("node", F.lit(k)), F.col("node").alias("b"), F.col("fp").alias("bf"))).alias(f"c{k}") for k in range(CENTRES)]
    shared = held.groupBy("passage").agg(F.count("*").alias("documents"), *centres).where("documents > 1").select(
        F.bitwise_not(F.bitwise_not("passage")).alias("_k"), "documents", F.array(*(F.struct(f"c{k}.b", f"c{k}.bf") for k in range(CENTRES))).alias("centres")
    )
    rarest = Window.partitionBy("node").orderBy("documents", "passage")
    met = held.join(shared, F.col("passage") == F.col("_k")).withColumn("_at", F.row_number().over(rarest)).where(F.col("_at") <= RAREST)
    return met.select("node", "fp", F.explode(F.array_distinct("centres")).alias("c")).where(
        (F.col("c.b") != F.col("node")) & (F.bit_count(F.col("fp").bitwiseXOR(F.col("c.bf"))) <= near_bits)
    ).select(F.greatest("node", "c.b").alias("a"), F.least("node", "c.b").alias("b")).distinct()


def alike(docs: DataFrame, pairs: DataFrame, similarity: float, words: int) -> DataFrame:
    """Those of ``pairs`` (a, b) of nodes whose texts' word shingles have at least that Jaccard similarity."""
    ends = pairs.select(F.explode(F.array("a", "b")).alias("_n")).distinct()

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            sets = [shingles(t.as_buffer().to_pybytes() if t.is_valid else b"", words).view(np.int64) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(sets, pa.list_(pa.int64()))], names=["node", "set"])

    ship(docs.sparkSession)
    named = docs.select(_named(docs)[0], docs["text"].cast("string").alias("text"))
    sets = named.join(ends, F.col("node") == F.col("_n"), "left_semi").dropDuplicates(["node"]).mapInArrow(batches, "node long, set array<long>")
    sets = staged(sets, "shingle-sets")
    both = pairs.join(sets.select(F.col("node").alias("a"), F.col("set").alias("x")), "a").join(sets.select(F.col("node").alias("b"), F.col("set").alias("y")), "b")
    common = F.size(F.array_intersect("x", "y"))
    return both.where(common >= F.lit(similarity) * (F.size("x") + F.size("y") - common)).select("a", "b")


@functools.lru_cache(maxsize=1)
def _usual(path: str) -> tuple[np.ndarray, np.ndarray]:
    """The usual shingles at ``path``, sorted, and how usual each is; once for each Python worker."""
    store, place = filesystem(path)
    held = ds.dataset(place, filesystem=store, format="parquet").to_table()
    order = np.argsort(keys := held.column("h").to_numpy().view(np.uint64))
    return keys[order], held.column("n").to_numpy()[order]


def usual_shingles(docs: DataFrame, words: int) -> str:
    """Where the shingles (h, n) lie that several texts of a sample share, the most frequent USUAL_MOST at most.

    They only decide in which order shingles are looked at: whatever they are, the same pairs are found.
    """

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for t in batch.column("text"):
                yield pa.RecordBatch.from_arrays([pa.array(shingles(t.as_buffer().to_pybytes() if t.is_valid else b"", words).view(np.int64))], names=["h"])

    some = docs.select(docs["text"].cast("string").alias("text")).where(F.pmod(F.xxhash64("text", F.lit(3)), F.lit(USUAL_SHARE)) == 0)
    path = scratch_path(docs.sparkSession, "usual-shingles")
    counted = some.mapInArrow(batches, "h long").groupBy("h").agg(F.count("*").cast("int").alias("n")).where("n > 1")
    counted = staged(counted, "usual-counts")
    if counted.count() > USUAL_MOST:  # 12 bytes each in every worker
        least = counted.groupBy("n").agg(F.count("*").alias("_c")).select("n", F.sum("_c").over(Window.orderBy(F.desc("n"))).alias("_upto")).where(F.col("_upto") <= USUAL_MOST).agg(F.min("n")).first()[0]
        counted = counted.where(F.col("n") >= least) if least is not None else counted.limit(0)
    counted.write.parquet(path)
    return path


def _rare_first(docs: DataFrame, similarity: float, words: int) -> DataFrame:
    """node and, packed to 8 bytes each, the first of its shingles in one order of all, rare ones first, and their number (size).

    A pair of that similarity has ``similarity`` of either's shingles in common, so its first common one is among the first 1 - ``similarity`` of both.
    """
    path = usual_shingles(docs, words)

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, often = _usual(path)
        for batch in it:
            sizes, firsts = [], []
            for t in batch.column("text"):
                own = shingles(t.as_buffer().to_pybytes() if t.is_valid else b"", words)
                if len(keys):
                    at = np.minimum(np.searchsorted(keys, own), len(keys) - 1)
                    own = own[np.lexsort((own, np.where(keys[at] == own, often[at], 0)))]
                sizes.append(len(own))
                firsts.append(own[: len(own) - math.ceil(similarity * len(own) - 1e-9) + 1].view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(sizes, pa.int32()), pa.array(firsts, pa.list_(pa.int64()))], names=["node", "size", "firsts"])

    named = docs.select(_named(docs)[0], docs["text"].cast("string").alias("text"))
    return named.mapInArrow(batches, "node long, size int, firsts array<long>")


def meeting(h: np.ndarray, node: np.ndarray, root: np.ndarray, size: np.ndarray, at: np.ndarray, similarity: float) -> np.ndarray:
    """Which rows (``h``, sorted) share their hash with one of another root, and could have enough in common with some text of its group. Takes one pass for each of two looks, not one for each pair."""
    some = np.arange(len(h))
    for _ in range(2):
        if not len(some):
            break
        starts = np.flatnonzero(np.concatenate([[True], h[some][1:] != h[some][:-1]]))
        rows = np.diff(np.concatenate([starts, [len(some)]]))
        mixed = np.minimum.reduceat(root[some], starts) != np.maximum.reduceat(root[some], starts)
        least = np.maximum(np.repeat(np.minimum.reduceat(size[some], starts), rows), similarity * size[some])  # of the other text
        some = some[np.repeat(mixed, rows) & ((size[some] - at[some]) * (1 + similarity) >= similarity * (size[some] + least) - 1e-6)]
    return some


def same_company(h: np.ndarray, node: np.ndarray) -> np.ndarray:
    """For each row a hash of all nodes of its ``h`` (sorted): the shingles of a passage that the same texts share get one."""
    if not len(h):
        return h
    starts = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
    mixed = node.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    sums = np.add.reduceat(mixed ^ (mixed >> np.uint64(32)), starts)
    return np.repeat(sums, np.diff(np.concatenate([starts, [len(h)]]))).view(np.int64)


def parities(own: np.ndarray) -> np.ndarray:
    """For each bit whether an odd number of the hashes ``own`` fall on it; four bits a hash or more, SKETCH_MOST at most.

    The sketches of two sets differ in no more bits than the sets have different members, whatever falls together.
    """
    bits = min(SKETCH_MOST, max(64, 1 << max(0, 4 * len(own) - 1).bit_length()))
    odd = np.bincount((own & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.uint64)


def differing(sketches: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """In how many bits the sketches ``a`` and ``b`` differ, the longer one folded to the shorter one's bits."""
    words = np.array([len(x) for x in sketches])
    short, out = np.minimum(words[a], words[b]), np.zeros(len(a), np.int64)
    for n in np.unique(short):
        pairs = np.flatnonzero(short == n)
        used, at = np.unique(np.concatenate([a[pairs], b[pairs]]), return_inverse=True)
        folded = np.stack([np.bitwise_xor.reduce(sketches[k].reshape(-1, n), axis=0) for k in used])
        for i in range(0, len(pairs), step := max(1, (1 << 20) // n)):
            x, y = at[: len(pairs)][i : i + step], at[len(pairs) :][i : i + step]
            out[pairs[i : i + step]] = np.bitwise_count(folded[x] ^ folded[y]).sum(axis=1)
    return out


def first_pairs(
    h: np.ndarray, node: np.ndarray, root: np.ndarray, size: np.ndarray, at: np.ndarray, sketches: list[np.ndarray], similarity: float
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of nodes of different roots that share a hash (``h``, sorted), whose shingles from there on could be enough in common, and whose sketches do not rule that out."""
    i, d = np.arange(len(h)), 0
    while len(i):
        d += 1
        i = i[i + d < len(h)]
        i = i[h[i] == h[i + d]]
        j = i + d
        both = size[i] + size[j]
        most = np.minimum(size[i] - at[i], size[j] - at[j])  # the shared one and those after it
        fits = np.flatnonzero((root[i] != root[j]) & (most * (1 + similarity) >= similarity * both - 1e-6))
        if len(fits):
            fits = fits[differing(sketches, i[fits], j[fits]) * (1 + similarity) <= (1 - similarity) * both[fits] + 1e-6]
            a, b = node[i[fits]], node[j[fits]]
            yield np.maximum(a, b), np.minimum(a, b)


def by_hash(it: Iterator[pa.RecordBatch], columns: list[str]) -> Iterator[pa.RecordBatch]:
    """Batches sorted by h, cut where h changes, so that no hash is in two of them."""
    held: list[pa.RecordBatch] = []
    for batch in it:
        batch = batch.select(columns)
        if not batch.num_rows:
            continue
        h = batch.column("h").to_numpy(zero_copy_only=False)
        first = held[0].column("h")[0].as_py() if held else h[0]
        if first == h[-1]:
            held.append(batch)
            continue
        last = int(np.searchsorted(h, h[-1]))
        yield pa.concat_batches([*held, batch.slice(0, last)])
        held = [batch.slice(last)]
    if held:
        yield pa.concat_batches(held)


def remaining_pairs(docs: DataFrame, roots: DataFrame, similarity: float, words: int) -> DataFrame:
    """(a, b): candidates for every pair of that similarity whose nodes do not have one root in ``roots`` (node, root) yet.

    The rare shingles of each text meet those of all other texts, whatever passages they stand in. Tasks read them in order and hold some shingles'
    texts at a time. Shingles that the same texts share count once, at the earliest place of each text (with it pairs are ruled out less often, never more). What meets texts of another root gets a sketch of all its shingles; pairs whose sketches differ in too many bits cannot be that similar and are
    never given out, so that a large group of texts that are nearly similar enough does not make a row for each of its pairs.
    """
    ship(docs.sparkSession)
    columns = ["h", "node", "root", "size", "at"]
    known = roots.select(F.col("node").alias("_n"), "root").hint("merge")
    firsts = _rare_first(docs, similarity, words).dropDuplicates(["node"])
    met = firsts.join(known, F.col("node") == F.col("_n"), "left").select("node", "root", "size", F.posexplode("firsts").alias("at", "h"))

    def numbers(batch: pa.RecordBatch) -> list[np.ndarray]:
        return [batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in columns]

    def meet(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_hash(it, columns):
            batch = batch.take(pa.array(meeting(*numbers(batch), similarity)))
            h, node = numbers(batch)[:2]
            yield batch.set_column(0, "h", pa.array(same_company(h, node)))

    def pairs(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_hash(it, [*columns, "sketch"]):
            sketches = [np.frombuffer(x.as_buffer(), np.uint64) for x in batch.column("sketch")]
            for a, b in first_pairs(*numbers(batch), sketches, similarity):
                both = np.unique(np.stack([a, b], axis=1), axis=0)
                yield pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], names=["a", "b"])

    def sketch(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            each = [parities(shingles(t.as_buffer().to_pybytes() if t.is_valid else b"", words)).tobytes() for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(each, pa.binary())], names=["node", "sketch"])

    ordered = met.select("h", "node", F.coalesce("root", "node").alias("root"), "size", "at").repartition("h").sortWithinPartitions("h")
    met = ordered.mapInArrow(meet, "h long, node long, root long, size int, at int")
    some = staged(met.groupBy("h", "node").agg(F.min("root").alias("root"), F.min("size").alias("size"), F.min("at").alias("at")), "meeting")
    named = docs.select(_named(docs)[0], docs["text"].cast("string").alias("text"))
    named = named.join(some.select(F.col("node").alias("_n")).distinct(), F.col("node") == F.col("_n"), "left_semi").dropDuplicates(["node"])
    sketches = named.mapInArrow(sketch, "node long, sketch binary").withColumnRenamed("node", "_n")
    ordered = some.join(sketches, F.col("node") == F.col("_n")).select(*columns, "sketch").repartition("h").sortWithinPartitions("h")
    return ordered.mapInArrow(pairs, "a long, b long").distinct()


def near_copies(docs: DataFrame, described: DataFrame, similarity: float, words: int, near_bits: int) -> DataFrame:
    """(node, root): the groups of all pairs of texts with that similarity, chains included.

    Shared passages join most of a group at little cost; what they leave apart is compared by its rare shingles, which misses no pair.
    """
    pairs = alike(docs, staged(_candidates(described, near_bits), "near-pairs"), similarity, words)
    roots = staged(components(pairs, "near-links"), "near-roots")
    more = staged(alike(docs, staged(remaining_pairs(docs, roots, similarity, words), "remaining-pairs"), similarity, words), "remaining-links")
    if more.isEmpty():
        return roots
    return components(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).union(more), "near-links")


def keep_one_of_each(docs: DataFrame, similarity: float = 0.8, words: int = 5, near_bits: int = NEAR_BITS) -> DataFrame:
    """One document of each group of near copies, the one with the smallest doc_id; all columns stay.

    Near copies have ``similarity`` of their word shingles. Fingerprints of whole texts of that similarity differ in more bits than
    a vantage-point tree can prune by, so the tree finds passages that two texts share (within two bits); some of their pairs are held against the
    fingerprints of the whole texts, and then exactly. All other pairs of that similarity are found by their rare shingles (:func:`remaining_pairs`).
    Groups are chains of such pairs. Of rows that share the kept doc_id and text one stays;
    a null doc_id stays only where its group has no other.
    """
    described = staged(_described(docs), "described")
    roots = near_copies(docs, described, similarity, words, near_bits).select(F.col("node").alias("_n"), "root")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash", "node")
    grouped = described.select("node", "doc_id", "text_hash").join(roots, F.col("node") == F.col("_n"))
    gone = grouped.select("node", "root").distinct().join(
        grouped.groupBy("root").agg(F.min(order)["node"].alias("_first")).select(F.bitwise_not(F.bitwise_not("root")).alias("_r"), "_first"), F.col("root") == F.col("_r")
    ).where("node <> _first")
    own, copy, left = unused(docs, "_own_node"), unused(docs, "_own_copy"), unused(docs, "_gone")
    gone = gone.select(F.col("node").alias(left)).distinct()
    keyed = docs.withColumn(own, _named(docs)[0])
    kept = keyed.join(gone, keyed[own] == F.col(left), "left_anti")
    return kept.withColumn(copy, F.row_number().over(Window.partitionBy(own).orderBy(F.lit(0)))).where(F.col(copy) == 1).select(*docs.columns)


def op4_simhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours_components(table(spark, sf_dir, "documents"))
