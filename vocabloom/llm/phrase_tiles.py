"""Collocations: phrases whose words keep together, counted in direct-address tiles of pairs.

Every level is one and the same step. Level 1 are words; those that are frequent get ids by falling frequency. A step takes sequences
of ids, counts adjacent pairs, and gives the frequent pairs ids by falling frequency again: pairs of words are phrases of
two, pairs of overlapping phrases of two are phrases of three, and so on. A phrase is frequent only if its parts are, so nothing is lost.

* Texts are dealt into chunks, and a chunk keeps its sequence as places in its own list of different words (later pairs). Only those lists
  meet the table of ids in Spark, never single words of texts, and no table of words is broadcast.
* The id space of a pair is cut into tiles of TILE x TILE ids. Among the first HEAD x HEAD tiles, which hold most pairs, each tile is counted by
  ``bincount`` over its cells, or where a chunk has few of its pairs by sorting; all other pairs are sorted coordinates, dealt by hash to
  buckets whose number grows with the words.
* Tiles of different chunks are added up in two rounds, the first by tile and a share of the chunks, one block at a time, so
  that the tile of the commonest words is no task's burden and memory holds one tile.

Defined results: a null text counts as empty, a null language as ``und``. Rows that repeat count each. Only A-Z are put in lower case.
Pieces end at ``.,;:!?``, line feeds, form feeds and carriage returns, words at blanks and tabs; any other character is part of a word. An empty table gives no rows.
Only ``text`` and ``lang`` are read. A level has less than 2^32 frequent phrases, or an error says so.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vocabloom.llm._common import gapless, ship, staged, table, text_slices

#: Text of a chunk, and of what is taken apart at once.
CHUNK_BYTES, SLICE_BYTES = 8 << 20, 2 << 20
#: Ids on a side of a tile, and tiles on a side of the part of the id space that is counted by tiles.
TILE, HEAD = 512, 32
#: Words of the corpus for each bucket of other pairs, and chunks for each share of a tile.
BUCKET_WORDS, SHARE_CHUNKS = 1 << 20, 512
#: Coordinates of a bucket that are gathered before equal ones are added up.
GATHERED = 1 << 21
LEAST, LONGEST, COVER, MOST = 30, 4, (80, 100), 2000

_KIND = np.zeros(256, np.uint8)
_KIND[[0x20, 0x09]] = 1
_KIND[[*b".,;:!?\n\x0b\x0c\r"]] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BREAK = re.compile(rb"[.,;:!?\n\x0b\x0c\r]")


def pack(values: np.ndarray, width: int = 4) -> bytes:
    """Whole numbers in ``width`` bytes each, the bytes of one weight together, compressed."""
    return zstandard.compress(np.ascontiguousarray(values.astype(f"<u{width}").view(np.uint8).reshape(-1, width).T).tobytes(), 1)


def unpack(data: bytes, width: int = 4) -> np.ndarray:
    raw = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(width, -1)
    return np.ascontiguousarray(raw.T).view(f"<u{width}").ravel().astype(np.int64)


def numbered(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct values in order, the place of each value among them, and their counts; by direct address where the values fill
    their range well enough, else by sorting."""
    span = int(values.max(initial=-1)) + 1
    if span > 16 * len(values):
        return np.unique(values, return_inverse=True, return_counts=True)
    counts = np.bincount(values, minlength=span)
    distinct = np.flatnonzero(counts)
    place = np.zeros(span, np.int64)
    place[distinct] = np.arange(len(distinct))
    return distinct, place[values], counts[distinct]


def split_words(raw: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The words of texts laid end to end (text k is raw[offsets[k] : offsets[k+1]]), the text of each, and whether it begins a piece."""
    kind = _KIND[raw]
    word = kind == 0
    before, after = np.concatenate([[False], word[:-1]]), np.concatenate([word[1:], [False]])
    before[offsets[:-1][offsets[:-1] < len(raw)]] = False
    after[offsets[1:][offsets[1:] > 0] - 1] = False
    starts, ends = np.flatnonzero(word & ~before), np.flatnonzero(word & ~after) + 1
    of = np.searchsorted(offsets, starts, side="right") - 1
    breaks = np.cumsum(kind == 2, dtype=np.int32)[starts]
    new = np.ones(len(starts), bool)
    new[1:] = (breaks[1:] != breaks[:-1]) | (of[1:] != of[:-1])
    bounds = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int32)
    return pa.StringArray.from_buffers(len(starts), pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(_LOWER[raw[word]]))), of, new


def _laid_out(part: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, list[str]]]:
    """Texts end to end with their bounds and languages. A long text comes in several runs, each up to a break."""
    texts, langs = part.column("text").cast(pa.string()), part.column("lang").to_pylist()
    if len(texts) == 1 and (pc.binary_length(texts)[0].as_py() or 0) > 2 * SLICE_BYTES:
        data, at = texts[0].as_py().encode(), 0
        while at < len(data):
            end = found.end() if (found := _BREAK.search(data, min(at + SLICE_BYTES, len(data)))) else len(data)
            yield np.frombuffer(data, np.uint8)[at:end], np.array([0, end - at]), langs
            at = end
        return
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.frombuffer(texts.buffers()[2], np.uint8) if texts.buffers()[2] else np.zeros(0, np.uint8)
    yield raw[offsets[0] : offsets[-1]], offsets - offsets[0], langs


def _batch(schema: pa.Schema, n: int, /, **columns: pa.Array) -> pa.RecordBatch:
    """Columns that are not given are null."""
    return pa.RecordBatch.from_arrays([columns[f.name].cast(f.type) if f.name in columns else pa.nulls(n, f.type) for f in schema], schema=schema)


_WORD_ROWS = pa.schema([("chunk", pa.int64()), ("place", pa.int32()), ("lang", pa.string()), ("word", pa.string()), ("n", pa.int64()), ("codes", pa.binary())])


def _tokens(docs: DataFrame) -> DataFrame:
    """Rows of a chunk's different words (chunk, place, lang, word, n), and one row of each chunk with its texts as places in them (chunk, codes):
    numbers from 1, with a 0 before each piece."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, size, parts, languages = TaskContext.get().partitionId() << 32, 0, [], {}

        def closed() -> Iterator[pa.RecordBatch]:
            words = pa.concat_arrays([p[0] for p in parts]).dictionary_encode()
            lang, new = np.concatenate([p[1] for p in parts]), np.concatenate([p[2] for p in parts])
            known = max(1, len(words.dictionary))
            distinct, place, counts = numbered(lang * known + words.indices.to_numpy())
            if not len(distinct):
                return
            codes = np.zeros(len(place) + int(new.sum()), np.int64)
            codes[np.arange(len(place)) + np.cumsum(new)] = place + 1
            n = len(distinct)
            yield _batch(
                _WORD_ROWS, n, chunk=pa.array(np.full(n, chunk)), place=pa.array(np.arange(n)), n=pa.array(counts),
                lang=pa.array(list(languages)).take(pa.array(distinct // known)), word=words.dictionary.take(pa.array(distinct % known)),
            )
            yield _batch(_WORD_ROWS, 1, chunk=pa.array([chunk]), codes=pa.array([pack(codes)]))

        for batch in batches:
            for part in text_slices(batch, "text", SLICE_BYTES):
                for raw, offsets, langs in _laid_out(part):
                    words, of, new = split_words(raw, offsets)
                    known = np.array([languages.setdefault(x, len(languages)) for x in langs], np.int64)
                    parts.append((words, known[of], new))
                    size += len(raw)
                    if size >= CHUNK_BYTES:
                        yield from closed()
                        chunk, size, parts, languages = chunk + 1, 0, [], {}
        if parts:
            yield from closed()

    texts = docs.select(F.coalesce(docs["lang"].cast("string"), F.lit("und")).alias("lang"), F.coalesce(docs["text"].cast("string"), F.lit("")).alias("text"))
    return staged(texts.mapInArrow(deal, "chunk long, place int, lang string, word string, n long, codes binary"), "phrase-words")


def _streamed(df: DataFrame, keys: list[str], order: list, take: Callable[[tuple], tuple[Callable, Callable]], schema: pa.Schema, spark_schema: str) -> DataFrame:
    """Rows of ``df`` in order of ``keys`` and ``order`` go one by one to the first function that ``take(key)`` gives, which yields batches, and at the
    end of the key the second one is called; nothing is held but what these hold."""

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, add, close = None, None, None
        for batch in batches:
            for k in range(batch.num_rows):
                row = {name: batch.column(name)[k].as_py() for name in batch.schema.names}
                key = tuple(row[c] for c in keys)
                if key != at:
                    if at is not None:
                        yield from close()
                    at, (add, close) = key, take(key)
                yield from add(row)
        if at is not None:
            yield from close()

    return df.repartition(*keys).sortWithinPartitions(*keys, *order).mapInArrow(stream, spark_schema)


_PAIR_ROWS = pa.schema([("chunk", pa.int64()), ("key", pa.int64()), ("start", pa.int64()), ("first", pa.binary()), ("second", pa.binary()), ("counts", pa.binary()), ("codes", pa.binary())])
_HIT_ROWS = pa.schema([("chunk", pa.int64()), ("places", pa.binary()), ("ids", pa.binary())])
_SUM_ROWS = pa.schema([("key", pa.int64()), ("first", pa.binary()), ("second", pa.binary()), ("counts", pa.binary())])


def _block(key: int, codes: np.ndarray, counts: np.ndarray, **more: list) -> dict[str, pa.Array]:
    """Sorted cells of a tile, or sorted pairs (a << 32 | b) of a bucket, with their counts."""
    tile = key < HEAD * HEAD
    first = codes if tile else codes >> 32
    named = {"key": [key], "first": [pack(np.diff(first, prepend=0))], "second": [b"" if tile else pack(codes & 0xFFFFFFFF)], "counts": [pack(counts, 8)]} | more
    return {k: pa.array(v) for k, v in named.items()}


def _codes(row: dict) -> np.ndarray:
    first = np.cumsum(unpack(row["first"]))
    return first if row["key"] < HEAD * HEAD else first << 32 | unpack(row["second"])


def pair_blocks(ids: np.ndarray, buckets: int) -> tuple[np.ndarray, list[tuple[int, int, np.ndarray, np.ndarray]]]:
    """The adjacent pairs of a sequence of ids (negative ones part it): the place of the pair at each position, from 1 (0 for none), and
    blocks (key, first place, codes, counts), one for each tile or bucket with a pair."""
    at = np.flatnonzero((ids[:-1] >= 0) & (ids[1:] >= 0))
    a, b = ids[at], ids[at + 1]
    if len(a) and max(a.max(), b.max()) >= 1 << 32:
        raise ValueError("a level has more than 2^32 frequent phrases")
    places, blocks, start = np.zeros(max(0, len(ids) - 1), np.int64), [], 1
    in_head = (a < TILE * HEAD) & (b < TILE * HEAD)
    where, x, y = at[in_head], a[in_head], b[in_head]
    tile, cell = (x // TILE * HEAD + y // TILE).astype(np.uint16), x % TILE * TILE + y % TILE
    order = np.argsort(tile, kind="stable")
    ends = np.cumsum(np.bincount(tile, minlength=HEAD * HEAD))
    for key in np.flatnonzero(np.diff(ends, prepend=0)).tolist():
        own = order[ends[key - 1] if key else 0 : ends[key]]
        distinct, place, counts = numbered(cell[own])
        places[where[own]] = start + place
        blocks.append((key, start, distinct, counts))
        start += len(distinct)
    where, codes = at[~in_head], a[~in_head] << 32 | b[~in_head]
    if len(codes):
        distinct, place, counts = np.unique(codes, return_inverse=True, return_counts=True)
        bucket = ((distinct.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)).astype(np.int64) % buckets
        order = np.argsort(bucket, kind="stable")
        moved = np.empty(len(order), np.int64)
        moved[order] = np.arange(len(order))
        places[where] = start + moved[place]
        ends = np.cumsum(np.bincount(bucket, minlength=buckets))
        for key in np.flatnonzero(np.diff(ends, prepend=0)).tolist():
            first = int(ends[key - 1]) if key else 0
            own = order[first : ends[key]]
            blocks.append((HEAD * HEAD + key, start + first, distinct[own], counts[own]))
    return places, blocks


def _pairs(chunks: DataFrame, hits: DataFrame, buckets: int, last: bool, name: str) -> DataFrame:
    """Blocks of the adjacent pairs of each chunk (chunk, key, start, first, second, counts) and, but for the last level, (chunk, codes)."""

    def take(key: tuple) -> tuple[Callable, Callable]:
        found = []

        def add(row: dict) -> Iterator[pa.RecordBatch]:
            if row["codes"] is None:
                found.append((unpack(row["places"]), unpack(row["ids"], 8)))
                return
            codes = unpack(row["codes"])
            of = np.full(int(codes.max(initial=0)) + 1, -1, np.int64)
            for places, ids in found:
                of[places] = ids
            places, blocks = pair_blocks(of[codes], buckets)
            for block, start, values, counts in blocks:
                yield _batch(_PAIR_ROWS, 1, **_block(block, values, counts, chunk=[key[0]], start=[start]))
            if blocks and not last:
                yield _batch(_PAIR_ROWS, 1, chunk=pa.array([key[0]]), codes=pa.array([pack(places)]))

        return add, lambda: ()

    none = F.lit(None).cast("binary")
    met = hits.select("chunk", "places", "ids", none.alias("codes")).unionByName(chunks.select("chunk", none.alias("places"), none.alias("ids"), "codes"))
    schema = "chunk long, key long, start long, first binary, second binary, counts binary, codes binary"
    return staged(_streamed(met, ["chunk"], [F.col("codes").isNotNull()], take, _PAIR_ROWS, schema), name)


def _sums(key: int, out: Callable[[np.ndarray, np.ndarray], Iterator[pa.RecordBatch]]) -> tuple[Callable, Callable]:
    """Adds up the blocks of one tile in an array of its cells, or of one bucket by sorting, and hands out the sums."""
    if key < HEAD * HEAD:
        cells = np.zeros(TILE * TILE, np.int64)

        def add(row: dict) -> Iterator[pa.RecordBatch]:
            cells[_codes(row)] += unpack(row["counts"], 8)
            return iter(())

        def close() -> Iterator[pa.RecordBatch]:
            found = np.flatnonzero(cells)
            return out(found, cells[found])

        return add, close
    parts, size = [], 0

    def merge() -> None:
        codes, counts = (np.concatenate(x) for x in zip(*parts))
        order = np.argsort(codes, kind="stable")
        codes, counts = codes[order], counts[order]
        first = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]]))
        parts[:] = [(codes[first], np.add.reduceat(counts, first))]

    def gather(row: dict) -> Iterator[pa.RecordBatch]:
        nonlocal size
        parts.append((_codes(row), unpack(row["counts"], 8)))
        size += len(parts[-1][0])
        if size > GATHERED:
            merge()
            size = len(parts[0][0]) // 2
        return iter(())

    def finish() -> Iterator[pa.RecordBatch]:
        merge()
        return out(*parts[0])

    return gather, finish


def _frequent(blocks: DataFrame, shares: int, least: int, name: str) -> DataFrame:
    """(id, a, b, f, key) of the pairs that occur ``least`` times or more; ids from 0 by falling frequency."""

    def partial(key: tuple) -> tuple[Callable, Callable]:
        return _sums(key[0], lambda codes, counts: iter([_batch(_SUM_ROWS, 1, **_block(key[0], codes, counts))]))

    rows = pa.schema([("key", pa.int64()), ("a", pa.int64()), ("b", pa.int64()), ("f", pa.int64())])

    def whole(key: tuple) -> tuple[Callable, Callable]:
        def out(codes: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
            codes, counts = codes[counts >= least], counts[counts >= least]
            if key[0] < HEAD * HEAD:
                a, b = key[0] // HEAD * TILE + codes // TILE, key[0] % HEAD * TILE + codes % TILE
            else:
                a, b = codes >> 32, codes & 0xFFFFFFFF
            for k in range(0, len(codes), 1 << 16):
                some = slice(k, k + (1 << 16))
                yield _batch(rows, len(codes[some]), key=pa.array(np.full(len(codes[some]), key[0])), a=pa.array(a[some]), b=pa.array(b[some]), f=pa.array(counts[some]))

        return _sums(key[0], out)

    shared = blocks.select("key", "first", "second", "counts", F.pmod(F.xxhash64("chunk"), F.lit(shares)).alias("share"))
    added = _streamed(shared, ["key", "share"], [], partial, _SUM_ROWS, "key long, first binary, second binary, counts binary")
    return _ranked(_streamed(added, ["key"], [], whole, rows, "key long, a long, b long, f long"), ["a", "b"], name)


def _ranked(rows: DataFrame, ties: list[str], name: str) -> DataFrame:
    """``rows`` with ids from 0 by falling f; staged."""
    placed = gapless(rows.withColumn("_every", F.lit(0)), "_every", [F.desc("f"), *map(F.col, ties)], name, "id")
    return staged(placed.drop("_every"), name)


def _word_hits(words: DataFrame, frequent: DataFrame) -> DataFrame:
    """(chunk, places, ids): the frequent words of each chunk."""

    def packed(group: pa.Table) -> pa.Table:
        place, ids = (group.column(c).to_numpy() for c in ("place", "id"))
        return pa.table({"chunk": group.column("chunk").combine_chunks().slice(0, 1), "places": pa.array([pack(place + 1)]), "ids": pa.array([pack(ids, 8)])})

    found = words.join(frequent.select("lang", "word", "id"), ["lang", "word"]).select("chunk", "place", "id")
    return found.groupBy("chunk").applyInArrow(packed, "chunk long, places binary, ids binary")


def _pair_hits(blocks: DataFrame, frequent: DataFrame, shares: int) -> DataFrame:
    """(chunk, places, ids): the frequent pairs of each chunk, a row for each of its blocks with any."""

    def packed(group: pa.Table) -> pa.Table:
        key, a, b, ids = (group.column(c).to_numpy() for c in ("key", "a", "b", "id"))
        codes = a % TILE * TILE + b % TILE if key[0] < HEAD * HEAD else a << 32 | b
        order = np.argsort(codes)
        block = _block(int(key[0]), codes[order], np.zeros(0, np.int64))
        return pa.table({"key": block["key"], "first": block["first"], "second": block["second"], "ids": pa.array([pack(ids[order], 8)])})

    def take(key: tuple) -> tuple[Callable, Callable]:
        codes, ids, cells = None, None, None

        def add(row: dict) -> Iterator[pa.RecordBatch]:
            nonlocal codes, ids, cells
            if row["ids"] is not None:
                codes, ids = _codes(row), unpack(row["ids"], 8)
                if key[0] < HEAD * HEAD:
                    cells = np.full(TILE * TILE, -1, np.int64)
                    cells[codes] = ids
            elif codes is not None:
                own = _codes(row)
                if cells is not None:
                    of = cells[own]
                else:
                    at = np.minimum(np.searchsorted(codes, own), len(codes) - 1)
                    of = np.where(codes[at] == own, ids[at], -1)
                if (hit := of >= 0).any():
                    yield _batch(_HIT_ROWS, 1, chunk=pa.array([row["chunk"]]), places=pa.array([pack(row["start"] + np.flatnonzero(hit))]), ids=pa.array([pack(of[hit], 8)]))

        return add, lambda: ()

    null = lambda kind: F.lit(None).cast(kind)
    known = frequent.select("key", "a", "b", "id").groupBy("key").applyInArrow(packed, "key long, first binary, second binary, ids binary")
    each = known.withColumn("share", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shares - 1).cast("long")))).select("key", "share", "first", "second", "ids", null("long").alias("chunk"), null("long").alias("start"))
    own = blocks.select("key", F.pmod(F.xxhash64("chunk"), F.lit(shares)).alias("share"), "first", "second", null("binary").alias("ids"), "chunk", "start")
    return _streamed(each.unionByName(own), ["key", "share"], [F.col("ids").isNull()], take, _HIT_ROWS, "chunk long, places binary, ids binary")


def frequent_phrases(docs: DataFrame, least: int = LEAST, longest: int = LONGEST) -> tuple[DataFrame, list[DataFrame]]:
    """(lang, n), the words of each language; and for each length of phrase its table (id, lang, phrase, last, fronts, backs, a, b, f).

    f is the number of occurrences, fronts and backs those of the phrase's first and last 1, 2, ... words; a and b are the ids of the phrases
    without the last and without the first word.
    """
    ship(docs.sparkSession)
    rows = _tokens(docs)
    words, chunks = rows.where("codes IS NULL"), rows.where("codes IS NOT NULL").select("chunk", "codes")
    totals = staged(words.groupBy("lang").agg(F.sum("n").alias("n")), "phrase-totals")
    every, shares = totals.agg(F.sum("n")).first()[0] or 0, -(-chunks.count() // SHARE_CHUNKS) or 1
    buckets = max(16, every // BUCKET_WORDS)
    frequent = _ranked(words.groupBy("lang", "word").agg(F.sum("n").alias("f")).where(F.col("f") >= least), ["lang", "word"], "phrases-1")
    none = F.lit(None).cast("long")
    levels = [frequent.select("id", "lang", F.col("word").alias("phrase"), F.col("word").alias("last"), F.array("f").alias("fronts"), F.array("f").alias("backs"), none.alias("a"), none.alias("b"), "f")]
    hits = _word_hits(words, frequent)
    for k in range(2, longest + 1):
        pairs = _pairs(chunks, hits, buckets, k == longest, f"phrase-pairs-{k}")
        blocks, chunks = pairs.where("codes IS NULL"), pairs.where("codes IS NOT NULL").select("chunk", "codes")
        frequent = _frequent(blocks, shares, least, f"phrases-{k}")
        hits = _pair_hits(blocks, frequent, shares)
        front = levels[-1].select(F.col("id").alias("a"), "lang", F.col("phrase").alias("_front"), "fronts")
        back = levels[-1].select(F.col("id").alias("b"), F.col("last").alias("last"), "backs")
        named = frequent.join(front, "a").join(back, "b").select(
            "id", "lang", F.concat_ws(" ", "_front", "last").alias("phrase"), "last", F.array_append("fronts", F.col("f")).alias("fronts"), F.array_append("backs", F.col("f")).alias("backs"), "a", "b", "f"
        )
        levels.append(staged(named, f"phrase-names-{k}"))
    return totals, levels


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, cover: tuple[int, int] = COVER, most: int = MOST) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``most`` best phrases of each language, by the weakest of their cuts.

    A phrase goes where a longer one around it has ``cover`` of its occurrences; that is so just when one of one more word has.
    """
    totals, levels = frequent_phrases(docs, least, longest)

    def cut(j: int, k: int) -> str:
        l, r = f"fronts[{j - 1}]", f"backs[{k - j - 1}]"  # noqa: E741
        score = f"CAST(2000000 AS DECIMAL(18, 0)) * CAST(f AS DECIMAL(19, 0)) div CAST({l} + {r} AS DECIMAL(19, 0))"
        return f"struct({score} AS score, {j} AS cut, {l} AS l, {r} AS r)"

    scored = None
    for k, phrases in enumerate(levels[1:], 2):
        if k < longest:
            around = levels[k].select(F.col("a").alias("id"), "f").unionByName(levels[k].select(F.col("b").alias("id"), "f")).groupBy("id").agg(F.max("f").alias("_most"))
            phrases = phrases.join(around, "id", "left").where(f"_most IS NULL OR CAST({cover[1]} AS DECIMAL(18, 0)) * _most < CAST({cover[0]} AS DECIMAL(18, 0)) * f")
        cuts = ", ".join(cut(j, k) for j in range(1, k))
        part = phrases.select("lang", "phrase", F.col("f").alias("a"), F.expr(f"array_min(array({cuts}))").alias("c")).select("lang", "phrase", "a", "c.l", "c.r", "c.score")
        scored = part if scored is None else scored.unionByName(part)
    order = [F.desc("score"), F.desc("a"), "phrase"]
    share = scored.withColumn("_share", F.pmod(F.xxhash64("phrase"), F.lit(64)))  # a language's best are among the best of its shares
    some = share.withColumn("_place", F.row_number().over(Window.partitionBy("lang", "_share").orderBy(*order))).where(F.col("_place") <= most)
    best = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= most)
    return best.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


OP12_SQL = r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
w AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS ws FROM p),
totals AS (SELECT lang, sum(len(ws))::BIGINT AS n FROM w GROUP BY lang),
g AS (SELECT lang, k, unnest(list_transform(range(1, len(ws)::BIGINT - k + 2), lambda i: array_to_string(list_slice(ws, i, i + k - 1), ' '))) AS phrase
      FROM w CROSS JOIN range(1, 5) AS s(k)),
f AS (SELECT lang, k, phrase, count(*) AS f FROM g GROUP BY ALL HAVING count(*) >= 30),
cut AS (SELECT lang, k, phrase, f, j, string_split(phrase, ' ') AS parts FROM f CROSS JOIN range(1, 4) AS s(j) WHERE j < k),
scored AS (
  SELECT c.lang, c.k, c.phrase, c.f AS a, x.f AS l, y.f AS r, c.j, (2000000::HUGEINT * c.f) // (x.f + y.f) AS score
  FROM cut c JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.parts[1:c.j], ' ')
             JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.parts[c.j + 1:], ' ')),
weakest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
inner_ AS (SELECT lang, array_to_string(string_split(phrase, ' ')[i:i + m - 1], ' ') AS phrase, f
           FROM f CROSS JOIN range(2, 4) AS x(m) CROSS JOIN range(1, 4) AS y(i) WHERE m < k AND i <= k - m + 1),
longer AS (SELECT lang, phrase, max(f) AS most FROM inner_ GROUP BY ALL),
kept AS (SELECT w.* FROM weakest w LEFT JOIN longer USING (lang, phrase) WHERE most IS NULL OR 100::HUGEINT * most < 80::HUGEINT * a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""
