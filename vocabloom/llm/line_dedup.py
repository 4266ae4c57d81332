"""Removal of lines that many documents share, by a sharded minimal perfect hash.

1. Documents are dealt into chunks of some megabytes, each with the distinct hashes of its lines and how many of
   its documents have each; both are written once.
2. The sorted hashes are cut by their leading bits into shards. Each shard adds up its counts and gets a minimal perfect
   hash over its distinct hashes, which places a compact fingerprint and a count: a :class:`Shard`, one row of the index.
3. The hashes of a chunk visit the shards in blocks and probe those arrays; only the hashes of common lines return to the
   chunk, where they meet its texts. No row stands for a line at any point.

The number of shards grows with the lines, so a shard, like a chunk, has a bounded size; nothing is broadcast.
A line that is in all documents is one hash in each chunk and one slot of one shard.

Hashes have 128 bits; two different lines with one hash are not told apart (for 10^11 lines a chance of 10^-17).
The fingerprint has 32 bits and matters only for an index that is probed by documents that it was not built from.

Defined results: a null or empty text is one empty line. Blank lines never go. Rows are documents, so rows that repeat a
doc_id count each, and a line that repeats within a document counts once. An empty table gives no rows.
Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from xxhash import xxh3_128_digest

from vocabloom.llm._common import ship, staged, table, text_slices

#: Bytes of text of a chunk (a longer text is a chunk of its own), and hashes of a shard before equal ones are added up.
CHUNK_BYTES, SHARD_KEYS = 8 << 20, 1 << 18
#: Documents from which on a line is common.
LEAST = 10
BLANKS = b" \t\n\x0b\x0c\r"
#: Bits of a level of the perfect hash for each key that it has to place.
SPREAD = 2
_STEP = np.uint64(0x9E3779B97F4A7C15)


def line_hashes(text: str) -> tuple[list[bytes], list[bytes | None]]:
    """The lines of a text and the hash of each one's key, None for a blank one; a key is stripped of blanks and has A-Z in lower case."""
    lines = text.encode().split(b"\n")
    return lines, [xxh3_128_digest(key) if (key := x.strip(BLANKS).lower()) else None for x in lines]


def _words(hashes: bytes) -> np.ndarray:
    """The hashes as rows of two 64-bit words."""
    return np.frombuffer(hashes, "<u8").reshape(-1, 2)


def _added(words: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes in order, with the sums of their counts."""
    order = np.lexsort((words[:, 1], words[:, 0]))
    words, counts = words[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], (words[1:] != words[:-1]).any(axis=1)])) if len(words) else np.zeros(0, np.int64)
    return words[first], np.add.reduceat(counts, first) if len(first) else counts


def _mixed(words: np.ndarray, level: int) -> np.ndarray:
    x = (words[:, 0] ^ (words[:, 1] * _STEP)) + np.uint64((level + 1) * int(_STEP) % 2**64)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


class Shard:
    """A minimal perfect hash of 128-bit hashes, with a fingerprint and a count in each key's slot.

    A level is a bit array in which the keys that are alone at their place set a bit; the others go to the next level. A key's
    slot is the number of set bits before its own, so n keys have the slots 0 to n - 1.
    """

    def __init__(self, sizes: np.ndarray, bits: np.ndarray, marks: np.ndarray, counts: np.ndarray):
        self.sizes, self.bits, self.marks, self.counts = sizes, bits, marks, counts
        self.slots = np.cumsum(bits, dtype=np.int64) - 1

    @classmethod
    def build(cls, words: np.ndarray, counts: np.ndarray) -> Shard:
        """``words`` are distinct."""
        levels, left = [], words
        while len(left):
            at = (_mixed(left, len(levels)) % np.uint64(SPREAD * len(left))).astype(np.int64)
            alone = np.bincount(at, minlength=SPREAD * len(left)) == 1
            levels.append(alone)
            left = left[~alone[at]]
        made = cls(np.array([len(x) for x in levels], np.int64), np.concatenate([np.zeros(0, bool), *levels]), np.zeros(len(words), "<u4"), np.zeros(len(words), "<u4"))
        at = made.places(words)
        made.marks[at], made.counts[at] = words[:, 1].astype("<u4"), np.minimum(counts, 2**32 - 1)
        return made

    def places(self, words: np.ndarray) -> np.ndarray:
        """The slot of each hash; -1 where no level has a bit, which no key has."""
        slots, open_, start = np.full(len(words), -1, np.int64), np.arange(len(words)), 0
        for level, size in enumerate(self.sizes.tolist()):
            at = start + (_mixed(words[open_], level) % np.uint64(size)).astype(np.int64)
            hit = self.bits[at]
            slots[open_[hit]] = self.slots[at[hit]]
            open_, start = open_[~hit], start + size
        return slots

    def probe(self, words: np.ndarray) -> np.ndarray:
        """The count of each hash, 0 where the fingerprint is another one's."""
        at = self.places(words)
        known = at >= 0
        known[known] = self.marks[at[known]] == words[known, 1].astype("<u4")
        return np.where(known, self.counts[np.where(known, at, 0)] if len(self.counts) else 0, 0)

    def row(self) -> dict[str, pa.Array]:
        return {
            "sizes": pa.array([self.sizes.tolist()], pa.list_(pa.int64())), "bits": pa.array([np.packbits(self.bits).tobytes()]),
            "marks": pa.array([self.marks.tobytes()]), "counts": pa.array([self.counts.tobytes()]),
        }

    @classmethod
    def of_row(cls, row: dict) -> Shard:
        sizes = np.array(row["sizes"], np.int64)
        bits = np.unpackbits(np.frombuffer(row["bits"], np.uint8), count=int(sizes.sum())).astype(bool)
        return cls(sizes, bits, np.frombuffer(row["marks"], "<u4"), np.frombuffer(row["counts"], "<u4"))


def _dealt(docs: DataFrame) -> DataFrame:
    """Rows of texts (doc_id, text, chunk) and, with a null text, rows of chunks (chunk, hashes, counts, keys); staged."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, size, found = TaskContext.get().partitionId() << 32, 0, []

        def closed() -> pa.RecordBatch:
            words, counts = _added(_words(b"".join(found)), np.ones(sum(map(len, found)) // 16, np.int64))
            return pa.RecordBatch.from_arrays(
                [pa.nulls(1, pa.int64()), pa.nulls(1, pa.string()), pa.array([chunk]), pa.array([words.tobytes()], pa.binary()), pa.array([counts.astype("<u4").tobytes()], pa.binary()), pa.array([len(words)], pa.int64())],
                names=["doc_id", "text", "chunk", "hashes", "counts", "keys"],
            )

        for batch in batches:
            for part in text_slices(batch, "text", CHUNK_BYTES):
                for text in part.column("text").to_pylist():
                    found.append(b"".join({h for h in line_hashes(text)[1] if h}))
                n = part.num_rows
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("text"), pa.array(np.full(n, chunk)), pa.nulls(n, pa.binary()), pa.nulls(n, pa.binary()), pa.nulls(n, pa.int64())],
                    names=["doc_id", "text", "chunk", "hashes", "counts", "keys"],
                )
                size += pc.sum(pc.binary_length(part.column("text"))).as_py() or 0
                if size >= CHUNK_BYTES:
                    yield closed()
                    chunk, size, found = chunk + 1, 0, []
        if found:
            yield closed()

    texts = docs.select(docs["doc_id"].cast("long").alias("doc_id"), F.coalesce(docs["text"].cast("string"), F.lit("")).alias("text"))
    return staged(texts.mapInArrow(deal, "doc_id long, text string, chunk long, hashes binary, counts binary, keys long"), "line-chunks")


def _shard_bits(chunks: DataFrame) -> int:
    keys = chunks.agg(F.sum("keys")).first()[0] or 0
    return max(4, (keys // SHARD_KEYS).bit_length())


def _cut(chunks: DataFrame, bits: int) -> DataFrame:
    """(shard, chunk, hashes, counts): the hashes of each chunk by their first ``bits`` bits."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                words, counts = _words(row["hashes"]), np.frombuffer(row["counts"], "<u4")
                shards, first = np.unique(words[:, 0] >> np.uint64(64 - bits), return_index=True)
                ends = [*first[1:].tolist(), len(words)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shards.astype(np.int64)), pa.array(np.full(len(shards), row["chunk"])), pa.array([words[a:b].tobytes() for a, b in zip(first.tolist(), ends)], pa.binary()), pa.array([counts[a:b].tobytes() for a, b in zip(first.tolist(), ends)], pa.binary())],
                    names=["shard", "chunk", "hashes", "counts"],
                )

    return chunks.select("chunk", "hashes", "counts").mapInArrow(cut, "shard long, chunk long, hashes binary, counts binary")


def build_index(chunks: DataFrame, bits: int) -> DataFrame:
    """(shard, keys, sizes, bits, marks, counts): a row for each :class:`Shard` over the lines of ``chunks``."""

    def build(group: pa.Table) -> pa.Table:
        words, counts = _added(
            _words(b"".join(group.column("hashes").to_pylist())), np.frombuffer(b"".join(group.column("counts").to_pylist()), "<u4").astype(np.int64)
        )
        shard = Shard.build(words, counts)
        return pa.table({"shard": group.column("shard").combine_chunks().slice(0, 1), "keys": pa.array([len(words)], pa.int64()), **shard.row()})

    schema = "shard long, keys long, sizes array<long>, bits binary, marks binary, counts binary"
    return staged(_cut(chunks, bits).groupBy("shard").applyInArrow(build, schema), "line-index")


def common_lines(chunks: DataFrame, index: DataFrame, bits: int, least: int) -> DataFrame:
    """(chunk, hits): the hashes of a chunk that ``index`` has with ``least`` documents or more; a row for each shard with any."""

    def probe(blocks: pa.Table, shards: pa.Table) -> pa.Table:
        chunk, hits = [], []
        if shards.num_rows:
            shard = Shard.of_row(shards.to_pylist()[0])
            for of, hashes in zip(blocks.column("chunk").to_pylist(), blocks.column("hashes").to_pylist()):
                words = _words(hashes)
                if (common := shard.probe(words) >= least).any():
                    chunk.append(of)
                    hits.append(words[common].tobytes())
        return pa.table({"chunk": pa.array(chunk, pa.int64()), "hits": pa.array(hits, pa.binary())})

    blocks = _cut(chunks, bits).select("shard", "chunk", "hashes")
    return blocks.groupBy("shard").cogroup(index.groupBy("shard")).applyInArrow(probe, "chunk long, hits binary")


def drop_common_lines(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """(doc_id, text, n_lines, n_dropped): every document without the lines whose key is in ``least`` documents or more; n_lines counts
    all of its lines."""
    ship(docs.sparkSession)
    dealt = _dealt(docs)
    chunks = dealt.where("text IS NULL")
    bits = _shard_bits(chunks)
    hits = common_lines(chunks, build_index(chunks, bits), bits, least)

    def drop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, common = None, set()
        for batch in batches:
            for part in text_slices(batch, "text"):
                kept, lines_of, dropped, ids = [], [], [], []
                for chunk, doc_id, text, hit in zip(*(part.column(c).to_pylist() for c in ("chunk", "doc_id", "text", "hits"))):
                    if chunk != at:
                        at, common = chunk, set()
                    if hit is not None:
                        common.update(hit[k : k + 16] for k in range(0, len(hit), 16))
                        continue
                    lines, hashes = line_hashes(text)
                    stay = [x for x, h in zip(lines, hashes) if h not in common]
                    kept.append(b"\n".join(stay).decode())
                    lines_of.append(len(lines))
                    dropped.append(len(lines) - len(stay))
                    ids.append(doc_id)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array(kept, pa.string()), pa.array(lines_of, pa.int64()), pa.array(dropped, pa.int64())], names=["doc_id", "text", "n_lines", "n_dropped"]
                )

    none = F.lit(None)
    met = hits.select("chunk", none.cast("long").alias("doc_id"), none.cast("string").alias("text"), "hits").unionByName(
        dealt.where("text IS NOT NULL").select("chunk", "doc_id", "text", none.cast("binary").alias("hits"))
    )
    ordered = met.repartition("chunk").sortWithinPartitions("chunk", F.col("hits").isNull())  # a chunk's hits come before its texts
    return ordered.mapInArrow(drop, "doc_id long, text string, n_lines long, n_dropped long")


def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = drop_common_lines(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


OP13_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT row, doc_id, generate_subscripts(lines, 1) AS place, unnest(lines) AS line FROM d),
k AS (SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
common AS (SELECT key FROM (SELECT DISTINCT row, key FROM k WHERE key <> '') GROUP BY key HAVING count(*) >= 10),
f AS (SELECT k.*, common.key IS NOT NULL AS gone FROM k LEFT JOIN common USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone), '')) AS kept_sha256
FROM f GROUP BY row, doc_id
"""
