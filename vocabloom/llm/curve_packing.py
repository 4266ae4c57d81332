"""Packing of documents into sequences along a Hilbert curve.

Each document's tokens are hashed to a vector, projected to a few dimensions and placed on a
Hilbert curve; documents are range-sorted by their place, so neighbours on the curve read
alike. The sorted tokens are one stream, cut every ``length`` tokens: only the last sequence has
padding. A task knows its own running totals, and one number for each task (its start in
the stream) is all that is shared.

Token ids are written once, as 16-bit numbers where the vocabulary allows, and shuffled once.

Defined results: a null text counts as empty; an empty text is its end id alone. Rows that repeat
are packed each. Ties on the curve are ordered by doc_id and ids; a null doc_id comes first. An
empty table gives no pieces. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vocabloom.llm._common import ship, spread, staged, table, text_slices
from vocabloom.llm.run_table import PairAgenda, RunTable

LENGTH, END_ID = 2048, 1
#: Hash buckets of a document vector, dimensions of the curve and bits of each.
BUCKETS, DIMS, BITS = 1024, 4, 12
#: New words of each batch that are encoded by the library too.
CHECKED = 64
class WordTokenizer:
    """Token ids of words, as the tokenizers library gives them.

    The vocabulary's tokenizer parts a text at white space first, so a word has the same ids
    anywhere. Plain Latin words go through the merge agenda in batches; any other word, and
    a sample of each batch as a check, goes to the library.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        if self.library.get_vocab_size() > 1 << 16:
            raise ValueError("ids are kept in 16 bits")
        spec = json.loads(self.library.to_str())
        model, self.added = spec["model"], [t["content"].lower() for t in spec["added_tokens"]]
        vocab, suffix = model["vocab"], model["end_of_word_suffix"]
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        pairs = {}
        for rank, (a, b) in enumerate(merges):
            pairs.setdefault((vocab[a], vocab[b]), (rank, vocab[a + b]))
        self.agenda = PairAgenda(pairs)
        # The byte-level alphabet: printable bytes stand for themselves, the others follow 255 in order.
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        letters = {b: chr(b) for b in shown}
        letters |= {b: chr(256 + k) for k, b in enumerate(b for b in range(256) if b not in letters)}
        self.inside = np.array([vocab[letters[b]] for b in range(256)], np.int64)
        self.at_end = np.array([vocab[letters[b] + suffix] for b in range(256)], np.int64)

    def by_library(self, words: list[str]) -> list[list[int]]:
        return [e.ids for e in self.library.encode_batch_fast(words, add_special_tokens=False)]

    def _plain(self, words: pa.Array) -> np.ndarray:
        """Words of visible ASCII without apostrophes and of Latin-1 letters (two bytes, the first C3)."""
        ends = np.frombuffer(words.buffers()[1], np.int32)[1 : len(words) + 1]
        raw = np.frombuffer(words.buffers()[2], np.uint8)[: ends[-1]]
        second = np.concatenate([[False], raw[:-1] == 0xC3])
        fits = (raw > 32) & (raw < 127) & (raw != 39) | (raw == 0xC3) | second & (raw != 0x97) & (raw != 0xB7)
        plain = np.logical_and.reduceat(fits, np.concatenate([[0], ends[:-1]]))
        for token in self.added:
            plain &= ~pc.match_substring(words, token, ignore_case=True).to_numpy(zero_copy_only=False)
        return plain

    def encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of different words end to end, and the length of each; an empty word has none."""
        if "" in words:
            ids, some = self.encode([w for w in words if w])
            lengths = np.zeros(len(words), np.int64)
            lengths[[i for i, w in enumerate(words) if w]] = some
            return ids, lengths
        if not words:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        given = pa.array(words, pa.string())
        plain = self._plain(given)
        text = pc.utf8_lower(given)
        ends = np.frombuffer(text.buffers()[1], np.int32)[1 : len(words) + 1].astype(np.int64)
        raw = np.frombuffer(text.buffers()[2], np.uint8)[: ends[-1]]
        starts = np.concatenate([[0], ends[:-1]])
        # A part is a run of letters, one digit, or a run of other characters.
        kind = np.where((raw >= 97) & (raw <= 122) | (raw >= 128), 0, np.where((raw >= 48) & (raw <= 57), 1, 2))
        cut = np.concatenate([[True], (kind[1:] != kind[:-1]) | (kind[1:] == 1)])
        cut[starts] = True
        part_starts = np.flatnonzero(cut)
        offsets = np.concatenate([part_starts, [len(raw)]]).astype(np.int32)
        parts = pa.BinaryArray.from_buffers(pa.binary(), len(part_starts), [None, pa.py_buffer(offsets), pa.py_buffer(raw)]).dictionary_encode()
        at, different = parts.indices.to_numpy(zero_copy_only=False), parts.dictionary
        flat = np.frombuffer(different.buffers()[2], np.uint8)
        part_ends = np.frombuffer(different.buffers()[1], np.int32)[1 : len(different) + 1].astype(np.int64)
        symbols = self.inside[flat[: part_ends[-1]]]
        symbols[part_ends - 1] = self.at_end[flat[part_ends - 1]]
        ids, sizes = self.agenda.run(symbols, np.diff(np.concatenate([[0], part_ends])))
        of_word = np.searchsorted(ends, part_starts, side="right")
        wanted = plain[of_word]
        ids = ids[spread((np.cumsum(sizes) - sizes)[at[wanted]], sizes[at[wanted]])]
        sums = np.bincount(of_word[wanted], sizes[at[wanted]], len(words)).astype(np.int64)
        odd, checked = np.flatnonzero(~plain).tolist(), np.flatnonzero(plain)[:CHECKED].tolist()
        theirs = dict(zip(odd + checked, self.by_library([words[i] for i in odd + checked])))
        starts = np.cumsum(sums) - sums
        for i in checked:
            if ids[starts[i] : starts[i] + sums[i]].tolist() != theirs[i]:
                raise ValueError(f"{words[i]!r} is {theirs[i]} in the library")
        if odd:
            sums[odd] = [len(theirs[i]) for i in odd]
            out = np.zeros(int(sums.sum()), np.int64)
            out[plain[np.repeat(np.arange(len(words)), sums)]] = ids
            starts = np.cumsum(sums) - sums
            for i in odd:
                out[starts[i] : starts[i] + sums[i]] = theirs[i]
            ids = out
        return ids, sums


@lru_cache(maxsize=2)
def _words(path: str) -> RunTable:
    """One store for each Python worker."""
    return RunTable(WordTokenizer(path).encode)


def hilbert(axes: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Place on the Hilbert curve of each row of coordinates below ``1 << bits``."""
    x = axes.astype(np.int64).T.copy()
    dims = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(dims):
            high = (x[i] & q) > 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & p)
            x[0] ^= np.where(high, p, swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        t ^= np.where((x[-1] & q) > 0, q - 1, 0)
        q >>= 1
    x ^= t
    key = np.zeros_like(t)
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


def curve_places(ids: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The place of each document from its token ids (laid end to end)."""
    axes = np.random.default_rng(7).standard_normal((BUCKETS, DIMS)).astype(np.float32)
    upto = np.zeros((len(ids) + 1, DIMS))
    np.cumsum(axes[ids % BUCKETS], axis=0, out=upto[1:], dtype=np.float64)
    ends = np.cumsum(lengths)
    mean = (upto[ends] - upto[ends - lengths]) / np.maximum(lengths, 1)[:, None]
    top = (1 << BITS) - 1
    return hilbert(np.clip((np.tanh(3 * mean) + 1) / 2 * top, 0, top).astype(np.int64))


def tokenize(docs: DataFrame, tokenizer_path: str, end_id: int = END_ID) -> DataFrame:
    """doc_id, place on the curve, number of tokens (with the end id) and the ids as 16-bit numbers."""
    ship(docs.sparkSession)

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _words(tokenizer_path)
        for batch in it:
            for part in text_slices(batch, "text", 6 << 20):
                lists = pc.ascii_split_whitespace(pc.fill_null(part.column("text"), ""))
                units = lists.flatten().dictionary_encode()
                flat, lengths = words.tokens(units.dictionary.to_pylist(), units.indices.to_numpy(zero_copy_only=False))
                counts = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
                upto = np.concatenate([[0], np.cumsum(lengths)])
                ends = np.cumsum(counts)
                starts, sizes = upto[ends - counts], upto[ends] - upto[ends - counts]
                places = curve_places(flat, sizes)
                raw = [flat[a : a + n].astype("<u2").tobytes() + end_id.to_bytes(2, "little") for a, n in zip(starts, sizes)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(places), pa.array(sizes + 1), pa.array(raw, pa.binary())],
                    names=["doc_id", "place", "tokens", "ids"],
                )

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(batches, "doc_id long, place long, tokens long, ids binary")


def _running(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds to each row the tokens before it in its task."""
    before = 0
    for batch in it:
        n = batch.column("tokens").to_numpy(zero_copy_only=False)
        upto = before + np.cumsum(n)
        before = int(upto[-1]) if len(n) else before
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(upto - n)], names=[*batch.schema.names, "before"])


def pack(docs: DataFrame, tokenizer_path: str | None = None, length: int = LENGTH) -> DataFrame:
    """The pieces: doc_id, start, length, ids_crc32, doc_tokens, sequence_id and offset."""
    path = tokenizer_path or public_tokenizers.path("word_bpe_49k.json")
    tokens = staged(tokenize(docs, path), "tokens")
    order = ["place", F.asc("doc_id"), F.crc32("ids")]
    stream = staged(
        tokens.repartitionByRange(*order).sortWithinPartitions(*order).select(
            "doc_id", "tokens", "ids", F.spark_partition_id().alias("task")
        ).mapInArrow(_running, "doc_id long, tokens long, ids binary, task int, before long"),
        "token-stream",
    )
    # One row for each task.
    totals = stream.groupBy("task").agg(F.sum("tokens").alias("total"))
    earlier = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("task", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("task_start"))
    placed = stream.join(F.broadcast(starts), "task").select(
        "doc_id", "tokens", "ids", (F.col("task_start") + F.col("before")).alias("at")
    )

    def cut(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            n, at = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("tokens", "at"))
            first, last = at // length, (at + n - 1) // length
            pieces = last - first + 1
            row = np.repeat(np.arange(len(n)), pieces)
            sequence = spread(first, pieces)
            lo = np.maximum(sequence * length, at[row])
            hi = np.minimum((sequence + 1) * length, at[row] + n[row])
            start = lo - at[row]
            ids = [np.frombuffer(x.as_buffer(), "<u2").astype("<u4") for x in batch.column("ids")]
            crc = [zlib.crc32(ids[r][a : a + k]) for r, a, k in zip(row, start, hi - lo)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(row)), pa.array(start), pa.array(hi - lo), pa.array(crc, pa.int64()),
                    pa.array(n[row]), pa.array(sequence), pa.array(lo - sequence * length),
                ],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
            )

    return placed.mapInArrow(
        cut, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    )


def op8_curve_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
