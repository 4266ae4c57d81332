"""SentencePiece encoding and decoding for merge-type (BPE) vocabularies.

The encoder keeps an agenda of adjacent symbol pairs ordered by the score of the piece they
would make, ties to the left; the best pair is merged until none is left, and what is not a
piece falls back to bytes. No piece runs from a visible character into a space mark or across a
line end (checked when a vocabulary is loaded), so the units between those places have
agendas of their own: a task works through the agendas of all units that are new in a batch
together, those of long units one by one from a heap (:class:`PairAgenda`), and keeps the results. Every new unit is checked against the
sentencepiece library in the Arrow batch that brought it; a difference is an error. Decoding
is the library's.

Defined results: a null text counts as empty. An empty text has the begin and end ids only. Rows
that repeat are encoded each; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vocabloom.llm._common import ship, table, text_slices
from vocabloom.llm.run_table import PairAgenda, RunTable

SPACE = "▁"
UNITS = re.compile(r"\n| +[^ \n]*|[^ \n]+")


class PieceModel:
    """The vocabulary of a model file, the agenda encoder over it, and the library's decoder.

    A symbol is the id of a piece, or for a character that is no piece, its code point above all ids.
    """

    def __init__(self, path: str):
        self.library = sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = sp.get_piece_size()
        names = [sp.id_to_piece(i) for i in range(self.size)]
        special = {i for i in range(self.size) if sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i)}
        ids = {p: i for i, p in enumerate(names) if i not in special}
        self.bytes = {int(names[i][3:5], 16): i for i in special if sp.is_byte(i)}
        self.begin, self.end = sp.bos_id(), sp.eos_id()
        if any(re.search(f"[^{SPACE}]{SPACE}|.\n|\n.", p, re.S) for p in ids) or len(self.bytes) != 256:
            raise ValueError("this vocabulary has pieces that cross words or no byte fallback")
        if self.size > 1 << 16:
            raise ValueError("ids are kept in 16 bits")
        self.symbols = np.arange(0x110000, dtype=np.int64) + self.size
        for p, i in ids.items():
            if len(p) == 1:
                self.symbols[ord(p)] = i
        ranks = {s: r for r, s in enumerate(sorted({sp.get_score(i) for i in ids.values()}, reverse=True))}

        def symbol(p: str) -> int | None:
            return ids.get(p, int(self.symbols[ord(p)]) if len(p) == 1 else None)

        pairs = {}
        for p, i in ids.items():
            for k in range(1, len(p)):
                left, right = symbol(p[:k]), symbol(p[k:])
                if left is not None and right is not None:
                    pairs[left, right] = ranks[sp.get_score(i)], i
        self.agenda = PairAgenda(pairs)
        self.runs = RunTable(self.checked)

    def merge(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of units (spaces are space marks), end to end, and the length of each."""
        text = "".join(units).replace(" ", SPACE)
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        lengths = np.fromiter(map(len, units), np.int64, len(units))
        symbols, lengths = self.agenda.run(self.symbols[codes], lengths)
        unknown = np.flatnonzero(symbols >= self.size)
        if len(unknown):
            spelled = {c: [self.bytes[b] for b in chr(c - self.size).encode()] for c in np.unique(symbols[unknown]).tolist()}
            times = np.ones(len(symbols), np.int64)
            times[unknown] = [len(spelled[c]) for c in symbols[unknown].tolist()]
            starts = np.cumsum(times) - times
            out = np.repeat(symbols, times)
            for k, c in zip(unknown.tolist(), symbols[unknown].tolist()):
                out[starts[k] : starts[k] + times[k]] = spelled[c]
            word = np.repeat(np.arange(len(lengths)), lengths)
            symbols, lengths = out, np.bincount(word, times, len(lengths)).astype(np.int64)
        return symbols, lengths

    def checked(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The agenda's ids of new units, compared with the library's in one batch.

        The library puts a space mark before a text: a unit that starts with a space is given
        without it, and others after a line end, whose ids are taken off.
        """
        ids, lengths = self.merge(units)
        head = len(self.library.encode("\n"))  # the mark and the line end
        given, cut = [], []
        for u in units:
            marked, ended = u[0] == " " and len(u) > 1, u[0] == "\n"
            given.append(u[1:] if marked else u if ended else "\n" + u)
            cut.append(0 if marked else head - 1 if ended else head)
        theirs = [t[k:] for t, k in zip(self.library.encode(given, num_threads=1), cut)]
        flat = np.fromiter((t for x in theirs for t in x), np.int64)
        if not np.array_equal(flat, ids) or not np.array_equal(lengths, [len(x) for x in theirs]):
            ends = np.cumsum(lengths)
            for u, a, b, other in zip(units, ends - lengths, ends, theirs):
                if ids[a:b].tolist() != other:
                    raise ValueError(f"{u!r}: {ids[a:b].tolist()} is not the library's {other}")
        return ids, lengths

    def _units(self, texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Different units of the texts, the number of each unit in order, and units in each text."""
        # A unit is what follows a space up to the next one, or a line end with what follows it.
        lists = pc.split_pattern(pc.replace_substring(texts, "\n", " \n"), " ")
        counts = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        flat = lists.flatten().dictionary_encode()
        at = flat.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        units = [u if u[:1] == "\n" else " " + u for u in flat.dictionary.to_pylist()]
        # Runs of spaces make empty parts: those texts, and those with space marks, are parted one by one.
        of = np.repeat(np.arange(len(counts)), counts)
        odd = np.zeros(len(counts), bool)
        empty = np.flatnonzero([u == " " for u in units])
        odd[of[np.isin(at, empty)]] = True
        odd |= pc.match_substring(texts, SPACE).to_numpy(zero_copy_only=False)
        if odd.any():
            known = {u: i for i, u in enumerate(units)}
            parts = np.split(at, np.cumsum(counts)[:-1])
            for i in np.flatnonzero(odd).tolist():
                text = texts[i].as_py()
                found = UNITS.findall(" " + text.replace(SPACE, " ")) if text else []
                parts[i] = np.array([known.setdefault(u, len(known)) for u in found], np.int64)
                counts[i] = len(found)
            units, at = list(known), np.concatenate(parts)
        used = np.unique(at)  # not the empty part
        place = np.zeros(len(units), np.int64)
        place[used] = np.arange(len(used))
        return [units[i] for i in used.tolist()], place[at], counts

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """Ids of each text, with begin and end ids."""
        units, at, counts = self._units(texts)
        runs, lengths = self.runs.tokens(units, at)
        upto = np.concatenate([[0], np.cumsum(lengths)])
        ends = np.cumsum(counts)
        ids = runs.astype("<u4")
        return [
            np.concatenate([[self.begin], ids[a:b], [self.end]]).astype("<u4")
            for a, b in zip(upto[ends - counts], upto[ends])
        ]

    def decode(self, ids: list[np.ndarray]) -> list[str]:
        return self.library.decode([x.tolist() for x in ids], num_threads=1)


@lru_cache(maxsize=2)
def load(path: str) -> PieceModel:
    """One model for each Python worker."""
    return PieceModel(path)


def encode_decode(docs: DataFrame, model_path: str) -> DataFrame:
    """doc_id, number and digest of the ids, and digest of the decoded text."""
    ship(docs.sparkSession)

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load(model_path)
        for batch in it:
            for part in text_slices(batch, "text", 6 << 20):
                ids = model.encode(pc.fill_null(part.column("text"), ""))
                decoded = model.decode(ids)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"), pa.array([len(x) for x in ids], pa.int64()),
                        pa.array([hashlib.sha256(x.tobytes()).hexdigest() for x in ids]),
                        pa.array([hashlib.sha256(t.encode()).hexdigest() for t in decoded]),
                    ],
                    names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(batches, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op9_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_decode(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
