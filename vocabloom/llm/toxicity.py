"""Toxicity scores from class-conditional Kneser-Ney models.

Each class, toxic and ordinary text, has a model of words: its own counts less a discount, and what the discount
leaves and TRUST of the corpus are given to the counts that both classes share. A word counts once for each
document that has it, so counts are those of different contexts, as Kneser-Ney's lower orders ask for, and repeated lines do not
distort them. With c a class's count, N and T its words and different words, D the discount and S a
word's share of all counts,

    p(word | class) = (max(c - D, 0) + (D T + TRUST · all) S) / (N + TRUST · all)

A rare expression is thus close to what both classes share, and only what one class has again and again stands out. The
evidence of a word is the logarithm of the two models' ratio, taken against that of a word that none of them has, which is neutral. A
document's evidence is the difference of its two log-likelihoods divided by its number of words, over all words
and over what single words have beyond STRONG (the language or subject of a text shifts every word a little; toxic
expressions stand out). A logistic curve over these two, and nothing else, is the score.

The words of all labelled documents but a quarter are counted with groupBy in Spark, and their evidence is computed there; the table
of it grows with the different words (12 bytes each), and every Python worker looks words up by 64-bit hash. At most
``per_class`` documents of each class from the other quarter, chosen by the hash of doc_id, set the logistic curve. Only texts and
toxic labels enter the models; only the text enters a score.

Defined results: a null text is scored like an empty one. Of labels that repeat a doc_id the
toxic one counts; null labels do not. With no toxic or no ordinary label every score is 0. Rows
that repeat are scored each.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.dataset as ds
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vocabloom.llm._common import add_columns, filesystem, scratch_path, ship, staged, table, text_slices, unused

DISCOUNT = 0.75
#: Share of all counts that the shared model weighs against a class's own ones.
TRUST = 0.15
#: Evidence above which a word counts as strong, and how much of it counts at most.
STRONG, STRONGEST = 1.5, 6.0
#: Labelled documents of each class that the logistic curve is fitted on at most.
PER_CLASS = 8000
THRESHOLD = 0.7
#: What is taken off the ends of words.
EDGES = ".,;:!?\"'()[]{}<>*_-/\\…«»¿¡“”‘’"
#: Seed of Spark's xxhash64.
SEED = 42


class Lookup:
    """A number for each 64-bit hash: sorted hashes, and where those with the same leading bits start; 0 for others."""

    def __init__(self, keys: np.ndarray, values: np.ndarray) -> None:
        order = np.argsort(keys)
        self.keys = keys[order]
        self.values = np.concatenate([values[order], [0]]).astype(np.float32)  # the last is for what is missing
        bits = max(1, int(2 * len(keys)).bit_length())
        self.shift = np.uint64(64 - bits)
        self.starts = np.concatenate([[0], np.cumsum(np.bincount((self.keys >> self.shift).astype(np.int64), minlength=1 << bits))]).astype(np.int32)

    def __call__(self, h: np.ndarray) -> np.ndarray:
        first = (h >> self.shift).astype(np.int64)
        at, end = self.starts[first], self.starts[first + 1]
        out = np.full(len(h), len(self.keys), np.int32)
        left = np.flatnonzero(at < end)
        at, end, h = at[left], end[left], h[left]
        while len(left):
            hit = self.keys[at] == h
            out[left[hit]] = at[hit]
            at += 1
            more = ~hit & (at < end)
            left, at, end, h = left[more], at[more], end[more], h[more]
        return self.values[out]


@lru_cache(maxsize=1)
def load(path: str) -> Lookup:
    """The evidence of the words at ``path``, once for each Python worker."""
    store, place = filesystem(path)
    held = ds.dataset(place, filesystem=store, format="parquet").to_table()
    return Lookup(held.column("hash").to_numpy().view(np.uint64), held.column("evidence").to_numpy())


@dataclass
class ToxicModel:
    """A table of evidence in the shared folder (the driver never holds it), and a logistic curve."""

    path: str
    curve: np.ndarray
    centre: np.ndarray
    scale: np.ndarray


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The different lower-case words of a batch, the number of each word in order, and words in each text."""
    lists = pc.utf8_split_whitespace(pc.utf8_lower(pc.fill_null(texts, "")))
    counts = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
    parts = lists.flatten().dictionary_encode()
    # Words that differ at their ends alone are one. What has nothing else is the empty word, which counts for nothing.
    trimmed = pc.utf8_trim(parts.dictionary, EDGES).dictionary_encode()
    at = trimmed.indices.to_numpy(zero_copy_only=False)[parts.indices.to_numpy(zero_copy_only=False)] if len(parts) else np.zeros(0, np.int64)
    return trimmed.dictionary, at, counts


def word_evidence(words: DataFrame) -> DataFrame:
    """(word, evidence) from the words' counts (word, ordinary, toxic)."""
    sums = words.agg(
        F.sum("ordinary").alias("n0"), F.sum("toxic").alias("n1"),
        F.count_if(F.col("ordinary") > 0).alias("t0"), F.count_if(F.col("toxic") > 0).alias("t1"),
    ).first()
    every = (sums["n0"] or 0) + (sums["n1"] or 0)
    share = (F.col("ordinary") + F.col("toxic")) / F.lit(float(max(1, every)))

    def gain(count: str, kinds: int) -> Column:
        """A word's probability in a class over what the shared counts alone give it there."""
        return 1 + F.greatest(F.col(count) - DISCOUNT, F.lit(0.0)) / (F.lit(DISCOUNT * kinds + TRUST * every) * share)

    return words.select("word", F.log(gain("toxic", sums["t1"] or 0) / gain("ordinary", sums["t0"] or 0)).cast("float").alias("evidence"))


def text_evidence(model: Lookup, texts: pa.Array) -> np.ndarray:
    """For each text its evidence by word, and its strong evidence by word."""
    words, at, counts = words_of(texts)
    hashes = np.fromiter((xxhash.xxh64_intdigest(w, seed=SEED) for w in words.to_pylist()), np.uint64, len(words))
    of_word = model(hashes).astype(np.float64)
    ends = np.cumsum(counts)

    def by_text(v: np.ndarray) -> np.ndarray:
        upto = np.concatenate([[0.0], np.cumsum(v[at])])
        return (upto[ends] - upto[ends - counts]) / np.maximum(counts, 1)

    return np.stack([by_text(of_word), by_text(np.clip(of_word - STRONG, 0, STRONGEST))], axis=1)


def score_texts(model: ToxicModel, texts: pa.Array) -> np.ndarray:
    x = (text_evidence(load(model.path), texts) - model.centre) / model.scale
    z = x @ model.curve[1:] + model.curve[0]
    return 1 / (1 + np.exp(-np.clip(z, -50, 50)))


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Newton's method for a logistic curve with intercept."""
    a = np.hstack([np.ones((len(x), 1)), x])
    w = np.zeros(a.shape[1])
    keep = ridge * np.eye(a.shape[1])
    keep[0, 0] = 1e-6
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + keep, a.T @ (p - y) + keep @ w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def count_words(texts: DataFrame) -> DataFrame:
    """(word, ordinary, toxic): in how many texts (text, toxic) of each class a word is."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "text", 3 << 20):
                words, at, counts = words_of(part.column("text"))
                n = max(1, len(words))
                once = np.unique(np.repeat(np.arange(len(counts)), counts) * n + at)
                toxic, at = part.column("toxic").to_numpy(zero_copy_only=False)[once // n], once % n
                some = pc.not_equal(words, "")
                of_class = (pa.array(np.bincount(at[toxic == c], minlength=n)[: len(words)].astype(np.int64)).filter(some) for c in (0, 1))
                yield pa.RecordBatch.from_arrays([words.filter(some), *of_class], names=["word", "ordinary", "toxic"])

    return texts.mapInArrow(count, "word string, ordinary long, toxic long").groupBy("word").agg(F.sum("ordinary").alias("ordinary"), F.sum("toxic").alias("toxic"))


def fit(docs: DataFrame, labels: DataFrame, learn: Column, per_class: int = PER_CLASS) -> ToxicModel | None:
    """Fits on the labelled documents for which ``learn`` (over doc_id) holds."""
    spark = ship(docs.sparkSession)
    known = labels.where(learn & F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).groupBy(
        F.col("doc_id").cast("long").alias("doc_id")
    ).agg(F.max(F.col("toxic").cast("int")).alias("toxic")).where("toxic IN (0, 1)").withColumn(
        "curve", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(4)) == 0
    )
    if known.select("toxic").distinct().count() < 2:
        return None
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    # Labels grow with the corpus, so their join is a shuffle at every size.
    words = staged(count_words(rows.join(known.where(~F.col("curve")).hint("merge"), "doc_id").select("text", "toxic")), "toxic-words")
    if words.isEmpty():
        return None
    path = scratch_path(spark, "toxic-model")
    word_evidence(words).select(F.xxhash64("word").alias("hash"), "evidence").write.parquet(path)
    model = ToxicModel(path, np.zeros(3), np.zeros(2), np.ones(2))

    def evidence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "text", 3 << 20):
                x = text_evidence(load(model.path), part.column("text"))
                yield add_columns(part, ["doc_id", "toxic"], **{f"x{i}": pa.array(x[:, i]) for i in range(2)})

    def measured(some: DataFrame) -> pd.DataFrame:
        """The evidence of at most per_class documents of each class; of rows that repeat an id the first text in order counts."""
        ids = [
            (r["doc_id"], c)
            for c in (0, 1)
            for r in some.where(F.col("toxic") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class).collect()
        ]
        chosen = spark.createDataFrame(ids, "doc_id long, toxic int")
        return (
            rows.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))
            .mapInArrow(evidence, "doc_id long, toxic int, x0 double, x1 double").toPandas()
        )

    sample = measured(known.where("curve"))
    if sample["toxic"].nunique() < 2:  # too few for both uses
        sample = measured(known)
    sample = sample.sort_values(["doc_id", "x0", "x1"])
    x = sample[["x0", "x1"]].to_numpy()
    model.centre, model.scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    model.curve = _logistic((x - model.centre) / model.scale, sample["toxic"].to_numpy())
    return model


def score(
    docs: DataFrame, model: ToxicModel | None, keep: list[str], threshold: float = THRESHOLD, names: tuple[str, str] = ("score", "predicted")
) -> DataFrame:
    """The columns ``keep`` with the score and whether it reaches ``threshold``, under ``names``."""
    ship(docs.sparkSession)
    schema = T.StructType([*(docs.schema[c] for c in keep), T.StructField(names[0], T.DoubleType()), T.StructField(names[1], T.IntegerType())])
    rows = docs.select(*keep) if "text" in keep else docs.select(*keep, F.col("text").cast("string"))

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for part in text_slices(batch, "text", 3 << 20):
                s = score_texts(model, part.column("text")) if model else np.zeros(part.num_rows)
                yield add_columns(part, keep, **{names[0]: pa.array(s), names[1]: pa.array((s >= threshold).astype(np.int32))})

    return rows.mapInArrow(batches, schema)


def keep_civil(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are not predicted to be toxic, with all their columns."""
    model = fit(docs, labels, F.lit(True))
    names = unused(docs, "score"), unused(docs, "predicted")
    return score(docs, model, docs.columns, names=names).where(F.col(names[1]) == 0).select(*docs.columns)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    model = fit(docs, labels, ~held_out)
    return score(docs, model, ["doc_id"]).select("doc_id", held_out.alias("held_out"), "score", "predicted")
