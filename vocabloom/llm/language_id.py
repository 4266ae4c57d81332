"""Language identification with string kernels.

Two texts are compared by the blended-spectrum presence kernel: the cosine of their sets of
character n-grams of lengths 2 to 4, hashed into ``BINS`` bins. A Nystroem map over landmark texts
turns the kernel into features, and one-versus-rest kernel ridge regression on a sample of labelled
texts gives each language a weight vector. Scoring is a chain of matrix products over
batches of texts. A long text is scored in windows of ``WINDOW`` characters, whose margins are averaged by
length, so a passage in another language weighs as much as it takes up; the whole text counts.

The model is fitted on at most ``per_language`` labelled rows with a text of each language (chosen by the
hash of doc_id). Every window of such a text is a training row, weighted by its length, so a text counts once; tasks
return only sums over their rows, and other tasks add them up, so the driver gets one small matrix a language. Each language gives an equal share of the landmarks, one window of a text each. The model
is a few hundred kilobytes whatever the size of the corpus.

Defined results: a text that is null or has no letter is ``und`` with score 0. Languages are compared
in alphabetical order, so ties go to the first. Without labelled rows every text is ``und``.
Rows that repeat are scored each; other columns are passed on where asked for.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vocabloom.llm._common import add_columns, ship, table, text_slices, unused

BINS, LENGTHS = 1 << 14, (2, 3, 4)
#: Rows of each language for the fit, landmarks in all, ridge, and the softness of the score.
PER_LANGUAGE, LANDMARKS, RIDGE, SOFTNESS = 1000, 128, 0.05, 8.0
WINDOW = 2000
#: Tasks that sum over the sampled texts, and rows of a language's sums that are added up together.
SUM_TASKS, SUM_ROWS = 32, 4
UNKNOWN = "und"


@dataclass
class LanguageModel:
    languages: list[str]
    landmarks: np.ndarray  # bins x landmarks, columns of length one
    weights: np.ndarray  # landmarks x languages
    bias: np.ndarray


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def presence(texts: list[str]) -> np.ndarray:
    """One row of ones and zeros for each text, scaled to length one."""
    lengths = np.array([len(t) + 2 for t in texts])
    joined = "".join(f" {t} " for t in texts).lower()
    if len(joined) != lengths.sum():  # a few characters grow when lower-cased
        lowered = [f" {t} ".lower() for t in texts]
        lengths, joined = np.array([len(t) for t in lowered]), "".join(lowered)
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    of = np.repeat(np.arange(len(texts), dtype=np.int64) * BINS, lengths)
    out = np.zeros(len(texts) * BINS, np.float32)
    rolled = codes * np.uint32(2654435761)
    for n in range(2, max(LENGTHS) + 1):
        if len(codes) < n:
            break
        rolled = (rolled[:-1] ^ (rolled[:-1] >> np.uint32(15))) * np.uint32(2246822519) + codes[n - 1 :] * np.uint32(3266489917)
        if n in LENGTHS:
            inside = of[: len(rolled)] == of[n - 1 :]
            mixed = (rolled ^ (rolled >> np.uint32(13))) & np.uint32(BINS - 1)
            out[(of[: len(rolled)] + mixed)[inside]] = 1
    out = out.reshape(len(texts), BINS)
    return out / np.sqrt(np.maximum(out.sum(axis=1, keepdims=True), 1))


def margins(model: LanguageModel, grams: np.ndarray) -> np.ndarray:
    return (grams @ model.landmarks) @ model.weights + model.bias


def windows_of(text: str) -> list[str]:
    return [text[k : k + WINDOW] for k in range(0, max(1, len(text)), WINDOW)]


def text_margins(model: LanguageModel, texts: list[str]) -> np.ndarray:
    """For each text the mean of its windows' margins, weighted by length."""
    windows = [(i, w) for i, t in enumerate(texts) for w in windows_of(t)]
    total, length = np.zeros((len(texts), len(model.languages))), np.zeros(len(texts))
    for k in range(0, len(windows), 128):
        at, parts = zip(*windows[k : k + 128])
        sizes = np.array([len(p) for p in parts], np.float64)
        np.add.at(total, np.array(at), margins(model, presence(list(parts))) * sizes[:, None])
        np.add.at(length, np.array(at), sizes)
    return total / np.maximum(length, 1)[:, None]


def _first_ids(ids: DataFrame, most: int) -> DataFrame:
    """The first ``most`` different ids of each language in the order of their hash, and their place (_place).

    Only ids whose hash is so low that some four times as many pass are ranked, so a frequent language is not sorted in one task.
    """
    parts = 1 << 30
    hashed = ids.withColumn("_h", F.pmod(F.xxhash64("doc_id"), F.lit(parts)))
    sizes = ids.groupBy(F.col("lang").alias("_lang")).agg(F.approx_count_distinct("doc_id").alias("_ids"))  # one row a language
    low = hashed.join(F.broadcast(sizes), F.col("lang") == F.col("_lang")).where(F.col("_h").cast("double") * F.col("_ids") <= 4.0 * most * parts)
    order = Window.partitionBy("lang").orderBy("_h", "doc_id")
    return low.select("lang", "doc_id", "_h").distinct().withColumn("_place", F.row_number().over(order)).where(F.col("_place") <= most)


def fit(docs: DataFrame, learn: Column, per_language: int = PER_LANGUAGE, landmarks: int = LANDMARKS) -> LanguageModel | None:
    """Fits on the rows of ``docs`` where ``learn`` holds and lang, doc_id and text are not null."""
    ship(docs.sparkSession)
    known = docs.where(learn & F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & F.col("text").isNotNull())
    chosen = _first_ids(known.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang")), per_language)
    ids = [(r["doc_id"], r["lang"], r["_place"]) for r in chosen.collect()]  # at most per_language for each language
    languages = sorted({lang for _, lang, _ in ids})
    if not languages:
        return None
    share = max(1, landmarks // len(languages))
    picked = docs.sparkSession.createDataFrame(ids, "doc_id long, lang string, place int").groupBy("doc_id", "lang").agg((F.min("place") <= share).alias("mark"))
    rows = known.select(
        F.col("doc_id").cast("long"), F.col("lang").cast("string"), F.col("text").cast("string")
    ).join(F.broadcast(picked), ["doc_id", "lang"])

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One window of each text, chosen by the hash of doc_id."""
        for batch in batches:
            for part in text_slices(batch, "text", 4 << 20):
                for i in range(0, part.num_rows, 128):
                    rows = part.slice(i, 128)
                    some = []
                    for doc, text in zip(rows.column("doc_id").to_pylist(), rows.column("text").to_pylist()):
                        windows = windows_of(text)
                        some.append(windows[zlib.crc32(str(doc).encode()) % len(windows)])
                    bits = np.packbits(presence(some) > 0, axis=1)
                    yield pa.RecordBatch.from_arrays(
                        [rows.column("doc_id"), rows.column("lang"), pa.array([x.tobytes() for x in bits], pa.binary())],
                        names=["doc_id", "lang", "grams"],
                    )

    one = rows.where("mark").groupBy("doc_id", "lang").agg(F.min("text").alias("text"))  # rows that repeat an id give one landmark
    sample = one.mapInArrow(packed, "doc_id long, lang string, grams binary").toPandas()
    sample = sample.sort_values(["lang", "doc_id", "grams"]).groupby("lang").head(share)
    marks = np.stack([np.frombuffer(g, np.uint8) for g in sample["grams"]])

    def unit(bits: np.ndarray) -> np.ndarray:
        grams = np.unpackbits(bits, axis=1).astype(np.float32)
        return grams / np.sqrt(np.maximum(grams.sum(axis=1, keepdims=True), 1))

    z = unit(marks)
    values, vectors = np.linalg.eigh((z @ z.T).astype(np.float64))
    good = values > 1e-6 * values.max()
    root = vectors[:, good] / np.sqrt(values[good])
    size = root.shape[1]

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """For each language the weights, the weighted features and their products, over every window of a task's texts."""
        columns = unit(marks).T
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            for part in text_slices(batch, "text", 4 << 20):
                windows = [
                    (lang, len(w) / len(text) if text else 1.0, w)
                    for lang, text in zip(part.column("lang").to_pylist(), part.column("text").to_pylist())
                    for w in windows_of(text)
                ]
                for i in range(0, len(windows), 128):
                    langs, weights, some = zip(*windows[i : i + 128])
                    x = np.hstack([np.ones((len(some), 1)), (presence(list(some)) @ columns).astype(np.float64) @ root])
                    of, weights = np.array(langs, dtype=object), np.array(weights)
                    for lang in set(langs):
                        mine = x[of == lang]
                        total[lang] = total.get(lang, 0) + (mine * weights[of == lang][:, None]).T @ mine
        task = TaskContext.get().partitionId()
        parts = [(lang, k, task, v[k : k + SUM_ROWS].tobytes()) for lang, v in total.items() for k in range(0, size + 1, SUM_ROWS)]
        if parts:
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, kind) for x, kind in zip(zip(*parts), (pa.string(), pa.int32(), pa.int32(), pa.binary()))], names=["lang", "first", "task", "sums"]
            )

    def added(part: pa.Table) -> pa.Table:
        """The sum of the tasks' rows ``first`` and after of a language's products, in the order of tasks, which float sums depend on."""
        total = sum(np.frombuffer(x.as_buffer()) for x in part.sort_by("task").column("sums"))
        return part.select(["lang", "first"]).slice(0, 1).append_column("sums", pa.array([total.tobytes()], pa.binary()))

    gathered = {lang: np.zeros((size + 1, size + 1)) for lang in languages}
    # Tasks add up what the tasks have summed, so the driver gets one matrix a language, however many tasks there are.
    each = rows.repartition(SUM_TASKS, "doc_id").select("lang", "text").mapInArrow(sums, "lang string, first int, task int, sums binary")
    for r in each.groupBy("lang", "first").applyInArrow(added, "lang string, first int, sums binary").collect():
        gathered[r["lang"]][r["first"] : r["first"] + SUM_ROWS] = np.frombuffer(bytes(r["sums"])).reshape(-1, size + 1)
    centre = sum(g[0, 1:] for g in gathered.values()) / sum(g[0, 0] for g in gathered.values())
    y = 2 * np.eye(len(languages)) - 1
    # Languages weigh the same, so that a rare one is not lost.
    products, targets = np.zeros((size, size)), np.zeros((size, len(languages)))
    for k, lang in enumerate(languages):
        g = gathered[lang] / gathered[lang][0, 0]
        mean = g[0, 1:]
        products += g[1:, 1:] - np.outer(mean, centre) - np.outer(centre, mean) + np.outer(centre, centre)
        targets += np.outer(mean - centre, y[k])
    solved = np.linalg.solve(products + RIDGE * np.trace(products) / size * np.eye(size), targets)
    return LanguageModel(
        languages, np.ascontiguousarray(z.T), (root @ solved).astype(np.float32), (y.mean(axis=0) - centre @ solved).astype(np.float32)
    )


def predict(
    docs: DataFrame, model: LanguageModel | None, keep: list[str], names: tuple[str, str] = ("lang_pred", "score")
) -> DataFrame:
    """The columns ``keep`` with the predicted language and its score (a softmax of the margins), under ``names``."""
    ship(docs.sparkSession)
    schema = T.StructType([*(docs.schema[c] for c in keep), T.StructField(names[0], T.StringType()), T.StructField(names[1], T.DoubleType())])
    text = "text" if "text" in keep else None
    rows = docs.select(*keep) if text else docs.select(*keep, F.col("text").cast("string"))
    languages = np.array([*(model.languages if model else []), UNKNOWN], dtype=object)

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for part in text_slices(batch, "text", 4 << 20):
                texts = pc.fill_null(part.column("text"), "").to_pylist()
                best = np.full(len(texts), len(languages) - 1)
                score = np.zeros(len(texts))
                known = np.array([i for i, t in enumerate(texts) if model and has_letter(t)], np.int64)
                if len(known):
                    m = SOFTNESS * text_margins(model, [texts[k] for k in known])
                    e = np.exp(m - m.max(axis=1, keepdims=True))
                    best[known] = m.argmax(axis=1)
                    score[known] = e.max(axis=1) / e.sum(axis=1)
                yield add_columns(part, keep, **{names[0]: pa.array(languages[best], pa.string()), names[1]: pa.array(score)})

    return rows.mapInArrow(batches, schema)


def keep_identified(docs: DataFrame) -> DataFrame:
    """The documents in an identified language, with all their columns; those without a letter go."""
    model = fit(docs, F.lit(True))
    names = unused(docs, "lang_pred"), unused(docs, "score")
    return predict(docs, model, docs.columns, names).where(F.col(names[0]) != UNKNOWN).select(*docs.columns)


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    model = fit(docs, ~held_out)
    return predict(docs, model, ["doc_id"]).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")
