import numpy as np
from pyspark.sql import functions as F

from vocabloom.llm import language_id


def test_first_ids_of_each_language(spark):
    """A frequent language, a rare one and a repeated id: the ids of lowest hash, each once, as by sorting all."""
    rows = [(i, "en") for i in range(3000)] + [(5000 + i, "de") for i in range(3)] + [(7, "en")] * 50 + [(9, "fr")] * 40
    ids = spark.createDataFrame(rows, "doc_id long, lang string")
    hashes = {r.doc_id: r.h for r in ids.distinct().select("doc_id", F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)).alias("h")).collect()}
    got = {}
    for r in language_id._first_ids(ids, 20).collect():
        got.setdefault(r.lang, {})[r._place] = r.doc_id
    for lang, most in (("en", 20), ("de", 3), ("fr", 1)):
        want = sorted({i for i, x in rows if x == lang}, key=lambda i: (hashes[i], i))[:most]
        assert [got[lang][k] for k in range(1, most + 1)] == want and len(got[lang]) == most


def test_kernel_is_a_cosine_of_sets():
    """The presence kernel of two texts against plain sets of their n-grams (bins of their own, as none collide here)."""
    texts = ["abca", "abcd", "zzz", "", "Ünder the Äpfel"]
    rows = language_id.presence(texts)
    sets = [{f" {t} ".lower()[i : i + n] for n in language_id.LENGTHS for i in range(len(t) + 3 - n)} for t in texts]
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            want = len(a & b) / np.sqrt(max(1, len(a)) * max(1, len(b)))
            assert abs(float(rows[i] @ rows[j]) - want) < 1e-5


def test_a_text_in_two_languages(spark):
    """Windows weigh by length: the language that takes up more of a long text wins, wherever it stands."""
    en = "the river runs over the stone and through the quiet town while people are walking home "
    de = "der schnelle Fuchs springt über den faulen Hund und läuft weg in die dunkle Nacht hinein "
    train = spark.createDataFrame([(i, (en if i % 2 else de) * 3, "en" if i % 2 else "de") for i in range(20)], "doc_id long, text string, lang string")
    model = language_id.fit(train, F.lit(True))
    asked = spark.createDataFrame([(0, en * 20 + de * 80), (1, de * 20 + en * 80), (2, en * 60 + de * 20 + en * 5)], "doc_id long, text string")
    got = language_id.predict(asked, model, ["doc_id"]).orderBy("doc_id").collect()
    assert [r.lang_pred for r in got] == ["de", "en", "en"] and all(0 < r.score < 1 for r in got)


def test_driver_gets_one_matrix_a_language(spark, monkeypatch):
    """However many tasks sum over the sampled texts, the driver gets as much, and the model is the same."""
    rows = [(i, f"{'river stone town' if i % 2 else 'Fuchs springt Hund'} {i * 7919 % 101} {i}", "en" if i % 2 else "de") for i in range(80)]
    train, frame, sent = spark.createDataFrame(rows, "doc_id long, text string, lang string"), type(spark.range(0)), []
    collect = frame.collect

    def counted(self):
        got = collect(self)
        if "sums" in self.columns:
            sent.append(sum(len(r["sums"]) for r in got))
        return got

    monkeypatch.setattr(frame, "collect", counted)
    models = []
    for tasks in (1, 24):
        monkeypatch.setattr(language_id, "SUM_TASKS", tasks)
        models.append(language_id.fit(train, F.lit(True), landmarks=20))
    one, many = models
    assert sent[0] == sent[1] <= 2 * 21 * 21 * 8, sent
    assert np.array_equal(one.landmarks, many.landmarks) and np.allclose(one.weights, many.weights) and np.allclose(one.bias, many.bias)
