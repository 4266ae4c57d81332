import hashlib
import itertools
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from vocabloom.llm import curve_packing, exact_dedup, kd_shards, language_id, licences, piece_codec, simhash_native, simhash_neardup, toxicity, warc

DOCS = "doc_id long, text string, lang string, source string, n_chars long, digest string, score double"
TEXTS = [
    "The quick brown fox jumps over the lazy dog again and again", "The quick  brown fox jumps over the lazy\ndog again and again", None, "", "  \n ", "one",
    "ÀÉ naïve <|endoftext|> don't ▁mark  double", "x " * 3000, "The quick brown fox jumps over the lazy dog again and again",
    "Der schnelle braune Fuchs springt über den faulen Hund und läuft weg", "日本語 text 🙂\tend\x00",
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en" if i != 9 else "de", "src0", 0, "clash", 0.5) for i, t in enumerate(TEXTS)]
    rows += [rows[0], (None, "one", None, None, None, None, None)]  # a repeated row and a row without an id
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


def test_exact_dedup(docs, empty):
    rows = exact_dedup.exact_dedup(docs).collect()
    assert len(rows) == docs.count() and exact_dedup.exact_dedup(empty).count() == 0
    groups = {}
    for r in rows:
        groups.setdefault(r.text_sha256, []).append(r)
    norm = {i: hashlib.sha256("".join((t or "").translate(dict.fromkeys([9, 10, 11, 12, 13, 32]))).encode()).hexdigest() for i, t in enumerate(TEXTS)}
    for r in rows:
        assert r.doc_id is None or r.text_sha256 == norm[r.doc_id]
    assert all(sum(r.kept for r in g) == 1 and all(r.group_size == len(g) for r in g) for g in groups.values())
    fox = groups[norm[0]]
    assert {r.keep_id for r in fox} == {1} and len(fox) == 4
    assert {r.keep_id for r in groups[norm[2]]} == {4}
    kept = exact_dedup.keep_first_copies(docs)
    assert kept.columns == docs.columns and kept.count() == len(groups)


def test_index_goes_on(spark, docs, tmp_path):
    index = exact_dedup.DigestIndex(spark, str(tmp_path / "index"), 2)
    first, second = docs.where("doc_id < 5"), docs.where("doc_id >= 5")
    assert exact_dedup.exact_dedup(first, index, "a").where("kept").count() == 2
    later = {r.doc_id: r for r in exact_dedup.exact_dedup(second, index, "b").collect()}
    assert not later[8].kept and later[8].keep_id == 1 and later[9].kept
    assert index.rows().count() == index.rows().select("digest").distinct().count()


def test_simhash_components(spark, docs, empty):
    rows = simhash_neardup.neighbours_components(docs).collect()
    assert len(rows) == docs.count() and simhash_neardup.neighbours_components(empty).count() == 0
    by = {r.doc_id: r for r in rows}
    assert by[2].fingerprint == by[3].fingerprint == by[4].fingerprint == "0" * 16
    assert by[8].component_id == 0 and by[9].component_id == 9
    assert simhash_neardup.keep_one_of_each(docs).count() == len({r.component_id for r in rows})


@pytest.mark.parametrize("crowd", [40, 10_000])
def test_links_equal_brute_force(spark, crowd):
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**63, 60, dtype=np.int64)
    near = [int(b) ^ (1 << int(j)) for b in base[:20] for j in rng.integers(0, 62, 6)]
    points = sorted({int(b) for b in base} | set(near) | {n ^ 3 for n in near[:30]})
    df = spark.createDataFrame([(p,) for p in points], "fp long")
    found = simhash_neardup.links(df, 2, shard_rows=50, crowd_rows=crowd).collect()

    def roots(pairs):
        root = {p: p for p in points}

        def find(x):
            while root[x] != x:
                x = root[x]
            return x

        for a, b in pairs:
            a, b = sorted((find(a), find(b)))
            root[b] = a
        return [find(p) for p in points]

    brute = [(a, b) for a, b in itertools.combinations(points, 2) if (a ^ b).bit_count() <= 2]
    assert roots([(r.a, r.b) for r in found]) == roots(brute)


def test_native_fingerprints(docs, empty):
    rows = simhash_native.fingerprint_report(docs).collect()
    assert len(rows) == docs.count() and simhash_native.fingerprint_report(empty).count() == 0
    by = {r.doc_id: r for r in rows}
    assert by[0].fingerprint == by[8].fingerprint and by[2].fingerprint == by[3].fingerprint == by[4].fingerprint
    text, following = TEXTS[9], TEXTS[8]
    edited = text[: len(text) - len(text) // 2] + following[: len(text) // 2]
    assert by[9].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest() and by[9].n_chars == len(text)
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows)
    assert all((r.near_fingerprints is None) == (r.doc_id != 0) for r in rows)


def test_block_tables(spark):
    rng = np.random.default_rng(5)
    fps = [int(x) for x in rng.integers(-(2**63), 2**63 - 1, 80, dtype=np.int64)]
    fps += [f ^ (1 << i) ^ (1 << (i + 20)) for i, f in enumerate(fps[:20])]
    df = spark.createDataFrame([(f,) for f in fps], "fp long")
    for expected in (0, 10**9):
        got = {(r.query, r.fp) for r in simhash_native.within_radius(df, df, 3, expected).collect()}
        assert got == {(a, b) for a in fps for b in fps if ((a ^ b) & (2**64 - 1)).bit_count() <= 3}


def test_shards(docs, empty):
    rows = kd_shards.shard(docs, 4).collect()
    assert len(rows) == docs.count() and kd_shards.shard(empty, 4).count() == 0
    slots = {}
    for r in rows:
        assert 0 <= r.shard < 4 and r.law == "bytes" and r.grown_shard is None
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert len({r.shard for r in rows if r.doc_id in (0, 8)}) == 1
    text = {i: t or "" for i, t in enumerate(TEXTS)}
    assert all(r.text_crc32 == zlib.crc32(text[r.doc_id].encode()) and r.size == len(text[r.doc_id].encode()) + 8 for r in rows if r.doc_id is not None)


def test_warc_round_trip(spark, tmp_path):
    pages = [(1, "http://a/1", "<p>é</p>"), (2, None, "<p>é</p>"), (3, "http://a/3", None), (4, "http://a/4", ""), (5, "u", "z" * 50_000), (5, "u", "z" * 50_000), (None, "n", "alone")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    files = warc.write_archive(df, str(tmp_path / "a"), shard_records=2, roll_bytes=50)
    assert len(files) >= 3 and not list((tmp_path / "a").glob("_temporary*"))
    rows = warc.read_archive(spark, str(tmp_path / "a")).collect()
    assert len(rows) == len(pages)
    kinds = sorted((r.page_id or 0, r.record_type, r.refers_to) for r in rows)
    assert kinds == [(0, "response", None), (1, "revisit", 2), (2, "response", None), (3, "revisit", 4), (4, "response", None), (5, "response", None), (5, "revisit", 5)]
    by = {r.page_id: r for r in rows if r.record_type == "response"}
    assert by[2].payload.decode() == "<p>é</p>" and by[5].payload_bytes == 50_000
    names = sorted(p.name for p in (tmp_path / "a").iterdir())
    warc.write_archive(df, str(tmp_path / "b"), shard_records=2, roll_bytes=50)
    assert names == sorted(p.name for p in (tmp_path / "b").iterdir())
    assert all((tmp_path / "a" / n).read_bytes() == (tmp_path / "b" / n).read_bytes() for n in names)
    warc.write_archive(df.limit(0), str(tmp_path / "c"))
    assert warc.read_archive(spark, str(tmp_path / "c")).count() == 0


def test_piece_codec_is_the_library(docs, empty):
    path = public_tokenizers.path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    rows = {r.doc_id: r for r in piece_codec.encode_decode(docs, path).collect()}
    for i, t in enumerate(TEXTS):
        ids = library.encode(t or "", add_bos=True, add_eos=True)
        assert rows[i].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest() and rows[i].n_tokens == len(ids)
        assert rows[i].decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()
    assert piece_codec.encode_decode(empty, path).count() == 0


def test_packing(docs, empty):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rows = curve_packing.pack(docs, length=64).collect()
    assert curve_packing.pack(empty).count() == 0
    runs = {}
    for r in rows:
        runs.setdefault(r.sequence_id, []).append((r.offset, r.length))
    full = [sum(n for _, n in v) for v in runs.values()]
    assert sorted(full)[1:] == [64] * (len(full) - 1) and set(runs) == set(range(len(runs)))
    assert all(o == sum(n for _, n in sorted(v)[:k]) for v in runs.values() for k, (o, _) in enumerate(sorted(v)))
    for i, t in enumerate(TEXTS[1:], 1):
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        for r in (r for r in rows if r.doc_id == i):
            assert r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes())


def test_hilbert_is_a_walk():
    axes = np.array(list(itertools.product(range(8), repeat=2)))
    key = curve_packing.hilbert(axes, 3)
    assert sorted(key) == list(range(64))
    walk = axes[np.argsort(key)]
    assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def test_languages(spark, docs, empty):
    en, de = "the cat and the dog ran over the hill with them ", "der hund und die katze liefen über den hügel mit ihnen "
    rows = [(i, (en if i % 2 else de) * (1 + i % 3) + str(i), "en" if i % 2 else "de") for i in range(60)]
    train = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_id.fit(train, F.lit(True))
    got = {r.doc_id: r for r in language_id.predict(docs, model, ["doc_id", "score"], ("lang_pred", "sure")).collect()}
    assert got[0].lang_pred == "en" and got[9].lang_pred == "de" and got[2].lang_pred == got[4].lang_pred == "und"
    assert language_id.fit(empty, F.lit(True)) is None
    assert {r.lang_pred for r in language_id.predict(docs, None, ["doc_id"]).collect()} == {"und"}
    kept = language_id.keep_identified(train)
    assert kept.columns == train.columns and kept.count() == 60


def test_toxicity(spark, docs, empty):
    rng = np.random.default_rng(1)
    words = ["alpha", "beta", "gamma", "delta", "river", "stone", "cloud", "green"]
    rows, marks = [], []
    for i in range(160):
        w = [words[k] for k in rng.integers(0, 8, 60)]
        if i % 4 == 0:
            for k in rng.integers(0, 60, 4):
                w[k] = ["grimbold", "snarkle"][k % 2]
        rows.append((i, " ".join(w)))
        marks.append((i, int(i % 4 == 0)))
    d, labels = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(marks + [(1, None)], "doc_id long, toxic int")
    model = toxicity.fit(d, labels, F.col("doc_id") < 120)
    scored = {r.doc_id: r.predicted for r in toxicity.score(d, model, ["doc_id"]).collect()}
    held = [i for i in range(120, 160)]
    assert np.mean([scored[i] == (i % 4 == 0) for i in held]) > 0.9
    assert all(0 <= r.score <= 1 for r in toxicity.score(docs, model, ["doc_id"]).collect())
    assert toxicity.fit(d, labels.limit(0), F.lit(True)) is None and toxicity.score(empty, model, ["doc_id"]).count() == 0


def test_licences(spark, docs, empty):
    model = licences.train(["the river runs over the stone", "a cloud of green"] * 40)
    cases = {
        "Released under the MIT License.": "mit", "x y z\nLicensed under the Apache License, Version 2.0.\nmore": "apache-2.0", "Licensed under CC BY-NC 4.0.": "cc-by-nc",
        "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions are met:": "bsd",
    }
    for text, family in cases.items():
        assert [f[2] for f in licences.find_licences(model, text)] == [family]
    for text in ("", "the public was licensed to run", "a general version of the software", "permission"):
        assert licences.find_licences(model, text) == []
    assert licences.scan(docs, model).count() == docs.count() and licences.scan(empty, model).count() == 0


def test_pipeline_stages(spark, docs, tmp_path):
    import corpus_pipeline

    labels = spark.createDataFrame([(0, 0)], "doc_id long, toxic int")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, kept, str(tmp_path))
        assert kept.columns == docs.columns, name
    assert {r.doc_id for r in kept.collect()} >= {1, 6, 7}
    assert corpus_pipeline.STAGES[-1][1](spark, kept, str(tmp_path)).count() >= kept.count()


def test_stages_keep_every_group_once(spark):
    """Null and shared ids: each group of equal or near texts keeps exactly one row, and no other text goes."""
    a, b, c = ("alpha beta gamma delta epsilon zeta", "one two three four five six seven", "uno dos tres cuatro cinco seis siete")
    rows = [(None, a), (None, b), (None, b), (1, c), (1, a + " "), (2, c), (3, None), (3, "other words in this text here"), (3, "other words in this text  here")]
    df = spark.createDataFrame([(i, t, None, "s", 0, "own", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long, _own_key string, _own_copy int")
    for stage in (exact_dedup.keep_first_copies, simhash_neardup.keep_one_of_each):
        out = stage(df)
        assert out.columns == df.columns
        got = sorted(((r.doc_id, "".join((r.text or "").split())) for r in out.collect()), key=str)
        assert got == sorted([(1, a.replace(" ", "")), (None, b.replace(" ", "")), (1, c.replace(" ", "")), (3, ""), (3, "otherwordsinthistexthere")], key=str)
        assert stage(df.limit(0)).count() == 0


def test_languages_train_on_whole_texts(spark):
    """A long text that opens in another language teaches its own, and texts that are null use up no quota."""
    en = "the river runs over the stone and through the quiet town while people are walking home "
    de = "der schnelle Fuchs springt über den faulen Hund und läuft weg in die dunkle Nacht hinein "
    rows = [(i, en * 30, "en") for i in range(8)] + [(i, en * 25 + de * 150, "de") for i in range(8, 16)]
    model = language_id.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), F.lit(True))
    asked = spark.createDataFrame([(0, en), (1, de)], "doc_id long, text string")
    assert [r.lang_pred for r in language_id.predict(asked, model, ["doc_id"]).orderBy("doc_id").collect()] == ["en", "de"]
    rows = [(i, en * 2, "en") for i in range(8)] + [(i, None if i % 10 else de * 2, "de") for i in range(10, 210)]
    model = language_id.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), F.lit(True), per_language=2)
    assert [r.lang_pred for r in language_id.predict(asked, model, ["doc_id"]).orderBy("doc_id").collect()] == ["en", "de"]


def test_licences_side_by_side():
    """Notices that are wrapped, that follow each other without a blank line, or that share a line are all found."""
    model = licences.train(["the river runs over the stone", "a cloud of green"] * 40)
    bsd = "Redistribution and use in source and binary forms, with or\nwithout modification, are permitted provided that\nthe following conditions are met"
    gpl = "This program is free software: you can redistribute it and/or modify\nit under the terms of the GNU General Public License\nas published by the Free Software Foundation"

    def got(text):
        return [f[:3] for f in licences.find_licences(model, text)]

    assert got("Licensed under the MIT license.\n" + bsd) == [(0, 0, "mit"), (1, 3, "bsd")]
    assert got(bsd + "\n" + gpl) == [(0, 2, "bsd"), (3, 5, "gpl")]
    assert got("Licensed under the MIT license. This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.") == [(0, 0, "mit"), (0, 0, "mpl")]
    assert got("Licensed under the GNU Lesser General Public License, version 2.1.") == [(0, 0, "lgpl")]


def test_licence_calibration_covers_all_paragraphs(spark):
    """Words are counted, and the threshold is set, over every line of every text; the sample has whole texts."""
    lines = ["the river runs over the stone"] * 60 + ["the permission of the publisher", "Licensed under the MIT license."]
    d = spark.createDataFrame([(i, "\n".join(lines)) for i in range(5)] + [(9, None)], "doc_id long, text string")
    counts, paragraphs = licences.word_frequencies(d)
    assert paragraphs == 5 * 61 and counts["permission"] == 5 and counts["the"] == 5 * 61 and "mit" not in counts
    assert len(licences.sample_paragraphs(d, 2)) == 2 * 62
    model = licences.train(["the river runs over the stone"] * 40, frequencies=(counts, paragraphs))
    score = float(licences._probabilities(model, licences.grams_of("the permission of the publisher".split()))[:-1].max())
    assert licences.calibrated(d, model).threshold == pytest.approx(min(max(0.5, score + 0.01), 0.9), abs=0.0011)
