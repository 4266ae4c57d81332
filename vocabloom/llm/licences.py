"""Licence scans: a trained paragraph classifier, confirmed by comparison with templates.

A paragraph is a line; in lines that follow each other and have model features, every span of words that has most of a
template's n-grams is tried as a paragraph too, so hard-wrapped notices, notices next to each other and several licences in
a line each count. Features are word n-grams of lengths 1 to 3. The
classifier is a sparse multinomial logistic regression over the licence families and an
unknown class. It is trained on the templates of the families, cut and embedded in other words,
against paragraphs of the corpus (all of a bounded sample of ``NEGATIVES`` documents, chosen by the hash of
doc_id, without the few that a template explains). Which words are common, and so start no feature, is counted over
all paragraphs of the corpus. Features with small weights are dropped; a
paragraph without any feature is unknown by definition and costs only a dictionary lookup for
each different word of a batch. The unknown class is calibrated: the family's probability must
exceed what all but a thousandth of the corpus' paragraphs reach that have a feature and that no template
explains, and at least one half. A prediction is
confirmed when a template of the family has most of its n-grams in the paragraph.

Defined results: a null or empty text has no paragraph and no licence. Rows that repeat a doc_id are
scanned each. The columns that are kept come first; extra columns do not matter.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vocabloom.llm._common import ship, table, text_slices

NEGATIVES, SPARSE, CONFIRMED = 400, 0.05, 0.6
#: Quantile and steps of the scores that calibrate the unknown class.
QUANTILE, STEPS = 0.999, 1000
UNKNOWN = "unknown"
WORD = re.compile(r"[^\W_]+(?:[.\-][^\W_]+)*")

#: Public notices of the licence families (fixed values).
TEMPLATES: dict[str, list[str]] = {
    "mit": [
        "Released under the MIT License.",
        "Licensed under the MIT license.",
        "This project is distributed under the terms of the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
        "In no event shall the authors or copyright holders be liable for any claim, damages or other liability, whether in an action of contract, tort or otherwise",
        "SPDX-License-Identifier: MIT",
    ],
    "apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS",
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "gpl": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
        "either version 2 of the License, or (at your option) any later version of the GNU General Public License.",
        "You should have received a copy of the GNU General Public License along with this program.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
        "SPDX-License-Identifier: GPL-2.0-only",
    ],
    "lgpl": [
        "Licensed under the GNU Lesser General Public License, version 2.1.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License",
    ],
    "agpl": [
        "Licensed under the GNU Affero General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation",
    ],
    "bsd": [
        "Licensed under the BSD 3-Clause License.",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ],
    "isc": [
        "Licensed under the ISC License.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ],
    "zlib": [
        "Licensed under the zlib License.",
        "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely",
    ],
    "unlicense": [
        "Released into the public domain under the Unlicense.",
        "This is free and unencumbered software released into the public domain.",
    ],
    "epl": [
        "Licensed under the Eclipse Public License, version 2.0.",
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License",
    ],
    "bsl": [
        "Licensed under the Boost Software License, Version 1.0.",
        "Distributed under the Boost Software License, Version 1.0.",
    ],
    "ofl": [
        "This Font Software is licensed under the SIL Open Font License, Version 1.1.",
    ],
    "wtfpl": [
        "This program is free software. It comes without any warranty, to the extent permitted by applicable law. You can redistribute it under the terms of the Do What The Fuck You Want To Public License",
    ],
    "cc0": [
        "Licensed under CC0 1.0 Universal.",
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    ],
    "mpl": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License 2.0.",
    ],
    "cc-by": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
    "cc-by-sa": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ],
    "cc-by-nc": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "cc-by-nd": [
        "Licensed under CC BY-ND 4.0.",
        "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.",
    ],
    "proprietary": [
        "All rights reserved. No part of this publication may be reproduced without the prior written permission of the publisher.",
        "Copyright. All rights reserved.",
    ],
}


@dataclass
class LicenceModel:
    families: list[str]
    rows: dict[str, int]  # n-gram -> row of weights
    weights: np.ndarray  # n-grams x (families and unknown)
    bias: np.ndarray
    threshold: float
    templates: list[tuple[int, frozenset]]  # family, n-grams
    firsts: frozenset  # words of the features


def words_in(text: str) -> list[str]:
    return WORD.findall(text.lower())


def grams_of(words: list[str]) -> set[str]:
    return {" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)}


def _probabilities(model: LicenceModel, grams: set[str]) -> np.ndarray:
    hit = [model.rows[g] for g in grams if g in model.rows]
    z = model.bias + model.weights[hit].sum(axis=0)
    e = np.exp(z - z.max())
    return e / e.sum()


def _similarity(templates: list[tuple[int, frozenset]], family: int, grams: set[str]) -> float:
    """The largest share of a template's n-grams that the paragraph has."""
    return max((len(t & grams) / len(t) for f, t in templates if f == family), default=0.0)


@lru_cache(maxsize=1)
def _templates() -> list[tuple[int, frozenset]]:
    return [(k, frozenset(grams_of(words_in(t)))) for k, f in enumerate(TEMPLATES) for t in TEMPLATES[f]]


@lru_cache(maxsize=1)
def _gram_words() -> tuple[dict[str, int], np.ndarray, np.ndarray, np.ndarray]:
    """The number of each template word, the words of every n-gram (the last number stands for none), where a template's n-grams start, and
    how many of them explain it."""
    grams = [[g.split(" ") for g in t] for _, t in _templates()]
    number = {w: i for i, w in enumerate(sorted({w for t in grams for g in t for w in g}))}
    words = np.array([[number[w] for w in g] + [len(number)] * (3 - len(g)) for t in grams for g in t])
    sizes = np.array([len(t) for t in grams])
    return number, words, np.cumsum(sizes) - sizes, CONFIRMED * sizes


@lru_cache(maxsize=1 << 16)
def _explainable(known: frozenset) -> bool:
    """Whether the template words that a paragraph has can make up most n-grams of a template."""
    number, words, starts, least = _gram_words()
    has = np.zeros(len(number) + 1, bool)
    has[[len(number), *(number[w] for w in known)]] = True
    return bool((np.add.reduceat(has[words].all(axis=1), starts, dtype=np.int64) >= least).any())


def _explained(templates: list[tuple[int, frozenset]], vocabulary: frozenset, words: list[str]) -> bool:
    """Whether a template has most of its n-grams in the paragraph."""
    if not _explainable(vocabulary.intersection(words)):
        return False
    grams = grams_of(words)
    return any(len(t & grams) >= CONFIRMED * len(t) for _, t in templates)


def word_frequencies(docs: DataFrame) -> tuple[dict[str, int], int]:
    """In how many paragraphs of all documents each word of the templates is, and how many paragraphs
    there are; without those that a template explains."""
    ship(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        templates, seen = _templates(), Counter()
        vocabulary = frozenset(g for _, t in templates for g in t if " " not in g)
        for batch in batches:
            for text in batch.column("text"):
                for line in (text.as_py() or "").split("\n"):
                    words = words_in(line)
                    if words and not _explained(templates, vocabulary, words):
                        seen.update(vocabulary.intersection(words))
                        seen[""] += 1
        yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], names=["word", "n"])

    rows = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()
    counts = {r["word"]: r["n"] for r in rows}
    return counts, counts.pop("", 0)


def calibrated(docs: DataFrame, model: LicenceModel) -> LicenceModel:
    """Sets the threshold from the scores of all paragraphs that have a feature and that no template explains."""
    spark = ship(docs.sparkSession)
    sent = spark.sparkContext.broadcast(model)  # as large as the templates

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, seen = sent.value, np.zeros(STEPS + 1, np.int64)
        vocabulary = frozenset(g for _, t in model.templates for g in t if " " not in g)
        for batch in batches:
            for text in batch.column("text"):
                for line in (text.as_py() or "").split("\n"):
                    words = words_in(line)
                    if not model.firsts.isdisjoint(words) and not _explained(model.templates, vocabulary, words):
                        seen[int(np.ceil(_probabilities(model, grams_of(words))[:-1].max() * STEPS))] += 1
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(seen[at])], names=["step", "n"])

    rows = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(score, "step int, n long").groupBy("step").agg(F.sum("n").alias("n")).collect()
    upto, total, reached = 0, sum(r["n"] for r in rows), 0.0
    for step, n in sorted((r["step"], r["n"]) for r in rows):
        upto, reached = upto + n, step / STEPS
        if upto >= QUANTILE * total:
            break
    model.threshold = float(min(max(0.5, reached + 0.01), 0.9))
    return model


def train(negatives: list[str], steps: int = 300, rate: float = 0.5, frequencies: tuple[dict[str, int], int] | None = None) -> LicenceModel:
    """The model from the templates and sampled corpus paragraphs; ``frequencies`` are those of the whole corpus,
    else of the sample."""
    families = list(TEMPLATES)
    rng = np.random.default_rng(11)
    templates = _templates()
    words_of_templates = frozenset(g for _, t in templates for g in t if " " not in g)
    plain = [w for w in map(words_in, negatives) if w and not _explained(templates, words_of_templates, w)]
    frequent, paragraphs = frequencies or (Counter(x for w in plain for x in set(w)), len(plain))
    # A word that is common in the corpus tells nothing by itself and starts no feature.
    common = {x for x, n in frequent.items() if n > 0.01 * paragraphs}
    pool = [x for w in plain for x in w] or ["text"]
    known = frozenset(g for _, t in templates for g in t)
    samples: list[tuple[set, int]] = [(known.intersection(grams_of(w)), len(families)) for w in plain]
    for k, f in enumerate(families):
        for t in TEMPLATES[f]:
            w = words_in(t)
            for r in range(12):
                some = [x for x in w if rng.random() > (0 if r == 0 else 0.08)]
                before, after = ([pool[i] for i in rng.integers(0, len(pool), rng.integers(0, 6))] if r > 1 else [] for _ in "ab")
                samples.append((grams_of([*before, *some, *after]), k))
    vocabulary = sorted({g for _, t in templates for g in t if any(x not in common for x in g.split(" "))})
    rows = {g: i for i, g in enumerate(vocabulary)}
    # Samples with the same features and class are one weighted row.
    alike = Counter((tuple(sorted(rows[g] for g in s if g in rows)), c) for s, c in samples)
    classes = len(families) + 1
    x = np.zeros((len(alike), len(rows)), np.float32)
    y = np.zeros((len(alike), classes), np.float32)
    for i, (hit, c) in enumerate(alike):
        x[i, list(hit)] = 1
        y[i, c] = 1
    times = np.array(list(alike.values()), np.float32)
    weight = times * (1 / np.maximum(times @ y, 1) @ y.T)
    weight = (weight / weight.sum())[:, None]
    w, b = np.zeros((len(rows), classes), np.float32), np.zeros(classes, np.float32)
    for _ in range(steps):
        z = x @ w + b
        e = np.exp(z - z.max(axis=1, keepdims=True))
        error = (e / e.sum(axis=1, keepdims=True) - y) * weight
        w -= rate * 20 * (x.T @ error)
        w = np.sign(w) * np.maximum(np.abs(w) - rate * 2e-5, 0)  # the sparse penalty
        b -= rate * 20 * error.sum(axis=0)
    used = np.abs(w).max(axis=1) >= SPARSE
    kept = [g for g, u in zip(vocabulary, used) if u]
    model = LicenceModel(
        families, {g: i for i, g in enumerate(kept)}, w[used], b, 0.5, templates,
        frozenset(x for g in kept for x in g.split(" ") if x not in common),
    )
    reached = max((float(_probabilities(model, grams_of(p))[:-1].max()) for p in plain), default=0.0)
    model.threshold = float(min(max(0.5, reached + 0.01), 0.9))
    return model


def confirmed_spans(model: LicenceModel, words: list[str]) -> list[tuple[int, int, int, float, float]]:
    """First and last word, family, probability and similarity of spans that a template and the classifier confirm.

    Spans grow word by word up to twice a template's words; of spans that overlap the most similar one stays.
    """
    if not words:
        return []
    all_grams, spans = grams_of(words), []
    for k, t in model.templates:
        if len(t & all_grams) < CONFIRMED * len(t):
            continue
        ends = [[(e - n + 1, g) for n in (1, 2, 3) if n <= e + 1 and (g := " ".join(words[e - n + 1 : e + 1])) in t] for e in range(len(words))]
        most = 2 * sum(" " not in g for g in t)
        for start, word in enumerate(words):
            if word not in t:
                continue
            seen, best, last = set(), 0, start
            for e in range(start, min(len(words), start + most)):
                seen.update(g for s, g in ends[e] if s >= start)
                if len(seen) > best:
                    best, last = len(seen), e
            if best >= CONFIRMED * len(t):
                spans.append((-best / len(t), last - start, start, last, k))
    taken, found = np.zeros(len(words), bool), []
    for similar, _, start, last, k in sorted(spans):
        if not taken[start : last + 1].any():
            p = _probabilities(model, grams_of(words[start : last + 1]))
            if p[k] >= model.threshold:
                taken[start : last + 1] = True
                found.append((start, last, k, float(p[k]), -similar))
    return sorted(found)


def find_licences(model: LicenceModel, text: str) -> list[tuple[int, int, str, float, float]]:
    """First and last line, family, probability and similarity of every confirmed paragraph of a text."""
    found, run = [], []
    lines = text.split("\n")

    def judge(first: int, last: int, words: list[str]) -> tuple | None:
        grams = grams_of(words)
        p = _probabilities(model, grams)
        k = int(p[:-1].argmax())
        similar = _similarity(model.templates, k, grams)
        if p[k] >= model.threshold and similar >= CONFIRMED:
            return first, last, model.families[k], float(p[k]), similar
        return None

    def close() -> None:
        mine = [j for n, w in run if (j := judge(n, n, w))]
        words, at = [x for _, w in run for x in w], [n for n, w in run for _ in w]
        for first, last, k, p, similar in confirmed_spans(model, words):
            first, last, family = at[first], at[last], model.families[k]
            if not any(f[2] == family and f[0] <= last and first <= f[1] for f in mine):
                mine.append((first, last, family, p, similar))
        if not mine and len(run) > 1 and (j := judge(run[0][0], run[-1][0], words)):
            mine = [j]
        found.extend(sorted(mine))
        run.clear()

    for n, line in enumerate(lines):
        words = words_in(line)
        if model.firsts.isdisjoint(words):
            close()
        else:
            run.append((n, words))
    close()
    return found


def sample_paragraphs(docs: DataFrame, documents: int = NEGATIVES) -> list[str]:
    """Paragraphs of at most ``documents`` documents, chosen by the hash of doc_id; of rows that repeat an id the first text in order counts."""
    rows = docs.where("doc_id IS NOT NULL AND text IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    ids = [(r[0],) for r in rows.select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(documents).collect()]
    picked = docs.sparkSession.createDataFrame(ids, "_id long")
    lines = rows.join(F.broadcast(picked), F.col("doc_id") == F.col("_id")).groupBy("_id").agg(F.min("text").alias("text")).select("_id", F.split("text", "\n").alias("lines"))
    return [line for r in sorted(lines.collect(), key=lambda r: (r["_id"], r["lines"] or [])) for line in r["lines"] or []]


def scan(docs: DataFrame, model: LicenceModel, keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` with paragraphs (lines that are not blank) and licences, an array of
    (first_line, last_line, family, probability, similarity)."""
    spark = ship(docs.sparkSession)
    keep = keep or ["doc_id"]
    entry = "array<struct<first_line:int,last_line:int,family:string,probability:double,similarity:double>>"
    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    sent = spark.sparkContext.broadcast(model)  # as large as the templates
    kind = pa.list_(pa.struct([
        ("first_line", pa.int32()), ("last_line", pa.int32()), ("family", pa.string()), ("probability", pa.float64()), ("similarity", pa.float64()),
    ]))

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        names = kind.value_type.names if hasattr(kind.value_type, "names") else [f.name for f in kind.value_type]
        for batch in it:
            for part in text_slices(batch, "_text"):
                texts = part.column("_text")
                # A text can only have a licence if one of its different words is a feature's word.
                lists = pc.utf8_split_whitespace(pc.utf8_lower(pc.fill_null(texts, "")))
                flat = lists.flatten().dictionary_encode()
                telling = np.array([not model.firsts.isdisjoint(WORD.findall(w)) for w in flat.dictionary.to_pylist()], bool)
                counts = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
                upto = np.concatenate([[0], np.cumsum(telling[flat.indices.to_numpy(zero_copy_only=False)] if len(flat) else [])]).astype(np.int64)
                ends = np.cumsum(counts)
                open_ = upto[ends] > upto[ends - counts]
                found = [
                    [dict(zip(names, x)) for x in find_licences(model, texts[i].as_py())] if may else [] for i, may in enumerate(open_.tolist())
                ]
                lines = pc.list_value_length(pc.split_pattern(pc.fill_null(texts, ""), "\n"))
                blank = pc.count_substring_regex(pc.fill_null(texts, ""), r"(?m)^[\t\v\f\r ]*$")
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in keep), pc.subtract(lines.cast(pa.int64()), blank.cast(pa.int64())), pa.array(found, kind)],
                    names=[*keep, "paragraphs", "licences"],
                )

    rows = docs.select(*keep, F.col("text").cast("string").alias("_text"))
    return rows.mapInArrow(batches, f"{schema}, paragraphs long, licences {entry}")


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document: its paragraphs, confirmed licence paragraphs, families, and the surest one."""
    docs = table(spark, sf_dir, "documents")
    found = scan(docs, calibrated(docs, train(sample_paragraphs(docs), frequencies=word_frequencies(docs))))
    best = F.element_at(F.sort_array(F.transform("licences", lambda x: F.struct(x["probability"], x["similarity"], x["family"])), False), 1)
    return found.select(
        "doc_id", "paragraphs", F.size("licences").alias("licence_paragraphs"),
        F.array_join(F.array_sort(F.array_distinct(F.transform("licences", lambda x: x["family"]))), ",").alias("families"),
        F.when(F.size("licences") > 0, best["family"]).alias("surest_family"),
        F.when(F.size("licences") > 0, best["probability"]).alias("probability"),
        F.when(F.size("licences") > 0, best["similarity"]).alias("similarity"),
    )
