"""Collocations against a plain count, and tiles against a counter."""

import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from vocabloom.llm import phrase_tiles
from vocabloom.llm.phrase_tiles import collocations, numbered, pack, pair_blocks, split_words, unpack


def plain(rows, least, longest=4, most=2000):
    counts, words = {}, Counter()
    for lang, text in rows:
        lang = lang or "und"
        low = re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\n\x0b\x0c\r]", low):
            w = [x for x in re.split("[ \t]+", piece) if x]
            words[lang] += len(w)
            for k in range(1, longest + 1):
                for i in range(len(w) - k + 1):
                    key = lang, tuple(w[i : i + k])
                    counts[key] = counts.get(key, 0) + 1
    frequent = {k: a for k, a in counts.items() if a >= least}
    around = {}
    for (lang, p), a in frequent.items():
        for k in range(2, len(p)):
            for i in range(len(p) - k + 1):
                inner = lang, p[i : i + k]
                around[inner] = max(around.get(inner, 0), a)
    out = {}
    for (lang, p), a in frequent.items():
        if len(p) > 1 and not 100 * around.get((lang, p), 0) >= 80 * a:
            score, _, left, right = min((2000000 * a // (counts[lang, p[:k]] + counts[lang, p[k:]]), k, counts[lang, p[:k]], counts[lang, p[k:]]) for k in range(1, len(p)))
            out.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), left, right))
    return sorted((lang, k, p.decode(), -a, x, y, words[lang], -s) for lang, some in out.items() for k, (s, a, p, x, y) in enumerate(sorted(some)[:most], 1))


def texts(seed, n):
    rng = np.random.default_rng(seed)
    pool = ["New", "york", "YORK", "city", "a", "b", "é", "É", "x y", "the", "of", "..", "\t", ",", "!", "\n", "\x0b", "z" * 30, "𝒳"]
    return [(rng.choice(["en", "fr", None]), " ".join(rng.choice(pool, rng.integers(0, 40)))) for _ in range(n)] + [("en", None), (None, ""), ("de", " \n ")]


@pytest.mark.parametrize("small", [False, True])
def test_equals_plain_count(spark, monkeypatch, small):
    if small:  # many chunks, shares and buckets; what workers look up in the module itself stays
        for name, value in {"CHUNK_BYTES": 500, "SLICE_BYTES": 40, "BUCKET_WORDS": 100, "SHARE_CHUNKS": 3}.items():
            monkeypatch.setattr(phrase_tiles, name, value)
    rows = texts(1, 300)
    rows[0] = ("en", " ".join(t for _, t in texts(2, 20) if t))
    df = spark.createDataFrame([(k, t, lang, b"") for k, (lang, t) in enumerate(rows)], "doc_id long, text string, lang string, codes binary").repartition(3)
    for least, most in ((3, 2000),) if small else ((12, 5),):
        assert sorted(map(tuple, collocations(df, least=least, most=most).collect())) == plain(rows, least, most=most)


def test_ids_beyond_the_tiles(spark, monkeypatch):
    monkeypatch.setattr(phrase_tiles, "CHUNK_BYTES", 50_000)
    monkeypatch.setattr(phrase_tiles, "BUCKET_WORDS", 1000)
    rng = np.random.default_rng(5)
    words = [f"w{k}" for k in np.concatenate([rng.integers(0, 25_000, 30_000), np.tile(rng.integers(0, 25_000, 400), 5)])]
    assert len(set(words)) > phrase_tiles.TILE * phrase_tiles.HEAD
    rows = [("en", " ".join(words[k : k + 200])) for k in range(0, len(words), 200)]
    df = spark.createDataFrame([(t, lang) for lang, t in rows], "text string, lang string").repartition(4)
    assert sorted(map(tuple, collocations(df, least=1, most=300).collect())) == plain(rows, 1, most=300)


def test_long_texts_come_in_runs():
    data = "ab, cd ef! " * 300_000 + "x" * 9_000_000 + " y"
    part = pa.RecordBatch.from_pydict({"text": [data], "lang": ["en"]})
    runs = [split_words(raw, offsets) for raw, offsets, _ in phrase_tiles._laid_out(part)]
    assert len(runs) > 1 and sum(len(w) for w, _, _ in runs) == 900_002
    whole = split_words(np.frombuffer(data.encode(), np.uint8), np.array([0, len(data)]))
    assert [x for w, _, _ in runs for x in w.to_pylist()] == whole[0].to_pylist() and np.concatenate([n for _, _, n in runs]).tolist() == whole[2].tolist()


def test_empty_table_and_no_phrase(spark):
    df = spark.createDataFrame([("one two", "en")] * 3, "text string, lang string")
    assert collocations(df.limit(0)).collect() == []
    assert collocations(df).collect() == []
    assert [tuple(r) for r in collocations(df, least=3).collect()] == [("en", 1, "one two", 3, 3, 3, 6, 1000000)]


def test_tiles_count_as_a_counter(monkeypatch):
    monkeypatch.setattr(phrase_tiles, "TILE", 4)
    monkeypatch.setattr(phrase_tiles, "HEAD", 2)
    rng = np.random.default_rng(3)
    ids = rng.integers(-1, 14, 2000)
    places, blocks = pair_blocks(ids, 3)
    want = Counter((a, b) for a, b in zip(ids[:-1].tolist(), ids[1:].tolist()) if a >= 0 and b >= 0)
    got, at = {}, {}
    for key, start, codes, counts in blocks:
        for k, (c, n) in enumerate(zip(codes.tolist(), counts.tolist())):
            pair = (key // 2 * 4 + c // 4, key % 2 * 4 + c % 4) if key < 4 else (c >> 32, c & 0xFFFFFFFF)
            got[pair], at[start + k] = n, pair
    assert got == want
    assert all((at[p] == (a, b)) if p else a < 0 or b < 0 for p, a, b in zip(places.tolist(), ids[:-1].tolist(), ids[1:].tolist()))
    with pytest.raises(ValueError):
        pair_blocks(np.array([1, 1 << 32]), 1)
    assert pair_blocks(np.zeros(0, np.int64), 3)[1] == []


def test_small_helpers():
    for values in ([], [0], [5, 0, 5, 2**40], [1] * 100):
        distinct, place, counts = numbered(np.array(values, np.int64))
        assert distinct[place].tolist() == values and counts.sum() == len(values)
    numbers = np.array([0, 1, 255, 256, 2**31, 2**32 - 1])
    assert unpack(pack(numbers)).tolist() == numbers.tolist() and unpack(pack(numbers << 20, 8), 8).tolist() == (numbers << 20).tolist()
    assert unpack(pack(numbers[:0])).tolist() == []
