import xxhash

from vocabloom.llm import simhash_native

TEXTS = ["", "  \n", "one", "one two", "Alpha beta ALPHA beta gamma", "x " * 700, "Ünder the Äpfel\tlies\nsnow", "a b c d e f g h i j k l m n o p"]


def brute_force(text):
    """Every run of up to three words votes with the 64 bits of its hash; a bit needs more than half of the votes."""
    words = text.lower().split()
    votes = []
    for i in range(len(words)):
        h = 42
        for w in words[i : i + 3]:
            h = xxhash.xxh64_intdigest(w.encode(), seed=h)
        votes.append(h)
    fp = sum(1 << j for j in range(64) if 2 * sum(v >> j & 1 for v in votes) > len(votes)) if votes else 0
    return fp - (1 << 64) if fp >> 63 else fp


def test_votes_are_counted(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "k long, text string")
    assert {r.k: r.fp for r in simhash_native.simhash(df, ["k"]).collect()} == {k: brute_force(t) for k, t in enumerate(TEXTS)}


def test_rows_of_one_key_are_one_bag(spark):
    df = spark.createDataFrame([(1, "a b"), (1, "a b"), (1, "c")], "k long, text string")
    rows = simhash_native.simhash(df, ["k"]).collect()
    a, b = xxhash.xxh64_intdigest(b"b", seed=xxhash.xxh64_intdigest(b"a", seed=42)), xxhash.xxh64_intdigest(b"b", seed=42)
    c = xxhash.xxh64_intdigest(b"c", seed=42)
    votes = [a, a, b, b, c]
    fp = sum(1 << j for j in range(64) if 2 * sum(v >> j & 1 for v in votes) > 5)
    assert [r.fp for r in rows] == [fp - (1 << 64) if fp >> 63 else fp]
