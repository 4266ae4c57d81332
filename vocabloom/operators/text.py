"""Vocabulary matching, term discovery and extraction over texts."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vocabloom.functions.frame import first_by, with_package, written

TOKEN_BREAK = r"[^a-z0-9\-]+"
#: Labels of a vocabulary that is sent to every task, some 100 bytes each; a larger one is shuffled.
SENT_LABELS = 200_000


def tokens(text: str) -> Column:
    return F.filter(F.split(F.lower(text), TOKEN_BREAK), lambda x: x != "")


def _runs(df: DataFrame, key: str, text: str, most: int, stops: list[str] = ()) -> DataFrame:
    """(key, _w1 .. _w``most``): one row for each token, with those that follow it (null beyond the end)."""
    words = tokens(text)
    if stops:
        words = F.filter(words, lambda x: ~x.isin(list(stops)))
    t = df.select(key, words.alias("_t"))
    ahead = [F.slice("_t", F.lit(k), F.greatest(F.size("_t") - k + 1, F.lit(0))).alias(f"_w{k}") for k in range(1, most + 1)]
    return t.select(key, F.explode(F.arrays_zip(*ahead)).alias("_r")).select(key, "_r.*")


def vocabulary_matches(docs: DataFrame, key: str, text: str, labels: DataFrame, most_words: int, least: int, single: bool = True) -> DataFrame:
    """Documents per label, by equality of token runs; labels in fewer than ``least`` are dropped.

    Labels of several words need more than 5 characters, single words (left out unless ``single``) more than 3; labels of more than
    ``most_words`` words are not sought. Tokens meet the first words of the labels before any run is spelled out.
    """
    words = tokens("label")
    several = F.size(words) > 1
    fits = F.when(several, F.length("label") > 5).otherwise((F.length("label") > 3) if single else F.lit(False))
    vocabulary = labels.where(fits & (F.size(words) <= most_words)).select(
        F.array_join(words, " ").alias("_gram"), "label", words[0].alias("_w1"), F.size(words).alias("_n")
    ).distinct()
    # Left to itself Spark shuffles every token of every text before it knows how small the vocabulary is.
    vocabulary = written(vocabulary, "vocabulary")
    starts = vocabulary.select("_w1", "_n").distinct()
    if vocabulary.count() <= SENT_LABELS:
        vocabulary, starts = F.broadcast(vocabulary), F.broadcast(starts)
    run = F.concat_ws(" ", *(F.when(F.col("_n") >= k, F.col(f"_w{k}")) for k in range(1, most_words + 1)))
    long_enough = F.lit(True)
    for k in range(2, most_words + 1):
        long_enough = long_enough & ((F.col("_n") < k) | F.col(f"_w{k}").isNotNull())
    met = _runs(docs, key, text, most_words).join(starts, "_w1").where(long_enough).select(key, run.alias("_gram"))
    hits = met.join(vocabulary.select("_gram", "label"), "_gram").select("label", key).distinct()
    return hits.groupBy("label").agg(F.count("*").alias("documents")).where(F.col("documents") >= least)


def frequency_tags(matches: DataFrame, kind: str) -> DataFrame:
    """(label, tag) like ``abstract_freq:12``."""
    return matches.select("label", F.concat(F.lit(f"{kind}_freq:"), F.col("documents").cast("string")).alias("tag"))


def add_tags(senses: DataFrame, found: DataFrame) -> DataFrame:
    """Senses with the tags of their lower-cased label after their own, repeats left out; those without tags (null) get none."""
    more = found.groupBy(F.lower("label").alias("_l")).agg(F.array_sort(F.collect_set("tag")).alias("_more"))
    return senses.join(more, F.lower("label") == F.col("_l"), "left").select(
        *(F.array_union("tags", F.coalesce("_more", F.array().cast("array<string>"))).alias("tags") if c == "tags" else F.col(c) for c in senses.columns)
    )


def new_terms(docs: DataFrame, key: str, text: str, known: DataFrame, least: int, max_share: float, n: int, stops: list[str] = (), features: int = 20_000) -> DataFrame:
    """The ``n`` best runs of one to three words outside the vocabulary: gram, documents and score.

    Runs in at least ``least`` documents and at most ``max_share`` of all; of these the ``features`` with most occurrences; the score is
    occurrences · (ln((1 + n) / (1 + documents)) + 1). Stop words are taken out first, and words of one or two characters are no gram.
    """
    total = docs.agg(F.count("*").alias("_n"))
    parts = [F.concat_ws(" ", *(f"_w{j}" for j in range(1, k + 1))) for k in (1, 2, 3)]
    grams = F.array(*(F.when(F.col(f"_w{k}").isNotNull(), p) for k, p in enumerate(parts, 1)))
    each = _runs(docs, key, text, 3, stops).select(key, F.explode(F.filter(grams, lambda x: x.isNotNull() & (F.length(x) > 2))).alias("gram"))
    counted = each.groupBy("gram", key).agg(F.count("*").alias("_tf")).groupBy("gram").agg(F.count("*").alias("documents"), F.sum("_tf").alias("_tf"))
    usual = counted.crossJoin(F.broadcast(total)).where(  # total is one row
        (F.col("documents") >= least) & (F.col("documents") <= F.col("_n") * max_share)
    ).orderBy(F.desc("_tf"), "gram").limit(features)
    fresh = usual.join(known.select(F.lower("label").alias("gram")).distinct(), "gram", "left_anti")
    score = F.round(F.col("_tf") * (F.log((1 + F.col("_n")) / (1 + F.col("documents"))) + 1), 6)
    return fresh.select("gram", "documents", score.alias("score")).orderBy(F.desc("score"), "gram").limit(n)


#: Names, agencies and patterns of grant numbers, in order of precedence (fixed values).
GRANTS = [
    ("NSF Award", "NSF", r"\b(?:NSF[- ]?)?(?:Award\s*(?:No\.?\s*)?)?(\d{7})\b"),
    ("NIH Grant", "NIH", r"\b([RKUPFTSDM]\d{2})\s*[-]?\s*([A-Z]{2})\s*[-]?\s*(\d{6,7})\b"),
    ("DOE Contract", "DOE", r"\b(DE-[A-Z]{2}\d{2}-\d{2}[A-Z]{2}\d{5})\b"),
    ("DOE Award", "DOE", r"\b(DE-[A-Z]{2,4}\d{7,10})\b"),
    ("NASA Grant", "NASA", r"\b(NN[XGHM]\d{2}[A-Z]{2}\d{2,5}[A-Z]?)\b"),
    ("NASA Award", "NASA", r"\b(80NSSC\d{2}[A-Z]\d{4})\b"),
    ("EU Grant", "EU", r"(?i)\b(?:grant\s*(?:agreement\s*)?(?:no\.?\s*)?|project\s*(?:no\.?\s*)?)(\d{6})\b"),
    ("EPSRC Grant", "EPSRC", r"\b(EP/[A-Z]\d{6}/\d)\b"),
    ("DFG Project", "DFG", r"(?i)\b(?:DFG|Deutsche\s+Forschungsgemeinschaft)\s*[-:]\s*(\d{6,9})\b"),
    ("NSERC Grant", "NSERC", r"(?i)\b(?:NSERC)\s*[-]?\s*(?:grant\s*)?(\d{4,6}[-]?\d{0,4})\b"),
    ("Generic Grant", "Unknown", r"(?i)(?:grant|award|funding|project|agreement|contract)\s*(?:number|no\.?|#|id)\s*[:.]?\s*([A-Z0-9][-A-Z0-9/]{4,20})"),
    ("Funded Reference", "Unknown", r"(?i)funded\s+by\s+.*?\(([A-Z0-9][-A-Z0-9/]{4,20})\)"),
]


#: What a text must have for a pattern to match at all, by the pattern's name; in lower case for those that ignore case.
_NEEDS = {
    "NSF Award": re.compile(r"\d{7}"), "NIH Grant": re.compile(r"[RKUPFTSDM]\d{2}"), "DOE Contract": re.compile("DE-"), "DOE Award": re.compile("DE-"), "NASA Grant": re.compile("NN[XGHM]"),
    "NASA Award": re.compile("80NSSC"), "EU Grant": re.compile("grant|project"), "EPSRC Grant": re.compile("EP/"), "DFG Project": re.compile("dfg|deutsche"), "NSERC Grant": re.compile("nserc"),
    "Generic Grant": re.compile("grant|award|funding|project|agreement|contract"), "Funded Reference": re.compile("funded"),
}


_GAPS = str.maketrans("", "", " -")


def find_grants(text: str, patterns: list[tuple]) -> list[tuple[str, str, str, int, int]]:
    """(number, agency, pattern_name, start, end) of each grant number of a text; of equal ones the first pattern's first."""
    low, plain = text.lower(), text.isascii()
    first: dict[str, tuple[str, str, str, int, int]] = {}
    for name, agency, pattern, need in patterns:
        any_case = bool(pattern.flags & re.IGNORECASE)
        # Beyond ASCII some letters equal others only without case, so such texts are searched by every pattern that ignores case.
        if need.search(low if any_case else text) or any_case and not plain:
            for m in pattern.finditer(text):
                number = "".join(m.groups())
                first.setdefault(number.upper().translate(_GAPS), (number, agency, name, *m.span()))
    return list(first.values())


def grants(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Grant numbers of each document: number, agency, pattern_name, and the start and end of the match in characters.

    Numbers that are equal without case, blanks and hyphens count once, for the first pattern and place. The patterns are those of a language whose
    blanks, digits and letters are Unicode's, so a no-break space before a number is a blank; Python searches whole texts in batches.
    """
    kind = dict(docs.dtypes)[key]
    patterns = [(name, agency, re.compile(pattern), _NEEDS[name]) for name, agency, pattern in GRANTS]
    find, names = find_grants, ["number", "agency", "pattern_name", "start", "end"]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, rows = [], []
            for k, x in enumerate(batch.column("_text").to_pylist()):
                for row in find(x, patterns):
                    at.append(k)
                    rows.append(row)
            columns = [pa.array([r[i] for r in rows], pa.int32() if i > 2 else pa.string()) for i in range(5)]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int64())), *columns], names=[key, *names])

    with_package(docs.sparkSession)
    rows = docs.select(F.col(key), F.col(text).cast("string").alias("_text")).where("_text IS NOT NULL")
    return rows.mapInArrow(search, f"`{key}` {kind}, number string, agency string, pattern_name string, start int, end int")


def field_counts(df: DataFrame, field: str) -> DataFrame:
    return df.groupBy(field).agg(F.count("*").alias("n"))


def markup_labels(df: DataFrame, label: str) -> DataFrame:
    return df.where(F.col(label).rlike(r"</?[a-zA-Z]+[^>]*>|&[a-z]+;"))


def distinct_journals(journals: DataFrame, order: list) -> DataFrame:
    """The first row of each journal, which is known by its ISSNs (array) or, without any, by its title."""
    key = F.coalesce(F.nullif(F.array_join("issn", "|"), F.lit("")), "title")
    return first_by(journals.withColumn("journal_key", key), ["journal_key"], order)


def subject_counts(journals: DataFrame) -> DataFrame:
    """Journals of each subject (array ``subjects``)."""
    return journals.select(F.explode("subjects").alias("subject")).groupBy("subject").agg(F.count("*").alias("journals"))
