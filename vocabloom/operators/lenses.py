"""Lenses: weight maps over disciplines, and rankings of senses, neighbours and papers through them.

A lens is configuration and stays on the driver: a library has a few for each discipline and pair of disciplines, each with one weight a
discipline. What it is applied to are DataFrames. Senses have sense_id, label, source, discipline, confidence, level and tier, and
where they exist secondary (array of disciplines) and tags (array).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vocabloom.functions.frame import first_by, top_by

#: Roles of templates with their altitudes and names (fixed values).
ROLES = {"director": (100000, "Director"), "program_mgr": (10000, "Program Manager"), "researcher": (1000, "Researcher")}
#: Disciplines that a driver takes at most.
MOST_DISCIPLINES = 1000
#: What tags add to a score (fixed values).
TAG_BONUS = {"abstract_freq:": 0.1, "title_freq:": 0.05, "pub_freq:": 0.05}


@dataclass(frozen=True)
class Lens:
    lens_id: str
    name: str
    role: str
    altitude: int
    discipline: str | None
    weights: dict[str, float]
    secondary: tuple[str, ...] = ()
    interests: dict[str, float] = field(default_factory=dict)
    org_node: str | None = None


def discipline_rows(disciplines: DataFrame) -> list[tuple[str, str, int]]:
    """(discipline_id, name, tier) of a dimension, in order; an error beyond MOST_DISCIPLINES."""
    name = F.col("name") if "name" in disciplines.columns else F.col("discipline_id")
    rows = disciplines.select("discipline_id", name.alias("name"), "tier").orderBy("discipline_id").limit(MOST_DISCIPLINES + 1).collect()
    if len(rows) > MOST_DISCIPLINES:
        raise ValueError(f"more than {MOST_DISCIPLINES} disciplines")
    return [tuple(r) for r in rows]


def template_lenses(disciplines: list[tuple[str, str, int]], pairs: list[tuple[str, str, str]] = ()) -> list[Lens]:
    """A lens for each discipline and role, for each pair (first, second, name) and role, and a neutral one.

    Own discipline .95, same tier .4, next tiers .25, else .1; a pair has .9 and .85, else .1; the neutral lens 1 throughout.
    """
    made = []
    for own, name, tier in disciplines:
        near = {d: 0.95 if d == own else {0: 0.4, 1: 0.25}.get(abs(t - tier), 0.1) for d, _, t in disciplines}
        made += [Lens(f"hat:{own}:{r}", f"{name} {title}", r, height, own, near) for r, (height, title) in ROLES.items()]
    for a, b, name in pairs:
        both = {d: {a: 0.9, b: 0.85}.get(d, 0.1) for d, _, _ in disciplines}
        made += [Lens(f"hat:{a}+{b}:{r}", f"{name} {title}", r, height, a, both, (b,)) for r, (height, title) in ROLES.items()]
    return [*made, Lens("hat:neutral", "Neutral Lens", "neutral", 10000, None, {d: 1.0 for d, _, _ in disciplines})]


def lens_table(spark: SparkSession, lenses: list[Lens]) -> DataFrame:
    rows = [(x.lens_id, x.name, x.role, x.altitude, x.discipline, list(x.secondary), x.weights) for x in lenses]
    return spark.createDataFrame(
        rows, "lens_id string, name string, role string, altitude int, discipline string, secondary array<string>, weights map<string,double>"
    )


def list_lenses(lenses: DataFrame, role: str | None = None, discipline: str | None = None) -> DataFrame:
    given = {"role": role, "discipline": discipline}
    for c, v in given.items():
        lenses = lenses if v is None else lenses.where(F.col(c) == v)
    return lenses.select("lens_id", "name", "role", "discipline", "altitude").orderBy("discipline", F.desc("altitude"))


def compose_lens(
    lenses: list[Lens], disciplines: list[tuple[str, str, int]], discipline: str, role: str = "researcher", interests: list[str] = (), org_node: str | None = None
) -> Lens:
    """The template of a discipline and role, else a lens of the discipline alone (.95); interests get weight 1."""
    found = next((x for x in lenses if x.lens_id == f"hat:{discipline}:{role}"), None)
    name = next((n for d, n, _ in disciplines if d == discipline), None)
    if found is None and name is None:
        raise ValueError(f"unknown discipline {discipline}")
    found = found or Lens(
        f"composed:{discipline}:{role}", f"{name} {role.replace('_', ' ').title()}", role, ROLES.get(role, (1000,))[0], discipline, {discipline: 0.95}
    )
    return Lens(found.lens_id, found.name, found.role, found.altitude, found.discipline, found.weights, found.secondary, dict.fromkeys(interests, 1.0), org_node)


def compose_lenses(requests: DataFrame, lenses: list[Lens], disciplines: list[tuple[str, str, int]]) -> DataFrame:
    """:func:`compose_lens` for every row of ``requests`` (discipline, role, interests): its columns and lens_id, name, altitude, weights, interest_weights.

    A request for an unknown discipline has none of them.
    """
    spark = requests.sparkSession
    known = lens_table(spark, lenses).select(
        F.col("lens_id").alias("_id"), F.col("name").alias("_name"), F.col("altitude").alias("_altitude"), F.col("weights").alias("_weights")
    )
    names = spark.createDataFrame([(d, n) for d, n, _ in disciplines], "_d string, _long string")
    joined = requests.join(F.broadcast(known), F.concat_ws(":", F.lit("hat"), "discipline", "role") == F.col("_id"), "left").join(
        F.broadcast(names), F.col("discipline") == F.col("_d"), "left"  # both as long as MOST_DISCIPLINES allows
    )
    some = F.col("_d").isNotNull()
    heights = reduce(lambda c, r: c.when(F.col("role") == r, ROLES[r][0]), ROLES, F.when(F.lit(False), 0)).otherwise(1000)
    return joined.select(
        *requests.columns,
        F.coalesce("_id", F.when(some, F.concat_ws(":", F.lit("composed"), "discipline", "role"))).alias("lens_id"),
        F.coalesce("_name", F.when(some, F.concat_ws(" ", "_long", F.initcap(F.replace("role", F.lit("_"), F.lit(" ")))))).alias("name"),
        F.coalesce("_altitude", F.when(some, heights)).alias("altitude"),
        F.coalesce("_weights", F.when(some, F.create_map("discipline", F.lit(0.95)))).alias("weights"),
        F.map_from_arrays("interests", F.transform("interests", lambda _: F.lit(1.0))).alias("interest_weights"),
    )


def highest_level(altitude: int) -> int | None:
    """Levels that an altitude shows at most."""
    return 2 if altitude >= 100000 else 4 if altitude >= 10000 else None


def weight_map(weights: dict[str, float]) -> Column:
    pairs = [F.lit(x) for k, v in weights.items() for x in (k, float(v))]
    return F.create_map(*pairs).cast("map<string,double>")


def weight_of(discipline: Column | str, weights: dict[str, float], default: float) -> Column:
    return F.coalesce(F.element_at(weight_map(weights), F.col(discipline) if isinstance(discipline, str) else discipline), F.lit(default))


def tier_boost(tier: str) -> Column:
    return F.when(F.col(tier) == 1, 2.0).when(F.col(tier) == 2, 1.5).when(F.col(tier) == 3, 1.0).otherwise(0.5)


def _confidence() -> Column:
    return F.coalesce(F.nullif(F.col("confidence"), F.lit(0.0)), F.lit(0.5))


def _starts(text: str) -> Callable[[Column], Column]:
    return lambda tag: F.contains(tag, F.lit(text))


def _others(senses: DataFrame) -> Column:
    none = F.array().cast("array<string>")
    return F.coalesce("secondary", none) if "secondary" in senses.columns else none


def lens_scores(senses: DataFrame, weights: dict[str, float], default: float = 0.1, bonus: bool = False) -> DataFrame:
    """weight · confidence · tier boost of every sense, plus the bonus of its tags; a secondary discipline counts seven tenths."""
    others = F.array_max(F.transform(_others(senses), lambda d: weight_of(d, weights, 0.0) * 0.7))
    score = F.greatest(weight_of("discipline", weights, default), F.coalesce(others, F.lit(0.0))) * _confidence() * tier_boost("tier")
    if bonus and "tags" in senses.columns:
        for start, more in TAG_BONUS.items():
            has = F.exists("tags", _starts(start))
            score = score + F.when(F.coalesce(has, F.lit(False)), more).otherwise(0.0)
    return senses.withColumn("score", F.round(score, 6))


def _visible(senses: DataFrame, search: str | None, altitude: int, source: str | None = None) -> DataFrame:
    if search:
        senses = senses.where(F.contains(F.lower("label"), F.lit(search.lower())))
    if (most := highest_level(altitude)) is not None:
        senses = senses.where(F.col("level").isNull() | (F.col("level") <= most))
    return senses if source is None else senses.where(F.col("source") == source)


def lens_query(senses: DataFrame, weights: dict[str, float], n: int, search: str | None = None, altitude: int = 1000) -> DataFrame:
    """The ``n`` best senses through a lens; is_bridge where a secondary discipline has a weight."""
    known = F.array(*map(F.lit, weights)).cast("array<string>")
    found = _visible(senses, search, altitude)
    return lens_scores(found, weights).withColumn("is_bridge", F.arrays_overlap(_others(found), known)).orderBy(F.desc("score"), "sense_id").limit(n)


def lens_query_full(
    senses: DataFrame, weights: dict[str, float], degree: DataFrame, n: int, *, search: str | None = None, source: str | None = None,
    altitude: int = 1000, least_weight: float = 0.2, least_score: float = 0.0, candidates: int | None = None,
) -> DataFrame:
    """The ``n`` best senses of the disciplines that the lens cares for, with tag bonus, the disciplines they bridge to and their relationships.

    ``candidates`` keeps only so many of the most confident senses before scoring; without it every sense is scored.
    """
    found = _visible(senses, search, altitude, source)
    cares = [d for d, w in weights.items() if w >= least_weight]
    if cares:
        found = found.where(F.col("discipline").isin(cares))
    if candidates is not None:
        found = found.orderBy(F.desc_nulls_last("confidence"), "sense_id").limit(candidates)
    known = F.array(*map(F.lit, weights)).cast("array<string>")
    to = F.filter(_others(found), lambda d: F.array_contains(known, d) & (d != F.col("discipline")))
    scored = lens_scores(found, weights, 0.05, bonus=True).withColumn("bridge_to", to).where(F.col("score") >= least_score)
    best = scored.orderBy(F.desc("score"), "sense_id").limit(n)
    return best.join(degree, "sense_id", "left").withColumn("rel_count", F.coalesce("degree", F.lit(0))).drop("degree").orderBy(F.desc("score"), "sense_id")


def discipline_query(senses: DataFrame, discipline: str, n: int) -> DataFrame:
    return senses.where(F.col("discipline") == discipline).orderBy(F.desc("confidence"), "label", "sense_id").limit(n)


def bridges(senses: DataFrame, a: str, b: str) -> DataFrame:
    """Senses with one of two disciplines as primary and the other among the secondary ones."""
    return senses.where(
        ((F.col("discipline") == a) & F.array_contains("secondary", b)) | ((F.col("discipline") == b) & F.array_contains("secondary", a))
    )


def lens_summary(senses: DataFrame, disciplines: list[str]) -> DataFrame:
    """Per source, and over all (source null): senses visible by a primary or secondary discipline, those by their primary
    one, and those of the latter that bridge to another."""
    seen = F.coalesce(F.col("discipline").isin(disciplines), F.lit(False))
    others = _others(senses)
    any_of = F.arrays_overlap(others, F.array(*map(F.lit, disciplines)).cast("array<string>"))
    return senses.rollup("source").agg(
        F.count_if(seen | F.coalesce(any_of, F.lit(False))).alias("visible"), F.count_if(seen).alias("by_primary"), F.count_if(seen & (F.size(others) > 0)).alias("bridges")
    )


def centre_senses(senses: DataFrame, label: str | Column, similar: int = 10) -> DataFrame:
    """The senses of a label, ignoring case; if there are none, the ``similar`` most confident ones whose label contains it."""
    wanted = F.lower(F.lit(label) if isinstance(label, str) else label)
    exact = senses.where(F.lower("label") == wanted)
    near = senses.where(F.contains(F.lower("label"), wanted)).orderBy(F.desc("confidence"), "sense_id").limit(similar)
    return exact.unionByName(near.where(~exact.exists()))


def neighbours(senses: DataFrame, edges: DataFrame, centre: DataFrame) -> DataFrame:
    """(neighbour, label, discipline, source, edge_confidence): the other ends of the centre's edges, one row for each edge."""
    own = centre.select("sense_id")
    forward = edges.join(own, F.col("source_sense_id") == F.col("sense_id"), "left_semi").select(F.col("target_sense_id").alias("neighbour"), F.col("confidence").alias("edge_confidence"))
    back = edges.join(own, F.col("target_sense_id") == F.col("sense_id"), "left_semi").join(own, F.col("source_sense_id") == F.col("sense_id"), "left_anti").select(
        F.col("source_sense_id").alias("neighbour"), F.col("confidence").alias("edge_confidence")
    )
    return forward.unionByName(back).join(senses.select(F.col("sense_id").alias("neighbour"), "label", "discipline", "source"), "neighbour")


def _one_a_label(near: DataFrame) -> DataFrame:
    return first_by(near.withColumn("_key", F.lower("label")), ["_key"], [F.desc("edge_confidence"), "neighbour"]).drop("_key")


def explore(senses: DataFrame, edges: DataFrame, label: str | Column, weights: dict[str, float], n: int) -> DataFrame:
    """The ``n`` best neighbour labels of a label's senses, each with its surest edge; score is weight · edge confidence."""
    near = _one_a_label(neighbours(senses, edges, centre_senses(senses, label)))
    score = weight_of("discipline", weights, 0.05) * F.coalesce(F.nullif(F.col("edge_confidence"), F.lit(0.0)), F.lit(0.5))
    return near.select("neighbour", "label", "discipline", F.round(score, 6).alias("score")).orderBy(F.desc("score"), "neighbour").limit(n)


def compare_lenses(senses: DataFrame, edges: DataFrame, label: str | Column, lenses: list[Lens], n: int = 15, top: int = 5) -> DataFrame:
    """How a label looks through each lens: rows (lens_id, kind, place, name, value).

    Of the ``n`` best neighbours of :func:`explore`: the ``top`` labels with their scores (kind neighbour) and the ``top``
    commonest disciplines with their counts (discipline); and the label's senses and edges (senses, connections).
    """
    centre = centre_senses(senses, label)
    near = neighbours(senses, edges, centre)
    each = F.explode(F.array(*(F.struct(F.lit(x.lens_id).alias("lens_id"), weight_map(x.weights).alias("weights")) for x in lenses)))
    weighed = _one_a_label(near).withColumn("_lens", each).select("_lens.lens_id", "neighbour", "label", "discipline", (
        F.coalesce(F.element_at("_lens.weights", F.col("discipline")), F.lit(0.05)) * F.coalesce(F.nullif(F.col("edge_confidence"), F.lit(0.0)), F.lit(0.5))
    ).alias("score")).withColumn("score", F.round("score", 6))
    best = top_by(weighed, ["lens_id"], [F.desc("score"), "neighbour"], n, "place")
    spread = top_by(best.groupBy("lens_id", "discipline").agg(F.count("*").alias("n")), ["lens_id"], [F.desc("n"), "discipline"], top, "place")

    def total(df: DataFrame, kind: str) -> DataFrame:
        names = F.explode(F.array(*(F.lit(x.lens_id) for x in lenses)))
        return df.agg(F.count("*").alias("n")).select(names.alias("lens_id"), F.lit(kind).alias("kind"), F.lit(0).alias("place"), F.lit(None).cast("string").alias("name"), F.col("n").cast("double").alias("value"))

    parts = [
        best.where(F.col("place") <= top).select("lens_id", F.lit("neighbour").alias("kind"), "place", F.col("label").alias("name"), F.col("score").alias("value")),
        spread.select("lens_id", F.lit("discipline").alias("kind"), "place", F.col("discipline").alias("name"), F.col("n").cast("double").alias("value")),
        total(centre, "senses"), total(near, "connections"),
    ]
    return reduce(DataFrame.unionByName, parts)


def lens_members(senses: DataFrame, lenses: list[Lens], least: float) -> DataFrame:
    """(lens_id, discipline, members): the labels of each discipline that a lens weighs at ``least``; a label's discipline is that of its
    first sense."""
    own = senses.groupBy("label").agg(F.min_by("discipline", "sense_id").alias("discipline")).groupBy("discipline").agg(F.count("*").alias("members"))
    sees = [(x.lens_id, d) for x in lenses for d, w in x.weights.items() if w >= least]
    table = senses.sparkSession.createDataFrame(sees, "lens_id string, discipline string")
    return own.join(table, "discipline").select("lens_id", "discipline", "members")  # one row for each discipline and lens


def papers_through_lens(
    pub_keywords: DataFrame, senses: DataFrame, weights: dict[str, float], relevance: float, least: int, n: int, search: str | None = None, least_weight: float = 0.2
) -> DataFrame:
    """Papers by the senses of their keywords: sum of relevance · confidence times the mean weight of the disciplines met.

    Only disciplines that the lens cares for count. Senses are summed up by label and keywords by paper and label before they meet,
    so a label with many senses costs one row. ``search`` keeps papers that have a keyword with that text.
    """
    cares = [d for d, w in weights.items() if w >= least_weight]
    by_label = senses.where(F.col("discipline").isin(cares)).groupBy(F.lower("label").alias("_l")).agg(
        F.countDistinct("sense_id").alias("_n"), F.sum("confidence").alias("_c"), *(F.max(F.col("discipline") == d).alias(f"_d{i}") for i, d in enumerate(cares))
    )
    keywords = pub_keywords.where(F.col("relevance") >= relevance).groupBy("pub", F.lower("label").alias("_l")).agg(F.sum("relevance").alias("_r"))
    if search:
        found = pub_keywords.where(F.contains(F.lower("label"), F.lit(search.lower()))).select("pub").distinct()
        keywords = keywords.join(found, "pub", "left_semi")
    out = keywords.join(by_label, "_l").groupBy("pub").agg(
        F.sum("_n").alias("senses"), F.sum(F.col("_r") * F.col("_c")).alias("raw"), *(F.max(f"_d{i}").alias(f"_d{i}") for i in range(len(cares)))
    ).where(F.col("senses") >= least)
    met = F.array(*(F.when(F.col(f"_d{i}"), F.struct(F.lit(d).alias("d"), F.lit(float(weights[d])).alias("w"))) for i, d in sorted(enumerate(cares), key=lambda x: x[1])))
    met = F.filter(met, lambda x: x.isNotNull())
    mean = F.aggregate(met, F.lit(0.0), lambda acc, x: acc + x["w"]) / F.size(met)
    return out.select(
        "pub", "senses", F.array_join(F.transform(met, lambda x: x["d"]), ",").alias("disciplines"), F.round(F.col("raw") * mean, 6).alias("score")
    ).orderBy(F.desc("score"), "pub").limit(n)
