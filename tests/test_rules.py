"""The rule automaton against trying the rules one by one, and the rule tables on plain examples."""

import time

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from vocabloom.functions.automaton import NONE, RULE_COLUMNS, Rule, RuleAutomaton, classified, rule_rows, rules_of
from vocabloom.operators.rule_tables import keyword_rules, source_rules, sub_category_rules
from vocabloom.operators.senses import keyword_disciplines, publication_senses, source_disciplines
from vocabloom.operators.vectors import sub_categories


def one_by_one(rules, row, scope=None):
    for at, r in enumerate(rules):
        text = row.get(r.field) if r.field else None
        if r.scope is not None and r.scope != scope:
            continue
        if r.field is None or text is not None and (text == r.text if r.kind == "is" else r.text in text if r.kind == "has" else text != ""):
            return at
    return NONE


words = st.text("ab ", max_size=5)
rules = st.lists(st.builds(Rule, st.sampled_from("xyz"), st.sampled_from(["is", "has", "any"]), st.sampled_from(["f", "g"]), words, st.sampled_from([None, "s", "t"])), min_size=1, max_size=12)


@settings(max_examples=200, deadline=None)
@given(rules, st.lists(st.tuples(st.none() | words, st.none() | words, st.sampled_from([None, "s", "u"])), min_size=1, max_size=8))
def test_first_rule_wins(table, rows):
    columns = {"f": pd.Series([r[0] for r in rows], dtype=object), "g": pd.Series([r[1] for r in rows], dtype=object)}
    found = RuleAutomaton(table).places(np.array([r[2] for r in rows], object), columns, len(rows))
    assert found.tolist() == [one_by_one(table, {"f": f, "g": g}, s) for f, g, s in rows]


def test_many_rules_cost_little_more():
    rng = np.random.default_rng(1)
    word = lambda: "".join(rng.choice(list("abcdefghij"), 6))
    table = [Rule(str(k), "has", "f", word()) for k in range(500)]
    texts = pd.Series([" ".join(word() for _ in range(12)) for _ in range(20_000)], dtype=object)

    def seconds(some):
        automaton = RuleAutomaton(some)
        return min(_timed(lambda: automaton.places(None, {"f": texts}, len(texts))) for _ in range(3))

    assert seconds(table) <= 2 * seconds(table[:50]) + 0.02


def _timed(f):
    start = time.perf_counter()
    f()
    return time.perf_counter() - start


def test_tables_of_rules(spark):
    table = spark.createDataFrame(rule_rows(keyword_rules()), RULE_COLUMNS)
    assert rules_of(table.repartition(4)) == keyword_rules()
    with pytest.raises(ValueError):
        RuleAutomaton([Rule("x", "starts", "f", "a")])
    with pytest.raises(ValueError):
        RuleAutomaton([Rule("x", "has", "f", "a" * (17 << 20))])
    df = spark.createDataFrame([("a", 1), (None, 2)], "f string, _rule int")
    got = classified(df, [Rule("x", "has", "f", "a")], {"f": df["f"]}, name="c", place="p").orderBy("_rule").collect()
    assert [(r["_rule"], r["c"], r["p"]) for r in got] == [(1, "x", 0), (2, None, None)]
    with pytest.raises(ValueError):
        classified(df, [Rule("x", "has", "g", "a")], {"f": df["f"]})


def test_keyword_disciplines(spark):
    rows = {
        ("Coal Ash", None): "coal_science", ("Marcellus play", None): "natural_gas", ("permeability", None): "fossil_energy", ("low permeability", None): "ee_me_engineering",
        ("deep learning of coke", None): "computation_data", ("steel alloys", None): "materials", ("gene flow", None): "ee_me_engineering", ("xyz", "Thermodynamics"): "ee_me_engineering",
        ("xyz", "Optics"): "ee_me_engineering", ("xyz", "Geology"): "earth_environmental", ("xyz", "applied BIOLOGY"): "biological_medical", ("xyz", None): "ee_me_engineering",
    }
    df = spark.createDataFrame(list(rows), "label string, category string")
    assert {(r["label"], r["category"]): r["discipline"] for r in keyword_disciplines(df).collect()} == rows


def test_source_disciplines(spark):
    rows = [
        ("OpenAlex", "Physical Sciences > Energy > Fuels", "x", None, "fossil_energy"), ("OpenAlex", "Social Sciences", "x", None, "policy_economics"), ("OpenAlex", "Health > Unheard", "x", None, "math_physics"),
        ("OpenAlex", None, "x", None, "math_physics"), ("NASA GCMD", "EARTH SCIENCE > ATMOSPHERE", "x", "sciencekeywords", "space_atmospheric"), ("NASA GCMD", "A > ATMOSPHERE", "x", "providers", "policy_economics"),
        ("NASA GCMD", "EARTH SCIENCE", "x", "sciencekeywords", "earth_environmental"), ("DOE OSTI", "Renewable Energy > Solar", "x", None, "renewable_alternative"), ("DOE OSTI", "", "x", None, "fossil_energy"),
        ("Library of Congress", "Science > Nuclear physics", "x", None, "math_physics"), ("Library of Congress", "Coal mines", "x", None, "coal_science"), ("UNESCO Thesaurus", None, "Biogas", None, "natural_gas"),
        ("UNESCO Thesaurus", None, "Poetry", None, "policy_economics"), ("NCBI Taxonomy", "coal", "coal", None, "biological_medical"), ("MeSH", None, "Methane", "D", "natural_gas"), ("MeSH", None, "Water", "D01", "chemical_sciences"),
        ("MeSH", None, "Water", None, "biological_medical"), (None, "coal", "coal", None, "math_physics"),
    ]
    df = spark.createDataFrame(rows, "source string, path string, label string, kind string, wanted string")
    assert source_disciplines(df).where("NOT discipline <=> wanted").collect() == []
    assert {r.scope for r in source_rules()} == {r[0] for r in rows}


def test_publication_senses(spark):
    mentions = spark.createDataFrame(
        [(p, " Coal ", "author", None) for p in range(12)] + [(1, "coal", "plus", "B"), (0, "x y", "plus", None), (3, "x y", "plus", "Geology"), (2, "x y", "plus", "Optics"), (5, " ", "author", None), (5, None, "plus", None)],
        "pub long, label string, kind string, category string",
    )
    senses = spark.createDataFrame([("k#0", "COAL")], "sense_id string, label string")
    tiers = spark.createDataFrame([("coal_science", 1)], "discipline_id string, tier int")
    got = {r["label"]: r for r in publication_senses(mentions, senses, tiers).collect()}
    assert set(got) == {"coal", "x y"}
    assert (got["coal"]["pubs"], got["coal"]["author"], got["coal"]["plus"], got["coal"]["tags"]) == (12, 12, 1, "author_keyword,keywords_plus,high_frequency,pillar_overlap")
    assert (got["coal"]["discipline"], got["coal"]["resolution_tier"], got["coal"]["confidence"]) == ("coal_science", 1, 0.62)
    assert (got["x y"]["sense_id"], got["x y"]["category"], got["x y"]["resolution_tier"]) == ("wos:x_y@WoS_publication#0", "Optics", 4)
    again = publication_senses(mentions, got["x y"] and spark.createDataFrame([("wos:x_y@WoS_publication#0", "z")], "sense_id string, label string"), tiers)
    assert {r["label"] for r in again.collect()} == {"coal"}


def test_sub_categories(spark):
    senses = spark.createDataFrame([(1, "Coal Combustion in air"), (2, "combustion"), (3, "hot air"), (4, "far"), (5, "no vector"), (6, "hydrogen"), (7, None)], "id long, label string")
    vectors = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, [0.9, 0.1]), (4, [-1.0, -1.0]), (6, [0.0, 0.0]), (7, [0.0, 0.0])], "id long, v array<double>")
    got = {r["id"]: (r["sub_category"], r["strategy"]) for r in sub_categories(senses, vectors, "id", "v", sub_category_rules(), 0.5).collect()}
    assert got == {1: ("coal_combustion", "pattern"), 2: ("combustion", "pattern"), 3: ("coal_combustion", "centroid"), 6: ("hydrogen", "pattern")}
