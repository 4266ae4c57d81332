"""Classification by an ordered table of rules, in one pass over a text for any number of rules.

The parts of texts that rules look for go into one Aho-Corasick automaton for each field (and scope), exact values into one dictionary; both give
the place of the first rule that holds. The least place over the fields wins, so the result is that of trying the rules one by one.
Different values of a field are looked up once in a batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import astuple, dataclass, fields

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vocabloom.functions.frame import with_package

#: Every worker holds the compiled table: so many rules, and bytes of their texts, at most.
MOST_RULES, MOST_BYTES = 200_000, 16 << 20
#: The place of no rule.
NONE = np.iinfo(np.int64).max


@dataclass(frozen=True)
class Rule:
    """``name`` is the class where ``field`` is (kind ``is``) or has within it (``has``) ``text``, or is not empty (``any``; without a field always);
    only for rows of ``scope``, if one is given."""

    name: str
    kind: str
    field: str | None = None
    text: str = ""
    scope: str | None = None


class _Field:
    """The first rules of one scope about one field."""

    def __init__(self, rules: list[tuple[int, Rule]]):
        self.exact: dict[str, int] = {}
        self.any = min((at for at, r in rules if r.kind == "any"), default=NONE)
        self.every = min((at for at, r in rules if r.kind == "has" and not r.text), default=NONE)  # any text has the empty one
        parts: dict[str, int] = {}
        for at, r in rules:
            if r.kind == "is":
                self.exact.setdefault(r.text, at)
            elif r.kind == "has" and r.text:
                parts.setdefault(r.text, at)
        self.parts = ahocorasick.Automaton() if parts else None
        for text, at in parts.items():
            self.parts.add_word(text, at)
        if parts:
            self.parts.make_automaton()

    def first(self, text: str | None) -> int:
        if text is None:
            return NONE
        found = min(self.exact.get(text, NONE), self.every, self.any if text else NONE)
        return min(found, min((at for _, at in self.parts.iter(text)), default=NONE)) if self.parts else found


class RuleAutomaton:
    """A compiled table of rules in their order."""

    def __init__(self, rules: list[Rule]):
        size = sum(len(r.text.encode()) for r in rules)
        if len(rules) > MOST_RULES or size > MOST_BYTES:
            raise ValueError(f"{len(rules)} rules of {size} bytes; a table has {MOST_RULES} rules and {MOST_BYTES} bytes at most")
        if odd := {r.kind for r in rules} - {"is", "has", "any"}:
            raise ValueError(f"unknown kinds of rules: {sorted(odd)}")
        self.names = [r.name for r in rules]
        self.fields = list(dict.fromkeys(r.field for r in rules if r.field))
        self.always = {s: min((at for at, r in enumerate(rules) if r.scope == s and not r.field), default=NONE) for s in {r.scope for r in rules}}
        self.by_scope = {
            s: {f: _Field(own) for f in self.fields if (own := [(at, r) for at, r in enumerate(rules) if r.scope == s and r.field == f])} for s in {r.scope for r in rules}
        }

    def places(self, scopes: np.ndarray | None, columns: dict[str, pd.Series], n: int) -> np.ndarray:
        """For each row the place of the first rule that holds, or NONE."""
        best = np.full(n, self.always.get(None, NONE), np.int64)
        for scope, of in self.by_scope.items():
            rows = np.arange(n) if scope is None else np.flatnonzero(scopes == scope) if scopes is not None else np.zeros(0, np.int64)
            if not len(rows):
                continue
            best[rows] = np.minimum(best[rows], self.always[scope])
            for name, rules in of.items():
                codes, values = pd.factorize(columns[name].to_numpy()[rows], use_na_sentinel=True)
                first = np.array([*map(rules.first, values), NONE], np.int64)  # the last for a null, whose code is -1
                best[rows] = np.minimum(best[rows], first[codes])
        return best


def rules_of(table: DataFrame) -> list[Rule]:
    """Rules from a table with the columns place, name, kind, field, text and scope, in order of place; its size is checked before it is collected."""
    size = table.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("b")).first()
    if size["n"] > MOST_RULES or size["b"] > MOST_BYTES:
        raise ValueError(f"{size['n']} rules of {size['b']} bytes; a table has {MOST_RULES} rules and {MOST_BYTES} bytes at most")
    return [Rule(r["name"], r["kind"], r["field"], r["text"] or "", r["scope"]) for r in table.orderBy("place").collect()]


def rule_rows(rules: list[Rule]) -> list[tuple]:
    """(place, name, kind, field, text, scope) of each rule, for a table."""
    return [(at, *astuple(r)) for at, r in enumerate(rules)]


RULE_COLUMNS = "place long, " + ", ".join(f"{f.name} string" for f in fields(Rule))


def classified(df: DataFrame, rules: list[Rule], of: dict[str, Column], scope: Column | None = None, name: str = "discipline", place: str | None = None) -> DataFrame:
    """``df`` with the class of the first rule that holds (null if none does), and the rule's place if a column is named for it.

    ``of`` gives the text of each field that rules name. The compiled table travels to each worker once, as a broadcast of checked size.
    """
    spark = df.sparkSession
    automaton = RuleAutomaton(rules)
    if missing := set(automaton.fields) - set(of):
        raise ValueError(f"no columns for the fields {sorted(missing)}")
    shared = with_package(spark).sparkContext.broadcast(rules)
    names, wanted = automaton.names, automaton.fields
    held: dict[str, RuleAutomaton] = {}

    def first(*columns: pd.Series) -> pd.Series:
        if "rules" not in held:
            held["rules"] = RuleAutomaton(shared.value)
        n = len(columns[0])
        at = held["rules"].places(columns[0].to_numpy(), dict(zip(wanted, columns[1:])), n)
        return pd.Series(np.where(at == NONE, -1, at))

    found = F.pandas_udf(first, "long")((scope if scope is not None else F.lit(None)).cast("string"), *(of[f].cast("string") for f in wanted))
    at = "_rule"
    while at in df.columns:
        at = "_" + at
    kinds = F.array(*map(F.lit, names))
    out = df.withColumn(at, found).withColumn(name, F.when(F.col(at) >= 0, F.get(kinds, F.col(at).cast("int"))))
    return (out.withColumn(place, F.when(F.col(at) >= 0, F.col(at))) if place else out).drop(at)
