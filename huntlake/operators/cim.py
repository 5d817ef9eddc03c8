"""Common information model (CIM): declarative column rules compiled to projections.

A rule set says, for each target column, where it comes from: a source column
(``Rename``), a fixed text (``Literal``) or a SQL expression over target names
(``Expression``). Applying it yields exactly the targets, sorted by name.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from huntlake.functions.names import aliased, column_lookup, quoted, text_literal

# Fixed value: the text that stands in a target whose source column does not exist.
MISSING_TEXT = "null"


@dataclass(frozen=True)
class Rename:
    target: str
    source: str


@dataclass(frozen=True)
class Literal:
    target: str
    text: str


@dataclass(frozen=True)
class Expression:
    target: str
    sql: str


Rule = Rename | Literal | Expression

_MARKED = re.compile(r"(EXPR|LITERAL)\s?=(.*)", re.DOTALL)


def parse_rules(entries: Iterable[dict[str, list[str]]], strict: bool = False) -> list[Rule]:
    """Read the text form of rules.

    An entry is ``{"rename": [source, target]}``, ``{"new": [target, "EXPR=<sql>"]}``
    or ``{"new": [target, "LITERAL=<text>"]}``; one blank may precede the ``=``.
    Anything else raises when ``strict`` and is left out otherwise.
    """
    rules: list[Rule] = []
    for entry in entries:
        for kind, (first, second) in entry.items():
            marked = _MARKED.fullmatch(second) if kind == "new" else None
            if kind == "rename":
                rules.append(Rename(target=second, source=first))
            elif marked and marked.group(1) == "EXPR":
                rules.append(Expression(target=first, sql=marked.group(2)))
            elif marked:
                rules.append(Literal(target=first, text=marked.group(2)))
            elif strict:
                raise ValueError(f"unknown rule {kind!r}: {[first, second]}")
    return rules


def apply_rules(df: DataFrame, rules: Iterable[Rule], missing: str | None = MISSING_TEXT) -> DataFrame:
    """Project ``df`` to the targets of ``rules``, sorted by name.

    A target whose source column does not exist holds ``missing``; a source that
    exists and is NULL stays NULL. Expressions see the renamed and literal
    targets, and those columns of ``df`` that no target replaces. One source may
    feed several targets.
    """
    rules = list(rules)
    repeated = sorted(name for name, uses in Counter(rule.target for rule in rules).items() if uses > 1)
    if repeated:
        raise ValueError(f"targets with more than one rule: {repeated}")

    names = df.columns
    actual = column_lookup(df.sparkSession, names)
    plain = {}
    expressions = {}
    for rule in rules:
        if isinstance(rule, Expression):
            expressions[rule.target] = f"{rule.sql} AS {quoted(rule.target)}"
        elif isinstance(rule, Literal):
            plain[rule.target] = _constant(rule.target, rule.text)
        elif (source := actual(rule.source)) is None:
            plain[rule.target] = _constant(rule.target, missing)
        else:
            plain[rule.target] = aliased(rule.target, source)

    replaced = {actual(target) for target in plain}
    others = [quoted(name) for name in names if name not in replaced]
    staged = df.selectExpr(*others, *plain.values())
    return staged.selectExpr(
        *(expressions.get(target) or quoted(target) for target in sorted([*plain, *expressions]))
    )


def fill_missing(df: DataFrame, sources: Iterable[str], missing: str | None = MISSING_TEXT) -> DataFrame:
    """Add each absent source column, holding ``missing``."""
    actual = column_lookup(df.sparkSession, df.columns)
    absent = [name for name in dict.fromkeys(sources) if actual(name) is None]
    return df.selectExpr("*", *(_constant(name, missing) for name in absent))


def _constant(target: str, text: str | None) -> str:
    return f"{text_literal(text)} AS {quoted(target)}"
