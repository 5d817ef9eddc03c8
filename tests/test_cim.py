from __future__ import annotations

import pytest

from huntlake.operators.cim import Expression, Literal, Rename, apply_rules, fill_missing, parse_rules
from huntlake.plans.rules import NETWORK, ROUTES


@pytest.fixture
def frame(spark):
    return spark.sql("select 'v' as `a:b`, 2 as n, cast(null as string) as empty")


def test_targets_sorted_by_code_point(frame):
    found = apply_rules(frame, [Rename("b", "n"), Literal("Z", "1"), Literal("_x", "2"), Rename("a", "a:b")])
    assert found.columns == ["Z", "_x", "a", "b"]


def test_absent_source_holds_text_and_null_stays_null(frame):
    rules = [Rename("absent", "nothing"), Rename("empty", "empty")]
    assert apply_rules(frame, rules).first() == ("null", None)
    assert apply_rules(frame, rules, missing=None).first() == (None, None)
    assert dict(apply_rules(frame, rules, missing=None).dtypes)["absent"] == "string"


def test_expressions_see_renamed_literal_and_untouched_columns(frame):
    found = apply_rules(
        frame,
        [Rename("x", "a:b"), Literal("lit", "it's"), Expression("all", "concat(x, lit, cast(n as string))")],
    )
    assert found.first().asDict() == {"all": "vit's2", "lit": "it's", "x": "v"}


def test_rename_over_an_existing_column(frame):
    assert apply_rules(frame, [Rename("n", "a:b"), Expression("m", "upper(n)")]).first() == ("V", "v")


def test_swapped_names(spark):
    found = apply_rules(spark.sql("select 1 as a, 2 as b"), [Rename("a", "b"), Rename("b", "a")])
    assert found.first().asDict() == {"a": 2, "b": 1}


def test_source_in_other_case_is_found(frame, settings):
    assert apply_rules(frame, [Rename("t", "A:B")]).first() == ("v",)
    settings(spark__sql__caseSensitive="true")
    assert apply_rules(frame, [Rename("t", "A:B")]).first() == ("null",)


def test_one_source_for_two_targets(frame):
    assert apply_rules(frame, [Rename("x", "n"), Rename("y", "n")]).first() == (2, 2)


def test_repeated_target_raises(frame):
    with pytest.raises(ValueError, match="'x'"):
        apply_rules(frame, [Rename("x", "n"), Literal("x", "1")])


def test_literals_with_quotes_and_backslashes(frame):
    text = "a'b\\c\"`\n"
    assert apply_rules(frame, [Literal("t", text)]).first() == (text,)


def test_rule_text():
    entries = [
        {"new": ["a", "EXPR=x = 1"]},
        {"new": ["b", "EXPR =y"]},
        {"new": ["c", "LITERAL="]},
        {"new": ["d", "LITERAL =EXPR=z"]},
        {"rename": ["s", "t"]},
    ]
    assert parse_rules(entries, strict=True) == [
        Expression("a", "x = 1"),
        Expression("b", "y"),
        Literal("c", ""),
        Literal("d", "EXPR=z"),
        Rename(target="t", source="s"),
    ]


@pytest.mark.parametrize("entry", [{"new": ["a", "no marker"]}, {"new": ["a", "EXPR  =x"]}, {"drop": ["a", "b"]}])
def test_unknown_rule_text(entry):
    assert parse_rules([entry]) == []
    with pytest.raises(ValueError, match="unknown rule"):
        parse_rules([entry], strict=True)


def test_fill_missing(frame):
    filled = fill_missing(frame, ["x:y", "A:B", "x:y"])
    assert filled.columns == ["a:b", "n", "empty", "x:y"]
    assert filled.first()["x:y"] == "null"


def test_route_widths():
    widths = {route.table: len({rule.target for rule in route.rules}) for route in ROUTES}
    assert widths == {
        "process": 36,
        "registry": 19,
        "service": 15,
        "file": 21,
        "network": 26,
        "dns": 18,
        "wmi": 22,
    }
    assert "event_message" not in {rule.target for rule in NETWORK.rules}
