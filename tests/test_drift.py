from __future__ import annotations

import datetime
import json

import pytest
from compare import rows
from hypothesis import HealthCheck, Phase, given, settings
from hypothesis import strategies as st

from huntlake.sources import drift, payload
from huntlake.sinks.shared import fresh_folder

DAY = [datetime.date(2024, 1, number) for number in range(1, 5)]


def messages(spark, found):
    return spark.createDataFrame(
        [(day, bytearray(text.encode()) if text is not None else None) for day, text in found], "day date, value binary"
    )


def held(value, at=""):
    """Brute force: {path: types} of one JSON value."""
    if isinstance(value, dict):
        found = {at: {"OBJECT"}}
        for name, inner in value.items():
            found |= held(inner, f"{at}.{drift._path_name(name)}" if at else drift._path_name(name))
        return found
    kinds = {bool: "BOOLEAN", int: "BIGINT", float: "DOUBLE", str: "STRING", type(None): "VOID"}
    return {at: {kinds[type(value)]}}


NAMES = st.text("ab_.`: <>,D1", max_size=4) | st.sampled_from(["OBJECT<", "a: BIGINT", "DECIMAL(2,1)", "ARRAY", "é"])
VALUES = st.recursive(
    st.none() | st.booleans() | st.integers(-(2**40), 2**40) | st.sampled_from(["", "x", "`>"]) | st.sampled_from([0.5, 1e300, -2.25]),
    lambda inner: st.dictionaries(NAMES, inner, max_size=4),
    max_leaves=12,
)


@settings(max_examples=5, deadline=None, phases=[Phase.generate], suppress_health_check=list(HealthCheck))
@given(st.lists(st.dictionaries(NAMES, VALUES, max_size=4), min_size=20, max_size=40))
def test_paths_equal_a_walk_in_plain_python(spark, found):
    expected: dict = {}
    for number, value in enumerate(found):
        for path, kinds in held(value).items():
            for kind in kinds:
                key = (DAY[number % 2], path, kind)
                expected[key] = expected.get(key, 0) + 1
    got = drift.drift_profile(messages(spark, [(DAY[n % 2], json.dumps(v)) for n, v in enumerate(found)]), "day")
    assert {tuple(row)[:3]: row["messages"] for row in got.collect()} == expected


def test_arrays_garbage_and_messages_that_are_no_objects(spark):
    found = [(DAY[0], text) for text in ('{"a":[]}', '{"a":[1,2.5]}', '{"a":[1,"x"]}', '{"a":[{"b":1},{"c":[true]}]}')]
    found += [(DAY[0], text) for text in ("no json", '{"a":1,"a":2}', '"text"', "[1]", "", None)] + [(None, '{"z":1}')]
    got = rows(drift.drift_profile(messages(spark, found), "day").drop("day"))
    assert got == sorted(
        [
            ("", "ARRAY", 1), ("", "CORRUPT", 3), ("", "OBJECT", 4), ("", "STRING", 1), ("[]", "BIGINT", 1), ("a", "ARRAY", 4),
            ("a[]", "VOID", 1), ("a[]", "DOUBLE", 1), ("a[]", "VARIANT", 1), ("a[]", "OBJECT", 1),
            ("a[].b", "BIGINT", 1), ("a[].c", "ARRAY", 1), ("a[].c[]", "BOOLEAN", 1),
        ],
        key=lambda row: tuple((True, str(v)) for v in row),
    )
    assert rows(drift.drift_profile(messages(spark, []), "day")) == []


HISTORY = [
    (DAY[0], '{"id":1,"who":{"n":"x"}}'),
    (DAY[1], '{"id":2,"who":{"n":null}}'),
    (DAY[2], '{"id":2.5,"who":{"n":"y","m":[1]}}'),
    (DAY[3], '{"id":3,"user":5}'),
    (DAY[3], '{"id":3,"user":"u"}'),
    (DAY[3], "garbage"),
]


def test_versions_begin_where_something_new_appears(spark):
    path = fresh_folder(spark, "profile")
    all_messages = messages(spark, HISTORY)
    assert drift.update_profile(all_messages.where("day < date'2024-01-03'"), path, "day") == DAY[:2]
    assert drift.update_profile(all_messages, path, "day") == DAY[2:]
    assert drift.update_profile(all_messages, path, "day", days=[DAY[1]]) == [DAY[1]]
    found = drift.schema_versions(drift.read_profile(spark, path, "day"), "day").collect()
    assert {(r["version"], r["path"], r["type"]) for r in found} == {
        (1, "", "OBJECT"), (1, "id", "BIGINT"), (1, "who", "OBJECT"), (1, "who.n", "STRING"),
        (2, "who.n", "VOID"), (3, "id", "DOUBLE"), (3, "who.m", "ARRAY"), (3, "who.m[]", "BIGINT"),
        (4, "user", "BIGINT"), (4, "user", "STRING"),
    }
    assert {(r["since"], r["last"], r["messages"]) for r in found if r["path"] == "id" and r["type"] == "BIGINT"} == {(DAY[0], DAY[3], 4)}
    assert drift.read_profile(spark, path, "day", DAY[1], DAY[2]).where("path = 'id'").count() == 2


def test_report_and_proposal(spark):
    profile = drift.drift_profile(messages(spark, HISTORY), "day")
    stored = payload.StructType.fromDDL("id bigint, who struct<n:string>, gone string")
    got = {row["path"]: (row["types"], row["action"]) for row in drift.drift_report(profile, stored).collect()}
    assert got == {
        "id": ("BIGINT,DOUBLE", "change"), "who": ("OBJECT", "keep"), "who.n": ("STRING", "keep"),
        "who.m": ("ARRAY", "add"), "who.m[]": ("BIGINT", "add"), "user": ("BIGINT,STRING", "mixed"),
    }
    with pytest.raises(ValueError, match="mixed types: user"):
        drift.proposed_schema(profile)
    with pytest.raises(ValueError, match="mixed must be"):
        drift.proposed_schema(profile, "drop")
    schema = drift.proposed_schema(profile, "variant")
    assert schema.simpleString() == "struct<id:double,user:variant,who:struct<m:array<bigint>,n:string>>"
    assert drift.proposed_schema(profile, "string")["user"].dataType.simpleString() == "string"
    decoded = payload.decode_json(payload.message_text(messages(spark, HISTORY)), schema)
    assert decoded.where("_corrupt_record is not null").count() == 1
    assert rows(decoded.selectExpr("to_json(user) as u").where("u is not null")) == [('"u"',), ("5",)]
    again = drift.drift_report(profile, drift.proposed_schema(profile, "variant")).where("action not in ('keep', 'mixed')")
    assert rows(again) == []
    assert drift.proposed_schema(drift.drift_profile(messages(spark, []), "day")).fields == []


def test_names_with_dots_and_quotes_come_back(spark):
    text = json.dumps({"a.b": {"c`d": 1, "": "x"}, "DECIMAL(2,1)": 0.5, "12": [{"x y": True}], "e": {}})
    schema = drift.proposed_schema(drift.drift_profile(messages(spark, [(DAY[0], text)]), "day"))
    assert {f.name for f in schema} == {"a.b", "DECIMAL(2,1)", "12", "e"}
    assert {f.name for f in schema["a.b"].dataType} == {"c`d", ""}
    row = payload.decode_json(payload.message_text(messages(spark, [(DAY[0], text)])), schema).first()
    assert row["a.b"]["c`d"] == 1 and row["DECIMAL(2,1)"] == 0.5 and row["12"][0]["x y"] is True
