from __future__ import annotations

import pytest
from hypothesis import given, settings as hypothesis_settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from huntlake.operators.ingest import add_batch_metadata, add_ingest_time, promote_event_fields
from huntlake.operators.shape import flatten, flatten_events, leaf_paths, prefix_columns, split_lines


def test_leaves_first_then_structs_from_last_to_first(spark):
    schema = "s1 struct<a:int,b:struct<c:int>>, x int, s2 struct<d:int,e:struct<f:int>,g:int>, m map<string,int>"
    flat = flatten(spark.createDataFrame([], schema))
    assert flat.columns == ["x", "m", "s2:d", "s2:g", "s2:e:f", "s1:a", "s1:b:c"]


def test_arrays_stay_whole_and_odd_names_work(spark):
    frame = spark.sql(
        "select named_struct('c.d', 1, '@t', named_struct('x`y', 'v')) as `a.b`, array(named_struct('k', 1)) as l"
    )
    flat = flatten(frame)
    assert flat.columns == ["l", "a.b:c.d", "a.b:@t:x`y"]
    assert flat.first()[1:] == (1, "v")


def test_null_structs_give_null_leaves(spark):
    flat = flatten(spark.createDataFrame([(None,)], "s struct<a:int,b:string>"))
    assert flat.first() == (None, None)


def test_clashing_names_raise(spark):
    frame = spark.sql("select 1 as `a:b`, named_struct('b', 2) as a")
    with pytest.raises(ValueError, match="a:b"):
        flatten(frame)


names = st.text("ab:.@`", min_size=1, max_size=3)
schemas = st.recursive(
    st.just(LongType()),
    lambda inner: st.lists(st.tuples(names, inner), min_size=1, max_size=3, unique_by=lambda f: f[0].lower()).map(
        lambda fields: StructType([StructField(name, kind) for name, kind in fields])
    ),
    max_leaves=8,
).filter(lambda kind: isinstance(kind, StructType))


@hypothesis_settings(max_examples=15, deadline=None)
@given(schemas)
def test_flatten_keeps_every_leaf_value(spark, schema):
    counter = iter(range(1000))

    def fill(kind):
        return tuple(fill(f.dataType) for f in kind.fields) if isinstance(kind, StructType) else next(counter)

    def look(row, path):
        return look(row[path[0]], path[1:]) if path else row

    row = fill(schema)
    frame = spark.createDataFrame([row], schema)
    paths = list(leaf_paths(schema))
    if len({":".join(path) for path in paths}) < len(paths):
        with pytest.raises(ValueError):
            flatten(frame)
        return
    flat = flatten(frame).first()
    nested = frame.first()
    assert list(flat) == [look(nested, path) for path in paths]


def test_prefix(spark):
    frame = spark.sql("select 1 as `a.b`, 2 as c")
    assert prefix_columns(frame, "p_").columns == ["p_a.b", "p_c"]


def test_split_lines_moves_the_column_last(spark):
    frame = spark.createDataFrame([("a\nb\n", 1), (None, 2), ("", 3)], "message string, n int")
    assert [tuple(r) for r in split_lines(frame).orderBy("n").collect()] == [(1, ["a", "b", ""]), (2, None), (3, [""])]


def test_batch_metadata(spark):
    frame = add_batch_metadata(spark.range(1), "src")
    assert frame.columns == ["datasource", "ingest_time", "id", "p_ingest_date"]
    row = frame.first()
    assert row["datasource"] == "src" and row["ingest_time"].date() == row["p_ingest_date"]


def test_ingest_time_leads(spark):
    assert add_ingest_time(spark.range(1)).columns == ["_ingest_time", "id"]


@pytest.fixture
def raw(spark):
    data = [(t, ("Security",), ("h",), "m1\nm2") for t in ("2024-01-01T23:59:59.9Z", "yesterday", None)]
    return spark.createDataFrame(
        data, "`@timestamp` string, winlog struct<channel:string>, agent struct<hostname:string>, message string"
    )


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Tokyo"])
def test_promoted_fields_and_utc_date(raw, settings, zone):
    settings(spark__sql__session__timeZone=zone)
    promoted = promote_event_fields(raw)
    assert promoted.columns[:4] == ["_sourcetype", "_event_time", "_event_date", "dvc_hostname"]
    dates = [r[0] and str(r[0]) for r in promoted.select("_event_date").collect()]
    assert dates == ["2024-01-01", None, None]


def test_flatten_events(raw):
    flat = flatten_events(promote_event_fields(raw))
    assert flat.columns[-2:] == ["agent:hostname", "winlog:channel"]
    assert flat.select(F.col("message")).first()[0] == ["m1", "m2"]
