from __future__ import annotations

import json

from compare import rows

from huntlake.sources.seen import EARLIEST, high_water, next_offsets, unseen

SCHEMA = "topic string, partition int, offset long, value binary"


def messages(spark, places):
    return spark.createDataFrame([(topic, part, offset, b"x") for topic, part, offset in places], SCHEMA)


def table(spark, places):
    return messages(spark, places).selectExpr("topic as _topic", "partition as _partition", "offset as _offset", "1 as other")


def places(df):
    return [row[:3] for row in rows(df.select("topic", "partition", "offset"))]


HELD = [("a", 0, 0), ("a", 0, 1), ("a", 0, 4), ("a", 2, 7), ("b", 0, 3)]


def test_marks_and_the_next_offsets(spark):
    held = table(spark, HELD).union(spark.createDataFrame([("a", 5, None, 1)], "t string, p int, o long, x int"))
    assert rows(high_water(held)) == [("a", 0, 4), ("a", 2, 7), ("b", 0, 3)]
    assert json.loads(next_offsets(held, {"a": 3, "c": 1})) == {"a": {"0": 5, "1": EARLIEST, "2": 8}, "c": {"0": EARLIEST}}


def test_only_messages_that_the_table_lacks_are_new(spark):
    read = [("a", 0, offset) for offset in range(7)] + [("a", 1, 0), ("a", 2, 7), ("a", 2, 8), ("b", 0, 3), ("b", 0, 2), ("c", 0, 0)]
    new = unseen(messages(spark, read), table(spark, HELD))
    assert new.columns == ["topic", "partition", "offset", "value"]
    assert sorted(places(new)) == sorted(set(read) - set(HELD))
    again = table(spark, HELD + places(new))
    assert unseen(messages(spark, read), again).count() == 0


def test_empty_tables_and_rows_without_coordinates(spark):
    read = [("a", 0, 0), ("a", 0, 1)]
    assert unseen(messages(spark, read), table(spark, [])).count() == 2
    assert unseen(messages(spark, []), table(spark, HELD)).count() == 0
    bare = spark.createDataFrame([(None, None, None, 1)], "_topic string, _partition int, _offset long, other int")
    assert unseen(messages(spark, read), bare).count() == 2
