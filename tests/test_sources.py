from __future__ import annotations

import gzip

import pytest
from compare import rows
from pyspark.sql.types import LongType, StringType, StructField, StructType

from huntlake.sources import (
    capture_schema,
    corrupt_records,
    decode_json,
    drop_corrupt,
    message_text,
    read_batch,
    read_table,
    read_topic,
    schema_from_text,
    schema_to_text,
    stream_topic,
    topic_options,
)


def test_json_lines_gzip_inferred_and_with_schema(spark, tmp_path):
    with gzip.open(tmp_path / "a.json.gz", "wt") as out:
        out.write('{"name": "x", "n": 1, "inner": {"k": "v"}}\n{"name": "é"}\n')
    inferred = read_batch(spark, str(tmp_path), "json")
    assert inferred.columns == ["inner", "n", "name"]
    typed = read_batch(spark, str(tmp_path), "json", "name string, n string")
    assert rows(typed) == [("x", "1"), ("é", None)]


def test_csv_header_and_inference(spark, tmp_path):
    (tmp_path / "a.csv").write_text("# Listingdate,SHA1,Listingreason\n2021-12-01 10:00:00,ab,C&C\n")
    read = read_batch(spark, str(tmp_path / "a.csv"), "csv")
    assert read.columns == ["# Listingdate", "SHA1", "Listingreason"]
    assert read.schema[0].dataType.simpleString() == "timestamp"


def test_csv_without_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text("1,example.org\n2,\n")
    read = read_batch(spark, str(tmp_path / "a.csv"), "csv", "n int, host string")
    assert rows(read) == [(1, "example.org"), (2, None)]


@pytest.mark.parametrize("fmt", ["parquet", "orc"])
def test_columnar_formats(spark, tmp_path, fmt):
    spark.range(3).write.format(fmt).save(str(tmp_path / fmt))
    assert read_batch(spark, str(tmp_path / fmt), fmt).count() == 3


def test_unknown_format_raises(spark):
    with pytest.raises(ValueError, match="unsupported"):
        read_batch(spark, "/nowhere", "xml2")


def test_read_table(spark):
    spark.range(2).write.mode("overwrite").saveAsTable("unit.two")
    assert read_table(spark, "unit.two").count() == 2


def test_topic_options():
    bounded = topic_options("b1:9094,b2:9094", "t", "earliest", "latest", min_partitions=64)
    assert bounded == {
        "kafka.bootstrap.servers": "b1:9094,b2:9094",
        "subscribe": "t",
        "startingOffsets": "earliest",
        "endingOffsets": "latest",
        "failOnDataLoss": "false",
        "minPartitions": "64",
    }
    unbounded = topic_options("b:1", "t", max_offsets_per_trigger=1000)
    assert "endingOffsets" not in unbounded
    assert unbounded["maxOffsetsPerTrigger"] == "1000"


def test_a_failed_topic_read_raises(spark):
    """Without the connector, or without a broker, the caller sees the error itself."""
    with pytest.raises(Exception, match="kafka"):
        read_topic(spark, "localhost:1", "t").count()
    with pytest.raises(Exception, match="kafka"):
        stream_topic(spark, "localhost:1", "t")


SCHEMA = StructType([StructField("a", StringType()), StructField("n", LongType())])
TEXTS = ['{"a": "x", "n": 1}', "not json", None, '{"a": "y", "extra": true}', '{"a": "z", "n": "word"}', "{}"]


@pytest.fixture
def messages(spark):
    data = [(t.encode() if t is not None else None, "topic", i % 2, i) for i, t in enumerate(TEXTS)]
    return spark.createDataFrame(data, "value binary, topic string, partition int, offset bigint")


def test_empty_messages_are_dropped(messages):
    assert message_text(messages).count() == 5


def test_good_messages(messages):
    good = drop_corrupt(decode_json(message_text(messages), SCHEMA))
    assert rows(good) == [(None, None), ("x", 1), ("y", None)]


def test_corrupt_messages_keep_text_and_coordinates(messages):
    decoded = decode_json(message_text(messages), SCHEMA, keep_raw=True, keep_coordinates=True)
    bad = corrupt_records(decoded).select("_raw", "_topic", "_partition", "_offset")
    assert rows(bad) == [("not json", "topic", 1, 1), (TEXTS[4], "topic", 0, 4)]


def test_drop_corrupt_without_marker_column(spark):
    assert drop_corrupt(spark.range(2)).count() == 2


def test_decode_stays_in_the_jvm(messages, plan):
    text = plan(drop_corrupt(decode_json(message_text(messages), SCHEMA)))
    assert "Python" not in text and "Exchange" not in text
    assert text.count("from_json") == 1, "a message is parsed once"


def test_capture_schema(spark):
    texts = [
        '{"@timestamp": "2024", "a.b": {"x:y": 1, "z": 1.5}, "l": [{"k": 1}], "none": null, "e": {}, "VOID": true}',
        "not json",
        None,
        '{"a.b": {"x:y": "text"}, "OBJECT": {"DECIMAL(1, 1)": 2}}',
    ]
    schema = capture_schema(spark.createDataFrame([(t,) for t in texts], "value string"))
    assert {item.name: item.dataType.simpleString() for item in schema.fields} == {
        "@timestamp": "string",
        "a.b": "struct<x:y:string,z:double>",
        "l": "array<struct<k:bigint>>",
        "none": "string",
        "e": "string",
        "VOID": "boolean",
        "OBJECT": "struct<DECIMAL(1, 1):bigint>",
    }
    assert schema_from_text(schema_to_text(schema)) == schema


def test_capture_schema_of_no_objects(spark):
    with pytest.raises(ValueError, match="not JSON objects"):
        capture_schema(spark.createDataFrame([("[1]",)], "value string"))


def test_captured_schema_decodes_what_it_saw(spark):
    text = '{"@timestamp": "2024", "w": {"event_id": 1, "d": {"x": null, "y": [1, 2]}}}'
    messages = spark.createDataFrame([(text,)], "value string")
    decoded = drop_corrupt(decode_json(messages, capture_schema(messages)))
    assert decoded.selectExpr("`@timestamp`", "w.event_id", "w.d.y").first() == ("2024", 1, [1, 2])
