from __future__ import annotations

import pytest
from compare import rows
from pyspark.sql import functions as F

from catalogue import inputs
from huntlake.operators.layout import optimize_table
from huntlake.plans.events import BRONZE_PARTITIONS, bronze_events, silver_tables
from huntlake.sinks.shared import shared_folder
from huntlake.streaming.append import checkpoint_path, stream_to_table
from huntlake.streaming.fanout import BATCH, fan_out

SCHEMA = "value binary, topic string, partition int, offset bigint"


@pytest.fixture
def topic(spark, sf_dir, tmp_path):
    """A folder that stands for a topic: ``deliver(n)`` adds the n-th quarter of the messages."""
    messages = inputs.messages(spark, sf_dir)

    def deliver(quarter: int) -> None:
        messages.filter(F.col("offset") % 4 == quarter).coalesce(2).write.mode("append").parquet(str(tmp_path / "in"))

    def stream():
        return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))

    deliver.stream = stream
    return deliver


def test_each_sink_has_its_own_checkpoint(spark):
    default = checkpoint_path(spark.range(1), "a.b")
    assert default == f"{shared_folder(spark)}/streams/a.b"
    assert checkpoint_path(spark.range(1), "a.c", "/root/") == "/root/streams/a.c"


def test_append_equals_batch_and_resumes(spark, sf_dir, tmp_path, topic):
    schema = inputs.payload_schema(spark, sf_dir)
    spark.sql("drop table if exists unit.stream")

    def run():
        stream_to_table(
            bronze_events(topic.stream(), schema, keep_raw=False, corrupt="drop"),
            "unit.stream",
            "bronze",
            BRONZE_PARTITIONS,
            checkpoint_root=str(tmp_path / "check"),
            path=str(tmp_path / "table"),
        ).awaitTermination()
        return spark.table("unit.stream").drop("_ingest_time").select("rid", "_event_date", "_sourcetype", "winlog")

    topic(0)
    topic(1)
    first = run().count()
    assert run().count() == first
    topic(2)
    topic(3)
    batch = bronze_events(inputs.messages(spark, sf_dir), schema, keep_raw=False, corrupt="drop")
    expected = rows(batch.select("rid", "_event_date", "_sourcetype", "winlog"))
    assert 0 < first < len(expected)
    assert rows(run()) == expected


def test_a_table_fed_by_a_stream_is_not_moved(spark, tmp_path, topic):
    spark.sql("drop table if exists unit.fed")
    topic(0)
    stream_to_table(
        topic.stream(), "unit.fed", "bronze", checkpoint_root=str(tmp_path / "check"), path=str(tmp_path / "fed")
    ).awaitTermination()
    with pytest.raises(ValueError, match="stream"):
        optimize_table(spark, "unit.fed", ["offset"])


def test_unknown_tier_raises(spark, topic):
    topic(0)
    with pytest.raises(ValueError, match="tier"):
        stream_to_table(topic.stream(), "unit.x", "none")


def fanned(spark, namespace):
    return {name: rows(spark.table(f"{namespace}.{name}").drop("_ingest_time", BATCH)) for name in TABLES}


TABLES = ("process", "wmi", "all_silver")


def only(bronze):
    return {name: frame for name, frame in silver_tables(bronze).items() if name in TABLES}


def test_fan_out_equals_batch_and_survives_a_failed_batch(spark, sf_dir, tmp_path, topic):
    schema = inputs.payload_schema(spark, sf_dir)
    spark.sql("create database if not exists unit_fan")
    for name in TABLES:
        spark.sql(f"drop table if exists unit_fan.{name}")
    broken = {"armed": False}

    def tables(bronze):
        frames = only(bronze)
        if broken["armed"] and not bronze.isStreaming:
            # the other tables of the batch are written, this one fails
            frames["wmi"] = frames["wmi"].withColumn("user_name", F.raise_error(F.lit("lost")).cast("string"))
        return frames

    def run():
        query = fan_out(
            bronze_events(topic.stream(), schema, keep_raw=False, corrupt="drop"),
            tables,
            "unit_fan",
            "fan",
            checkpoint_root=str(tmp_path / "check"),
            path=str(tmp_path / "tables"),
        )
        query.awaitTermination()

    topic(0)
    topic(1)
    run()
    topic(2)
    topic(3)
    broken["armed"] = True
    with pytest.raises(Exception, match="lost"):
        run()
    broken["armed"] = False
    run()
    run()

    batch = only(bronze_events(inputs.messages(spark, sf_dir), schema, keep_raw=False, corrupt="drop"))
    found = fanned(spark, "unit_fan")
    for name, frame in batch.items():
        columns = spark.table(f"unit_fan.{name}").drop("_ingest_time", BATCH).columns
        assert found[name] == rows(frame.select(*(F.col(f"`{c}`") for c in columns))), name
    batches = {r[0] for r in spark.table("unit_fan.all_silver").select(BATCH).distinct().collect()}
    assert len(batches) == 4 and not any(b.startswith("None") for b in batches)
    assert len({b.rsplit("-", 1)[0] for b in batches}) == 1


def test_fan_out_takes_up_columns_after_a_restart(spark, tmp_path):
    spark.sql("create database if not exists unit_grow")
    spark.sql("drop table if exists unit_grow.t")

    def run(low, extra):
        spark.range(low, low + 5).selectExpr("id", "'d' as _event_date").write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema("id long, _event_date string").parquet(str(tmp_path / "in"))

        def tables(frame):
            return {"t": frame.withColumn("late", F.col("id") * 2) if extra else frame}

        places = {"checkpoint_root": str(tmp_path / "check"), "path": str(tmp_path / "out")}
        fan_out(stream, tables, "unit_grow", "grow", **places).awaitTermination()

    run(0, extra=False)
    run(10, extra=True)
    expected = [(i, None) for i in range(5)] + [(i, 2 * i) for i in range(10, 15)]
    assert rows(spark.table("unit_grow.t").select("id", "late")) == sorted(expected, key=lambda r: (str(r[0])))


def test_stream_takes_up_columns_and_fields_after_a_restart(spark, tmp_path):
    spark.sql("drop table if exists unit.evolving")

    def run(low, fields):
        spark.range(low, low + 2).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema("id long").parquet(str(tmp_path / "in")).selectExpr("id", *fields, "id % 2 as p")
        places = {"checkpoint_root": str(tmp_path / "check"), "path": str(tmp_path / "out")}
        stream_to_table(stream, "unit.evolving", "bronze", ["p"], **places).awaitTermination()

    run(0, ["named_struct('a', id) as s"])
    run(2, ["named_struct('b', id) as s", "id as late"])
    run(4, ["id as late"])
    assert rows(spark.table("unit.evolving").select("id", "s.a", "s.b", "late", "p")) == [
        (0, 0, None, None, 0),
        (1, 1, None, None, 1),
        (2, None, 2, 2, 0),
        (3, None, 3, 3, 1),
        (4, None, None, 4, 0),
        (5, None, None, 5, 1),
    ]
    with pytest.raises(ValueError, match="late"):
        run(6, ["'text' as late"])
