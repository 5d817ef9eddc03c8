from __future__ import annotations

from functools import partial

import pytest
from compare import rows
from pyspark.sql import functions as F

from huntlake.sinks.cleanup import remove_unreferenced, unreferenced_files
from huntlake.sinks.shared import in_parallel
from huntlake.streaming import ledger
from huntlake.streaming.fanout import fan_out


def frame(spark, low, high, day="2024-01-01"):
    return spark.range(low, high).selectExpr("id", f"date'{day}' as _event_date")


def partitions(spark, root, table="t"):
    return ledger.live_partitions(spark, root).where(F.col("table") == table).count()


def ids(spark, root, table="t"):
    return sorted(row["id"] for row in ledger.read_ledger_table(spark, root, table).collect())


def test_many_batches_become_one_partition_for_each_day(spark, tmp_path):
    root = str(tmp_path)
    for batch in range(12):
        days = frame(spark, batch * 10, batch * 10 + 5).union(frame(spark, batch * 10 + 5, batch * 10 + 10, f"2024-01-0{2 + batch % 2}"))
        assert ledger.write_batch({"t": days}, root, "q", batch)
    assert partitions(spark, root) == 24 and ids(spark, root) == list(range(120))
    assert ledger.compact_ledger_table(spark, root, "t", columns=["id"]) == 3
    assert partitions(spark, root) == 3 and ids(spark, root) == list(range(120))
    assert ledger.compact_ledger_table(spark, root, "t") == 0  # nothing new, nothing rewritten
    ledger.write_batch({"t": frame(spark, 200, 203)}, root, "q", 12)
    assert partitions(spark, root) == 4
    assert ledger.compact_ledger_table(spark, root, "t") == 1
    assert partitions(spark, root) == 3 and ids(spark, root) == [*range(120), 200, 201, 202]


def test_a_repeated_batch_is_written_once_and_a_failed_one_is_not_seen(spark, tmp_path):
    root = str(tmp_path)
    assert ledger.write_batch({"t": frame(spark, 0, 3), "u": frame(spark, 0, 2)}, root, "q", 0)
    assert not ledger.write_batch({"t": frame(spark, 0, 3), "u": frame(spark, 0, 2)}, root, "q", 0)
    broken = frame(spark, 5, 7).withColumn("id", F.raise_error(F.lit("lost")).cast("long"))
    with pytest.raises(Exception, match="lost"):
        ledger.write_batch({"t": frame(spark, 3, 5), "u": broken}, root, "q", 1)
    assert ids(spark, root) == [0, 1, 2] and ids(spark, root, "u") == [0, 1]
    assert ledger.write_batch({"t": frame(spark, 3, 5), "u": frame(spark, 5, 7)}, root, "q", 1)
    assert ledger.write_batch({"t": frame(spark, 9, 10)}, root, "another", 1)
    assert ids(spark, root) == [0, 1, 2, 3, 4, 9] and ids(spark, root, "u") == [0, 1, 5, 6]


def test_replaced_and_failed_files_are_removed(spark, tmp_path):
    root = str(tmp_path)
    for batch in range(3):
        ledger.write_batch({"t": frame(spark, batch, batch + 1)}, root, "q", batch)
    ledger.write_folder(frame(spark, 50, 60), root, "t", ["_event_date"])  # never committed
    ledger.compact_ledger_table(spark, root, "t")

    def left():
        return unreferenced_files(spark, [f"{root}/data"], ledger.live_folders(spark, root), hours=0.0)

    assert unreferenced_files(spark, [f"{root}/data"], ledger.live_folders(spark, root)).count() == 0  # all are young
    dry = remove_unreferenced(spark, left())
    assert len(dry.folders) == 4 and dry.files >= 4 and left().count() == dry.files
    remove_unreferenced(spark, left(), dry_run=False)
    assert left().count() == 0 and ids(spark, root) == [0, 1, 2]


def test_a_reader_keeps_what_it_has_planned_with(spark, tmp_path):
    root = str(tmp_path)
    for batch in range(2):
        ledger.write_batch({"t": frame(spark, batch, batch + 1)}, root, "q", batch)
    before = ledger.read_ledger_table(spark, root, "t")
    ledger.write_batch({"t": frame(spark, 7, 8)}, root, "q", 2)
    ledger.compact_ledger_table(spark, root, "t")
    assert before.count() == 2 and ids(spark, root) == [0, 1, 7]


def test_tables_grow_and_refuse_other_types(spark, tmp_path):
    root = str(tmp_path)
    first = frame(spark, 0, 1).selectExpr("id", "named_struct('a', id) as s", "_event_date")
    second = frame(spark, 1, 2).selectExpr("id", "named_struct('b', id) as s", "id as late", "_event_date")
    ledger.write_batch({"t": first}, root, "q", 0)
    ledger.write_batch({"t": second}, root, "q", 1)
    with pytest.raises(ValueError, match="late"):
        ledger.write_batch({"t": frame(spark, 2, 3).selectExpr("id", "'text' as late", "_event_date")}, root, "q", 2)
    expected = [(0, 0, None, None), (1, None, 1, 1)]
    for _ in range(2):
        assert rows(ledger.read_ledger_table(spark, root, "t").select("id", "s.a", "s.b", "late")) == expected
        ledger.compact_ledger_table(spark, root, "t")


def test_days_are_chosen_by_type_and_odd_values_survive(spark, tmp_path):
    root = str(tmp_path)
    data = spark.range(30).selectExpr("id", "if(id % 5 = 4, null, cast(id % 5 + 8 as int)) as part", "if(id % 2 = 0, 'a/b', \"it's\") as kind")
    for batch in range(2):
        ledger.write_batch({"t": data}, root, "q", batch, ["part", "kind"])
    before = rows(ledger.read_ledger_table(spark, root, "t"))
    assert len(before) == 60
    assert ledger.compact_ledger_table(spark, root, "t", ["part", "kind"], where="part < '10'") == 4
    assert rows(ledger.read_ledger_table(spark, root, "t")) == before
    with pytest.raises(Exception, match="id"):
        ledger.compact_ledger_table(spark, root, "t", ["part", "kind"], where="id < 3")
    assert ledger.compact_ledger_table(spark, root, "t", ["part", "kind"]) == 6
    assert rows(ledger.read_ledger_table(spark, root, "t")) == before


def test_no_partitions_no_rows_and_no_table(spark, tmp_path):
    root = str(tmp_path)
    with pytest.raises(ValueError, match="names no table"):
        ledger.read_ledger_table(spark, root, "t")
    ledger.write_batch({"t": spark.range(0)}, root, "q", 0, [])
    assert ids(spark, root) == []
    for batch in (1, 2):
        ledger.write_batch({"t": spark.range(batch)}, root, "q", batch, [])
    assert ledger.compact_ledger_table(spark, root, "t", []) == 1 and ids(spark, root) == [0, 0, 1]


def test_commits_side_by_side_are_all_there(spark, tmp_path):
    root, names = str(tmp_path), [f"t{at}" for at in range(8)]
    for batch in range(2):
        ledger.write_batch({name: frame(spark, batch, batch + 1) for name in names}, root, "q", batch)
    in_parallel(spark, [partial(ledger.compact_ledger_table, spark, root, name) for name in names], 8)
    assert [partitions(spark, root, name) for name in names] == [1] * 8
    entries = [[ledger._entry(name, ledger.ADD, "f", "p", 1)] for name in names for _ in range(3)]
    in_parallel(spark, [partial(ledger.commit, spark, root, entry) for entry in entries], 8)
    assert ledger.ledger_entries(spark, root).where("folder = 'f'").count() == len(entries)


def test_a_batch_is_there_before_its_writes_begin(spark, tmp_path):
    filled = []

    def tables(events):
        if not events.isStreaming:
            held = spark.sparkContext._jsc.sc().getRDDStorageInfo()
            filled.append(any(info.numCachedPartitions() == info.numPartitions() for info in held))
        return {"t": events}

    frame(spark, 0, 10).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("id long, _event_date date").parquet(str(tmp_path / "in"))
    ledger.ledger_fan_out(stream, tables, str(tmp_path / "t"), "fill", checkpoint_root=str(tmp_path / "c")).awaitTermination()
    spark.sql("create database if not exists unit_fill")
    fan_out(stream, tables, "unit_fill", "fill2", checkpoint_root=str(tmp_path / "c"), path=str(tmp_path / "u")).awaitTermination()
    assert filled == [True, True]


def test_a_stream_resumes_after_a_batch_that_failed_in_one_table(spark, tmp_path):
    root = str(tmp_path / "tables")
    armed = {"broken": False}

    def tables(events):
        odd = events.where("id % 2 = 1")
        return {"all": events, "odd": odd.withColumn("id", F.raise_error(F.lit("lost")).cast("long")) if armed["broken"] else odd}

    def run():
        stream = spark.readStream.schema("id long, _event_date date").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
        ledger.ledger_fan_out(stream, tables, root, "led", checkpoint_root=str(tmp_path / "check")).awaitTermination()

    frame(spark, 0, 10).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    run()
    frame(spark, 10, 20).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    armed["broken"] = True
    with pytest.raises(Exception, match="lost"):
        run()
    assert ids(spark, root, "all") == list(range(10))
    ledger.compact_ledger_table(spark, root, "all")
    armed["broken"] = False
    run()
    assert ids(spark, root, "all") == list(range(20)) and ids(spark, root, "odd") == list(range(1, 20, 2))
