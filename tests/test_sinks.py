from __future__ import annotations

from types import SimpleNamespace

import pytest
from compare import rows
from pyspark import StorageLevel

from huntlake.operators.layout import optimize_table
from huntlake.sinks.shared import fresh_folder, in_parallel, shared, shared_folder
from huntlake.sinks.tables import (
    append_files,
    append_table,
    batch_writer,
    create_namespace,
    list_partitions,
    read_files,
    set_statistics_width,
)


@pytest.fixture
def table(spark, tmp_path):
    spark.sql("drop table if exists unit.sink")
    return "unit.sink", str(tmp_path / "sink")


def test_batch_writer_modes_and_partitions(spark, table):
    name, path = table
    frame = spark.range(4).selectExpr("id", "id % 2 as p")
    for _ in range(2):
        batch_writer(frame, ["p"], "overwrite").option("path", path).saveAsTable(name)
    assert spark.table(name).count() == 4
    batch_writer(frame, ["p"]).saveAsTable(name)
    assert spark.table(name).count() == 8
    assert [r["partition"] for r in list_partitions(spark, name).collect()] == ["p=0", "p=1"]


def test_tier_is_checked(spark, table):
    with pytest.raises(ValueError, match="tier"):
        append_table(spark.range(1), table[0], "platinum")


def test_new_and_absent_columns(spark, table):
    name, path = table
    append_table(spark.sql("select 1 as id, 'a' as `x:y`, 'p' as day"), name, "silver", ["day"], path=path)
    append_table(spark.sql("select 'q' as day, named_struct('@t', 1) as s, 2 as id"), name, "silver", ["day"])
    append_table(spark.sql("select 3 as id, 'r' as day"), name, "silver", ["day"])
    found = spark.table(name).selectExpr("id", "`x:y`", "s.`@t`", "day")
    assert rows(found) == [(1, "a", None, "p"), (2, None, 1, "q"), (3, None, None, "r")]


def test_type_change_raises_and_changes_nothing(spark, table):
    name, path = table
    append_table(spark.sql("select 1 as id"), name, "silver", path=path)
    with pytest.raises(ValueError, match="id"):
        append_table(spark.sql("select 'x' as id, 1 as other"), name, "silver")
    assert spark.table(name).columns == ["id"]


def test_columns_are_matched_as_spark_matches_names(spark, table):
    name, path = table
    append_table(spark.sql("select 1 as Id, 'a' as v"), name, "silver", path=path)
    append_table(spark.sql("select 'b' as V, 2 as id"), name, "silver")
    assert rows(spark.table(name)) == [(1, "a"), (2, "b")]


def test_nullability_is_no_type_change(spark, table):
    name, path = table
    append_table(spark.sql("select array('a') as l"), name, "silver", path=path)
    append_table(spark.sql("select array('b', null) as l"), name, "silver")
    assert spark.table(name).count() == 2


def test_nested_growth_in_files(spark, tmp_path):
    path = str(tmp_path / "files")
    append_files(spark.sql("select named_struct('a', 1) as s"), path)
    append_files(spark.sql("select named_struct('b', 'x') as s, 7 as n"), path)
    assert rows(read_files(spark, path).selectExpr("s.a", "s.b", "n")) == [(None, "x", 7), (1, None, None)]


def test_nested_growth_of_a_table(spark, table):
    name, path = table
    append_table(spark.sql("select 1 as id, named_struct('a', 1, 'l', array(named_struct('x', 1))) as s"), name, "bronze", path=path)
    append_table(spark.sql("select 2 as id, named_struct('A', 2, 'b', 'n') as s, 'new' as t"), name, "bronze")
    append_table(spark.sql("select 3 as id, named_struct('l', array(named_struct('y', 7), null)) as s"), name, "bronze")
    append_table(spark.sql("select 4 as id, cast(null as struct<c: int>) as s"), name, "bronze")
    found = spark.table(name).selectExpr("id", "s.a", "s.b", "s.l.x", "s.l.y", "s.c", "s is null", "t")
    assert rows(found) == [
        (1, 1, None, [1], [None], None, False, None),
        (2, 2, "n", None, None, None, False, "new"),
        (3, None, None, [None, None], [7, None], None, False, None),
        (4, None, None, None, None, None, True, None),
    ]


def test_nested_growth_keeps_moved_partitions_and_properties(spark, table):
    name, path = table
    first = spark.sql("select id, named_struct('a', id) as s, 'd/' || id % 2 as day from range(6) union all select 9, null, null")
    append_table(first, name, "bronze", ["day"], path=path)
    spark.sql(f"alter table {name} set tblproperties ('owner team' = 'x''y')")
    optimize_table(spark, name, ["id"], where="day = 'd/1'")
    append_table(spark.sql("select 7L as id, named_struct('b', 'n') as s, 'd/1' as day"), name, "bronze", ["day"])
    found = rows(spark.table(name).selectExpr("id", "s.a", "s.b", "day"))
    assert found == rows(spark.sql(
        "select id, id as a, cast(null as string) as b, 'd/' || id % 2 as day from range(6)"
        " union all select 9, null, null, null union all select 7, null, 'n', 'd/1'"
    ))
    assert ("owner team", "x'y") in rows(spark.sql(f"show tblproperties {name}"))
    assert not spark.catalog.tableExists(f"{name}__grown")


def test_nested_growth_of_a_table_without_a_path_keeps_its_rows(spark):
    spark.sql("drop table if exists unit.managed")
    append_table(spark.sql("select named_struct('a', 1) as s"), "unit.managed", "bronze")
    append_table(spark.sql("select named_struct('a', 2, 'b', 3) as s"), "unit.managed", "bronze")
    with pytest.raises(ValueError, match="s.a has another type"):
        append_table(spark.sql("select named_struct('a', 'x') as s"), "unit.managed", "bronze")
    assert rows(spark.table("unit.managed").select("s.a", "s.b")) == [(1, None), (2, 3)]


def test_balanced_write_has_few_files(spark, tmp_path):
    frame = spark.range(0, 1000, 1, 8).selectExpr("id", "id % 5 as p")
    for label, balanced in (("plain", False), ("balanced", True)):
        name = f"unit.{label}"
        spark.sql(f"drop table if exists {name}")
        append_table(frame, name, "silver", ["p"], path=str(tmp_path / label), balanced=balanced)
        assert spark.table(name).count() == 1000
    count = {label: len(list((tmp_path / label).glob("*/*.parquet"))) for label in ("plain", "balanced")}
    assert count == {"plain": 40, "balanced": 5}


def test_balanced_write_splits_a_hot_partition(spark, settings, tmp_path):
    settings(spark__sql__adaptive__advisoryPartitionSizeInBytes="64KB")
    frame = spark.range(0, 60_000, 1, 8).selectExpr(
        "sha1(cast(id as string)) as k", "if(id % 3 = 0, 'hot', 'd' || id % 9) as p"
    )
    spark.sql("drop table if exists unit.hot")
    append_table(frame, "unit.hot", "silver", ["p"], path=str(tmp_path / "hot"), balanced=True)
    assert len(list((tmp_path / "hot" / "p=hot").glob("*.parquet"))) > 3
    assert spark.table("unit.hot").count() == 60_000


def test_shared_is_released_also_after_an_error(spark):
    frame = spark.range(5)
    with pytest.raises(RuntimeError), shared(frame) as held:
        assert held.storageLevel != StorageLevel.NONE
        raise RuntimeError
    assert not frame.storageLevel.useMemory


def test_in_parallel_runs_all_and_raises(spark):
    done = []

    def fail():
        raise RuntimeError("write failed")

    with pytest.raises(RuntimeError, match="write failed"):
        in_parallel(spark, [fail, lambda: done.append(spark.range(3).count())], 2)
    assert done == [3]


def session_like(master: str, **conf: str):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default=None: conf.get(key.replace(".", "_"), default)),
        sparkContext=SimpleNamespace(master=master),
    )


def test_shared_folder_is_the_one_the_session_names():
    cluster = session_like("yarn", spark_checkpoint_dir="hdfs:///check/")
    assert shared_folder(cluster) == "hdfs:///check"
    assert fresh_folder(cluster, "x") != fresh_folder(cluster, "x")


def test_shared_folder_without_setting():
    for master in ("local[2]", "local-cluster[2,1,1024]", "yarn"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            shared_folder(session_like(master))
    first, second = (fresh_folder(session_like("local[2]"), "x") for _ in range(2))
    assert first != second and first.rpartition("/")[0] == second.rpartition("/")[0]
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        fresh_folder(session_like("yarn"), "x")


def test_namespace_and_use(spark):
    before = spark.catalog.currentDatabase()
    create_namespace(spark, "unit_ns", use=True)
    assert spark.catalog.currentDatabase() == "unit_ns"
    spark.sql(f"use {before}")


def test_statistics_width(spark):
    set_statistics_width(spark)
    assert spark.conf.get("delta.dataSkippingNumIndexedCols") == "5"
