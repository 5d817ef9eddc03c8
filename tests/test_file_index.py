from __future__ import annotations

import datetime

import pytest
from compare import rows
from pyspark.sql import functions as F

from huntlake.operators.file_index import bloom_index, holding, in_range, overlap_depth, zone_map
from huntlake.operators.layout import zorder
from huntlake.sinks.tables import append_table


def files_read(df) -> int:
    """Files that the scan of ``df`` opened."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    plan = plan.executedPlan() if "AdaptiveSparkPlan" in plan.nodeName() else plan
    return max(leaf_files(plan))


def leaf_files(plan):
    if plan.nodeName().startswith("Scan parquet"):
        return [plan.metrics().get("numFiles").get().value()]
    below = [plan.plan()] if "QueryStage" in plan.nodeName() else []
    children = plan.children()
    below += [children.apply(at) for at in range(children.size())]
    return [count for child in below for count in leaf_files(child)] or [0]


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """3,000 rows in one folder a kind, of odd names, with NULLs, NaN and names that clash with those of the index."""
    path = str(tmp_path_factory.mktemp("indexed") / "table")
    data = spark.range(3000).selectExpr(
        "cast(id as int) as n",
        "case when id % 50 = 0 then null when id % 77 = 0 then cast('NaN' as double) else id / 7 end as file",
        "case when id < 1000 then null else concat('u', id) end as `a.b`",
        "date_add(date'2024-01-01', cast(id div 100 as int)) as day",
        "array(id) as words",
        "element_at(array('a b', 'x:y', '50%', 'é', null), cast(id % 5 + 1 as int)) as kind",
    )
    zorder(data, ["n"], files=10).write.partitionBy("kind").parquet(path)
    return spark.read.parquet(path)


@pytest.mark.parametrize(
    "ranges, sql",
    [
        ({"n": (100, 120)}, "n between 100 and 120"),
        ({"n": ("9", 10)}, "n between 9 and 10"),
        ({"n": (2990, None), "kind": ("x:y", "x:y")}, "n >= 2990 and kind = 'x:y'"),
        ({"file": (1.0, 2.0)}, "file between 1 and 2"),
        ({"file": (428.0, None)}, "file >= 428"),
        ({"a.b": (None, "u1001")}, "`a.b` <= 'u1001'"),
        ({"day": ("2024-01-03", datetime.date(2024, 1, 3))}, "day = '2024-01-03'"),
        ({"n": (None, None)}, "n is not null"),
        ({"n": (5000, None)}, "false"),
        ({}, "true"),
    ],
)
def test_ranges_give_the_rows_of_a_filter(stored, ranges, sql):
    zones = zone_map(stored)
    assert str(rows(in_range(stored, zones, ranges))) == str(rows(stored.where(sql)))  # as texts: NaN is not NaN


def test_files_out_of_range_are_not_opened(stored):
    zones = zone_map(stored, ["n"])
    total = zones.count()
    assert total == len(stored.inputFiles()) and zones.agg(F.sum("rows")).first()[0] == 3000
    assert 0 < files_read(in_range(stored, zones, {"n": (100, 104)})) <= total // 4
    assert files_read(in_range(stored, zones, {"n": (None, 104), "file": (1.0, 2.0)})) <= total // 4
    assert files_read(in_range(stored, zones, {"file": (1.0, 2.0)})) == total


def test_a_zone_map_covers_the_first_columns(stored):
    assert zone_map(stored, first=2).schema["zones"].dataType.names == ["n", "file"]
    assert zone_map(stored).schema["zones"].dataType.names == ["n", "file", "a.b", "day", "kind"]
    first = zone_map(stored).where("zones.`a.b`.low is null").agg(F.max("zones.n.high"), F.min("zones.`a.b`.nulls")).first()
    assert first[0] < 1000 and first[1] > 0


@pytest.mark.parametrize("column, values", [("a.b", ["u1500", "u7", "none", None]), ("n", [3, 2999, 10**6]), ("kind", ["50%", "é"]), ("n", [])])
def test_indicators_give_the_rows_of_a_filter(stored, column, values):
    index = bloom_index(stored, ["a.b", "n", "kind"])
    expected = stored.where(F.col(f"`{column}`").isin([value for value in values if value is not None]))
    assert str(rows(holding(stored, index, column, values))) == str(rows(expected))


def test_files_without_an_indicator_are_not_opened(spark, stored):
    index = bloom_index(stored, ["a.b"]).cache()
    known = index.select("file").distinct().count()
    wanted = spark.createDataFrame([("u1500",), ("u1500",), ("u2000",)], "words string")
    found = holding(stored, index, "a.b", wanted)
    assert found.count() == 2
    unknown = len(stored.inputFiles()) - known  # they hold NULL only, and are read since the index does not know them
    assert files_read(found) <= unknown + 2 + known // 10
    assert index.agg(F.max("words")).first()[0] == 64


def test_few_files_match_by_chance(spark, tmp_path):
    data = spark.range(200_000).selectExpr("concat('v', id) as v", "id % 20 as part")
    data.repartition(20, "part").write.partitionBy("part").parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    index = bloom_index(table, ["v"]).cache()
    strange = [f"strange{i}" for i in range(5)]
    assert files_read(holding(table, index, "v", strange)) <= 6
    assert index.where("words < 64 or word >= words").count() == 0


def test_files_that_an_index_does_not_know_are_read(spark, tmp_path):
    path = str(tmp_path / "grown")
    spark.range(100).selectExpr("id").write.parquet(path)
    old = spark.read.parquet(path)
    zones, index = zone_map(old).cache(), bloom_index(old, ["id"]).cache()
    zones.count(), index.count()
    spark.range(50, 150).selectExpr("id").write.mode("append").parquet(path)
    new = spark.read.parquet(path)
    assert in_range(new, zones, {"id": (140, None)}).count() == 10
    assert in_range(new, zones, {"id": (60, 60)}).count() == holding(new, index, "id", [60]).count() == 2
    assert holding(new, index, "id", [149]).count() == 1


def test_an_empty_table_has_an_empty_index(spark, tmp_path):
    spark.range(0).write.parquet(str(tmp_path / "none"))
    table = spark.read.parquet(str(tmp_path / "none"))
    assert zone_map(table).count() == bloom_index(table, ["id"]).count() == 0
    assert in_range(table, zone_map(table), {"id": (1, 2)}).count() == holding(table, bloom_index(table, ["id"]), "id", [1]).count() == 0


def test_depth_counts_files_that_overlap(spark, tmp_path):
    zones = spark.createDataFrame(
        [("d/p=1/a", (1, 5)), ("d/p=1/b", (5, 9)), ("d/p=1/c", (6, 7)), ("d/p=2/a", (1, 2)), ("d/p=2/b", (3, 4)), ("d/p=3/a", (None, None))],
        "file string, v struct<low int, high int>",
    ).select("file", F.struct("v").alias("zones"))
    got = {row["folder"]: (row["files"], row["depth"]) for row in overlap_depth(zones, ["v"]).collect()}
    assert got == {"d/p=1": (3, 2), "d/p=2": (2, 1), "d/p=3": (1, 0)}
