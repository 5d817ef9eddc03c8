from __future__ import annotations

import datetime
from pathlib import Path

import pytest
from compare import rows

from huntlake.operators import hunts, sketches
from huntlake.sinks.shared import fresh_folder

SCHEMA = "day date, issuer string, " + ", ".join(f"{name} string" for name in hunts.ISSUER_SETS)
DAY = [datetime.date(2024, 1, number) for number in range(1, 9)]


def certs(spark, found):
    return spark.createDataFrame([(day, issuer, *([value] * 6)) for day, issuer, value in found], SCHEMA)


def many(spark, size):
    """A hot issuer with ``size`` subjects over eight days, repeated, and small ones beside it."""
    return spark.range(2 * size).selectExpr(
        "date_add(date'2024-01-01', cast(id % 8 as int)) as day",
        "if(id % 3 = 0, concat('i', id % 50), 'hot') as issuer",
        *[f"cast(id % {size} as string) as {name}" for name in hunts.ISSUER_SETS],
    )


def test_estimates_are_within_their_error_of_the_exact_counts(spark):
    all_rows = many(spark, 60_000)
    near = {row["issuer"]: row for row in sketches.estimated_counts(sketches.issuer_states(all_rows, "day")).collect()}
    exact = hunts.issuer_counts(all_rows).collect()
    assert len(near) == len(exact) == 51
    for row in exact:
        for name in hunts.ISSUER_SETS:
            assert abs(near[row["issuer"]][name] - row[name]) <= 4 * sketches.relative_error() * row[name] + 1


def test_nulls_empty_texts_repeats_and_empty_tables(spark):
    found = [(DAY[0], "a", ""), (DAY[0], "a", ""), (DAY[1], "a", "x"), (DAY[1], "a", None), (DAY[1], "", None)]
    found += [(None, "a", "lost"), (DAY[0], None, "lost")]
    states = sketches.issuer_states(certs(spark, found), "day")
    assert rows(sketches.estimated_counts(states)) == [("", 0, 0, 0, 0, 0, 0, 1), ("a", 2, 2, 2, 2, 2, 2, 4)]
    assert rows(sketches.estimated_counts(sketches.issuer_states(certs(spark, []), "day"))) == []


def test_merging_in_steps_gives_the_same_estimates(spark):
    states = sketches.issuer_states(many(spark, 5_000), "day")
    halves = sketches.merged_states(states.selectExpr("*", "day > date'2024-01-04' as late"), "late", "issuer")
    assert rows(sketches.estimated_counts(halves)) == rows(sketches.estimated_counts(states))


def test_only_new_days_are_read_and_days_are_replaced_whole(spark):
    source, path = fresh_folder(spark, "certs"), fresh_folder(spark, "states")
    many(spark, 1_000).where("day < date'2024-01-05'").write.partitionBy("day").parquet(source)
    assert sketches.update_issuer_states(spark.read.parquet(source), path, "day") == DAY[:4]
    assert sketches.update_issuer_states(spark.read.parquet(source), path, "day") == []
    many(spark, 1_000).where("day = date'2024-01-05'").write.mode("append").partitionBy("day").parquet(source)
    later = spark.read.parquet(source)
    for file in Path(source, "day=2024-01-02").glob("*.parquet"):
        file.write_bytes(b"no longer readable")
    assert sketches.update_issuer_states(later, path, "day", [DAY[4]]) == [DAY[4]]
    assert sketches.update_issuer_states(later, path, "day", [DAY[4]]) == [DAY[4]]
    got = sketches.estimated_counts(sketches.read_issuer_states(spark, path, "day"))
    whole = sketches.estimated_counts(sketches.issuer_states(many(spark, 1_000).where("day < date'2024-01-06'"), "day"))
    assert rows(got) == rows(whole)
    some = sketches.read_issuer_states(spark, path, "day", DAY[1], DAY[2])
    assert {row["day"] for row in some.collect()} == set(DAY[1:3])


def test_a_day_must_be_a_date(spark):
    with pytest.raises(ValueError, match="must be a date"):
        sketches.update_issuer_states(many(spark, 10).selectExpr("* except (day)", "string(day) as day"), "x", "day")
