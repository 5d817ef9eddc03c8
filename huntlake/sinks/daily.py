"""Folders of daily results: each day is made once from its own rows, and made anew only on demand."""

from __future__ import annotations

import datetime
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from huntlake.functions.names import field
from huntlake.sinks.cleanup import path_exists


def days_of(df: DataFrame, day: str) -> list[datetime.date]:
    """The distinct days of a frame; one value a day reaches the driver. A NULL day is left out."""
    found = df.select(field(day).alias("day")).where("day is not null").distinct()
    return sorted(row["day"] for row in found.collect())


def stored_days(spark: SparkSession, path: str, day: str) -> list[datetime.date]:
    """The days that a folder of daily results holds; none where there is no folder yet."""
    return days_of(spark.read.parquet(path), day) if path_exists(spark, path) else []


def update_days(
    source: DataFrame,
    path: str,
    day: str,
    make: Callable[[DataFrame], DataFrame],
    days: Iterable[datetime.date] | None = None,
) -> list[datetime.date]:
    """Write ``make`` of the rows of some days as the partitions of these days, and return the days.

    Without ``days`` these are the days of ``source`` that the folder lacks;
    finding them reads the one column, which costs no data where it partitions
    ``source``. With ``days`` just these are made, and replaced where they are there.
    The filter on the day reaches the scan, so other days are not read. A day
    is replaced whole: a call that is repeated after a failure leaves its rows
    once. A day for which ``make`` gives no row is not stored. The column must be a date
    and a column of what ``make`` returns.
    """
    spark = source.sparkSession
    if source.schema[day].dataType.typeName() != "date":
        raise ValueError(f"{day} must be a date")
    if days is None:
        held = set(stored_days(spark, path, day))
        days = [one for one in days_of(source, day) if one not in held]
    days = sorted(set(days))
    if days:
        made = make(source.where(field(day).isin(days)))
        made.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(day).parquet(path)
    return days


def between(stored: DataFrame, day: str, since: datetime.date | None, until: datetime.date | None) -> DataFrame:
    """The rows of the days from ``since`` to ``until``, both included; an open end has no bound."""
    for bound, keep in ((since, F.col(day) >= F.lit(since)), (until, F.col(day) <= F.lit(until))):
        if bound is not None:
            stored = stored.where(keep)
    return stored
