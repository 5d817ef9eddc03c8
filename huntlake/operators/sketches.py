"""Issuers counted by mergeable sketches: a state for each day and issuer, united over any span of days.

The exact counts (``hunts.issuer_counts``) read all certificates every time. A
state of a day is made once; a new day reads its own certificates only, and a
span of days reads states only. A state is at most ``2 ** SIZE`` bytes and a
few, however many values it has seen, so a large issuer costs no more than that.
"""

from __future__ import annotations

import datetime
import math
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from huntlake.functions.names import field
from huntlake.operators.hunts import ISSUER_SETS
from huntlake.sinks.daily import between, update_days

#: Logarithm of the registers of a state.
SIZE = 12


def relative_error(size: int = SIZE) -> float:
    """The standard error of an estimate, as a share of the true number; few values are counted nearly exactly."""
    return 1.04 / math.sqrt(1 << size)


def issuer_states(certs: DataFrame, day: str, size: int = SIZE) -> DataFrame:
    """One row per day and issuer: a state of each of the six fields, and the certificates.

    NULL is no value, the empty text is one. Rows without a day or an issuer are left out. Rows are reduced to
    states in their tasks, so what is shuffled is one state for each task, day
    and issuer, and a hot issuer is no hot task.
    """
    named = certs.where(field(day).isNotNull() & F.col("issuer").isNotNull())
    # sketches ignore an empty text, so every text gets a first letter
    states = [F.hll_sketch_agg(F.concat(F.lit("="), F.col(name)), size).alias(name) for name in ISSUER_SETS]
    return named.groupBy(field(day).alias(day), "issuer").agg(*states, F.count(F.lit(1)).alias("certificates"))


def merged_states(states: DataFrame, *keys: str | Column) -> DataFrame:
    """States united by ``keys``, such as the issuer and the month of the day. The result can be merged again."""
    united = [F.hll_union_agg(name).alias(name) for name in ISSUER_SETS]
    return states.groupBy(*keys).agg(*united, F.sum("certificates").alias("certificates"))


def estimated_counts(states: DataFrame, *keys: str | Column) -> DataFrame:
    """One row per issuer (or per ``keys``): about how many distinct values each of the six fields has; certificates exactly."""
    merged = merged_states(states, *(keys or ("issuer",)))
    rest = [name for name in merged.columns if name not in ISSUER_SETS]
    return merged.select(
        *[field(name) for name in rest if name != "certificates"],
        *[F.hll_sketch_estimate(name).alias(name) for name in ISSUER_SETS],
        "certificates",
    )


def update_issuer_states(
    certs: DataFrame, path: str, day: str, days: Iterable[datetime.date] | None = None, size: int = SIZE
) -> list[datetime.date]:
    """Make the states of the days that the folder lacks, or of ``days`` anew, and return the days (see ``update_days``)."""
    return update_days(certs, path, day, lambda rows: issuer_states(rows, day, size), days)


def read_issuer_states(
    spark: SparkSession, path: str, day: str, since: datetime.date | None = None, until: datetime.date | None = None
) -> DataFrame:
    """The stored states of a span of days, both ends included."""
    return between(spark.read.parquet(path), day, since, until)
