"""Ingest metadata and promoted event fields."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from huntlake.functions.names import field


def add_batch_metadata(df: DataFrame, datasource: str) -> DataFrame:
    """Lead with the data source and ingest time, end with the ingest date."""
    return df.select(
        F.lit(datasource).alias("datasource"),
        F.current_timestamp().alias("ingest_time"),
        "*",
        F.current_date().alias("p_ingest_date"),
    )


def add_ingest_time(df: DataFrame) -> DataFrame:
    """Lead with the ingest time."""
    return df.select(F.current_timestamp().alias("_ingest_time"), "*")


def promote_event_fields(df: DataFrame) -> DataFrame:
    """Lead with the four event fields that bronze is laid out and filtered by.

    The date is cut from the text of the timestamp, so it is the UTC date in any
    session time zone. Text that is no date gives NULL.
    """
    return df.select(
        field("winlog", "channel").alias("_sourcetype"),
        field("@timestamp").alias("_event_time"),
        field("@timestamp").try_cast("date").alias("_event_date"),
        field("agent", "hostname").alias("dvc_hostname"),
        "*",
    )
