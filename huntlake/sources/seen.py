"""Bounded ingest that can be repeated: high-water marks of a table, and the messages beyond them.

A bronze table with message coordinates (``_topic``, ``_partition``,
``_offset``) tells itself how far it has come. The next bounded read starts
there, and messages that are read again are left out.
"""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: stands for the first offset that a topic partition still has.
EARLIEST = -2


def high_water(table: DataFrame) -> DataFrame:
    """(topic, partition, mark): the last offset of each topic partition in a bronze table with coordinates."""
    held = table.where("_offset is not null").groupBy(F.col("_topic").alias("topic"), F.col("_partition").alias("partition"))
    return held.agg(F.max("_offset").alias("mark"))


def next_offsets(table: DataFrame, partitions: Mapping[str, int]) -> str:
    """``startingOffsets`` of the next bounded read, for topics with the given numbers of partitions.

    A topic partition without rows starts at its earliest offset. The driver
    holds one number for each topic partition.
    """
    marks = {(row["topic"], row["partition"]): row["mark"] for row in high_water(table).collect()}
    starts = {
        topic: {str(number): marks[topic, number] + 1 if (topic, number) in marks else EARLIEST for number in range(count)}
        for topic, count in partitions.items()
    }
    return json.dumps(starts)


def unseen(messages: DataFrame, table: DataFrame) -> DataFrame:
    """The messages (topic, partition, offset, ..) that are not in a bronze table with coordinates.

    Those beyond the mark of their topic partition are new without a look at the
    table. Only the others, which a repeated or overlapping read brings, are
    looked up by their coordinates, so a gap that an earlier read left is filled.
    """
    marks = F.broadcast(high_water(table))  # a row for each topic partition
    marked = messages.join(marks, ["topic", "partition"], "left")
    beyond = F.col("mark").isNull() | (F.col("offset") > F.col("mark"))
    seen = table.where("_offset is not null").select(
        F.col("_topic").alias("topic"), F.col("_partition").alias("partition"), F.col("_offset").alias("offset")
    )
    again = marked.where(~beyond).join(seen, ["topic", "partition", "offset"], "left_anti")
    return marked.where(beyond).select(messages.columns).union(again.select(messages.columns))
