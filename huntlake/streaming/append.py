"""Streaming append to tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from huntlake.functions.names import field
from huntlake.sinks.growth import grow_table
from huntlake.sinks.shared import shared_folder
from huntlake.sinks.tables import check_tier

AVAILABLE_NOW = {"availableNow": True}


def checkpoint_path(df: DataFrame, name: str, root: str | None = None) -> str:
    """Checkpoint of the stream that feeds ``name``; each sink has its own."""
    return f"{(root or shared_folder(df.sparkSession)).rstrip('/')}/streams/{name}"


def stream_to_table(
    df: DataFrame,
    name: str,
    tier: str,
    partition_by: Sequence[str] = (),
    checkpoint_root: str | None = None,
    fmt: str = "parquet",
    path: str | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Start a stream that appends ``df`` to a table and return the running query.

    The default trigger processes what is there, in as many batches as the source
    options ask for, and stops; ``{"processingTime": "1 minute"}`` keeps running.
    A restart resumes from the checkpoint, so nothing is read twice. The table
    takes up new columns and fields of ``df`` when the stream starts.
    """
    check_tier(tier)
    if fmt != "delta" and df.sparkSession.catalog.tableExists(name):
        # partition columns never grow, and Spark guesses their types from the folder names of a stream's files
        grow_table(df.sparkSession, name, df.drop(*map(field, partition_by)).schema)
    writer = (
        df.writeStream.format(fmt)
        .outputMode("append")
        .queryName(name)
        .option("checkpointLocation", checkpoint_path(df, name, checkpoint_root))
        .trigger(**(trigger or AVAILABLE_NOW))
    )
    if fmt == "delta":
        writer = writer.option("mergeSchema", "true")
    if path:
        writer = writer.option("path", path)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return writer.toTable(name)


def stream_tables(
    frames: dict[str, DataFrame],
    namespace: str,
    tier: str,
    partition_by: Sequence[str] = (),
    checkpoint_root: str | None = None,
    fmt: str = "parquet",
    path: str | None = None,
    trigger: dict | None = None,
) -> list[StreamingQuery]:
    """Start one stream per frame, each appending to the table of its name.

    Meant for frames over a bronze table: every stream reads its own columns of
    the new files, and commits exactly once on its own. A source that should be
    read once only, such as a topic, is for ``fan_out``.
    """
    return [
        stream_to_table(
            frame,
            f"{namespace}.{name}",
            tier,
            partition_by,
            checkpoint_root,
            fmt,
            f"{path}/{name}" if path else None,
            trigger,
        )
        for name, frame in frames.items()
    ]
