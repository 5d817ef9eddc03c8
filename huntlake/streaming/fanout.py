"""One stream feeding many tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from huntlake.sinks.growth import create_table, fit_to_table
from huntlake.sinks.shared import PARALLEL_WRITES, filled, in_parallel
from huntlake.streaming.append import AVAILABLE_NOW, checkpoint_path

BATCH = "_batch"
QUERY_ID_PROPERTY = "sql.streaming.queryId"


def fan_out(
    stream: DataFrame,
    tables: Callable[[DataFrame], dict[str, DataFrame]],
    namespace: str,
    label: str,
    partition_by: Sequence[str] = ("_event_date",),
    checkpoint_root: str | None = None,
    path: str | None = None,
    trigger: dict | None = None,
    at_once: int = PARALLEL_WRITES,
) -> StreamingQuery:
    """Start a stream that writes every frame of ``tables(stream)`` to its own table.

    A micro-batch is read and decoded once, before its writes, kept for the duration of its writes
    (``at_once`` at a time) and then released. Each write replaces the table partitions of its own batch
    (column ``_batch``), so a batch that is run again after a failure leaves its
    rows once in every table. A table takes up columns that it does not have
    yet, for instance after a restart with more of them. The first batch over a
    long backlog is as large as the source allows: bound it with the source's
    option for offsets or files per trigger. The price is one table partition per batch and
    day, so the trigger should be minutes rather than seconds, and long-lived
    tables are better fed from bronze by ``stream_tables``.
    """
    spark = stream.sparkSession
    for name, frame in tables(stream).items():
        schema = frame.withColumn(BATCH, F.lit("")).schema
        place = f"{path}/{name}" if path else None
        create_table(spark, f"{namespace}.{name}", schema, [*partition_by, BATCH], place)

    def write(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        session.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
        query_id = session.sparkContext.getLocalProperty(QUERY_ID_PROPERTY)

        def replace(name: str, frame: DataFrame) -> None:
            table = f"{namespace}.{name}"
            marked = frame.withColumn(BATCH, F.lit(f"{query_id}-{batch_id}"))
            fit_to_table(marked, table).write.insertInto(table, overwrite=True)

        with filled(batch) as events:
            in_parallel(session, (partial(replace, *item) for item in tables(events).items()), at_once)

    return (
        stream.writeStream.foreachBatch(write)
        .queryName(label)
        .option("checkpointLocation", checkpoint_path(stream, label, checkpoint_root))
        .trigger(**(trigger or AVAILABLE_NOW))
        .start()
    )
