"""Windows event pipeline: messages to bronze, bronze to flat events, routes and the wide table."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from huntlake.functions.names import field
from huntlake.operators.cim import MISSING_TEXT, apply_rules
from huntlake.operators.ingest import add_ingest_time, promote_event_fields
from huntlake.operators.layout import bloom_options, optimize_table
from huntlake.operators.shape import flatten_events
from huntlake.plans.rules import EVENT_ID, ROUTES, SYSMON_CHANNEL, Route
from huntlake.sinks.shared import PARALLEL_WRITES, in_parallel, shared
from huntlake.sinks.tables import append_table
from huntlake.sources.payload import CORRUPT, RAW, decode_json, is_garbage, message_elements, message_text

BRONZE_PARTITIONS = ("_event_date", "_sourcetype")
WIDE_TABLE = "all_silver"
SILVER_PARTITIONS = ("_event_date",)
BLOOM_COLUMNS = {route.table: route.bloom_columns for route in ROUTES} | {WIDE_TABLE: ("_sourcetype",)}
CLUSTER_COLUMNS = {route.table: route.cluster_columns for route in ROUTES} | {WIDE_TABLE: ("event_id",)}


def bronze_events(
    messages: DataFrame,
    schema: StructType,
    keep_raw: bool = True,
    keep_coordinates: bool = False,
    corrupt: str = "keep",
) -> DataFrame:
    """Kafka-like messages (a ``value`` column) to bronze rows; nothing is lost by default.

    A message that is an array gives one row per element. A field of another
    type than ``schema`` is NULL and its event stays. With ``keep_raw`` the text
    of every message is kept, so that such fields, and fields outside
    ``schema``, can be read again. ``corrupt`` says what becomes of messages
    that are not JSON: ``keep`` leaves them as rows and adds the column
    ``_corrupt_record``, ``drop`` leaves them out (``quarantine`` gives them).
    Valid on batch and streaming frames.
    """
    if corrupt not in ("keep", "drop"):
        raise ValueError(f"corrupt must be 'keep' or 'drop', not {corrupt!r}; see ingested() for both kinds at once")
    decoded = decode_json(
        message_elements(message_text(messages)), schema, keep_raw=keep_raw, keep_coordinates=keep_coordinates
    )
    return _bronze(decoded, corrupt)


def _bronze(decoded: DataFrame, corrupt: str) -> DataFrame:
    if corrupt == "drop":
        decoded = decoded.filter(~is_garbage()).drop(CORRUPT)
    return promote_event_fields(add_ingest_time(decoded))


def quarantine(messages: DataFrame, schema: StructType) -> DataFrame:
    """The messages that are not JSON: their text and where in the topic they are."""
    decoded = decode_json(message_elements(message_text(messages)), schema, keep_raw=True, keep_coordinates=True)
    return _quarantined(decoded)


def _quarantined(decoded: DataFrame) -> DataFrame:
    return decoded.filter(is_garbage()).select("_topic", "_partition", "_offset", RAW)


@contextmanager
def ingested(messages: DataFrame, schema: StructType) -> Iterator[tuple[DataFrame, DataFrame]]:
    """Bronze rows and quarantined messages of one batch, from one read and one decode.

    Both frames are valid inside the ``with`` block, during which the decoded
    messages are kept; together they hold every message that is not empty.
    """
    decoded = decode_json(message_elements(message_text(messages)), schema, keep_raw=True, keep_coordinates=True)
    with shared(decoded) as kept:
        yield _bronze(kept, "drop"), _quarantined(kept)


def route_events(flat_events: DataFrame, route: Route) -> DataFrame:
    """The Sysmon events of one route, unchanged."""
    event_id = field(EVENT_ID)
    if isinstance(flat_events.schema[EVENT_ID].dataType, StringType):
        wanted = event_id.isin(*route.event_ids)
    else:
        wanted = event_id.isin(*map(int, route.event_ids))
    return flat_events.filter((F.col("_sourcetype") == SYSMON_CHANNEL) & wanted)


def route_table(flat_events: DataFrame, route: Route, missing: str | None = MISSING_TEXT) -> DataFrame:
    """The silver rows of one route: filter and two projections, no shuffle."""
    return apply_rules(route_events(flat_events, route), route.rules, missing)


def wide_table(flat_events: DataFrame) -> DataFrame:
    """All events, flat, with the event id under its model name."""
    return flat_events.withColumnRenamed(EVENT_ID, "event_id")


def silver_tables(bronze: DataFrame, routes: tuple[Route, ...] = ROUTES) -> dict[str, DataFrame]:
    """Every silver table of a bronze frame, by table name.

    Each one reads bronze on its own: with bronze in columnar files partitioned
    by event type, a route reads its partition and its own fields only, which
    costs less than caching the wide frame. For one-shot sources see
    ``huntlake.streaming.fanout``.
    """
    flat = flatten_events(bronze)
    return {route.table: route_table(flat, route) for route in routes} | {WIDE_TABLE: wide_table(flat)}


def append_silver(
    bronze: DataFrame,
    namespace: str,
    fmt: str = "parquet",
    path: str | None = None,
    balanced: bool = False,
    bloom: bool = False,
    at_once: int = PARALLEL_WRITES,
) -> list[str]:
    """Append the silver tables of a bronze frame in batch; returns the table names.

    ``balanced`` gathers the rows of a day before the write, and ``bloom`` adds
    the bloom filters of each table to Parquet files.
    """
    writes = [
        partial(
            append_table,
            frame,
            f"{namespace}.{table}",
            "silver",
            SILVER_PARTITIONS,
            fmt,
            path=f"{path}/{table}" if path else None,
            balanced=balanced,
            options=bloom_options(BLOOM_COLUMNS[table]) if bloom else None,
        )
        for table, frame in silver_tables(bronze).items()
    ]
    in_parallel(bronze.sparkSession, writes, at_once)
    return [f"{namespace}.{table}" for table in BLOOM_COLUMNS]


def optimize_silver(
    spark: SparkSession, namespace: str, where: str | None = None, at_once: int = PARALLEL_WRITES, depth: int | None = None
) -> None:
    """Compact and Z-order every silver table by its own columns, keeping its bloom filters.

    A job of its own, to be run between appends, usually with ``where`` naming
    the days that are complete, or with ``depth`` to leave out those whose files
    overlap little (see ``optimize_table``).
    """
    rewrites = [
        partial(
            optimize_table,
            spark,
            f"{namespace}.{table}",
            columns,
            where,
            options=bloom_options(BLOOM_COLUMNS[table]),
            depth=depth,
        )
        for table, columns in CLUSTER_COLUMNS.items()
    ]
    in_parallel(spark, rewrites, at_once)
