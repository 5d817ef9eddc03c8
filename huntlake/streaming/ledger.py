"""Tables behind a ledger: a fan-out whose batches are seen in all tables at once, compacted while it runs.

Below a root each table has a folder of data and all share one ledger:

    root/_ledger/part-*.parquet                  what was added and replaced, one file for each commit
    root/data/<table>/_folder=<id>/<partitions>  the files of one write

A write puts its files into a folder of its own and then adds its partitions to
the ledger. A commit is one small file, so it is there as a whole or not at
all, for all tables of a batch together. Files that no commit names are seen by
no reader: a batch that fails leaves nothing, and one that is run again after
its commit does nothing. A compaction merges the partitions that many batches
have written and replaces them in one commit. It only replaces what it has read,
so a stream may go on meanwhile; two compactions of one table may not overlap.
Those of several tables may run side by side; one driver commits them in turn.

Readers plan with what the ledger names at that moment. Files stay where they
are until ``remove_unreferenced`` deletes those that the ledger no longer names.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable, Sequence
from functools import partial, reduce
from threading import Lock
from urllib.parse import unquote

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from huntlake.functions.names import field
from huntlake.operators.layout import zorder
from huntlake.sinks.cleanup import path_exists
from huntlake.sinks.growth import merged_type, nullable
from huntlake.sinks.shared import PARALLEL_WRITES, filled, in_parallel
from huntlake.streaming.append import AVAILABLE_NOW, checkpoint_path
from huntlake.streaming.fanout import QUERY_ID_PROPERTY

FOLDER = "_folder"
ENTRY = (
    "commit string, query string, batch long, table string, action string, folder string, partition string, "
    "rows long, columns string, at timestamp"
)
ADD, REPLACE, DONE = "add", "replace", "done"
# Jobs that write to one folder side by side remove each other's temporary files.
COMMITTING = Lock()


def ledger_entries(spark: SparkSession, root: str) -> DataFrame:
    """All entries of the ledger. ``done`` marks a batch; ``add`` and ``replace`` name a partition of a folder."""
    path = f"{root}/_ledger"
    if not path_exists(spark, path):
        return spark.createDataFrame([], ENTRY)
    return spark.read.schema(ENTRY).parquet(path)


def live_partitions(spark: SparkSession, root: str) -> DataFrame:
    """The entries of the partitions that readers see: added, and not replaced since."""
    entries = ledger_entries(spark, root)
    replaced = entries.where(F.col("action") == REPLACE).select("table", "folder", "partition")
    added = entries.where((F.col("action") == ADD) & F.col("partition").isNotNull())
    return added.join(replaced, ["table", "folder", "partition"], "left_anti")


def read_ledger_table(spark: SparkSession, root: str, table: str) -> DataFrame:
    """The rows of a table as the ledger has it now, under the merged schema of all its writes.

    A table that no commit names raises. The driver holds one path for each
    partition and write, and after a compaction one for each partition.
    """
    schema = _schema(spark, root, table)
    if schema is None:
        raise ValueError(f"the ledger of {root} names no table {table!r}")
    return _read(spark, root, table, schema, live_partitions(spark, root).where(F.col("table") == table).collect())


def _read(spark: SparkSession, root: str, table: str, schema: StructType, live: Iterable[Row]) -> DataFrame:
    base = f"{root}/data/{table}"
    paths = sorted({f"{base}/{FOLDER}={row['folder']}" + (f"/{row['partition']}" if row["partition"] else "") for row in live})
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", base).parquet(*paths).select(*(field(name) for name in schema.names))


def _schema(spark: SparkSession, root: str, table: str) -> StructType | None:
    """The merged schema of all writes of a table; its distinct schemas are few."""
    entries = ledger_entries(spark, root).where((F.col("table") == table) & F.col("columns").isNotNull())
    found = entries.groupBy("columns").agg(F.min("at").alias("since")).orderBy("since", "columns").collect()
    kinds = [StructType.fromJson(json.loads(row["columns"])) for row in found]
    return reduce(lambda old, new: merged_type(spark, old, new, table), kinds) if kinds else None


def write_folder(frame: DataFrame, root: str, table: str, partition_by: Sequence[str]) -> list[Row]:
    """Write ``frame`` into a folder of its own; the entries that would make it seen.

    Raises if the type of a column is not that of the table.
    """
    spark = frame.sparkSession
    columns = nullable(frame.schema)
    known = _schema(spark, root, table)
    if known is not None:
        merged_type(spark, known, columns, table)
    folder = uuid.uuid4().hex
    path = f"{root}/data/{table}/{FOLDER}={folder}"
    frame.write.partitionBy(*partition_by).parquet(path)
    files = spark.read.schema(columns).parquet(path).groupBy("_metadata.file_path").count().collect()
    held: dict[str, int] = {}
    for row in files:
        place = unquote(row["file_path"]).split(f"/{FOLDER}={folder}/", 1)[1].rpartition("/")[0]
        held[place] = held.get(place, 0) + row["count"]
    # a write without rows still tells its columns
    return [_entry(table, ADD, folder, place, rows, columns.json()) for place, rows in (held or {None: 0}).items()]


def _entry(table: str | None, action: str, folder=None, partition=None, rows=None, columns=None) -> Row:
    return Row(table=table, action=action, folder=folder, partition=partition, rows=rows, columns=columns)


def commit(spark: SparkSession, root: str, entries: Sequence[Row], query: str | None = None, batch: int | None = None) -> None:
    """Add entries to the ledger, all in one file."""
    name = uuid.uuid4().hex
    rows = [(name, query, batch, e.table, e.action, e.folder, e.partition, e.rows, e.columns) for e in entries]
    kinds = ENTRY.rsplit(",", 1)[0]
    frame = spark.createDataFrame(rows, kinds).withColumn("at", F.current_timestamp()).coalesce(1)
    with COMMITTING:
        frame.write.mode("append").parquet(f"{root}/_ledger")


def committed(spark: SparkSession, root: str, query: str, batch: int) -> bool:
    done = (F.col("action") == DONE) & (F.col("query") == query) & (F.col("batch") == batch)
    return not ledger_entries(spark, root).where(done).isEmpty()


def write_batch(
    frames: dict[str, DataFrame],
    root: str,
    query: str,
    batch: int,
    partition_by: Sequence[str] = ("_event_date",),
    at_once: int = PARALLEL_WRITES,
) -> bool:
    """Write the frames of one batch and commit them together; False if that batch is in the ledger already."""
    spark = next(iter(frames.values())).sparkSession
    if committed(spark, root, query, batch):
        return False
    entries: list[Row] = []

    def write(name: str, frame: DataFrame) -> None:
        entries.extend(write_folder(frame, root, name, partition_by))

    in_parallel(spark, (partial(write, *item) for item in frames.items()), at_once)
    commit(spark, root, [*entries, _entry(None, DONE)], query, batch)
    return True


def ledger_fan_out(
    stream: DataFrame,
    tables: Callable[[DataFrame], dict[str, DataFrame]],
    root: str,
    label: str,
    partition_by: Sequence[str] = ("_event_date",),
    checkpoint_root: str | None = None,
    trigger: dict | None = None,
    at_once: int = PARALLEL_WRITES,
) -> StreamingQuery:
    """Start a stream that writes every frame of ``tables(stream)`` to its own table behind the ledger of ``root``.

    A micro-batch is read and decoded once, and is seen in all tables at once or
    in none. Tables take up new columns and new fields of structs; another type
    fails the batch before anything of it is seen.
    """
    root = root.rstrip("/")

    def write(batch: DataFrame, batch_id: int) -> None:
        query = batch.sparkSession.sparkContext.getLocalProperty(QUERY_ID_PROPERTY)
        with filled(batch) as events:
            write_batch(tables(events), root, query, batch_id, partition_by, at_once)

    return (
        stream.writeStream.foreachBatch(write)
        .queryName(label)
        .option("checkpointLocation", checkpoint_path(stream, label, checkpoint_root))
        .trigger(**(trigger or AVAILABLE_NOW))
        .start()
    )


def compact_ledger_table(
    spark: SparkSession,
    root: str,
    table: str,
    partition_by: Sequence[str] = ("_event_date",),
    columns: Sequence[str] = (),
    where: str | None = None,
    options: dict[str, str] | None = None,
) -> int:
    """Merge the partitions that lie in more than one folder; returns how many were merged.

    ``columns`` Z-orders the rows of a merged partition, ``where`` chooses
    partitions by their columns, and ``options`` are write options such as
    ``bloom_options``. Partitions that lie in one folder are left alone, so a
    second call without new batches rewrites nothing. The rows are counted
    before the commit.
    """
    root = root.rstrip("/")
    schema = _schema(spark, root, table)
    if schema is None:
        raise ValueError(f"the ledger of {root} names no table {table!r}")
    live = live_partitions(spark, root).where(F.col("table") == table).collect()
    folders: dict[str, list[Row]] = {}
    for row in live:
        folders.setdefault(row["partition"], []).append(row)
    many = {place: rows for place, rows in folders.items() if len(rows) > 1}
    if where:
        many = {place: many[place] for place in _chosen(spark, root, table, schema, many, partition_by, where)}
    old = [row for rows in many.values() for row in rows]
    if not old:
        return 0
    frame = _read(spark, root, table, schema, old)
    if columns:
        frame = zorder(frame, columns, partition_by)
    else:
        frame = frame.hint("rebalance", *partition_by) if partition_by else frame.hint("rebalance")
    folder = uuid.uuid4().hex
    path = f"{root}/data/{table}/{FOLDER}={folder}"
    frame.write.partitionBy(*partition_by).options(**(options or {})).parquet(path)
    files = spark.read.schema(schema).parquet(path).groupBy("_metadata.file_path").count().collect()
    held: dict[str, int] = {}
    for row in files:
        place = unquote(row["file_path"]).split(f"/{FOLDER}={folder}/", 1)[1].rpartition("/")[0]
        held[place] = held.get(place, 0) + row["count"]
    wanted = {place: sum(row["rows"] for row in rows) for place, rows in many.items()}
    if held != wanted:
        raise RuntimeError(f"{path} holds {held} and not {wanted}; {table} is left as it was")
    added = [_entry(table, ADD, folder, place, rows, schema.json()) for place, rows in held.items()]
    gone = [_entry(table, REPLACE, row["folder"], row["partition"], row["rows"]) for row in old]
    commit(spark, root, added + gone)
    return len(many)


def _chosen(
    spark: SparkSession,
    root: str,
    table: str,
    schema: StructType,
    many: dict[str, list[Row]],
    partition_by: Sequence[str],
    where: str,
) -> list[str]:
    """The partitions whose rows ``where`` chooses, judged on the table's own types; no data is read."""
    one_each = [rows[0] for rows in many.values()]
    if not one_each:
        return []
    only = StructType([schema[name] for name in partition_by])
    spark.createDataFrame([], only).filter(where)  # raises if it names more than the partition columns
    path_of = F.regexp_extract(F.col("_metadata.file_path"), f"/{FOLDER}=[^/]*/(.*)/[^/]*$", 1)
    base = f"{root}/data/{table}"
    paths = [f"{base}/{FOLDER}={row['folder']}/{row['partition']}" for row in one_each]
    frame = spark.read.schema(schema).option("basePath", base).parquet(*paths)
    found = frame.filter(where).select(path_of.alias("place")).distinct().collect()
    return [unquote(row["place"]) for row in found]


def live_folders(spark: SparkSession, root: str) -> DataFrame:
    """(folder): the full paths of all folders that hold files the ledger names."""
    path = F.concat_ws("/", F.lit(f"{root.rstrip('/')}/data"), "table", F.concat(F.lit(f"{FOLDER}="), "folder"), F.nullif("partition", F.lit("")))
    return live_partitions(spark, root.rstrip("/")).select(path.alias("folder"))
