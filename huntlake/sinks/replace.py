"""Overwriting a table in one switch, and finishing or undoing what a failure left half done.

``replace_table`` writes beside the old files, counts, and then points the
catalog at the new files with one statement. Readers see the old rows or the new
ones. Where the new schema needs another catalog entry, the new entry is
complete before the old one gives up its name, and ``recover_table`` finishes
the exchange of names after a failure between two statements.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from huntlake.functions.names import text_literal
from huntlake.sinks.growth import create_table, nullable

#: Names of the entries that take part in an exchange: the next one, and the one that was there.
NEXT, LAST = "__next", "__last"


def described(spark: SparkSession, name: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for row in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect():
        found.setdefault(row["col_name"], row["data_type"])
    return found


def recover_table(spark: SparkSession, name: str) -> str:
    """Bring a table back to one entry after a failed ``replace_table``; what was done: ``kept``, ``finished`` or ``undone``.

    A new entry bears the name ``<table>__next`` only once it is complete, so
    where the table's own name is free the new entry takes it. Files of entries
    that are dropped are left for ``remove_unreferenced``.
    """
    exists = spark.catalog.tableExists
    if exists(name):
        done = "kept"
        if exists(f"{name}{NEXT}"):
            _drop_entry(spark, f"{name}{NEXT}")
            done = "undone"
        if exists(f"{name}{LAST}"):
            _drop_entry(spark, f"{name}{LAST}")
            done = "finished"
        return done
    if exists(f"{name}{NEXT}"):
        spark.sql(f"ALTER TABLE {name}{NEXT} RENAME TO {name}")
        if exists(f"{name}{LAST}"):
            _drop_entry(spark, f"{name}{LAST}")
        return "finished"
    if exists(f"{name}{LAST}"):
        spark.sql(f"ALTER TABLE {name}{LAST} RENAME TO {name}")
        return "undone"
    return "kept"


def _drop_entry(spark: SparkSession, name: str) -> None:
    """Drop an entry whose files lie in a folder that was named when it was created, and so stay."""
    if described(spark, name)["Type"] != "EXTERNAL":
        # a managed entry takes its folder with it: point it at an empty one first
        spark.sql(f"ALTER TABLE {name} SET LOCATION {text_literal(described(spark, name)['Location'].rstrip('/') + '__gone')}")
    spark.sql(f"DROP TABLE {name}")


def replace_table(
    df: DataFrame,
    name: str,
    partition_by: Sequence[str] = (),
    path: str | None = None,
    options: dict[str, str] | None = None,
) -> str:
    """Make the rows of ``df`` the rows of a Parquet table, at once; returns the folder of its files.

    The table may be new, and may get other columns, types or partitions. Its
    files are written to ``path`` and a suffix, or beside the table's present
    files; those stay until ``remove_unreferenced`` deletes them, also in the
    warehouse, where they keep the folder of a table that had no path. ``df`` may
    read the table itself. Two calls for one table may not overlap, and a
    failure before the switch leaves the table as it was.
    """
    spark = df.sparkSession
    recover_table(spark, name)
    known = spark.catalog.tableExists(name)
    old = described(spark, name)["Location"].rstrip("/") if known else None
    target = f"{(path or old or _default_place(spark, name)).rstrip('/')}_{uuid.uuid4().hex}"
    schema = _written(df, target, partition_by, options)
    if not known:
        _complete_entry(spark, name, schema, target, partition_by)
        return target
    if not partition_by and not _partitions_of(spark, name) and _same(spark.table(name).schema, schema):
        spark.sql(f"ALTER TABLE {name} SET LOCATION {text_literal(target)}")
        spark.catalog.refreshTable(name)
        return target
    _complete_entry(spark, f"{name}{NEXT}", schema, target, partition_by)
    exchange(spark, name)
    return target


def exchange(spark: SparkSession, name: str) -> None:
    """Let ``<table>__next`` take the name of a table; what fails in between ``recover_table`` finishes."""
    spark.sql(f"ALTER TABLE {name} RENAME TO {name}{LAST}")
    spark.sql(f"ALTER TABLE {name}{NEXT} RENAME TO {name}")
    _drop_entry(spark, f"{name}{LAST}")
    spark.catalog.refreshTable(name)


def _partitions_of(spark: SparkSession, name: str) -> list[str]:
    return [column.name for column in spark.catalog.listColumns(name) if column.isPartition]


def _same(old: StructType, new: StructType) -> bool:
    return nullable(old).simpleString() == nullable(new).simpleString()


def _default_place(spark: SparkSession, name: str) -> str:
    """Where the catalog would put a table of that name."""
    database, _, table = name.rpartition(".")
    rows = spark.sql(f"DESCRIBE DATABASE {database or spark.catalog.currentDatabase()}").collect()
    return {row[0]: row[1] for row in rows}["Location"].rstrip("/") + f"/{table.lower()}"


def _written(df: DataFrame, target: str, partition_by: Sequence[str], options: dict[str, str] | None) -> StructType:
    """Write the rows to ``target``, and compare what is there with what went in; the schema, partition columns last."""
    schema = nullable(df.schema)
    ordered = StructType([item for item in schema if item.name not in partition_by] + [schema[name] for name in partition_by])
    given = Observation()
    counted = df.observe(given, F.count(F.lit(1)).alias("rows"))
    counted.write.partitionBy(*partition_by).options(**(options or {})).parquet(target)
    held = df.sparkSession.read.schema(ordered).parquet(target).count()
    if held != given.get["rows"]:
        raise RuntimeError(f"{target} holds {held} rows of {given.get['rows']}; the table is left as it was")
    return ordered


def _complete_entry(spark: SparkSession, name: str, schema: StructType, target: str, partition_by: Sequence[str]) -> None:
    """A catalog entry over the files of ``target``; it has the name only when all its partitions are in it."""
    draft = f"{name}__draft"
    if spark.catalog.tableExists(draft):
        _drop_entry(spark, draft)
    create_table(spark, draft, schema, partition_by, target)
    if partition_by:
        spark.sql(f"MSCK REPAIR TABLE {draft}")
    spark.sql(f"ALTER TABLE {draft} RENAME TO {name}")
