"""Batch table sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession

from huntlake.sinks.growth import fit_to_table

TIERS = ("bronze", "silver", "gold")

# The Delta setting for the number of leading columns with statistics, and its value for bronze.
STATISTICS_SETTING = "delta.dataSkippingNumIndexedCols"
BRONZE_STATISTICS_COLUMNS = 5


def batch_writer(
    df: DataFrame, partition_by: Sequence[str] = (), mode: str = "append", fmt: str = "parquet"
) -> DataFrameWriter:
    """A configured writer; finish it with ``saveAsTable`` or ``save``."""
    writer = df.write.format(fmt).mode(mode)
    return writer.partitionBy(*partition_by) if partition_by else writer


def create_namespace(spark: SparkSession, name: str, use: bool = False) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")
    if use:
        spark.sql(f"USE {name}")


def balance(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Bring the rows of a table partition together before a partitioned write.

    Without it every task writes a file into every partition it has rows for.
    Adaptive execution merges small partitions and splits one that holds a large
    share of the rows. It costs a shuffle.
    """
    return df.hint("rebalance", *partition_by)


def append_table(
    df: DataFrame,
    name: str,
    tier: str,
    partition_by: Sequence[str] = (),
    fmt: str = "parquet",
    path: str | None = None,
    balanced: bool = False,
    options: dict[str, str] | None = None,
) -> None:
    """Append to a bronze, silver or gold table, creating it at first.

    The table takes up new columns of ``df`` and new fields of its structs (see
    ``grow_table``), and those that ``df`` lacks are filled with NULL. ``path``
    places the files when the table is created.
    """
    check_tier(tier)
    spark = df.sparkSession
    if fmt == "delta":
        if tier == "bronze":
            set_statistics_width(spark)
            options = {STATISTICS_SETTING: str(BRONZE_STATISTICS_COLUMNS)} | (options or {})
        options = {"mergeSchema": "true"} | (options or {})
    elif spark.catalog.tableExists(name):
        df = fit_to_table(df, name)
    if balanced and partition_by:
        df = balance(df, partition_by)
    writer = batch_writer(df, partition_by, "append", fmt).options(**(options or {}))
    if path and not spark.catalog.tableExists(name):  # an existing table may have been moved since
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def append_files(df: DataFrame, path: str, partition_by: Sequence[str] = (), fmt: str = "parquet") -> None:
    """Append to a folder of files whose schema may grow, also inside nested structs."""
    batch_writer(df, partition_by, "append", fmt).save(path)


def read_files(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Read what ``append_files`` wrote, under the merged schema of all files."""
    return spark.read.option("mergeSchema", "true").format(fmt).load(path)


def list_partitions(spark: SparkSession, name: str) -> DataFrame:
    """The partitions of a table, as ``a=1/b=x`` in column ``partition``."""
    return spark.sql(f"SHOW PARTITIONS {name}")


def set_statistics_width(spark: SparkSession, columns: int = BRONZE_STATISTICS_COLUMNS) -> None:
    """Number of columns Delta keeps statistics for in tables this session creates.

    Parquet needs no such setting: every row group carries them for all columns.
    """
    spark.conf.set(STATISTICS_SETTING, str(columns))


def check_tier(tier: str) -> None:
    if tier not in TIERS:
        raise ValueError(f"tier must be one of {TIERS}, not {tier!r}")
