"""Batch file and catalog sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

COLUMNAR_FORMATS = ("parquet", "orc", "delta")


def read_batch(
    spark: SparkSession,
    path: str | list[str],
    fmt: str = "parquet",
    schema: StructType | str | None = None,
    **options: str,
) -> DataFrame:
    """Read a batch source.

    * ``json``: JSON Lines, compressed by file extension. Without ``schema`` the
      types are inferred, which is one more pass over the input; at scale pass a
      stored schema.
    * ``csv``: with ``schema`` the file has no header line; without it the first
      line names the columns and the types are inferred.
    * ``parquet``, ``orc``, ``delta``: self-describing.
    """
    reader = spark.read.options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    if fmt == "json":
        return reader.json(path)
    if fmt == "csv":
        if schema is None:
            return reader.options(header="true", inferSchema="true").csv(path)
        return reader.options(header="false").csv(path)
    if fmt in COLUMNAR_FORMATS:
        return reader.format(fmt).load(path)
    raise ValueError(f"unsupported batch format {fmt!r}")


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """Scan a catalog table."""
    return spark.read.table(name)
