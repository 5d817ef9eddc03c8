"""Physical layout of Parquet tables: bloom filters and Z-order clustering."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence
from typing import Any
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StructType

from huntlake.functions.names import field, quoted, text_literal
from huntlake.operators.file_index import overlap_depth, zone_map
from huntlake.sinks.growth import partition_specs, partition_values

# Fixed value: accepted share of false positives in a bloom filter.
BLOOM_FALSE_POSITIVES = 0.1

# Bytes that one filter may take at most. Parquet keeps a filter per row group and
# column, and picks the smallest size that holds the values it has seen.
BLOOM_MOST_BYTES = 1 << 20

ZORDER_BITS = 6
BOUNDS_SAMPLE_ROWS = 5_000
ZORDER_KEY = "_zorder_key"
STREAM_LOG = "_spark_metadata"
# The folder of a file, and how the folders are named that optimize_table writes to.
FOLDER = "^(.*)/[^/]*$"
OPTIMIZED = "_[0-9a-f]{32}(/|$)"


def bloom_options(
    columns: Iterable[str],
    false_positives: float = BLOOM_FALSE_POSITIVES,
    most_bytes: int = BLOOM_MOST_BYTES,
) -> dict[str, str]:
    """Parquet write options that add a bloom filter to each of ``columns``, sized by the values in each row group."""
    options = {
        "parquet.bloom.filter.adaptive.enabled": "true",
        "parquet.bloom.filter.max.bytes": str(most_bytes),
        "parquet.bloom.filter.fpp": str(false_positives),
    }
    return options | {f"parquet.bloom.filter.enabled#{name}": "true" for name in columns}


def zorder(
    df: DataFrame,
    columns: Sequence[str],
    partition_by: Sequence[str] = (),
    files: int | None = None,
    tie: Sequence[str] = (),
    bits: int = ZORDER_BITS,
) -> DataFrame:
    """Distribute and sort rows by a key that interleaves the range buckets of ``columns``.

    Rows near in every column land in the same file, so min/max statistics on any
    of the columns skip files. The rows stay the same. Rows with equal keys are
    split by ``tie`` columns, or by a hash of the whole row, so a value that
    fills a third of the table still spreads over many files. Without ``files``
    the number of output partitions is left to adaptive execution.
    """
    bits = min(bits, 62 // len(columns))
    bounds = _range_bounds(df, columns, 2**bits)
    buckets = [_bucket(field(name), bounds[name]) for name in columns]
    keyed = df.withColumn(ZORDER_KEY, _interleave(buckets, bits))
    lead = [field(name) for name in partition_by] + [F.col(ZORDER_KEY)]
    ties = [field(name) for name in tie] or [F.xxhash64(*(field(name) for name in df.columns))]
    spread = keyed.repartitionByRange(*([files] if files else []), *lead, *ties)
    return spread.sortWithinPartitions(*lead).drop(ZORDER_KEY)


def optimize_table(
    spark: SparkSession,
    name: str,
    columns: Sequence[str],
    where: str | None = None,
    files: int | None = None,
    options: dict[str, str] | None = None,
    depth: int | None = None,
) -> str:
    """Compact and Z-order a catalog table, or the partitions chosen by ``where``.

    ``where`` may name partition columns only, so that whole partitions are
    rewritten; anything else raises before a file is written. ``options`` are
    write options such as ``bloom_options``. With ``depth``, a partition is rewritten
    only if a value of one of ``columns`` may lie in more than ``depth`` of its files,
    and it has been written to since it was last optimised; with no such partition
    nothing is written. A Delta table is handed to Delta's own command.
    The files of a Parquet table are rewritten to a new directory beside the old
    one, and the catalog is then pointed to it; the old files are left for
    running readers and are not deleted. Nobody may append to the chosen
    partitions meanwhile. Returns the new directory, the old one if nothing was
    rewritten, or the table name for Delta.

    A Parquet table that a stream appends to directly is refused: the stream
    keeps its own list of files and goes on writing to the old directory.
    """
    detail = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
    if detail["Provider"].lower() == "delta":
        chosen = f" WHERE {where}" if where else ""
        spark.sql(f"OPTIMIZE {name}{chosen} ZORDER BY ({', '.join(map(quoted, columns))})")
        return name

    location = detail["Location"].rstrip("/")
    if _exists(spark, f"{location}/{STREAM_LOG}"):
        raise ValueError(f"{name} is written by a stream and cannot be moved to a new directory")
    partition_by = [c.name for c in spark.catalog.listColumns(name) if c.isPartition]
    if where:
        _check_partition_filter(spark, name, partition_by, where)
    moved = _partitions(spark, name, partition_by, where) if partition_by else {}
    table = spark.table(name)
    chosen = table.filter(where) if where else table
    if depth is not None:
        folders = _deep_folders(chosen, columns, depth)
        if not folders:
            return location
        folder = F.regexp_extract("_metadata.file_path", FOLDER, 1)
        chosen = chosen.filter(folder.isin(folders))
        kept = {"/".join(unquote(path).split("/")[-len(partition_by) :]) for path in folders}
        moved = {path: spec for path, spec in moved.items() if path in kept}
    rows = chosen.select("*", F.col("_metadata.row_index").alias("_row_index"))
    written = zorder(rows, columns, partition_by, files, tie=["_row_index"]).drop("_row_index")
    target = f"{location}_{uuid.uuid4().hex}"
    written.write.partitionBy(*partition_by).options(**(options or {})).parquet(target)
    folders = _check_written(spark, target, written.schema, chosen.count(), moved if partition_by else None)

    if not partition_by:
        spark.sql(f"ALTER TABLE {name} SET LOCATION {text_literal(target)}")
    for path in folders:
        spark.sql(f"ALTER TABLE {name} PARTITION ({moved[path]}) SET LOCATION {text_literal(f'{target}/{path}')}")
    spark.catalog.refreshTable(name)
    return target


def _deep_folders(table: DataFrame, columns: Sequence[str], depth: int) -> list[str]:
    """Folders whose files overlap in more than ``depth``, other than those that hold what one optimisation wrote."""
    settled = (F.col("writes") == 1) & F.col("folder").rlike(OPTIMIZED)
    found = overlap_depth(zone_map(table, columns), columns).where((F.col("depth") > depth) & ~settled)
    return [row["folder"] for row in found.collect()]


def _check_written(
    spark: SparkSession, target: str, schema: StructType, expected: int, moved: dict[str, str] | None
) -> list[str]:
    """The partition folders below ``target``; raises unless they hold ``expected`` rows and are all to be moved.

    A partition that has no rows has no folder and stays where it is.
    """
    files = spark.read.schema(schema).parquet(target).groupBy("_metadata.file_path").count().collect()
    held = sum(row["count"] for row in files)
    root = target.rsplit("/", 1)[1]
    folders = {unquote(row["file_path"]).split(f"/{root}/", 1)[1].rpartition("/")[0] for row in files}
    strange = folders - set(moved) if moved is not None else set()
    if held != expected or strange:
        raise RuntimeError(
            f"{target} holds {held} rows of {expected}, and partitions that were not chosen: {sorted(strange)}; "
            "the table is left as it was"
        )
    return sorted(folders) if moved is not None else []


def _check_partition_filter(spark: SparkSession, name: str, partition_by: Sequence[str], where: str) -> None:
    """Raise unless ``where`` can be told from the partition columns alone: a part of a partition would replace it."""
    columns = [item for item in spark.table(name).schema.fields if item.name in partition_by]
    try:
        if not columns:
            raise ValueError(f"{name} has no partitions that {where!r} could choose")
        spark.createDataFrame([], StructType(columns)).filter(where)
    except AnalysisException as error:
        raise ValueError(f"{where!r} names more than the partition columns {list(partition_by)} of {name}") from error


def _exists(spark: SparkSession, path: str) -> bool:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)


def _partitions(
    spark: SparkSession, name: str, partition_by: Sequence[str], where: str | None
) -> dict[str, str]:
    """Directory name -> SQL partition spec, for the partitions of a table that ``where`` chooses."""
    specs = partition_specs(spark, name, partition_by)
    if where is None or not specs:
        return specs
    rows = [(path, *partition_values(path)) for path in specs]
    schema = ", ".join(f"{quoted(column)} string" for column in ("_path", *partition_by))
    kinds = spark.table(name).schema
    # the filter is judged on the types it has in the table: as texts, 10 lies below 5
    typed = [field(column).cast(kinds[column].dataType).alias(column) for column in partition_by]
    found = spark.createDataFrame(rows, schema).select("_path", *typed).filter(where)
    return {row["_path"]: specs[row["_path"]] for row in found.collect()}


def _range_bounds(df: DataFrame, columns: Sequence[str], buckets: int) -> dict[str, list[Any]]:
    """Up to ``buckets - 1`` distinct quantiles per column.

    Numbers take theirs from one aggregate over all rows, and other types from
    the values of about ``BOUNDS_SAMPLE_ROWS`` rows with the smallest hashes.
    They decide where rows lie, never which rows there are.
    """
    shares = [step / buckets for step in range(1, buckets)]
    kinds = {item.name: item.dataType for item in df.select(*(field(name).alias(name) for name in columns)).schema.fields}
    numbers = [name for name in columns if isinstance(kinds[name], NumericType)]
    others = [name for name in columns if name not in numbers]
    bounds: dict[str, list[Any]] = {}
    if numbers:
        row = df.agg(*(F.percentile_approx(field(name), shares, BOUNDS_SAMPLE_ROWS) for name in numbers)).first()
        bounds |= {name: list(dict.fromkeys(row[at] or ())) for at, name in enumerate(numbers)}
    if others:
        draw = F.xxhash64(*(field(name) for name in df.columns))
        picked = df.select(*(field(name) for name in others), draw.alias("_draw")).orderBy("_draw").limit(BOUNDS_SAMPLE_ROWS)
        rows = picked.collect()
        for at, name in enumerate(others):
            ranked = sorted(row[at] for row in rows if row[at] is not None)
            cuts = (ranked[len(ranked) * step // buckets] for step in range(1, buckets)) if ranked else ()
            bounds[name] = list(dict.fromkeys(cuts))
    return bounds


def _bucket(column: Column, bounds: list[Any]) -> Column:
    """Number of ``bounds`` at or below the value, by binary search; 0 for NULL."""

    def search(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(column >= F.lit(bounds[middle]), search(middle + 1, high)).otherwise(search(low, middle))

    return F.when(column.isNull(), F.lit(0)).otherwise(search(0, len(bounds)))


def _interleave(buckets: list[Column], bits: int) -> Column:
    """One number from the bits of all buckets, taken in turn."""
    key = F.lit(0).cast("bigint")
    for position, bucket in enumerate(buckets):
        wide = bucket.cast("bigint")
        for bit in range(bits):
            picked = F.shiftright(wide, bit).bitwiseAND(F.lit(1))
            key = key.bitwiseOR(F.shiftleft(picked, bit * len(buckets) + position))
    return key
