"""Files that nothing refers to any more: found by listing and an anti join, removed after a dry run.

Rewrites (``optimize_table``, ``replace_table``, compaction of ledger tables)
write beside the old files and then switch; the old files stay for running
readers. Here they are found by what the catalog or a ledger names, never by
guessing from names alone.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from typing import NamedTuple
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Hours that files are left alone after they were written: running writes are not yet named by anything.
GRACE_HOURS = 24.0
STREAM_LOG = "_spark_metadata"
#: What the name of a rewrite adds to that of the folder it is beside.
BESIDE = "_[0-9a-f]{32}"


class Unreferenced(NamedTuple):
    """What nothing refers to: files and bytes, and the folders that hold nothing else."""

    files: int
    bytes: int
    folders: list[str]


def path_exists(spark: SparkSession, path: str) -> bool:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)


def spark_path(path: str) -> str:
    """A path without the scheme of local files, which listings and catalogs write in several ways."""
    scheme, colon, rest = path.partition(":")
    if not colon or "/" in scheme:
        return path
    return "/" + rest.lstrip("/") if scheme == "file" else path


def listed_files(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(path, folder, bytes, modified) of all files below ``paths``; names and sizes only, no content is read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(list(paths))
    path = F.regexp_replace("path", "^file:/+", "/")
    return found.select(
        path.alias("path"),
        F.regexp_replace(path, "/[^/]*$", "").alias("folder"),
        F.col("length").alias("bytes"),
        F.col("modificationTime").alias("modified"),
    )


def unreferenced_files(spark: SparkSession, paths: Sequence[str], live: DataFrame, hours: float = GRACE_HOURS) -> DataFrame:
    """The files below ``paths`` in no folder of ``live`` (folder), left alone for ``hours``."""
    named = live.select(F.regexp_replace("folder", "^file:/+", "/").alias("folder")).distinct()
    old = F.col("modified") < F.current_timestamp() - F.make_dt_interval(secs=F.lit(hours * 3600))
    return listed_files(spark, paths).where(old).join(named, "folder", "left_anti")


def table_folders(spark: SparkSession, names: Sequence[str]) -> list[str]:
    """The folders that the catalog names for tables: of every partition, or of the whole where there are none."""
    found = []
    for name in names:
        place = _location(spark, name)
        if path_exists(spark, f"{place}/{STREAM_LOG}"):
            raise ValueError(f"{name} is written by a stream, which keeps its own list of files")
        if any(column.isPartition for column in spark.catalog.listColumns(name)):
            # the folders of the files that readers of the table would open
            files = spark.table(name).select(F.regexp_replace(F.col("_metadata.file_path"), "/[^/]*$", "").alias("folder"))
            found += [unquote(row["folder"]) for row in files.distinct().collect()]
        else:
            found.append(place)
    return [spark_path(folder) for folder in found]


def _location(spark: SparkSession, name: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'").collect()
    return spark_path(rows[0]["data_type"]).rstrip("/")


def _beside(spark: SparkSession, place: str) -> list[str]:
    """The folder a table was created in, and all rewrites beside it."""
    first = re.sub(f"({BESIDE})+$", "", place)
    hadoop = spark._jvm.org.apache.hadoop.fs
    found = hadoop.Path(first).getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(hadoop.Path(f"{first}*"))
    paths = [spark_path(status.getPath().toString()) for status in found or ()]
    own = re.compile(f"{re.escape(first)}({BESIDE})*")
    return [path for path in paths if own.fullmatch(path)]


def unreferenced_of_table(spark: SparkSession, name: str, hours: float = GRACE_HOURS) -> DataFrame:
    """The files in the folder of a Parquet table, and in those of its rewrites, that the table does not use."""
    live = spark.createDataFrame([(folder,) for folder in table_folders(spark, [name])], "folder string")
    paths = _beside(spark, _location(spark, name))
    return unreferenced_files(spark, paths, live, hours)


def remove_unreferenced(spark: SparkSession, files: DataFrame, dry_run: bool = True) -> Unreferenced:
    """Tell what the files of ``files`` (path, folder, bytes) take up and, unless it is a dry run, delete them.

    They are deleted by name, so a file that a writer adds to such a folder
    meanwhile stays. The driver holds the names of a partition of files at a time.
    """
    folders = files.groupBy("folder").agg(F.count(F.lit(1)).alias("files"), F.sum("bytes").alias("bytes")).orderBy("folder").collect()
    told = Unreferenced(
        sum(row["files"] for row in folders), sum(row["bytes"] for row in folders), [row["folder"] for row in folders]
    )
    if dry_run:
        return told
    hadoop = spark._jvm.org.apache.hadoop.fs
    names = files.select("path").orderBy("path")
    for row in names.toLocalIterator():
        path = hadoop.Path(row["path"])
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, False)
    return told
