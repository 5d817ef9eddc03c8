"""What each file of a table holds: value ranges and bloom bits, kept as tables, by which a scan leaves files out.

An index describes files, and files are never written twice under one name. A
scan names the files it leaves out, so a file that the index does not know is
read: an index that is behind its table costs reads and never rows. The paths
left out pass through the driver, as the paths of all files do when Spark plans
a scan; for a table of very many files, choose partitions and their part of the
index first.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType, VariantType

from huntlake.functions.names import field

#: Columns of a table that a zone map covers unless they are named.
ZONE_COLUMNS = 32
#: Bits of a bloom filter for each distinct value of a file, at least.
BITS_PER_VALUE = 12
#: Bits that one value sets, all in one word of 64 bits.
BITS_SET = 4
LEAST_WORDS = 64

NESTED = (ArrayType, MapType, StructType, VariantType)
FILE = "_metadata.file_path"


def zone_map(table: DataFrame, columns: Sequence[str] | None = None, first: int = ZONE_COLUMNS) -> DataFrame:
    """(file, bytes, rows, zones) of every file that has rows: ``zones.<column>`` is (low, high, nulls).

    ``table`` is read from files, and not changed since. Without ``columns`` the
    first ``first`` columns that are not nested are covered. A column that is
    NULL throughout a file has NULL bounds; NaN is above all numbers.
    """
    plain = [item.name for item in table.schema.fields if not isinstance(item.dataType, NESTED)]
    zones = [
        F.struct(F.min(field(name)).alias("low"), F.max(field(name)).alias("high"), F.count_if(field(name).isNull()).alias("nulls")).alias(name)
        for name in (columns if columns is not None else plain[:first])
    ]
    held = [F.max("_metadata.file_size").alias("bytes"), F.count(F.lit(1)).alias("rows"), F.struct(*zones).alias("zones")]
    return table.groupBy(F.col(FILE).alias("file")).agg(*held)


def in_range(table: DataFrame, zones: DataFrame, ranges: Mapping[str, tuple[Any, Any]]) -> DataFrame:
    """The rows whose columns lie in all ``ranges``, from the files whose zones reach into them.

    A range is (lowest, highest), both included, with None for an open end. The
    ends are cast to the column's type, so a range of texts is one in the order
    of the column's own values. A column that the map does not cover leaves out
    no file. NULL lies in no range.
    """
    covered = zones.schema["zones"].dataType.names
    hit, near = F.lit(True), F.lit(True)
    for name, (low, high) in ranges.items():
        kind = table.schema[name].dataType
        zone = F.col("zones").getField(name) if name in covered else None
        hit = hit & field(name).isNotNull()
        if zone is not None:
            near = near & zone.getField("low").isNotNull()
        if low is not None:
            hit = hit & (field(name) >= F.lit(low).cast(kind))
            near = near & (zone.getField("high") >= F.lit(low).cast(kind)) if zone is not None else near
        if high is not None:
            hit = hit & (field(name) <= F.lit(high).cast(kind))
            near = near & (zone.getField("low") <= F.lit(high).cast(kind)) if zone is not None else near
    return files_of(table, zones, zones.where(near)).where(hit)


def bloom_index(table: DataFrame, columns: Sequence[str], bits_per_value: int = BITS_PER_VALUE) -> DataFrame:
    """(column, words, word, mask, file): bloom bits of the distinct values of each file and column.

    A filter has ``words`` words of 64 bits, a power of two that follows from
    the distinct values of the file, and only words with a bit are rows. So the
    bits are made by an aggregate, and values are looked up by an equi-join.
    Write it sorted by column, words and word. NULL is not indexed.
    """
    hashes = [F.struct(F.lit(name).alias("column"), F.when(field(name).isNotNull(), F.xxhash64(field(name))).alias("hash")) for name in columns]
    rows = table.select(F.col(FILE).alias("file"), F.explode(F.array(*hashes)).alias("value")).where("value.hash is not null")
    distinct = rows.select("file", "value.column", "value.hash").distinct()
    held = F.count(F.lit(1)).over(Window.partitionBy("file", "column"))
    needed = F.greatest(F.lit(LEAST_WORDS), held * bits_per_value / 64)
    words = F.pow(F.lit(2.0), F.ceil(F.log2(needed))).cast("long")
    placed = distinct.withColumn("words", words).select("file", "column", "words", _word(F.col("words")).alias("word"), _mask().alias("mask"))
    return placed.groupBy("column", "words", "word", "file").agg(F.bit_or("mask").alias("mask")).select("column", "words", "word", "mask", "file")


def holding(table: DataFrame, index: DataFrame, column: str, values: DataFrame | Iterable[Any]) -> DataFrame:
    """The rows whose ``column`` is one of ``values``, from the files whose bloom bits allow for one of them.

    ``values`` is a DataFrame of one column, which is cast to the column's type,
    or a list of values of that type. NULL is found nowhere.
    """
    spark, kind = table.sparkSession, table.schema[column].dataType
    if not isinstance(values, DataFrame):
        values = spark.createDataFrame([(value,) for value in values], StructType().add("value", kind))
    wanted = values.select(field(values.columns[0]).cast(kind).alias("_wanted")).where("_wanted is not null").distinct()
    bits = index.where(F.col("column") == column)
    sizes = [row["words"] for row in bits.select("words").distinct().collect()]  # powers of two: a few dozen at most
    probe = wanted.select(F.xxhash64("_wanted").alias("hash"))
    probe = probe.withColumn("words", F.explode(F.array(*map(F.lit, sizes)).cast("array<long>")))
    probe = probe.select("words", _word(F.col("words")).alias("word"), _mask().alias("asked"))
    files = bits.join(probe, ["words", "word"]).where(F.col("mask").bitwiseAND(F.col("asked")) == F.col("asked")).select("file").distinct()
    known = bits.select("file").distinct()
    return files_of(table, known, files).join(wanted, field(column) == F.col("_wanted"), "left_semi")


def files_of(table: DataFrame, known: DataFrame, wanted: DataFrame) -> DataFrame:
    """``table`` without the files that ``known`` names and ``wanted`` does not (both have a column ``file``)."""
    left_out = known.select("file").join(wanted.select("file"), "file", "left_anti").distinct()
    paths = [row["file"] for row in left_out.collect()]
    return table.where(~F.col(FILE).isin(paths)) if paths else table


def overlap_depth(zones: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(folder, files, writes, depth): in how many files of a folder one value of a column can lie, at most.

    The bounds of the files are swept in order; a file opens at its low value and
    closes after its high one. ``depth`` is the greatest over ``columns``, and
    ``writes`` tells how many writes the files come from. Folders without
    a value have depth 0.
    """
    folder, write = F.regexp_extract("file", r"^(.*)/[^/]*$", 1), F.regexp_extract("file", r"([^/]*)$", 1)
    write = F.regexp_replace(write, r"^part-\d+-([0-9a-f-]{36}).*$", "$1")
    placed = zones.withColumn("folder", folder).withColumn("write", write)
    found = placed.groupBy("folder").agg(F.count(F.lit(1)).alias("files"), F.count_distinct("write").alias("writes"))
    for name in columns:
        zone = F.col("zones").getField(name)
        edges = F.array(F.struct(zone.getField("low").alias("at"), F.lit(0).alias("closes")), F.struct(zone.getField("high").alias("at"), F.lit(1).alias("closes")))
        swept = placed.where(zone.getField("low").isNotNull()).select("folder", F.explode(edges).alias("edge")).select("folder", "edge.*")
        before = Window.partitionBy("folder").orderBy("at", "closes").rowsBetween(Window.unboundedPreceding, 0)
        depth = swept.withColumn("open", F.sum(1 - 2 * F.col("closes")).over(before)).groupBy("folder").agg(F.max("open").alias(name))
        found = found.join(depth, "folder", "left")
    deepest = [F.coalesce(field(name), F.lit(0)) for name in columns]
    return found.select("folder", "files", "writes", F.greatest(F.lit(0), *deepest).cast("long").alias("depth"))


def _word(words: Column) -> Column:
    return F.shiftrightunsigned("hash", 6 * BITS_SET).bitwiseAND(words - 1)


def _mask() -> Column:
    mask = F.lit(0).cast("long")
    for at in range(BITS_SET):
        place = F.shiftrightunsigned("hash", 6 * at).bitwiseAND(F.lit(63)).cast("int")
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), place))
    return mask
