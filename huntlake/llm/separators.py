"""Token counts: a separator scan over flat token files that have no index.

A file is the ids of its documents end to end, each followed by an
end-of-document id, two bytes an id, high byte first. Files are read in blocks
that start anywhere; each block finds its separators in one vectorised
comparison, and a prefix scan over the blocks of a file tells where the
document that a block begins with has begun.
"""

from __future__ import annotations

from collections.abc import Iterator
from urllib.parse import quote

import numpy as np
import pyarrow as pa
import pyarrow.fs as fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from huntlake.llm.common import per_batch
from huntlake.llm.tokens import ids_of
from huntlake.sinks.cleanup import spark_path

WIDTH = 2
#: The separator. As text it is one character of two bytes, so Spark's text writer can put it after each document.
SEPARATOR = "߿"
END = int.from_bytes(SEPARATOR.encode(), "big")
#: Ids of a block.
BLOCK = 1 << 20
#: Blocks that a task reads, about; 64 MB.
TASK_BLOCKS = 32
SCANNED = "file string, block long, size long, seps array<long>"


def write_flat(docs: DataFrame, path: str, vocabulary: str | None = None) -> None:
    """Write the texts of ``docs`` (shard, place, text) as flat files, one folder per shard, in order of place.

    Rows stay in their tasks: a shard that lies in one task becomes one file.
    A NULL or empty text is a document without ids.
    """

    def make(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        found = []
        for text in batch.column(2):
            ids = np.frombuffer(ids_of(text.as_py(), vocabulary), "<u4")
            if len(ids) and ids.max() >= END:
                raise ValueError(f"the vocabulary has ids from {END} on, which the file format keeps for itself")
            found.append(ids.astype(">u2").tobytes())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(found, pa.binary())], ["shard", "place", "ids"]
        )

    (
        docs.select(F.col("shard").cast("string"), F.col("place").cast("long"), "text")
        .mapInArrow(per_batch(make), "shard string, place long, ids binary")
        .sortWithinPartitions("shard", "place")
        .select(F.col("ids").cast("string").alias("value"), "shard")
        .write.partitionBy("shard")
        .option("lineSep", SEPARATOR)
        .text(path)
    )


def block_ranges(spark: SparkSession, path: str, block: int = BLOCK) -> DataFrame:
    """(file, block, bytes) of all files under ``path``, cut every ``block`` ids wherever that falls.

    Only names and lengths of files are read. Blocks are dealt over tasks by file and number, so a file of any
    size is read by many tasks.
    """
    step = WIDTH * block
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).where("length > 0")
    files = files.select(F.col("path").alias("file"), "length")
    blocks = files.agg(F.sum(F.expr(f"(length - 1) div {step} + 1"))).first()[0] or 0
    ranges = files.select("file", "length", F.explode(F.expr(f"sequence(0L, (length - 1) div {step})")).alias("block"))
    rest = F.least(F.lit(step).cast("long"), F.col("length") - F.col("block") * step)
    # a given number of parts, which adaptive execution leaves as it is: the rows are small, what they stand for is not
    return ranges.select("file", "block", rest.alias("bytes")).repartition(max(1, -(-blocks // TASK_BLOCKS)), "file", "block")


def scan_ranges(ranges: DataFrame, block: int = BLOCK, end: int = END) -> DataFrame:
    """(file, block, size, seps), as ``scan`` gives it, of blocks that each task reads from their files by itself.

    Files are opened through ``pyarrow``, so they lie on a shared file system that it knows. A file that has become
    shorter since it was listed, or does not end after a whole id, raises.
    """

    def make(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for file, number, size in zip(*(column.to_pylist() for column in batch.columns)):
            system, place = file_system(file)
            with system.open_input_file(place) as opened:
                held = opened.read_at(size, number * WIDTH * block)
            if len(held) != size or size % WIDTH:
                raise ValueError(f"{file} is cut off in block {number}")
            yield found_in([file], [number], [held], end)

    return ranges.select("file", "block", "bytes").mapInArrow(per_batch(make), SCANNED)


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path as Spark lists it, and the path there; local paths come with one slash or three."""
    place = spark_path(path)
    return (fs.LocalFileSystem(), place) if place.startswith("/") else fs.FileSystem.from_uri(quote(place, safe=":/@"))


def found_in(files: list[str], blocks: list[int], held: list[bytes], end: int) -> pa.RecordBatch:
    """The size of each block and the places of its separators."""
    sizes, seps = [], []
    for one in held:
        ids = np.frombuffer(one, ">u2")
        sizes.append(len(ids))
        seps.append(np.flatnonzero(ids == end))
    return pa.RecordBatch.from_arrays(
        [pa.array(files), pa.array(blocks, pa.int64()), pa.array(sizes, pa.int64()), pa.array(seps, pa.list_(pa.int64()))],
        ["file", "block", "size", "seps"],
    )


def scan(blocks: DataFrame, end: int = END) -> DataFrame:
    """(file, block, size, seps): the ids in each block (file, block, ids) and the places of its separators."""

    def make(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        yield found_in(*(column.to_pylist() for column in batch.columns), end)

    return blocks.select("file", "block", "ids").mapInArrow(per_batch(make), SCANNED)


def stitched(found: DataFrame) -> DataFrame:
    """(file, ordinal, n_tokens, closed) of each document of each file, from its scanned blocks.

    The scan over the blocks carries the number of ids and of separators before
    a block and the place after the last separator. Ids after the last
    separator of a file are a document that is not closed. An empty document
    has 0 tokens. A file without ids gives no row.
    """
    file = Window.partitionBy("file").orderBy("block")
    before = file.rowsBetween(Window.unboundedPreceding, -1)
    placed = found.withColumn("base", F.coalesce(F.sum("size").over(before), F.lit(0)))
    placed = placed.withColumn("after", F.when(F.size("seps") > 0, F.col("base") + F.element_at("seps", -1) + 1))
    carried = placed.select(
        "file",
        "base",
        "size",
        "seps",
        F.coalesce(F.max("after").over(before), F.lit(0)).alias("open"),
        F.coalesce(F.sum(F.size("seps")).over(before), F.lit(0)).alias("closed_before"),
        F.lead("block").over(file).isNull().alias("final"),
    )
    # a document ends at each separator; in the last block one may end at the end of the file
    ends = F.transform("seps", lambda place: F.col("base") + place)
    tail = F.coalesce(F.try_element_at("seps", F.lit(-1)) + F.col("base") + 1, F.col("open")) < F.col("base") + F.col("size")
    listed = carried.select(
        "file", "open", "closed_before", ends.alias("ends"), (F.col("final") & tail).alias("tail"), (F.col("base") + F.col("size")).alias("stop")
    )
    all_ends = F.when(F.col("tail"), F.concat("ends", F.array("stop"))).otherwise(F.col("ends"))
    starts = F.concat(F.array("open"), F.transform("ends", lambda place: place + 1))
    rows = listed.select("file", "closed_before", F.size("ends").alias("n"), starts.alias("starts"), F.posexplode(all_ends))
    return rows.select(
        "file",
        (F.col("closed_before") + F.col("pos")).cast("long").alias("ordinal"),
        (F.col("col") - F.get("starts", F.col("pos"))).cast("long").alias("n_tokens"),
        (F.col("pos") < F.col("n")).alias("closed"),
    )


def count_tokens(spark: SparkSession, path: str, block: int = BLOCK) -> DataFrame:
    """The documents of all flat files under ``path``: file, ordinal, n_tokens, closed."""
    return stitched(scan_ranges(block_ranges(spark, path, block), block))
