"""What the operators of this package share: the shared folder, word rules, ranks, Arrow loops."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager, nullcontext

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from huntlake.sinks.shared import fresh_folder

#: White space that separates words; anything else belongs to a word. ``bytes.split`` uses the same six bytes.
GAP = "[\\x20\\x09-\\x0D]+"
#: Parts that a large group is dealt into before it is ranked.
RANK_PARTS = 256
#: Rows that a Python worker handles at a time.
SLICE = 500
#: Rows that are sent to a Python worker at once where texts go, and the setting for it.
SENT = 2000
ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Actions in here send at most ``SENT`` rows at once to Python, so neither side holds many texts outside the heap."""
    before = spark.conf.get(ARROW_ROWS)
    if not 0 < int(before) <= SENT:
        spark.conf.set(ARROW_ROWS, str(SENT))
    try:
        yield
    finally:
        spark.conf.set(ARROW_ROWS, before)


def saved(df: DataFrame, label: str, small: bool = False) -> DataFrame:
    """``df`` written to the shared folder and read again: computed once, safe from lost executors.

    With ``small``, rows go to Python in ``small_batches``.
    """
    path = fresh_folder(df.sparkSession, label)
    with small_batches(df.sparkSession) if small else nullcontext():
        df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words_of(text: Column) -> Column:
    """The words of a text as an array; empty for a NULL text."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), GAP), lambda word: word != "")


def per_batch(make: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]], rows: int = SLICE):
    """A function for ``mapInArrow`` that handles a few hundred rows at a time, so a worker holds few texts twice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                yield from make(batch.slice(at, rows))

    return run


def text_bytes(column: pa.Array) -> Iterator[bytes]:
    """The UTF-8 bytes of each text; empty for NULL."""
    return (value.as_py() or b"" for value in column.cast(pa.binary()))


def ranked(df: DataFrame, group: str, order: list[str], name: str, parts: int = RANK_PARTS) -> DataFrame:
    """Add the rank of each row in its group, from 0, in an order fixed by ``order`` alone.

    A group is dealt by hash into ``parts``, the rows of a part are numbered by
    themselves, and the sizes of the parts before it are added, so a group of a
    third of all rows is never in one task. Rows equal in ``order`` may change
    places; they are told apart by nothing that is ranked.
    """
    part, size, base = f"{name}_part", f"{name}_size", f"{name}_base"
    dealt = df.withColumn(part, F.pmod(F.xxhash64(*order), F.lit(parts)).cast("int"))
    sizes = dealt.groupBy(group, part).agg(F.count(F.lit(1)).alias(size))
    before = Window.partitionBy(group).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select(
        F.col(group).alias(f"{name}_group"),
        F.col(part).alias(f"{name}_of"),
        F.coalesce(F.sum(size).over(before), F.lit(0)).alias(base),
    )
    inside = Window.partitionBy(group, part).orderBy(*order)
    numbered = dealt.withColumn(name, F.row_number().over(inside).cast("long") - 1)
    joined = numbered.join(bases, (F.col(group) == F.col(f"{name}_group")) & (F.col(part) == F.col(f"{name}_of")))
    return joined.withColumn(name, F.col(name) + F.col(base)).select(*df.columns, name)
