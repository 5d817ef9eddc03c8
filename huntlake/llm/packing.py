"""Packing: documents into sequences of tokens, by cutting-stock patterns.

A document's ids are cut into full sequences and a rest. The histogram of the
rests by length class (lengths rounded up to ``UNIT`` tokens) gives a linear
program over patterns of classes (``cutting_stock.py``). The rests of one class
are ranked, and the patterns take them in that order, so each piece finds its
sequence by a join with the few ranges of its class.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from huntlake.llm.common import per_batch, ranked, saved
from huntlake.llm.cutting_stock import GAP, plan
from huntlake.llm.tokens import ids_of

CAPACITY = 1024
END = 0
#: Tokens of a length class. Smaller units pad less and make a larger linear program.
UNIT = 8
#: Tokens handed on at a time when the ids themselves are kept.
BATCH_TOKENS = 1 << 21


def pieces(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str | None = None, keep_ids: bool = False) -> DataFrame:
    """The pieces of each document: full ones, and last a rest of 1 to ``capacity`` - 1 tokens."""
    columns = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long" + ", ids array<int>" * keep_ids

    def make(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        rows, kept, tokens = [], [], 0

        def out() -> pa.RecordBatch:
            arrays = [pa.array(column, pa.int64()) for column in (zip(*rows) if rows else [[]] * 5)]
            if keep_ids:
                arrays.append(pa.array(kept, pa.list_(pa.int32())))
            return pa.RecordBatch.from_arrays(arrays, [column.split()[0] for column in columns.split(", ")])

        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            ids = np.frombuffer(ids_of(text.as_py(), vocabulary) + END.to_bytes(4, "little"), "<u4")
            for start in range(0, len(ids), capacity):
                piece = ids[start : start + capacity]
                rows.append((doc_id, start, len(piece), zlib.crc32(piece.tobytes()), len(ids)))
                if keep_ids:
                    kept.append(piece.view("<i4"))
            tokens += len(ids)
            if tokens >= BATCH_TOKENS:
                yield out()
                rows, kept, tokens = [], [], 0
        yield out()

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(per_batch(make), columns)


def places(patterns: list[tuple[dict[int, int], int]]) -> Iterator[tuple[int, int, int, int, int, int]]:
    """(class, from rank, to rank, copies, first sequence, first slot) of each class in each pattern."""
    taken: Counter = Counter()
    sequence = 0
    for pattern, times in patterns:
        slot = 0
        for size in sorted(pattern, reverse=True):
            copies = pattern[size]
            yield size, taken[size], taken[size] + copies * times, copies, sequence, slot
            taken[size] += copies * times
            slot += copies
        sequence += times


def pack(
    docs: DataFrame,
    capacity: int = CAPACITY,
    vocabulary: str | None = None,
    unit: int = UNIT,
    gap: float = GAP,
    keep_ids: bool = False,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset (and ids).

    A document is its ids and one id ``END``; a NULL or empty text is that id
    alone. Every id is in one piece, and the pieces of a sequence follow each
    other from offset 0. Sequences shorter than ``capacity`` are to be padded.
    Equal rows are packed each for itself; a NULL doc_id is packed like any
    other. Other columns are not read.
    """
    spark = docs.sparkSession
    cut = saved(pieces(docs, capacity, vocabulary, keep_ids), "pieces", small=True)
    cut = cut.withColumn("size", F.expr(f"(length + {unit - 1}) div {unit}"))
    histogram = {row["size"]: row["count"] for row in cut.groupBy("size").count().collect()}
    slots = spark.createDataFrame(
        list(places(plan(histogram, capacity // unit, gap))),
        "class long, low long, high long, copies long, first long, shift long",
    )
    chosen = ranked(cut, "size", ["doc_id", "start", "ids_crc32"], "place").join(
        F.broadcast(slots),  # bounded by the capacity: a few entries for each pattern, a few patterns for each class
        (F.col("size") == F.col("class")) & (F.col("place") >= F.col("low")) & (F.col("place") < F.col("high")),
    )
    before = Window.partitionBy("sequence_id").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    return (
        chosen.withColumn("sequence_id", F.col("first") + F.expr("(place - low) div copies"))
        .withColumn("slot", F.col("shift") + (F.col("place") - F.col("low")) % F.col("copies"))
        .withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0)))
        .select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", *["ids"] * keep_ids)
    )
