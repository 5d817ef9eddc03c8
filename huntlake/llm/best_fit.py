"""Best-fit packing planned on the histogram of lengths.

Best fit takes the pieces from the longest to the shortest and puts each into
the sequence with the least room that still holds it. Pieces of one length are
alike, and so are sequences filled alike, so the plan works on counts: all
sequences with the same room take their copies of a length in one step. The
plan is a list of slots (length, ranks, sequences, place), and documents find
theirs by joining on the length and their rank within it.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator, Mapping
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from huntlake.llm.common import per_batch, ranked, saved
from huntlake.llm.word_tokens import ids_of

CAPACITY = 4096
END = 1
#: Pieces of a length that are ranked in one go.
RANKED_ROWS = 100_000
#: Tokens handed on at a time.
BATCH_TOKENS = 1 << 21


class Slot(NamedTuple):
    """Ranks ``low`` to ``high`` of a length, ``copies`` to a sequence, from sequence ``first`` on, at ``place``."""

    length: int
    low: int
    high: int
    copies: int
    first: int
    place: int


def plan(histogram: Mapping[int, int], capacity: int = CAPACITY) -> Iterator[Slot]:
    """The slots of best fit by falling length; every rank of every length is in one slot."""
    if any(not 0 < length <= capacity for length in histogram):
        raise ValueError("a piece has no token, or more than a sequence holds")
    open_rooms: list[int] = []  # rising
    filled: dict[int, list[tuple[int, int]]] = defaultdict(list)  # room -> (first sequence, sequences)
    sequences = 0

    def add(room: int, first: int, count: int) -> None:
        if count and room:
            if room not in filled:
                insort(open_rooms, room)
            filled[room].append((first, count))

    for length in sorted(histogram, reverse=True):
        rank, total = 0, histogram[length]
        while rank < total:
            at = bisect_left(open_rooms, length)
            if at < len(open_rooms):
                room = open_rooms[at]
                first, count = filled[room].pop()
                if not filled[room]:
                    del filled[room], open_rooms[at]
            else:
                room, first, count = capacity, sequences, -(-(total - rank) // (capacity // length))
                sequences += count
            copies = room // length
            full, over = divmod(min(total - rank, count * copies), copies)
            if full:
                yield Slot(length, rank, rank + full * copies, copies, first, capacity - room)
                add(room - copies * length, first, full)
                rank += full * copies
            if over:
                yield Slot(length, rank, rank + over, over, first + full, capacity - room)
                add(room - over * length, first + full, 1)
                rank += over
            used = full + (over > 0)
            add(room, first + used, count - used)


def pieces(docs: DataFrame, capacity: int, vocabulary: str | None, end: int, keep_ids: bool) -> DataFrame:
    """The pieces of each document: one, or, where it is longer than a sequence, full ones and a last one."""
    columns = "doc_id long, piece int, start long, length int, ids_crc32 long" + ", ids array<int>" * keep_ids
    names = [column.split()[0] for column in columns.split(", ")]
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64()]

    def make(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        rows, kept, tokens = [], [], 0

        def out() -> pa.RecordBatch:
            arrays = [pa.array(column, kind) for column, kind in zip(zip(*rows) if rows else [[]] * 5, kinds)]
            return pa.RecordBatch.from_arrays(arrays + [pa.array(kept, pa.list_(pa.int32()))] * keep_ids, names)

        found, bounds = ids_of(batch.column(1), vocabulary)
        for at, doc_id in enumerate(batch.column(0).to_pylist()):
            ids = np.append(found[bounds[at] : bounds[at + 1]], np.uint32(end))
            for number, start in enumerate(range(0, len(ids), capacity)):
                piece = ids[start : start + capacity]
                rows.append((doc_id, number, start, len(piece), zlib.crc32(piece.tobytes())))
                if keep_ids:
                    kept.append(piece.view("<i4"))
            tokens += len(ids)
            if tokens >= BATCH_TOKENS:
                yield out()
                rows, kept, tokens = [], [], 0
        yield out()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(per_batch(make), columns)


def pack(
    docs: DataFrame,
    capacity: int = CAPACITY,
    vocabulary: str | None = None,
    end: int = END,
    keep_ids: bool = False,
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ids).

    A document is its ids and ``end``; a NULL or empty text is ``end`` alone.
    Only a document longer than ``capacity`` is cut, and only its last piece may
    be shorter. The pieces of a sequence follow each other from offset 0.
    Equal rows are packed each for itself, a NULL doc_id like any other, and no
    row gives no piece. Other columns are not read.
    """
    spark = docs.sparkSession
    cut = saved(pieces(docs, capacity, vocabulary, end, keep_ids), "pieces")
    histogram = {row["length"]: row["count"] for row in cut.groupBy("length").count().collect()}
    # the plan follows from the histogram, so its size is bounded by the capacity and not by the documents
    slots = spark.createDataFrame(
        [tuple(slot) for slot in plan(histogram, capacity)],
        "of int, low long, high long, copies long, first long, place long",
    )
    parts = max(1, -(-max(histogram.values(), default=0) // RANKED_ROWS))
    order = ["doc_id", "piece", "ids_crc32"]
    found = ranked(cut, "length", order, "rank", max(parts, 16)).join(
        F.broadcast(slots),
        (F.col("length") == F.col("of")) & (F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high")),
    )
    within = F.col("rank") - F.col("low")
    return found.select(
        "doc_id",
        "piece",
        "start",
        F.col("length").cast("long").alias("length"),
        "ids_crc32",
        (F.col("first") + F.expr("(rank - low) div copies")).alias("sequence_id"),
        (F.col("place") + within % F.col("copies") * F.col("length")).alias("offset"),
        *["ids"] * keep_ids,
    )
