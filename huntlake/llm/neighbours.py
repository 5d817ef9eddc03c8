"""Approximate nearest neighbours: a hash-prefix forest.

Each tree gives a vector a string of hash bits and keeps the strings of its
rows in a sorted array. A query descends to the rows with which it shares the
longest prefix, and then ascends in all trees at once, a bit at a time, so that
ever more rows share its shorter prefix. Distances are exact.

The rows are dealt into blocks of bounded size, each with a forest of its own,
and every query visits every block; how far it ascends is settled for all
blocks together. A first pass ascends until each block has given ``FIRST``
rows. The nearest found tell how often their hash bits agree with the query's,
and so the prefix length at which a row that near is in one of the trees with
probability ``CERTAIN``; a second pass ascends to it.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from huntlake.llm.common import saved

TREES = 64
BITS = 24
NEAREST = 10
FIRST = 400
CERTAIN = 0.97
#: Rows and queries of a block.
ROWS, QUERIES = 1 << 14, 1 << 12
SEED = 7
#: The hyperplanes' thresholds are medians over about this many rows, chosen by hash.
SAMPLE = 2000

FOUND = "query_id long, vec_id long, score double, agree double"


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, embedding as doubles) of the rows that take part: an id, and only finite numbers, not all zero."""
    numbers = F.col("embedding").cast("array<double>")
    fine = F.forall(numbers, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.where(F.col("vec_id").isNotNull() & fine & F.exists(numbers, lambda x: x != 0)).select(
        F.col("vec_id").cast("long"), numbers.alias("embedding")
    )


def matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    flat = column.combine_chunks()
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


class Trees:
    """The hash functions of all trees for vectors of one length."""

    def __init__(self, width: int, medians: np.ndarray | None = None, trees: int = TREES, bits: int = BITS):
        self.trees, self.bits = trees, bits
        self.planes = np.random.default_rng(SEED + width).standard_normal((trees, width, bits))
        self.medians = np.zeros((trees, bits)) if medians is None else medians

    def strings(self, rows: np.ndarray, tree: int) -> np.ndarray:
        """The hash strings of the rows, the first bit the highest."""
        on = rows @ self.planes[tree] > self.medians[tree]
        return on @ (1 << np.arange(self.bits - 1, -1, -1))


def fit(rows: DataFrame, total: int) -> dict[int, np.ndarray]:
    """The thresholds for each length of vectors, from a sample of about ``SAMPLE`` rows."""
    draw = F.pmod(F.xxhash64(F.lit("sample"), "vec_id"), F.lit(1_000_000)) * max(total, 1) < SAMPLE * 1_000_000
    sample = rows.where(draw).select("embedding").limit(4 * SAMPLE).toArrow().column(0).to_pylist()
    found = {}
    for width in {len(one) for one in sample}:
        some = np.array([one for one in sample if len(one) == width])
        found[width] = np.array([np.median(some @ planes, axis=0) for planes in Trees(width).planes])
    return found


def nearest_in_block(
    ids: np.ndarray, rows: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, levels: np.ndarray | None, trees: Trees
) -> list[tuple[int, int, float, float]]:
    """The nearest rows of a block for each query, with the share of hash bits that agree.

    ``levels`` are the prefix lengths to ascend to; without them each query
    ascends until ``FIRST`` rows share a prefix with it.
    """
    strings = [trees.strings(rows, tree) for tree in range(trees.trees)]
    asked = [trees.strings(queries, tree) for tree in range(trees.trees)]
    orders = [np.argsort(one, kind="stable") for one in strings]
    arrays = [one[order] for one, order in zip(strings, orders)]

    def ranges(level: np.ndarray | int) -> tuple[np.ndarray, np.ndarray]:
        """Where the rows lie that share the query's first ``level`` bits: from, to, by tree and query."""
        span = np.left_shift(1, trees.bits - level)
        low = [np.searchsorted(array, one // span * span) for array, one in zip(arrays, asked)]
        high = [np.searchsorted(array, one // span * span + span) for array, one in zip(arrays, asked)]
        return np.array(low), np.array(high)

    if levels is None:
        levels = np.zeros(len(queries), np.int64)
        waiting = np.ones(len(queries), bool)
        for level in range(trees.bits, 0, -1):  # all trees ascend together
            low, high = ranges(level)
            enough = waiting & ((high - low).sum(axis=0) >= FIRST)
            levels[enough] = level
            waiting &= ~enough
            if not waiting.any():
                break
    low, high = ranges(levels)
    out = []
    for q, query in enumerate(queries):
        near = np.zeros(len(rows), bool)
        for tree, order in enumerate(orders):
            near[order[low[tree, q] : high[tree, q]]] = True
        near &= ids != query_ids[q]
        at = np.flatnonzero(near)
        distance = np.sqrt(((rows[at] - query) ** 2).sum(axis=1))
        order = np.lexsort((ids[at], distance))
        fresh = np.ones(len(order), bool)  # a vec_id that is stored several times takes one place for each distance
        fresh[1:] = (np.diff(ids[at][order]) != 0) | (np.diff(distance[order]) != 0)
        for i in order[fresh][:NEAREST]:
            row = at[i]
            differ = sum(int(strings[t][row] ^ asked[t][q]).bit_count() for t in range(trees.trees))
            out.append((int(query_ids[q]), int(ids[row]), float(distance[i]), 1 - differ / (trees.trees * trees.bits)))
    return out


def _visit(rows: DataFrame, queries: DataFrame, medians: dict[int, np.ndarray], blocks: int, parts: int) -> DataFrame:
    """Every query in every block: (query_id, vec_id, score, agree) of the nearest in each."""

    def make(left: pa.Table, right: pa.Table) -> pa.Table:
        found = []
        if len(left) and len(right):
            width = left.column("width")[0].as_py()
            levels = right.column("level").to_numpy()
            found = nearest_in_block(
                left.column("vec_id").to_numpy(),
                matrix(left.column("embedding"), width),
                right.column("query_id").to_numpy(),
                matrix(right.column("query"), width),
                None if levels[0] < 0 else levels.astype(np.int64),
                Trees(width, medians.get(width)),
            )
        names = ("query_id", "vec_id", "score", "agree")
        kinds = (pa.int64(), pa.int64(), pa.float64(), pa.float64())
        columns = zip(*found) if found else [[]] * 4
        return pa.table({name: pa.array(column, kind) for name, column, kind in zip(names, columns, kinds)})

    left = rows.select(
        F.size("embedding").alias("width"),
        F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).alias("block"),
        F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"),
        "vec_id",
        "embedding",
    )
    right = queries.select(
        F.size("query").alias("width"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block"),
        F.pmod(F.xxhash64("query_id"), F.lit(parts)).cast("int").alias("part"),
        "query_id",
        "query",
        "level",
    )
    keys = ("width", "block", "part")
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(make, FOUND)


def _best(found: DataFrame) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.distinct().withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= NEAREST)


def nearest(vectors: DataFrame, is_query: str) -> DataFrame:
    """(query_id, rank, vec_id, score): the nearest rows found for each row for which ``is_query`` holds.

    Rank 1 is the nearest by Euclidean distance, ties go to the smaller vec_id,
    and there are fewer than ``NEAREST`` ranks only where there are fewer
    candidates. A row is no candidate for a query of its own vec_id. Vectors
    that are NULL, zero or hold a NULL or non-finite number take no part, and
    vectors of different lengths never meet. Rows that repeat a vec_id and a
    distance count once. Other columns are not read.
    """
    rows = saved(usable(vectors), "vectors")
    asked = rows.where(is_query).select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query"))
    total, questions = rows.count(), asked.count()
    blocks, parts = max(1, -(-total // ROWS)), max(1, -(-questions // QUERIES))
    medians = fit(rows, total)
    first = saved(_visit(rows, asked.withColumn("level", F.lit(-1)), medians, blocks, parts), "nearest")
    # the farthest of the first neighbours sets the prefix that one of the trees shares with probability CERTAIN
    miss = 1 - (1 - CERTAIN) ** (1 / TREES)
    agree = F.greatest(F.least(F.min("agree"), F.lit(0.999)), F.lit(0.01))
    level = F.greatest(F.least(F.floor(F.lit(math.log(miss)) / F.log(agree)), F.lit(BITS)), F.lit(0)).cast("int")
    # fewer than the ranks asked for: look at all rows
    level = F.when(F.count(F.lit(1)) < NEAREST, F.lit(0)).otherwise(level)
    levels = _best(first).groupBy("query_id").agg(level.alias("level"))
    again = asked.join(levels, "query_id", "left").withColumn("level", F.coalesce("level", F.lit(0)))
    second = _visit(rows, again, medians, blocks, parts)
    return _best(first.unionByName(second).drop("agree")).select("query_id", F.col("rank").cast("int"), "vec_id", "score")
