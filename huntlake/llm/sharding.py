"""Sharding: a uniform shuffle into shards of exact sizes, by a hypergeometric communication matrix.

Rows are dealt by hash into partitions. How many rows of each partition go to
each shard is drawn at once from the law that a uniform shuffle would give, a
multivariate hypergeometric one with the shards' sizes as totals. Each
partition permutes its rows and hands the drawn numbers out in order; each
shard permutes what it receives.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from huntlake.llm.common import ranked, saved

SHARDS = 24
#: Partitions, hence rows of the matrix: its size on the driver is PARTITIONS x SHARDS numbers.
PARTITIONS = 256
SEED = 20240607
#: Copies of one row that are numbered at a time.
COPIES = 1 << 16
#: Standard deviations around the mode that are drawn from; what lies beyond is below the precision of a double.
SPREAD = 12


def hypergeometric(good: int, bad: int, draws: int, rng: np.random.Generator) -> int:
    """How many of ``draws`` balls are good, drawn without return; totals of any size."""
    low, high = max(0, draws - bad), min(draws, good)
    if low == high:
        return low
    total = good + bad
    share = good / total
    deviation = math.sqrt(draws * share * (1 - share) * (total - draws) / max(total - 1, 1))
    mode = (draws + 1) * (good + 1) // (total + 2)
    reach = int(SPREAD * deviation) + 30
    k = np.arange(max(low, mode - reach), min(high, mode + reach), dtype=float)
    steps = np.log(good - k) + np.log(draws - k) - np.log(k + 1) - np.log(bad - draws + k + 1)
    weight = np.append(0.0, np.cumsum(steps))
    weight = np.cumsum(np.exp(weight - weight.max()))
    return max(low, mode - reach) + int(np.searchsorted(weight, rng.random() * weight[-1], side="right"))


def communication_matrix(counts: list[int], sizes: list[int], seed: int = SEED) -> list[list[int]]:
    """Rows: how many rows of each partition go to each shard. Row sums are ``counts``, column sums ``sizes``."""
    if sum(counts) != sum(sizes):
        raise ValueError("the shards must hold all rows")
    rng, left, matrix = np.random.default_rng(seed), list(sizes), []
    for count in counts:
        row, rest = [], sum(left)
        for size in left:
            row.append(hypergeometric(size, rest - size, count - sum(row), rng))
            rest -= size
        left = [size - sent for size, sent in zip(left, row)]
        matrix.append(row)
    return matrix


def shuffled(rows: DataFrame, shards: int = SHARDS, partitions: int = PARTITIONS, seed: int = SEED) -> DataFrame:
    """``rows`` with ``shard`` (0 to ``shards`` - 1, counts at most one apart) and ``slot`` (from 0, without gaps).

    Every assignment of rows to slots is as likely as any other. The draw
    depends on the rows and the seed alone, so a repeated task repeats it.
    Equal rows are numbered and take part each for itself. NULLs are values
    like others. The columns of ``rows`` must be of types that can be grouped.
    """
    names = rows.columns
    if {"shard", "slot"} & set(names):
        raise ValueError("shard and slot are given by the shuffle")
    several = rows.groupBy(*names).agg(F.count(F.lit(1)).alias("_n"))
    several = several.withColumn("_lot", F.explode(F.expr(f"sequence(0L, (_n - 1) div {COPIES})")))
    several = several.withColumn(
        "_copy", F.explode(F.expr(f"sequence(_lot * {COPIES}, least(_n, (_lot + 1) * {COPIES}) - 1)"))
    )
    keyed = several.select(
        *names,
        "_copy",
        F.xxhash64(F.lit(seed), F.lit("first"), *names, "_copy").alias("_first"),
        F.xxhash64(F.lit(seed), F.lit("second"), *names, "_copy").alias("_second"),
    ).withColumn("_partition", F.pmod("_first", F.lit(partitions)).cast("int"))
    keyed = saved(keyed, "dealt")

    found = {row["_partition"]: row["count"] for row in keyed.groupBy("_partition").count().collect()}
    counts = [found.get(partition, 0) for partition in range(partitions)]
    total = sum(counts)
    sizes = [total // shards + (shard < total % shards) for shard in range(shards)]
    ends = [
        (partition, np.cumsum(row).tolist())
        for partition, row in enumerate(communication_matrix(counts, sizes, seed))
    ]
    matrix = keyed.sparkSession.createDataFrame(ends, "_of int, _ends array<long>")

    local = Window.partitionBy("_partition").orderBy("_first", *names, "_copy")
    placed = (
        keyed.withColumn("_place", F.row_number().over(local) - 1)
        .join(F.broadcast(matrix), F.col("_partition") == F.col("_of"))  # partitions x shards numbers
        .withColumn("shard", F.size(F.filter("_ends", lambda end: end <= F.col("_place"))))
        .select(*names, "_copy", "_second", "shard")
    )
    return ranked(placed, "shard", ["_second", *names, "_copy"], "slot").select(*names, "shard", "slot")


def document_rows(docs: DataFrame) -> DataFrame:
    """(doc_id, size, text_crc32) of each document; a NULL text counts as empty."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        F.col("doc_id").cast("long"),
        (F.octet_length(text) + F.lit(8)).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
