"""Vector code compression: codebooks for the parts of vectors, trained by Lloyd's rounds where the members live.

A member is a distinct part with the number of vectors that hold it. Members
are written once into files by (position, entry, salt), where salts split
entries with many members. An entry's owner adds up its resident members inside
their tasks, and only the sums travel. After the update each task compares its
residents with the new codebook of their position: members that keep their
entry are written where they are, and only those that change it go through the
shuffle to the files of their new entry.

The codebooks are bounded by parameters and are all that reaches the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from huntlake.llm.common import saved
from huntlake.llm.vectors import finite, floor_mean, integers, matrix
from huntlake.sinks.shared import fresh_folder

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024
#: Members of an entry that one salt stands for.
RESIDENTS = 1000
#: Parts that are compared with a codebook at a time.
ROWS = 4096
#: Below this, sums of whole numbers are exact in floating point.
EXACT = float(1 << 53)

MEMBER = "position int, part array<int>, weight long, entry int"


def nearest(x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest entry of each part, ties to the lower index, and the exact squared distance."""
    entry, error = np.empty(len(x), np.int64), np.empty(len(x), np.int64)
    largest = max(np.abs(x).max(initial=0), np.abs(book).max(initial=0))
    kind = np.float64 if x.shape[1] * (2.0 * largest) ** 2 < EXACT else np.int64
    entries = book.astype(kind)
    size = np.einsum("ij,ij->i", entries, entries)
    for at in range(0, len(x), ROWS):
        some = x[at : at + ROWS].astype(kind)
        apart = np.einsum("ij,ij->i", some, some)[:, None] - 2 * (some @ entries.T) + size
        entry[at : at + ROWS] = apart.argmin(axis=1)
        error[at : at + ROWS] = apart.min(axis=1)
    return entry, error


def members(vectors: DataFrame, parts: int, width: int) -> DataFrame:
    """(position, part, weight): the distinct parts of all vectors; copies are added up before they are moved."""
    pieces = F.array(*[F.slice("v", at * width + 1, width) for at in range(parts)])
    placed = vectors.select(F.posexplode(pieces).alias("position", "part"))
    return placed.groupBy("position", "part").agg(F.count(F.lit(1)).alias("weight"))


def assigned(residents: DataFrame, books: np.ndarray) -> DataFrame:
    """Each member with its nearest entry, and whether that is another than its ``entry`` before."""
    width = books.shape[2]

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            position = batch.column(0).to_numpy(zero_copy_only=False)
            x, before = matrix(batch.column(1), width), batch.column(3).to_numpy(zero_copy_only=False)
            entry = np.empty(len(x), np.int64)
            for at in np.unique(position):
                own = position == at
                entry[own] = nearest(x[own], books[at])[0]
            changed = pa.array(entry != before).cast(pa.int32())
            columns = [*batch.columns[:3], pa.array(entry, pa.int32()), changed]
            yield pa.RecordBatch.from_arrays(columns, ["position", "part", "weight", "entry", "changed"])

    return residents.mapInArrow(make, f"{MEMBER}, changed int")


def settled(moving: DataFrame, counts: dict[tuple[int, int], int]) -> DataFrame:
    """The members written into the files of their owners; entries with many members have many owners."""
    spark = moving.sparkSession
    owners = [(position, entry, -(-count // RESIDENTS)) for (position, entry), count in counts.items()]
    salts = spark.createDataFrame(owners, "position int, entry int, salts int")
    # at most a row for each entry of each position
    salted = moving.join(F.broadcast(salts), ["position", "entry"], "left")
    salt = F.pmod(F.xxhash64("part"), F.coalesce("salts", F.lit(1)))
    return saved(salted.repartition("position", "entry", salt).select("position", "part", "weight", "entry"), "members")


def counted(residents: DataFrame) -> dict[tuple[int, int], int]:
    found = residents.groupBy("position", "entry").agg(F.count(F.lit(1)).alias("members")).collect()
    return {(row["position"], row["entry"]): row["members"] for row in found}


def updated(residents: DataFrame, books: np.ndarray) -> tuple[np.ndarray, dict[tuple[int, int], int]]:
    """The codebooks with each entry at the floor of its members' mean, and the number of members of each entry."""
    width = books.shape[2]
    weight = F.col("weight").cast("decimal(20,0)")
    sums = [F.sum(F.col("part")[at] * weight).alias(f"s{at}") for at in range(width)]
    owned = residents.groupBy("position", "entry").agg(
        F.count(F.lit(1)).alias("members"), F.sum("weight").alias("weight"), *sums
    )
    after, counts = books.copy(), {}
    for row in owned.collect():
        key = (row["position"], row["entry"])
        after[key] = [floor_mean(row[f"s{at}"], row["weight"]) for at in range(width)]
        counts[key] = row["members"]
    return after, counts


def train(vectors: DataFrame, width: int, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray:
    """Codebooks (position, entry, component) of the vectors (vec_id, v) of ``parts`` times ``width`` integers."""
    spark = vectors.sparkSession
    first = vectors.where("vec_id is not null").orderBy("vec_id", "v").limit(entries).collect()
    if not first:
        return np.zeros((parts, 0, width), np.int64)
    books = np.array([row["v"] for row in first], np.int64).reshape(len(first), parts, width).transpose(1, 0, 2).copy()
    fresh = members(vectors, parts, width).withColumn("entry", F.lit(-1))
    began = saved(assigned(fresh, books).drop("changed"), "members")
    residents = settled(began, counted(began))
    for turn in range(rounds):
        after, counts = updated(residents, books)
        if turn == rounds - 1 or (after == books).all():
            return after
        books = after
        path = fresh_folder(spark, "members")
        assigned(residents, books).write.partitionBy("changed").parquet(path)
        told = spark.read.schema(f"{MEMBER}, changed int").parquet(path)
        stay, go = (told.where(F.col("changed") == flag).drop("changed") for flag in (0, 1))
        residents = stay.union(settled(go, counts))
    return books


def encode(vectors: DataFrame, books: np.ndarray) -> DataFrame:
    """(vec_id, label, code, error) of every vector; NULL where it has not as many components as the codebooks."""
    parts, count, width = books.shape

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = np.flatnonzero(batch.column(2).is_valid().to_numpy(zero_copy_only=False))
            x = matrix(batch.column(2), parts * width)
            found = [nearest(x[:, at * width : (at + 1) * width], books[at]) for at in range(parts)]
            digits = np.stack([entry for entry, _ in found], axis=1).astype(np.uint8)
            code, error = [None] * batch.num_rows, [None] * batch.num_rows
            for row, digit, off in zip(held.tolist(), digits, sum(error for _, error in found).tolist()):
                code[row], error[row] = digit.tobytes().hex(), off
            columns = [*batch.columns[:2], pa.array(code, pa.string()), pa.array(error, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "label", "code", "error"])

    fitting = F.when(F.size("v") == (parts * width if count else -1), F.col("v"))
    kinds = f"vec_id long, label {vectors.schema['label'].dataType.simpleString()}, code string, error long"
    return vectors.select("vec_id", "label", fitting.alias("v")).mapInArrow(make, kinds)


def compress(
    rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE
) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, label, code, error) of the vectors that take part, and the codebooks.

    Vectors that are NULL or hold a NULL or non-finite component are dropped; a
    component of ``MOST`` / ``scale`` or more raises. The vectors' length is
    the most frequent one that ``parts`` divides, ties to the longer; vectors of
    another length get a NULL code and error. Rows without an id are coded but
    start no entry; rows that share an id count each, ordered by their
    integers. With fewer rows than ``entries`` the codebooks are smaller. Other
    columns are not read.
    """
    if not 1 <= entries <= 256:
        raise ValueError("a code has two hexadecimal digits: 1 to 256 entries")
    kept = rows.where(finite(F.col("embedding")))
    vectors = kept.select(F.col("vec_id").cast("long").alias("vec_id"), "label", integers(F.col("embedding"), scale).alias("v"))
    sizes = kept.groupBy(F.size("embedding").alias("n")).count().where((F.col("n") > 0) & (F.col("n") % parts == 0))
    common = sizes.orderBy(F.desc("count"), F.desc("n")).first()
    width = common["n"] // parts if common else 1
    fitting = vectors.where(F.size("v") == parts * width if common else F.lit(False)).select("vec_id", "v")
    books = train(fitting, width, parts, entries, rounds)
    return encode(vectors, books), books


def digest(books: np.ndarray) -> str:
    """Hash of all components by position, entry and place."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def summarised(coded: DataFrame, books: np.ndarray) -> DataFrame:
    """Add the sum of errors over rows of one label, NULL labels together, and the hash of the codebooks."""
    coded = saved(coded, "codes")
    totals = coded.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "of")
    joined = coded.join(totals, F.col("label").eqNullSafe(F.col("of")))
    return joined.select("vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))
