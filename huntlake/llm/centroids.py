"""Centroid clustering: Lloyd's rounds in integers, with centroids ruled out by PCA-rotated coordinates.

Every vector is stored once with its integers, its ``LEAD`` leading coordinates
in the basis of the principal components, and the norm of the rest. For a
vector x and a centroid c with leading coordinates y, z and rest norms r, s

    |y - z|^2 + (r - s)^2  <=  |x - c|^2,

since the rests lie in one subspace and differ in length by |r - s| already. A
round measures the centroid of the least bound in integers, and then, in
integers too, every other one whose bound is not above that distance. Floating
point decides with a margin what is measured, and nothing else.

Each task adds up its own vectors by cluster, so a round moves one row per
task, cluster and component, and a cluster of a third of all rows costs no more
than any other. What reaches the driver is the centroids and the products of
components, both bounded by parameters.
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

DIMS = 64
CLUSTERS = 40
ROUNDS = 5
SCALE = 256
SALT = "2:"
#: Leading coordinates that are stored.
LEAD = 16
#: Share of the squared norms that a bound may be off by in floating point; the true error is some 1e-14.
MARGIN = 1e-9
#: Vectors that are compared at a time, and pairs that are measured at a time.
ROWS, PAIRS = 4096, 1 << 14

OUTPUT = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"


def principal(vectors: DataFrame, dims: int) -> tuple[np.ndarray, np.ndarray] | None:
    """Mean and principal components (columns, the strongest first) of all vectors; None if there are none."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total, products = 0, np.zeros(dims), np.zeros((dims, dims))
        for batch in batches:
            x = matrix(batch.column(0), dims, np.float64)
            count, total, products = count + len(x), total + x.sum(axis=0), products + x.T @ x
        if count:
            values = np.concatenate([[count], total, products.ravel()])
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(values))), pa.array(values)], ["at", "value"])

    parts = vectors.select("v").mapInArrow(make, "at long, value double")
    found = parts.groupBy("at").agg(F.sum("value").alias("value")).toArrow()
    if not found.num_rows:
        return None
    values = np.zeros(1 + dims + dims * dims)
    values[found.column("at").to_numpy()] = found.column("value").to_numpy()
    mean = values[1 : 1 + dims] / values[0]
    spread = values[1 + dims :].reshape(dims, dims) / values[0] - np.outer(mean, mean)
    return mean, np.linalg.eigh(spread)[1][:, ::-1]


def rotated(x: np.ndarray, mean: np.ndarray, basis: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Leading coordinates, and the norm of what they leave."""
    centred = x - mean
    lead = centred @ basis
    return lead, np.linalg.norm(centred - lead @ basis.T, axis=1)


def stored(vectors: DataFrame, mean: np.ndarray, basis: np.ndarray) -> DataFrame:
    """(vec_id, v, lead, rest) of every vector."""
    dims = len(mean)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                lead, rest = rotated(matrix(batch.column(1), dims, np.float64), mean, basis)
                leads = pa.FixedSizeListArray.from_arrays(pa.array(lead.ravel()), lead.shape[1]).cast(pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([*batch.columns, leads, pa.array(rest)], ["vec_id", "v", "lead", "rest"])

    return vectors.mapInArrow(make, "vec_id long, v array<int>, lead array<double>, rest double")


class Centroids:
    """Integer centroids with their bounds' coordinates."""

    def __init__(self, whole: np.ndarray, mean: np.ndarray, basis: np.ndarray):
        self.whole = whole
        self.lead, self.rest = rotated(whole.astype(np.float64), mean, basis)

    def distances(self, x: np.ndarray, which: np.ndarray) -> np.ndarray:
        """The exact squared distance of each vector to the centroid named for it."""
        found = np.empty(len(x), np.int64)
        for at in range(0, len(x), PAIRS):
            apart = x[at : at + PAIRS] - self.whole[which[at : at + PAIRS]]
            found[at : at + PAIRS] = np.einsum("ij,ij->i", apart, apart)
        return found

    def bounds(self, lead: np.ndarray, rest: np.ndarray) -> np.ndarray:
        """No more than the squared distance of each vector to each centroid."""
        size, own = np.einsum("ij,ij->i", lead, lead), np.einsum("ij,ij->i", self.lead, self.lead)
        near = size[:, None] - 2 * (lead @ self.lead.T) + own + (rest[:, None] - self.rest) ** 2
        return near - MARGIN * ((size + rest**2)[:, None] + own + self.rest**2)

    def nearest(self, x: np.ndarray, lead: np.ndarray, rest: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """The nearest centroid of each vector, ties to the smaller number, its distance, and how many pairs were measured."""
        bounds = self.bounds(lead, rest)
        each = np.arange(len(x))
        first = bounds.argmin(axis=1)
        distance = self.distances(x, first)
        left = bounds <= distance[:, None]
        left[each, first] = False
        rows, others = np.nonzero(left)
        found = np.concatenate([distance, np.empty(len(rows), np.int64)])
        for at in range(0, len(rows), PAIRS):
            some = rows[at : at + PAIRS]
            found[len(x) + at : len(x) + at + len(some)] = self.distances(x[some], others[at : at + PAIRS])
        rows, others = np.concatenate([each, rows]), np.concatenate([first, others])
        order = np.lexsort((others, found, rows))
        order = order[np.searchsorted(rows[order], each)]
        return others[order], found[order], len(rows)


def _per_slice(batches: Iterator[pa.RecordBatch], centroids: Centroids) -> Iterator[tuple]:
    """(batch, integers, clusters, distances) of a few thousand vectors at a time; columns vec_id, v, lead, rest."""
    dims = centroids.whole.shape[1]
    for whole in batches:
        for at in range(0, whole.num_rows, ROWS):
            batch = whole.slice(at, ROWS)
            x = matrix(batch.column(1), dims)
            lead = matrix(batch.column(2), centroids.lead.shape[1], np.float64)
            rest = batch.column(3).to_numpy(zero_copy_only=False)
            yield batch, x, *centroids.nearest(x, lead, rest)[:2]


def moved(vectors: DataFrame, centroids: Centroids) -> np.ndarray:
    """The centroids after a round: floor of the mean of each cluster; an empty one stays."""
    count, dims = centroids.whole.shape

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals, sizes = np.zeros((count, dims), np.int64), np.zeros(count, np.int64)
        for _, x, cluster, _ in _per_slice(batches, centroids):
            order = np.argsort(cluster, kind="stable")
            found, starts = np.unique(cluster[order], return_index=True)
            totals[found] += np.add.reduceat(x[order], starts, axis=0)
            sizes += np.bincount(cluster, minlength=count)
        held = np.flatnonzero(sizes)
        rows = [np.repeat(held, dims), np.tile(np.arange(dims), len(held)), totals[held].ravel(), np.repeat(sizes[held], dims)]
        yield pa.RecordBatch.from_arrays([pa.array(row, pa.int64()) for row in rows], ["cluster", "at", "total", "size"])

    parts = vectors.mapInArrow(make, "cluster long, at long, total long, size long")
    wide = [F.sum(F.col(name).cast("decimal(20,0)")).alias(name) for name in ("total", "size")]
    after = centroids.whole.copy()
    for row in parts.groupBy("cluster", "at").agg(*wide).collect():
        after[row["cluster"], row["at"]] = floor_mean(row["total"], row["size"])
    return after


def cluster(
    rows: DataFrame,
    clusters: int = CLUSTERS,
    rounds: int = ROUNDS,
    dims: int = DIMS,
    scale: int = SCALE,
    salt: str = SALT,
    lead: int = LEAD,
) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, cluster, distance) of the vectors that take part, and the final centroids.

    Vectors that are NULL, of another length than ``dims``, or that hold a NULL
    or non-finite component take no part; one with a component of ``MOST`` /
    ``scale`` or more raises. The centroids start as the vectors with the
    smallest sha256 of ``salt`` and id, all of them where there are fewer; rows
    without an id are assigned but start none, and rows that share an id count
    each, ordered by their integers. No vector at all gives no row. Other
    columns are not read.
    """
    given = rows.where(F.col("vec_id").isNotNull() | F.col("embedding").isNotNull())
    taking = given.where(finite(F.col("embedding")) & (F.size("embedding") == dims))
    vectors = taking.select(F.col("vec_id").cast("long").alias("vec_id"), integers(F.col("embedding"), scale).alias("v"))
    found = principal(vectors, dims)
    named = F.sha2(F.concat(F.lit(salt), F.col("vec_id").cast("string")).cast("binary"), 256)
    first = vectors.where("vec_id is not null").select(named.alias("hash"), "v").orderBy("hash", "v").limit(clusters).collect()
    if found is None or not first:
        return rows.sparkSession.createDataFrame([], "vec_id long, cluster int, distance long"), np.zeros((0, dims), np.int64)
    mean, basis = found[0], np.ascontiguousarray(found[1][:, :lead])
    table = saved(stored(vectors, mean, basis), "rotated")
    whole = np.array([row["v"] for row in first], np.int64)
    for _ in range(rounds):
        after = moved(table, Centroids(whole, mean, basis))
        if (after == whole).all():
            break
        whole = after
    last = Centroids(whole, mean, basis)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, _, near, distance in _per_slice(batches, last):
            columns = [batch.column(0), pa.array(near, pa.int32()), pa.array(distance)]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "cluster", "distance"])

    return table.mapInArrow(make, "vec_id long, cluster int, distance long"), whole


def summarised(assigned: DataFrame, centroids: np.ndarray) -> DataFrame:
    """Add to each row the sum of distances of its cluster and of all, and the hash of its centroid."""
    spark = assigned.sparkSession
    assigned = saved(assigned, "assigned")
    sums = {
        row["cluster"]: int(row["total"])
        for row in assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(20,0)")).alias("total")).collect()
    }
    told = [
        (number, total, sum(sums.values()), hashlib.sha256(",".join(map(str, centroids[number])).encode()).hexdigest())
        for number, total in sums.items()
    ]
    totals = spark.createDataFrame(told, "number int, cluster_inertia long, inertia long, centroid_sha256 string")
    joined = assigned.join(F.broadcast(totals), F.col("cluster") == F.col("number"))  # a row for each cluster
    return joined.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
