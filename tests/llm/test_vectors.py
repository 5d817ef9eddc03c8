"""Centroid clustering and vector codes against plain Python on small tables, and against SQL on the given one."""

from __future__ import annotations

import hashlib
import math
import random
from collections import defaultdict

import numpy as np
import pytest
from compare import run_query, run_sql

from huntlake.llm import centroids, codes, queries
from huntlake.llm.vectors import MOST

SCHEMA = "vec_id long, embedding array<double>, label int, cluster int, v int, entry int, of int, number int"


def table(spark, rows):
    """(vec_id, embedding, label) with further columns whose names the operators use themselves."""
    return spark.createDataFrame([(*row, 7, 7, 7, 7, 7) for row in rows], SCHEMA)


def vectors(seed, count, dims, spread, ids=None):
    draw = random.Random(seed)
    centres = [[draw.gauss(0, 1) for _ in range(dims)] for _ in range(6)]
    made = []
    for number in range(count):
        centre = draw.choice(centres)
        vector = [round(x + draw.gauss(0, spread), 2) for x in centre]
        made.append((number if ids is None else draw.randrange(ids), vector, draw.choice([None, 1, 2])))
    return made


ODD = [
    (901, None, 1),
    (902, [], 1),
    (903, [math.nan] * 4, 1),
    (904, [1.0, math.inf, 0.0, 0.0], None),
    (905, [1.0, None, 0.0, 0.0], 2),
    (None, [0.5, 0.25, -0.5, -0.25], None),
    (None, None, None),
    (906, [1.0, 2.0], 2),
    (907, [0.0, 0.0, 0.0, 0.0], 1),
    (907, [0.0, 0.0, 0.0, 0.0], 1),
    (907, [3.0, -3.0, 3.0, -3.0], 1),
]


def scaled(vector, scale):
    if vector is None or any(x is None or not math.isfinite(x) for x in vector):
        return None
    return tuple(math.floor(scale * x) for x in vector)


def apart(a, b):
    return sum((x - y) ** 2 for x, y in zip(a, b))


def lloyd(points, starts, rounds):
    """Assignments after ``rounds`` updates, and the centroids; points may repeat."""
    current = [tuple(start) for start in starts]
    for turn in range(rounds + 1):
        near = [min(range(len(current)), key=lambda i: (apart(point, current[i]), i)) for point in points]
        if turn == rounds:
            return near, current
        held = defaultdict(list)
        for point, at in zip(points, near):
            held[at].append(point)
        current = [
            tuple(sum(column) // len(held[at]) for column in zip(*held[at])) if at in held else centre
            for at, centre in enumerate(current)
        ]


def plain_clusters(rows, clusters, rounds, dims):
    kept = [(key, scaled(v, 256)) for key, v, _ in rows if scaled(v, 256) is not None and len(v) == dims]
    named = sorted((hashlib.sha256(f"2:{key}".encode()).hexdigest(), v) for key, v in kept if key is not None)
    near, final = lloyd([v for _, v in kept], [v for _, v in named[:clusters]], rounds)
    return sorted(((key, at, apart(v, final[at])) for (key, v), at in zip(kept, near)), key=str), final


@pytest.mark.parametrize("spread", [0.02, 1.0])
@pytest.mark.parametrize("lead", [1, 2, 4])
def test_clusters_equal_plain_rounds(spark, spread, lead):
    rows = vectors(3, 240, 4, spread) + ODD
    found, final = centroids.cluster(table(spark, rows), clusters=9, rounds=4, dims=4, lead=lead)
    expected, centres = plain_clusters(rows, 9, 4, 4)
    assert sorted((tuple(row) for row in found.collect()), key=str) == expected
    assert [tuple(row) for row in final.tolist()] == centres


def test_clusters_of_ties_repeats_and_few_rows(spark):
    square = [(i, [float(i % 2), float(i // 2 % 2), 0.0, 0.0], None) for i in range(16)] * 3
    for rows, clusters in ((square, 5), (square, 200), (ODD, 3), (vectors(1, 30, 4, 0.1, ids=4), 8)):
        found, _ = centroids.cluster(table(spark, rows), clusters=clusters, rounds=3, dims=4)
        assert sorted((tuple(row) for row in found.collect()), key=str) == plain_clusters(rows, clusters, 3, 4)[0]


def test_sums_and_hashes_of_clusters(spark):
    rows = vectors(8, 60, 4, 0.5)
    told = centroids.summarised(*centroids.cluster(table(spark, rows), clusters=5, rounds=2, dims=4)).collect()
    expected, centres = plain_clusters(rows, 5, 2, 4)
    total = defaultdict(int)
    for _, at, distance in expected:
        total[at] += distance
    for row in told:
        assert row["cluster_inertia"] == total[row["cluster"]] and row["inertia"] == sum(total.values())
        text = ",".join(map(str, centres[row["cluster"]]))
        assert row["centroid_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    assert len(told) == 60


@pytest.mark.parametrize("rows", [[], [(1, None, 1)], [(1, [1.0], 1)]])
def test_no_vector_gives_no_cluster(spark, rows):
    assert centroids.summarised(*centroids.cluster(table(spark, rows))).collect() == []


def test_bounds_never_exceed_distances():
    draw = np.random.default_rng(4)
    for scale in (1.0, 1e3, 1e7):
        x = np.floor(draw.standard_normal((300, 64)) * scale * np.geomspace(1, 0.01, 64)).astype(np.int64)
        basis = np.linalg.qr(draw.standard_normal((64, 64)))[0][:, :16]
        mean = x.mean(axis=0)
        some = centroids.Centroids(x[:40], mean, basis)
        lead, rest = centroids.rotated(x.astype(float), mean, basis)
        exact = ((x[:, None, :] - x[None, :40, :]) ** 2).sum(axis=2)
        assert (some.bounds(lead, rest) <= exact).all()
        near, distance, _ = some.nearest(x, lead, rest)
        assert (near == exact.argmin(axis=1)).all() and (distance == exact.min(axis=1)).all()


def test_bounds_spare_most_pairs_of_clustered_vectors():
    draw = np.random.default_rng(4)
    centres = draw.standard_normal((40, 64)) * 300
    x = np.floor(centres[draw.integers(0, 40, 4000)] + draw.standard_normal((4000, 64)) * 40).astype(np.int64)
    mean = x.mean(axis=0)
    basis = np.linalg.eigh(np.cov(x.T))[1][:, ::-1][:, :16]
    lead, rest = centroids.rotated(x.astype(float), mean, basis)
    measured = centroids.Centroids(np.floor(centres).astype(np.int64), mean, basis).nearest(x, lead, rest)[2]
    assert measured < 0.05 * 40 * len(x)


def plain_codes(rows, parts, entries, rounds):
    kept = [(key, label, scaled(v, 1024)) for key, v, label in rows if scaled(v, 1024) is not None]
    sizes = defaultdict(int)
    for _, _, v in kept:
        if v and len(v) % parts == 0:
            sizes[len(v)] += 1
    width = max(sizes, key=lambda n: (sizes[n], n)) // parts
    fit = [v for _, _, v in kept if len(v) == width * parts]
    starts = [v for _, v in sorted((key, v) for key, _, v in kept if key is not None and len(v) == width * parts)[:entries]]
    found, books = [], []
    for at in range(parts):
        own = [v[at * width : (at + 1) * width] for v in fit]
        near, book = lloyd(own, [v[at * width : (at + 1) * width] for v in starts], rounds)
        found.append([(i, apart(x, book[i])) for i, x in zip(near, own)])
        books.append(book)
    told, coded = [], iter(zip(*found))
    for key, label, v in kept:
        code, error = None, None
        if len(v) == width * parts:
            pairs = next(coded)
            code, error = "".join(f"{i:02x}" for i, _ in pairs), sum(d for _, d in pairs)
        told.append((key, label, code, error))
    return sorted(told, key=str), books


@pytest.mark.parametrize("spread, ids", [(0.02, None), (1.0, None), (0.3, 20)])
def test_codes_equal_plain_rounds(spark, spread, ids, monkeypatch):
    monkeypatch.setattr(codes, "RESIDENTS", 7)  # so that entries have several owners
    rows = vectors(5, 240, 4, spread, ids) + ODD
    found, books = codes.compress(table(spark, rows), parts=2, entries=12, rounds=4)
    expected, plain = plain_codes(rows, 2, 12, 4)
    assert sorted((tuple(row) for row in found.collect()), key=str) == expected
    assert [[tuple(entry) for entry in book] for book in books.tolist()] == plain


def test_codes_of_one_hot_vector_and_few_rows(spark):
    hot = [(i, [0.25, 0.5, 0.75, 1.0], 1) for i in range(300)] + vectors(2, 20, 4, 0.5)
    for rows, entries in ((hot, 8), (ODD, 256), ([(1, [1.0, 2.0, 3.0, 4.0], None)], 256)):
        found, _ = codes.compress(table(spark, rows), parts=4, entries=entries, rounds=2)
        assert sorted((tuple(row) for row in found.collect()), key=str) == plain_codes(rows, 4, entries, 2)[0]


def test_members_that_keep_their_entry_are_not_moved(spark, monkeypatch):
    """What goes through ``settled`` after the first round is only what changed its entry."""
    sizes = []

    def watched(moving, counts, settled=codes.settled):
        sizes.append(moving.count())
        return settled(moving, counts)

    monkeypatch.setattr(codes, "settled", watched)
    codes.compress(table(spark, vectors(5, 600, 4, 0.05)), parts=2, entries=12, rounds=4)
    assert len(sizes) > 1 and all(size < sizes[0] / 2 for size in sizes[1:])


def test_label_errors_and_no_rows(spark):
    rows = vectors(9, 50, 4, 0.5) + [(99, [1.0], None)]
    told = codes.summarised(*codes.compress(table(spark, rows), parts=2, entries=4, rounds=2)).collect()
    expected, books = plain_codes(rows, 2, 4, 2)
    total = defaultdict(int)
    for _, label, _, error in expected:
        total[label] += error or 0
    label_of = {key: label for key, label, _, _ in expected}
    flat = ",".join(str(x) for book in books for entry in book for x in entry)
    assert {row["codebooks_sha256"] for row in told} == {hashlib.sha256(flat.encode()).hexdigest()}
    assert len(told) == 51 and all(row["label_error"] == total[label_of[row["vec_id"]]] for row in told)
    for none in ([], [(1, None, 1)], [(1, [math.nan], 1)]):
        assert codes.summarised(*codes.compress(table(spark, none))).collect() == []


@pytest.mark.parametrize("run", [lambda t: centroids.cluster(t, dims=4)[0], lambda t: codes.compress(t)[0]])
def test_components_too_large_to_be_exact_are_refused(spark, run):
    with pytest.raises(Exception, match="beyond"):
        run(table(spark, [(1, [float(MOST), 0.0, 0.0, 0.0], 1)])).collect()


def test_distances_of_large_integers_are_exact():
    draw = random.Random(2)
    x = np.array([[draw.randrange(-MOST, MOST) for _ in range(16)] for _ in range(50)], np.int64)
    entry, error = codes.nearest(x, x[:9])
    for at, row in enumerate(x.tolist()):
        assert (error[at], entry[at]) == min((apart(row, other), i) for i, other in enumerate(x[:9].tolist()))


@pytest.mark.parametrize("name", ["op11_centroid_clustering", "op13_vector_codes"])
def test_queries_equal_sql(spark, sf_dir, name, monkeypatch):
    monkeypatch.setattr("compare.TABLES", ("embeddings",))
    assert run_query(queries.QUERIES[name](spark, sf_dir)) == run_sql(queries.ORACLES[name], sf_dir)
