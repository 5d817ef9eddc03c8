from __future__ import annotations

import numpy as np

from huntlake.llm import neighbours

NAN, INF = float("nan"), float("inf")


def table(spark, rows):
    return spark.createDataFrame([(*row, 1, 2) for row in rows], "vec_id long, embedding array<float>, rank int, level int")


def brute(rows, query_id, query, most=10):
    query = np.array(query, np.float32).astype(float)
    found = {
        (float(np.sqrt(((np.array(v, np.float32).astype(float) - query) ** 2).sum())), i)
        for i, v in rows
        if i is not None and i != query_id and v is not None and len(v) == len(query) and None not in v and np.isfinite(v).all() and np.any(v)
    }
    return [(i, d) for d, i in sorted(found)[:most]]


def test_recall_on_the_table(spark):
    vectors = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    got = neighbours.nearest(vectors, "vec_id % 100 = 0").collect()
    rows = [(r["vec_id"], r["embedding"]) for r in vectors.collect()]
    hits = total = 0
    for query_id, query in rows:
        if query_id % 100 == 0:
            mine = {r["vec_id"] for r in got if r["query_id"] == query_id}
            exact = {i for i, _ in brute(rows, query_id, query)}
            hits, total = hits + len(mine & exact), total + len(exact)
    assert hits / total >= 0.9


def test_ranks_scores_and_ties(spark):
    draw = np.random.default_rng(3)
    near = draw.normal(size=(6, 8)).tolist()
    rows = [(i, near[i % 6]) for i in range(60)] + [(i, draw.normal(size=8).tolist()) for i in range(60, 90)]
    rows += [(100, None), (101, [0.0] * 8), (102, [NAN] + [1.0] * 7), (103, [INF] + [1.0] * 7), (104, [None] + [1.0] * 7), (None, near[0])]
    rows += [(200, [1.0, 2.0]), (201, [1.0, 2.5]), (300, []), (0, near[0]), (7, near[1])]
    got = neighbours.nearest(table(spark, rows), "vec_id % 100 = 0").collect()
    by_query: dict[int, list] = {}
    for r in sorted(got, key=lambda r: (r["query_id"], r["rank"])):
        by_query.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(by_query[r["query_id"]])
    assert set(by_query) == {0, 200}
    for query_id, found in by_query.items():
        expected = brute(rows, query_id, next(v for i, v in rows if i == query_id))
        assert [i for i, _ in found] == [i for i, _ in expected]
        assert np.allclose([d for _, d in found], [d for _, d in expected], atol=1e-12)
    assert neighbours.nearest(table(spark, []), "vec_id % 100 = 0").collect() == []
    assert neighbours.nearest(table(spark, [(100, [1.0, 2.0])]), "vec_id % 100 = 0").collect() == []


def test_a_vector_stored_many_times_takes_one_place(spark):
    rows = [(0, [1.0, 0.0])] + [(7, [1.0, 0.1])] * 12 + [(i, [1.0, float(i)]) for i in range(10, 30)]
    got = [(r["rank"], r["vec_id"]) for r in neighbours.nearest(table(spark, rows), "vec_id = 0").orderBy("rank").collect()]
    assert got == [(1, 7)] + [(rank, rank + 8) for rank in range(2, 11)]
