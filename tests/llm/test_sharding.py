from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pytest
from tables import documents

from huntlake.llm import sharding


def test_matrix_has_its_sums():
    for counts, sizes in (([5, 0, 7], [4, 4, 4]), ([100] * 20, [1000, 999, 1]), ([0], [0, 0]), ([3 * 10**12, 10**12], [2 * 10**12] * 2)):
        matrix = sharding.communication_matrix(counts, sizes)
        assert [sum(row) for row in matrix] == counts and [sum(column) for column in zip(*matrix)] == sizes
        assert min(min(row) for row in matrix) >= 0
    with pytest.raises(ValueError):
        sharding.communication_matrix([1], [2])


@pytest.mark.parametrize("good, bad, draws", [(10, 30, 12), (3, 2, 4), (500, 700, 300), (1, 10**6, 1000)])
def test_draws_follow_the_hypergeometric_law(good, bad, draws):
    rng, reference = np.random.default_rng(1), np.random.default_rng(2)
    mine = np.array([sharding.hypergeometric(good, bad, draws, rng) for _ in range(4000)])
    other = reference.hypergeometric(good, bad, draws, 4000)
    error = 5 * max(other.std(), 0.02) / 60
    assert abs(mine.mean() - other.mean()) < error and abs(mine.std() - other.std()) < max(error, 0.05)


def test_shards_are_exact_and_slots_have_no_gaps(spark):
    rows = [(i, f"text {i}") for i in range(500)] + [(1000 + i, "copy") for i in range(250)]
    rows += [(7, "text 7")] * 40 + [(None, None), (None, "x"), (2000, None), (2001, ""), (7, "other")]
    got = sharding.shuffled(sharding.document_rows(documents(spark, rows))).collect()
    counts = Counter(r["shard"] for r in got)
    assert set(counts) == set(range(24)) and max(counts.values()) - min(counts.values()) <= 1
    for shard in range(24):
        assert sorted(r["slot"] for r in got if r["shard"] == shard) == list(range(counts[shard]))
    expected = Counter((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in rows)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == expected
    copies = Counter(r["shard"] for r in got if r["doc_id"] is not None and 1000 <= r["doc_id"] < 1250)
    assert len(copies) > 20 and max(copies.values()) < 30  # copies go where chance sends them
    again = sharding.shuffled(sharding.document_rows(documents(spark, rows[::-1]))).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))


def test_few_rows_and_none(spark):
    few = sharding.shuffled(sharding.document_rows(documents(spark, [(1, "a"), (2, "b")]))).collect()
    assert sorted((r["shard"], r["slot"]) for r in few) == [(0, 0), (1, 0)]
    assert sharding.shuffled(sharding.document_rows(documents(spark, []))).collect() == []


def test_matrix_is_that_of_a_uniform_shuffle():
    rng = np.random.default_rng(5)
    first = Counter()
    for seed in rng.integers(0, 2**31, 3000):
        matrix = sharding.communication_matrix([2, 3, 1], [2, 2, 2], int(seed))
        first[tuple(matrix[0])] += 1
    # two of six places for the first partition's rows: 15 ways, 3 of them within one shard
    assert abs(sum(n for row, n in first.items() if 2 in row) / 3000 - 3 / 15) < 0.04
