from __future__ import annotations

import math
from collections import Counter

from hypothesis import given, settings as hypothesis_settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from huntlake.functions import shannon_entropy


def by_hand(text: str) -> float:
    shares = [count / len(text) for count in Counter(text).values()]
    return -sum(share * math.log2(share) for share in shares)


def scores(spark, texts):
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    scored = frame.select("i", shannon_entropy(F.col("t")).alias("e"))
    return [row["e"] for row in scored.orderBy("i").collect()]


def test_fixed_cases(spark):
    texts = [None, "", "a", "aaaa", "ab", "aabb", "abcd", "éèê", "日本語日本語", "😀😀a", "a.b*c+", "line\nbreak"]
    texts.append("a" * 200_000 + "b")
    found = scores(spark, texts)
    assert found[0] is None
    assert found[1] == 0.0
    for text, score in list(zip(texts, found))[2:]:
        assert math.isclose(score, by_hand(text), abs_tol=1e-12)
    assert str(found[3]) == "0.0"


@hypothesis_settings(max_examples=8, deadline=None)
@given(st.lists(st.text(st.characters(exclude_categories=["Cs", "Cc"]), max_size=60), min_size=1, max_size=60))
def test_against_definition_and_bounds(spark, texts):
    reversed_texts = [text[::-1] for text in texts]
    for text, score, turned in zip(texts, scores(spark, texts), scores(spark, reversed_texts)):
        expected = by_hand(text) if text else 0.0
        assert math.isclose(score, expected, abs_tol=1e-9)
        assert math.isclose(score, turned, abs_tol=1e-9)
        assert 0.0 <= score <= math.log2(len(text) or 1) + 1e-9


def test_no_python_worker(spark, plan):
    frame = spark.createDataFrame([("abc",)], "t string").select(shannon_entropy(F.col("t")))
    assert "Python" not in plan(frame)
