from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tables import documents
from tokenizers import Tokenizer

from huntlake.llm import cutting_stock, packing, tokens

TOKENIZER = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
TOKENIZER.encode_special_tokens = True


def ids(text):
    return np.frombuffer(tokens.ids_of(text), "<u4").tolist()


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.sampled_from("ab'st  \n\t　é東5.,|<>endoftx́"), max_size=60))
def test_ids_are_those_of_the_tokenizer(text):
    assert ids(text) == TOKENIZER.encode(text, add_special_tokens=False).ids


def test_parts_of_a_long_text_give_the_same_ids():
    text = "some words, 12 more\n\n and  spaces " * 200
    parts = list(tokens.parts(text, 100))
    assert len(parts) > 10 and "".join(parts) == text
    assert sum((ids(part) for part in parts), []) == ids(text)
    assert list(tokens.parts("x" * 500, 100)) == ["x" * 500]


@pytest.mark.parametrize("histogram", [{}, {128: 3}, {1: 1000}, {64: 7, 65: 7, 3: 1}, {n: n % 7 for n in range(1, 129)}])
def test_plan_holds_exactly_the_histogram(histogram):
    got: Counter = Counter()
    for pattern, times in cutting_stock.plan(histogram, 128):
        assert times > 0 and sum(size * copies for size, copies in pattern.items()) <= 128
        got.update({size: copies * times for size, copies in pattern.items()})
    assert got == +Counter(histogram)


def test_plan_is_near_the_lower_bound():
    draw = np.random.default_rng(0)
    histogram = {size: int(draw.integers(50, 500)) for size in range(1, 65)}
    bins = sum(times for _, times in cutting_stock.plan(histogram, 64))
    assert bins <= 1.03 * sum(size * count for size, count in histogram.items()) / 64 + 1
    with pytest.raises(ValueError):
        cutting_stock.plan({65: 1}, 64)


def test_pack(spark):
    rows = [(i, "word " * (37 * i % 1500)) for i in range(60)] + [(100, None), (101, ""), (7, "again"), (7, "again"), (None, "no id")]
    rows += [(200 + i, "same text here") for i in range(50)] + [(300, "long " * 5000)]
    got = packing.pack(documents(spark, rows), keep_ids=True).collect()
    by_doc: Counter = Counter()
    by_sequence: dict[int, list] = {}
    for row in got:
        by_doc[row["doc_id"], row["doc_tokens"]] += row["length"]
        by_sequence.setdefault(row["sequence_id"], []).append(row)
        assert len(row["ids"]) == row["length"] > 0
        assert row["ids_crc32"] == zlib.crc32(np.array(row["ids"], "<u4").tobytes())
    expected: Counter = Counter()
    for doc_id, text in rows:
        expected[doc_id, len(ids(text)) + 1] += len(ids(text)) + 1
    assert by_doc == expected
    for pieces in by_sequence.values():
        pieces.sort(key=lambda row: row["offset"])
        ends = [row["offset"] + row["length"] for row in pieces]
        assert [row["offset"] for row in pieces] == [0, *ends[:-1]] and ends[-1] <= 1024
    long = sorted((row["start"], row["ids"]) for row in got if row["doc_id"] == 300)
    assert sum((part for _, part in long), []) == ids("long " * 5000) + [0]
    assert packing.pack(documents(spark, [])).collect() == []
