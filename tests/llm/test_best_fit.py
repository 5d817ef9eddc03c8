from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tables import documents
from tokenizers import Tokenizer

from huntlake.llm import best_fit
from huntlake.llm.word_tokens import ids_of


def one_by_one(histogram, capacity):
    """Best fit of single pieces, longest first: the number of sequences."""
    rooms = []
    for length in sorted(Counter(histogram).elements(), reverse=True):
        fitting = [room for room in rooms if room >= length]
        if fitting:
            rooms.remove(min(fitting))
            rooms.append(min(fitting) - length)
        else:
            rooms.append(capacity - length)
    return len(rooms)


def filled(histogram, capacity):
    """The pieces (place, length) of each planned sequence; every rank must be in one slot."""
    ranks, sequences = Counter(), defaultdict(list)
    for slot in best_fit.plan(histogram, capacity):
        assert slot.low == ranks[slot.length]
        ranks[slot.length] = slot.high
        for within in range(slot.high - slot.low):
            number, copy = divmod(within, slot.copies)
            sequences[slot.first + number].append((slot.place + copy * slot.length, slot.length))
    assert ranks == Counter({length: count for length, count in histogram.items() if count})
    return sequences


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(0, 30), max_size=40))
def test_a_plan_of_counts_equals_best_fit_of_single_pieces(histogram):
    sequences = filled(histogram, 40)
    assert len(sequences) == one_by_one(histogram, 40)
    assert sorted(sequences) == list(range(len(sequences)))
    for held in sequences.values():
        at = 0
        for place, length in sorted(held):
            assert place == at
            at += length
        assert at <= 40


def test_a_plan_depends_on_the_lengths_and_not_on_the_counts():
    small = {length: 5 + length % 7 for length in range(1, 300)}
    large = {length: count * 1_000_000 + 1 for length, count in small.items()}
    slots = list(best_fit.plan(large, 4096))
    assert len(slots) < 20 * len(small)
    tokens = sum(length * count for length, count in large.items())
    assert max(slot.first + -(-(slot.high - slot.low) // slot.copies) for slot in slots) <= tokens / 4096 + 2


@pytest.mark.parametrize("histogram", [{0: 1}, {41: 1}])
def test_pieces_that_fit_no_sequence_are_refused(histogram):
    with pytest.raises(ValueError):
        list(best_fit.plan(histogram, 40))


def reference():
    known = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    known.encode_special_tokens = True
    return known


def whole(known, texts):
    return [b"".join(i.to_bytes(4, "little") for i in one.ids) for one in known.encode_batch(texts, add_special_tokens=False)]


def ids(texts):
    found, bounds = ids_of(pa.array(texts, pa.string()))
    return [found[a:b].tobytes() for a, b in zip(bounds, bounds[1:])]


def test_ids_of_odd_texts_equal_those_of_the_tokenizer():
    draw = random.Random(5)
    odd = ["", " ", "\n\t", "\x0b\x0c\x1c\x85  　", "İΣ Σ́ ΑΣ ΑΣ. é ́", "<|endoftext|>", "a<|startoftext|>b", "I'LL don't'S 12³", "\x00​", "x" * 5000]
    alphabet = " \t\n\r\x0b\x0c\x1f  aBéΣςß'’sTt12.,<|>中́̇İ\U0001f600"
    texts = odd + ["".join(draw.choices(alphabet, k=draw.randrange(40))) for _ in range(500)]
    assert ids(texts) == whole(reference(), texts)


def test_ids_stay_right_when_kept_words_are_dropped(monkeypatch):
    monkeypatch.setattr("huntlake.llm.word_tokens.KEPT_WORDS", 3)
    texts = ["one two three", "four five one", "one one six " + "long" * 20, "two"] * 3
    assert [found for text in texts for found in ids([text])] == whole(reference(), texts)
    assert ids([None, "one"]) == [b"", *whole(reference(), ["one"])]


def test_the_whole_table_against_the_tokenizer(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    texts = {row["doc_id"]: row["text"] or "" for row in docs.collect()}
    known, found = reference(), defaultdict(dict)
    expected = {key: ids + (1).to_bytes(4, "little") for key, ids in zip(texts, whole(known, list(texts.values())))}
    packed = best_fit.pack(docs).collect()
    sequences = defaultdict(list)
    for row in packed:
        assert row["piece"] not in found[row["doc_id"]]
        found[row["doc_id"]][row["piece"]] = row
        sequences[row["sequence_id"]].append((row["offset"], row["length"]))
    assert found.keys() == expected.keys()
    for key, ids in expected.items():
        held = [found[key][number] for number in sorted(found[key])]
        assert len(held) == -(-len(ids) // 4 // 4096)
        for number, row in enumerate(held):
            part = ids[4 * 4096 * number : 4 * 4096 * (number + 1)]
            assert (row["start"], row["length"], row["ids_crc32"]) == (4096 * number, len(part) // 4, zlib.crc32(part))
    for held in sequences.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= 4096
    tokens = sum(len(ids) // 4 for ids in expected.values())
    lengths = Counter(row["length"] for row in packed)
    assert len(sequences) == one_by_one(lengths, 4096) <= tokens / 4096 * 1.02 + 1


def test_nulls_empty_repeats_and_clashing_names(spark):
    data = [(1, "a b c"), (1, "a b c"), (1, "other"), (2, None), (3, ""), (None, "a b c"), (None, "a b c"), (4, "word " * 50)]
    packed = best_fit.pack(documents(spark, data), capacity=16, keep_ids=True).collect()
    assert sorted(str(row["doc_id"]) for row in packed) == sorted(["1"] * 3 + ["2", "3"] + ["None"] * 2 + ["4"] * 4)
    for row in packed:
        assert len(row["ids"]) == row["length"]
        assert row["ids_crc32"] == zlib.crc32(b"".join(i.to_bytes(4, "little") for i in row["ids"]))
    assert [row["ids"] for row in packed if row["doc_id"] in (2, 3)] == [[1], [1]]
    places = [(row["sequence_id"], row["offset"]) for row in packed]
    assert len(set(places)) == len(places)
    assert best_fit.pack(documents(spark, [])).count() == 0


def test_many_equal_lengths_are_ranked_in_parts(spark, monkeypatch):
    monkeypatch.setattr(best_fit, "RANKED_ROWS", 10)
    packed = best_fit.pack(documents(spark, [(i, "one") for i in range(1000)]), capacity=8).collect()
    assert len({(row["sequence_id"], row["offset"]) for row in packed}) == 1000
    assert len({row["sequence_id"] for row in packed}) == 250
