from __future__ import annotations

import numpy as np
import pytest
from tables import documents, random_texts

from huntlake.llm import recompression, substrings
from huntlake.llm.recompression import block_of


def brute(rows, width=13):
    first: dict[tuple, int] = {}
    split = [(doc_id, (text or "").encode().split()) for doc_id, text in rows]
    for doc_id, words in split:
        for at in range(len(words) - width + 1):
            if doc_id is not None:
                body = tuple(words[at : at + width])
                first[body] = min(first.get(body, doc_id), doc_id)
    out = []
    for doc_id, words in split:
        gone = set()
        for at in range(len(words) - width + 1):
            if doc_id is not None and first[tuple(words[at : at + width])] < doc_id:
                gone.update(range(at, at + width))
        kept = b" ".join(word for at, word in enumerate(words) if at not in gone).decode()
        out.append((doc_id, len(words), len(gone), kept))
    return out


def found(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("vocabulary", [1, 2, 5, 40])
def test_equal_windows_have_equal_anchors(vocabulary):
    texts = [text.encode().split() for text in random_texts(vocabulary, 40, vocabulary, 200)]
    starts, keys = block_of(texts).anchors(13)
    words = [word for text in texts for word in text]
    seen: dict[tuple, int] = {}
    assert len(starts) == sum(max(0, len(text) - 12) for text in texts)
    for start, key in zip(starts.tolist(), keys.tolist()):
        assert seen.setdefault(tuple(words[start : start + 13]), key) == key


def test_words_are_named_as_split_has_them_and_without_a_call_each(monkeypatch):
    draw = np.random.default_rng(5)
    letters = np.frombuffer(b"ab\x00\xff\xc2\xa0\x1c\x1f\x85 \t\n\r\x0b\x0c", np.uint8)
    texts = [draw.choice(letters, size).tobytes() for size in [0, 1, 2, *range(3, 200)]]
    texts += [b"", b" \n ", b"a", b" a", b"a ", b"a\x00", b"x" * 255, b"x" * 256, b"y" * 7 + b" " + b"y" * 8 + b" " + b"y" * 9]
    longer = [b"x" * 257, b"x" * 256 + b"y", b"z" * 100_000 + b" a " + b"z" * 99_999]
    names = {}
    for held, whole in ((texts + longer, False), (texts, True)):
        if whole:  # one hash call for each word took a third of the pass
            for name in ("xxh64_digest", "xxh64_intdigest"):
                monkeypatch.setattr(recompression.xxhash, name, None)
        for text, found in zip(held, recompression.names_by_text(held), strict=True):
            words = text.split()
            assert len(words) == len(found)
            for word, name in zip(words, found.tolist()):
                assert names.setdefault(word, name) == name
    assert len(set(names.values())) == len(names)
    where, block = next(substrings.blocks(texts, 13))
    assert len(block.names) == sum(len(text.split()) for text in texts if len(text.split()) >= 13)
    assert [row for row, _ in where] == [row for row, text in enumerate(texts) if len(text.split()) >= 13]


@pytest.mark.parametrize("seed, vocabulary", [(1, 2), (2, 6), (3, 60)])
def test_removal_is_exact(spark, seed, vocabulary):
    rows = list(enumerate(random_texts(seed, 40, vocabulary, 90)))
    assert found(substrings.keep_unique(documents(spark, rows))) == sorted(brute(rows), key=str)


def test_parts_of_a_long_document_meet(spark, monkeypatch):
    monkeypatch.setattr(substrings, "BLOCK_WORDS", 50)
    texts = random_texts(4, 6, 5, 400)
    where, sizes = [], []
    for rows, block in substrings.blocks([text.encode() for text in texts], 13):
        starts, _ = block.anchors(13)
        at = substrings._rows_of(starts, block, rows)
        where.extend(zip(*(part.tolist() for part in at)))
        sizes.append(len(block.names))
    expected = [(row, at) for row, text in enumerate(texts) for at in range(len(text.split()) - 12)]
    assert where == expected and max(sizes) <= 50 + 50 + 12


def test_nulls_repeats_and_other_texts_of_one_id(spark):
    passage = " ".join(f"p{i}" for i in range(20))
    rows = [
        (1, f"a {passage} b"),
        (2, passage),
        (2, f"x y {passage}"),
        (2, passage),
        (None, passage),
        (3, None),
        (4, ""),
        (5, " \n\t "),
        (6, "short text"),
        (0, "short text"),
    ]
    assert found(substrings.keep_unique(documents(spark, rows))) == sorted(brute(rows), key=str)


def test_many_copies_and_a_table_without_rows(spark):
    rows = [(i, " ".join(f"c{j}" for j in range(30)) + " tail") for i in range(200)]
    got = found(substrings.keep_unique(documents(spark, rows)))
    assert got == sorted(brute(rows), key=str)
    assert found(substrings.keep_unique(documents(spark, []))) == []


def test_key_filter_holds_its_keys(spark):
    keys = np.random.default_rng(0).integers(-(2**63), 2**63 - 1, 1000)
    held = substrings.KeyFilter(spark.createDataFrame([(int(k),) for k in keys], "key long"))
    assert held.has(keys.view(np.uint64)).all()
    assert held.has(np.arange(1000, dtype=np.uint64)).mean() < 0.01
