"""Substring dedup: remove words of long passages that a document with a smaller id has too.

Rounds of recompression (``recompression.py``) give each window of words an
anchor, a symbol that depends on the window alone. Neighbouring windows share
anchors, so a document has far fewer anchors than windows. Three passes over
the documents, none of which moves a text:

1. The anchors of all documents, to find those that occur in two of them.
2. For these, the chunks: runs of windows with one anchor, and the hash of all
   words they cover. Where all chunks of an anchor are equal, the windows of
   the later documents are repeats.
3. Where they differ, at the ends of passages, the windows themselves.

Equal windows have equal anchors, so no repeat is missed; a repeat is taken
for one only if 128 bits of hashes of its words agree. What a pass looks for is
sent to it as a Bloom filter of fixed size, and so is what rows are to be
joined with. If a filter is too full, more chunks and windows are compared; the
result stays the same. Passages that very many documents hold are sent to all
tasks, so that no task gets all copies of one (``later``).
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from huntlake.llm.common import per_batch, saved, text_bytes
from huntlake.llm.key_filter import KeyFilter
from huntlake.llm.recompression import ROUNDS, STEP_A, STEP_B, Block, Spans, block_of_names, names_by_text

WIDTH = 13
#: Words of a block, and of a part of a long document.
BLOCK_WORDS = 1 << 14
#: Windows of a chunk, which four bits hold.
MOST_WINDOWS = 15
#: Places that a mark holds, in words.
MOST_WORDS = 1 << 28
#: The most frequent repeats, which are sent to all tasks.
FREQUENT = 1000


def blocks(texts: Iterable[bytes], width: int) -> Iterator[tuple[list[tuple[int, int]], Block]]:
    """Blocks of about ``BLOCK_WORDS`` words, with (row, place of its first word) of each part.

    A longer document is cut into parts that overlap by ``width - 1`` words: each
    window is in one part, and its anchor is the same there.
    """
    where, held, size = [], [], 0
    for row, words in enumerate(names_by_text(texts)):
        for at in range(0, max(len(words) - width + 1, 0), BLOCK_WORDS):
            part = words[at : at + BLOCK_WORDS + width - 1]
            where.append((row, at))
            held.append(part)
            size += len(part)
            if size >= BLOCK_WORDS:
                yield where, block_of_names(held)
                where, held, size = [], [], 0
    if held:
        yield where, block_of_names(held)


def _rows_of(starts: np.ndarray, block: Block, where: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """The row and the place in its document of each window."""
    windows = np.diff(np.searchsorted(starts, block.bounds))
    part = np.repeat(np.arange(len(windows)), windows)
    rows, offsets = np.array(where, np.int64).T
    return rows[part], starts - block.bounds[part] + offsets[part]


def _fresh(*columns: np.ndarray) -> np.ndarray:
    """Where one of the columns differs from the row before."""
    fresh = np.ones(len(columns[0]), bool)
    fresh[1:] = np.logical_or.reduce([column[1:] != column[:-1] for column in columns])
    return fresh


def _wanted(keys: np.ndarray, wanted: KeyFilter) -> np.ndarray:
    """Whether each key may be a wanted one; neighbours that share a key ask once."""
    fresh = _fresh(keys)
    return wanted.has(keys[fresh])[np.cumsum(fresh) - 1]


def _anchored(batch: pa.RecordBatch, width: int, rounds: int):
    """For each block of a batch with (doc_id, text, ..): block, first words, keys, rows and places of its windows."""
    for where, block in blocks(text_bytes(batch.column(1)), width):
        starts, keys = block.anchors(width, rounds)
        rows, places = _rows_of(starts, block, where)
        yield block, starts, keys, rows, places


def anchor_rows(docs: DataFrame, width: int, rounds: int) -> DataFrame:
    """(key) of the anchors of all windows, each key once per document and block."""

    def make(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for _, _, keys, rows, _ in _anchored(batch, width, rounds):
            fresh = _fresh(keys, rows)
            keys, rows = keys[fresh], rows[fresh]
            fresh = np.ones(len(keys), bool)
            order = np.lexsort((keys, rows))
            fresh[order[1:]] = (np.diff(keys[order]) != 0) | (np.diff(rows[order]) != 0)
            yield pa.RecordBatch.from_arrays([pa.array(keys[fresh].view(np.int64))], ["key"])

    return docs.select("doc_id", "text").mapInArrow(per_batch(make), "key long")


def _marks(tags: np.ndarray, places: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """31 bits of the text's hash, as an id may stand on several texts, the first window's place, the number of windows."""
    if len(places) and places.max() >= MOST_WORDS:
        raise ValueError(f"a document of more than {MOST_WORDS} words")
    return tags << 32 | places << 4 | sizes


def chunk_rows(docs: DataFrame, wanted: KeyFilter, width: int, rounds: int) -> DataFrame:
    """(doc_id, mark, key, body) of the runs of windows whose anchor is one of the wanted keys."""

    def make(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        tags = batch.column(2).to_numpy(zero_copy_only=False)
        for block, starts, keys, rows, places in _anchored(batch, width, rounds):
            hot = _wanted(keys, wanted)
            starts, keys, rows, places = starts[hot], keys[hot], rows[hot], places[hot]
            if not len(starts):
                continue
            heads = np.ones(len(starts), bool)
            heads[1:] = (np.diff(keys) != 0) | (np.diff(starts) != 1)
            since = np.arange(len(starts)) - np.maximum.accumulate(np.where(heads, np.arange(len(starts)), 0))
            at = np.flatnonzero(heads | (since % MOST_WINDOWS == 0))
            sizes = np.diff(np.append(at, len(starts)))
            body = Spans(block.names, STEP_B).of(starts[at], starts[at] + sizes + (width - 1))
            marks = _marks(tags[rows[at]], places[at], sizes)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[rows[at]], pa.int64()), pa.array(marks), pa.array(keys[at].view(np.int64)), pa.array(body.view(np.int64))],
                ["doc_id", "mark", "key", "body"],
            )

    columns = "doc_id long, mark long, key long, body long"
    return docs.select("doc_id", "text", "tag").mapInArrow(per_batch(make), columns)


def window_rows(docs: DataFrame, wanted: KeyFilter, width: int, rounds: int) -> DataFrame:
    """(doc_id, mark, a, b) of the windows whose anchor is one of the wanted keys; ``a`` and ``b`` hash their words."""

    def make(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        tags = batch.column(2).to_numpy(zero_copy_only=False)
        for block, starts, keys, rows, places in _anchored(batch, width, rounds):
            hot = _wanted(keys, wanted)
            starts, rows, places = starts[hot], rows[hot], places[hot]
            if not len(starts):
                continue
            a, b = (Spans(block.names, step).of(starts, starts + width).view(np.int64) for step in (STEP_A, STEP_B))
            marks = _marks(tags[rows], places, np.ones(len(rows), np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[rows], pa.int64()), pa.array(marks), pa.array(a), pa.array(b)], ["doc_id", "mark", "a", "b"]
            )

    return docs.select("doc_id", "text", "tag").mapInArrow(per_batch(make), "doc_id long, mark long, a long, b long")


def may_match(rows: DataFrame, keys: list[str], wanted: KeyFilter) -> DataFrame:
    """``rows`` (of 64-bit numbers) without most of those whose ``keys`` are not wanted."""
    names = rows.columns

    def make(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        held = wanted.has(batch.column(len(names)).to_numpy(zero_copy_only=False).view(np.uint64))
        yield batch.select(names).filter(pa.array(held))

    hashed = rows.withColumn("_hash", F.xxhash64(*keys))
    return hashed.mapInArrow(per_batch(make, 1 << 16), ", ".join(f"{name} long" for name in names))


def later(rows: DataFrame, keys: list[str], shared: DataFrame, label: str) -> DataFrame:
    """(doc_id, mark) of the rows that lie in a group of ``shared`` (keys, least) and not in its least document.

    The most frequent groups, a bounded number, are joined without a shuffle,
    so no other has more than that share of the rows left in one task.
    """
    spark = rows.sparkSession
    names = [name for name in rows.columns if name in (*keys, "doc_id", "mark")]
    with KeyFilter(shared.select(F.xxhash64(*keys))) as wanted:
        some = saved(may_match(rows.select(names), keys, wanted), label, small=True)
    sizes = some.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).orderBy(F.desc("rows"), *keys).limit(FREQUENT)
    top = shared.join(F.broadcast(sizes), keys).select(shared.columns).collect()  # at most FREQUENT rows, as is the next
    frequent = F.broadcast(spark.createDataFrame(top, shared.schema))
    hot = some.join(frequent, keys)
    cold = some.join(frequent, keys, "left_anti").join(shared, keys)
    return hot.unionByName(cold).where("doc_id > least").select("doc_id", "mark")


def repeated_marks(docs: DataFrame, width: int = WIDTH, rounds: int = ROUNDS) -> DataFrame:
    """(doc_id, tag, marks) of the windows that also start in a document with a smaller id."""
    tagged = docs.where("doc_id is not null").select(
        F.col("doc_id").cast("long"), "text", F.expr("xxhash64(text) & 2147483647").alias("tag")
    )
    ends = F.min("doc_id").alias("least"), F.max("doc_id").alias("most")
    # a key may be counted twice for one document; it is then compared and found to be in one only
    shared = anchor_rows(tagged, width, rounds).groupBy("key").count().where("count > 1")
    with KeyFilter(shared.select("key")) as wanted:
        chunks = saved(chunk_rows(tagged, wanted, width, rounds), "chunks", small=True)
    groups = chunks.groupBy("key").agg(*ends, F.min("body").alias("low"), F.max("body").alias("high"))
    groups = saved(groups.where("least < most"), "groups")
    same = groups.where("low = high").select("key", "least")
    later_chunks = later(chunks, ["key"], same, "later-chunks")
    with KeyFilter(groups.where("low <> high").select("key")) as mixed:
        windows = saved(window_rows(tagged, mixed, width, rounds), "windows", small=True)
    first = saved(windows.groupBy("a", "b").agg(*ends).where("least < most").drop("most"), "first")
    marks = later_chunks.unionByName(later(windows, ["a", "b"], first, "later-windows"))
    # by text as well as by id: an id may stand on very many rows
    return marks.groupBy("doc_id", F.shiftright("mark", 32).alias("tag")).agg(F.collect_set("mark").alias("marks"))


def _kept(batch: pa.RecordBatch, width: int) -> Iterator[pa.RecordBatch]:
    """(row, n_words, n_removed, kept) of a batch (row, text, marks)."""
    total, removed, kept = [], [], []
    for text, held in zip(text_bytes(batch.column(1)), batch.column(2)):
        words = text.split()
        held = held.values.to_numpy(zero_copy_only=False) if held.is_valid else np.zeros(0, np.int64)
        held = held & 0xFFFFFFFF
        total.append(len(words))
        if len(held):
            edges = np.bincount(held >> 4, minlength=len(words) + 1)
            edges -= np.bincount((held >> 4) + (held & 15) + (width - 1), minlength=len(words) + 1)
            stay = np.flatnonzero(np.cumsum(edges)[: len(words)] == 0)
            words = [words[i] for i in stay.tolist()]
        removed.append(total[-1] - len(words))
        kept.append(b" ".join(words))
    kept = pa.array(kept, pa.binary()).cast(pa.string())
    yield pa.RecordBatch.from_arrays(
        [batch.column(0), pa.array(total, pa.int64()), pa.array(removed, pa.int64()), kept], ["row", "n_words", "n_removed", "kept"]
    )


def kept_words(docs: DataFrame, carry: list[str], width: int = WIDTH, rounds: int = ROUNDS) -> DataFrame:
    """(row, n_words, n_removed, kept) of every row of ``docs`` (doc_id, text), its columns ``carry`` in ``row``.

    A word goes if a window of ``width`` words that covers it also starts in a
    document with a smaller id; ``kept`` are the others, joined by one space. A
    NULL text has no words and gives an empty ``kept``. Rows with a NULL id keep
    all words and serve no other row. Rows of one id do not count against each
    other. Windows are judged on the input, not on what is left. A document of
    ``MOST_WORDS`` words or more raises.
    """
    marks = saved(repeated_marks(docs, width, rounds).withColumnRenamed("tag", "_tag"), "marks")
    marked = KeyFilter(marks.select(F.xxhash64("doc_id", "_tag")))

    def touched(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        yield batch.select(columns).filter(pa.array(held(batch)))

    def untouched(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        left = batch.select(["row", "text"]).filter(pa.array(~held(batch)))
        yield from _kept(left.append_column("marks", pa.nulls(left.num_rows, pa.list_(pa.int64()))), width)

    def held(batch: pa.RecordBatch) -> np.ndarray:
        return marked.has(batch.column("hash").to_numpy(zero_copy_only=False).view(np.uint64))

    columns = ["row", "text", "tag", "id"]
    rows = docs.select(
        F.struct(*carry).alias("row"),
        F.col("text").cast("string").alias("text"),
        F.expr("xxhash64(text) & 2147483647").alias("tag"),
        F.col("doc_id").cast("long").alias("id"),
    )
    kind = rows.schema["row"].dataType.simpleString()
    kinds = f"row {kind}, n_words long, n_removed long, kept string"
    hashed = rows.withColumn("hash", F.xxhash64("id", "tag"))
    # only texts that lose words, and a few more, go through a shuffle
    some = hashed.mapInArrow(per_batch(touched), f"row {kind}, text string, tag long, id long")
    same = (F.col("id") == F.col("doc_id")) & (F.col("tag") == F.col("_tag"))
    if "text" in carry:
        some = some.drop("text")
    joined = some.join(marks, same, "left").select("row", "row.text" if "text" in carry else "text", "marks")
    return hashed.mapInArrow(per_batch(untouched), kinds).union(joined.mapInArrow(per_batch(partial(_kept, width=width)), kinds))


def without_repeats(docs: DataFrame, width: int = WIDTH, rounds: int = ROUNDS) -> DataFrame:
    """(row, kept): the rows of ``docs`` (doc_id, text, ..), and what is left of texts that lose words; see ``kept_words``.

    ``kept`` is NULL for a text that loses nothing, and one that loses all words is left out. Only texts that lose words, and a
    few more, go through Python and a shuffle; of the others only hashes do.
    """
    marks = saved(repeated_marks(docs, width, rounds).select(F.col("doc_id").alias("_id"), F.col("tag").alias("_tag"), "marks"), "marks")
    tag = F.expr("xxhash64(text) & 2147483647")
    asked = KeyFilter(marks.select(F.xxhash64("_id", "_tag"))).may_hold(F.col("doc_id").cast("long"), tag)
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col("doc_id").cast("long").alias("id"), tag.alias("tag"), asked.alias("asked"))
    some = rows.where("asked").join(marks, (F.col("id") == F.col("_id")) & (F.col("tag") == F.col("_tag")), "left")
    kinds = f"row {rows.schema['row'].dataType.simpleString()}, n_words long, n_removed long, kept string"
    found = some.select("row", F.col("row.text").cast("string").alias("text"), "marks").mapInArrow(per_batch(partial(_kept, width=width)), kinds)
    found = found.where("n_removed = 0 or n_words > n_removed")
    rest = rows.where(~F.col("asked")).select("row", F.lit(None).cast("string").alias("kept"))
    return rest.union(found.select("row", F.when(F.col("n_removed") > 0, F.col("kept")).alias("kept")))


def keep_unique(docs: DataFrame, width: int = WIDTH, rounds: int = ROUNDS) -> DataFrame:
    """(doc_id, n_words, n_removed, kept) of every row; see ``kept_words``. Other columns are not read."""
    found = kept_words(docs.select(F.col("doc_id").cast("long"), "text"), ["doc_id"], width, rounds)
    return found.select("row.doc_id", "n_words", "n_removed", "kept")
