"""Language ID: bit-sliced Bloom filters of typical letter n-grams, one bit of a slot per language.

A slot holds a mask of languages. An n-gram is looked up in ``HASHES`` slots,
and the AND of their masks is the set of all languages whose filter has it, in
one step for all languages. A text's languages are counted bit by bit over its
n-grams, and the counts are corrected for what a filter of that filling reports
by chance.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from huntlake.llm.common import per_batch, saved, small_batches
from huntlake.llm.key_filter import KeyFilter

GRAM = 4
HASHES = 3
#: Slots of the filters, 8 bytes each: the size of what is broadcast.
SLOTS = 1 << 20
#: The classifier is fitted on about this many labelled documents of each language, chosen by hash.
SAMPLE = 2000
#: An n-gram is typical of a language with at least this share of the sum of its rates in all languages.
SHARE = 0.2
#: A text whose best language knows fewer of its n-grams is rejected by ``reject``.
LEAST_SCORE = 0.2
UNKNOWN = "und"
#: A mask has 64 bits.
MOST_LANGUAGES = 63
#: Characters handled at a time.
CHUNK = 1 << 20
STEP = np.uint64(0x9E3779B97F4A7C15)
MIX = np.uint64(0xBF58476D1CE4E5B9)


@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    """Which code points are letters."""
    return np.fromiter((chr(point).isalpha() for point in range(0x110000)), bool, 0x110000)


def gram_hashes(text: str | None) -> Iterator[np.ndarray]:
    """Hashes of the n-grams of a text: its letters in lower case, other characters as single spaces.

    Nothing for a text without a letter. A long text comes in parts.
    """
    text = text or ""
    tail = np.full(1, 32, np.uint32)
    for at in range(0, len(text), CHUNK):
        points = np.frombuffer(text[at : at + CHUNK].lower().encode("utf-32-le", "surrogatepass"), np.uint32)
        points = np.where(letters()[points], points, np.uint32(32))
        points = np.concatenate([tail, points])
        blank = points == 32
        points = points[~(blank & np.append(False, blank[:-1]))]
        last = at + CHUNK >= len(text)
        if last and (points != 32).any():
            points = np.append(points, np.full(max(1, GRAM - len(points)), 32, np.uint32))
        if len(points) >= GRAM and (points != 32).any():
            codes = points.astype(np.uint64)
            value = codes[: len(codes) - GRAM + 1].copy()
            for i in range(1, GRAM):
                value = value * STEP + codes[i : len(codes) - GRAM + 1 + i]
            value = (value ^ (value >> np.uint64(29))) * MIX
            yield value ^ (value >> np.uint64(32))
        tail = points[1 - GRAM :] if len(points) >= GRAM else points


def slots_of(hashes: np.ndarray, slots: int) -> Iterator[np.ndarray]:
    """The slots of each hash, by double hashing."""
    step = (hashes >> np.uint64(32)) | np.uint64(1)
    for turn in range(HASHES):
        yield ((hashes + np.uint64(turn) * step) % np.uint64(slots)).astype(np.int64)


@dataclass(frozen=True)
class Filters:
    """Masks of languages by slot, the languages by bit, and their rates of false positives."""

    masks: np.ndarray
    languages: tuple[str, ...]

    @property
    def false_rates(self) -> np.ndarray:
        filled = [(self.masks >> np.uint64(bit) & np.uint64(1)).mean() for bit in range(len(self.languages))]
        return np.array(filled) ** HASHES

    def counts(self, text: str | None) -> tuple[int, np.ndarray]:
        """How many n-grams a text has, and how many of them each filter reports."""
        total, found = 0, np.zeros(len(self.languages), np.int64)
        for hashes in gram_hashes(text):
            mask = np.full(len(hashes), ~np.uint64(0))
            for slot in slots_of(hashes, len(self.masks)):
                mask &= self.masks[slot]
            total += len(hashes)
            for bit in range(len(self.languages)):
                found[bit] += np.count_nonzero(mask & np.uint64(1 << bit))
        return total, found

    def predict(self, text: str | None, rates: np.ndarray) -> tuple[str, float]:
        total, found = self.counts(text)
        if not total or not self.languages:
            return UNKNOWN, 0.0
        share = np.clip((found / total - rates) / (1 - rates), 0.0, 1.0)
        best = int(share.argmax())
        return self.languages[best], float(share[best])


def fit(labelled: DataFrame, sample: int = SAMPLE, slots: int = SLOTS, share: float = SHARE) -> Filters:
    """Filters from documents (doc_id, text, lang); rows without a language teach nothing.

    The sample is drawn by a hash of the id, about ``sample`` documents of each
    language. The masks are gathered on the driver: ``slots`` numbers at most.
    """
    labelled = labelled.where("lang is not null and text is not null")
    sizes = {row["lang"]: row["count"] for row in labelled.groupBy("lang").count().limit(MOST_LANGUAGES + 1).collect()}
    if len(sizes) > MOST_LANGUAGES:
        raise ValueError(f"a mask holds {MOST_LANGUAGES} languages")
    languages = tuple(sorted(sizes))
    masks = np.zeros(slots, np.uint64)
    if not languages:
        return Filters(masks, languages)
    spark = labelled.sparkSession
    bits = spark.createDataFrame(
        [(name, bit, min(1.0, sample / sizes[name])) for bit, name in enumerate(languages)],
        "lang string, bit int, rate double",
    )
    chosen = labelled.join(F.broadcast(bits), "lang").where(
        F.pmod(F.xxhash64(F.lit("sample"), "doc_id"), F.lit(1_000_000)) < F.col("rate") * 1_000_000
    )

    def count(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        by_bit: dict[int, list[np.ndarray]] = {}
        for bit, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            by_bit.setdefault(bit, []).extend(gram_hashes(text.as_py()))
        for bit, hashes in by_bit.items():
            if hashes:
                grams, counts = np.unique(np.concatenate(hashes), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(grams), bit, np.int32)), pa.array(grams.view(np.int64)), pa.array(counts)],
                    ["bit", "gram", "count"],
                )

    with small_batches(spark):
        grams = (
            chosen.select("bit", "text")
            .mapInArrow(per_batch(count), "bit int, gram long, count long")
            .groupBy("bit", "gram")
            .agg(F.sum("count").alias("count"))
            .persist()
        )
        totals = {row["bit"]: row["total"] for row in grams.groupBy("bit").agg(F.sum("count").alias("total")).collect()}
    per_language = [
        F.sum(F.when(F.col("bit") == bit, F.col("count") / totals.get(bit, 1)).otherwise(0.0)).alias(f"rate_{bit}")
        for bit in range(len(languages))
    ]
    rates = grams.groupBy("gram").agg(*per_language)
    whole = sum((F.col(f"rate_{bit}") for bit in range(len(languages))), F.lit(0.0))
    mask = F.lit(0).cast("long")
    for bit in range(len(languages)):
        mask = mask + F.when(F.col(f"rate_{bit}") >= whole * share, F.lit(1 << bit)).otherwise(F.lit(0))

    def place(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        hashes = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
        marks = np.tile(batch.column(1).to_numpy(zero_copy_only=False), HASHES)
        where = np.concatenate(list(slots_of(hashes, slots))) if len(hashes) else np.zeros(0, np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(where), pa.array(marks)], ["slot", "mask"])

    placed = rates.select("gram", mask.alias("mask")).mapInArrow(per_batch(place, 1 << 16), "slot long, mask long")
    held = placed.groupBy("slot").agg(F.bit_or("mask").alias("mask")).toArrow()
    grams.unpersist()
    masks[held.column("slot").to_numpy()] = held.column("mask").to_numpy().view(np.uint64)
    return Filters(masks, languages)


def predict(docs: DataFrame, filters: Filters) -> DataFrame:
    """(doc_id, lang_pred, score) of every row, from its text alone.

    ``lang_pred`` is a language of the filters, the first by name on a tie, or
    ``und`` with score 0 for a text that is NULL or has no letter. The score is
    the share of the text's n-grams that the language's filter knows.
    """
    sent = docs.sparkSession.sparkContext.broadcast((filters.masks.tobytes(), filters.languages))

    def make(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        masks, languages = sent.value
        known = Filters(np.frombuffer(masks, np.uint64), languages)
        rates = known.false_rates
        names, scores = [], []
        for text in batch.column(1):
            name, score = known.predict(text.as_py(), rates)
            names.append(name)
            scores.append(score)
        arrays = [batch.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64())]
        yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "lang_pred", "score"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        per_batch(make), "doc_id long, lang_pred string, score double"
    )


def accepted(docs: DataFrame, filters: Filters, least: float = LEAST_SCORE) -> DataFrame:
    """The rows of ``docs`` with a language: not ``und``, and at least ``least`` of the n-grams known.

    Filters without a language accept nothing. Texts go to Python in small
    batches, to find the rejected ones; the rows themselves do not.
    """
    sent = docs.sparkSession.sparkContext.broadcast((filters.masks.tobytes(), filters.languages))

    def rejected(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        masks, languages = sent.value
        known = Filters(np.frombuffer(masks, np.uint64), languages)
        rates = known.false_rates
        found = (known.predict(text.as_py(), rates) for text in batch.column(2))
        gone = pa.array([name == UNKNOWN or score < least for name, score in found], pa.bool_())
        yield batch.select(["_id", "_tag"]).filter(gone)

    own, tag = F.col("doc_id").cast("long"), F.xxhash64("text")
    rows = docs.select(own.alias("_id"), tag.alias("_tag"), "text")
    gone = saved(rows.mapInArrow(per_batch(rejected), "_id long, _tag long").distinct(), "rejected", small=True)
    asked = KeyFilter(gone.select(F.xxhash64("_id", "_tag"))).may_hold(own, tag)
    same = own.eqNullSafe(F.col("_id")) & (tag == F.col("_tag"))
    # only texts that go, and a few more, are moved
    return docs.where(~asked).union(docs.where(asked).join(gone, same, "left_anti"))
