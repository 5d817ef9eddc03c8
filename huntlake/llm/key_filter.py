"""A Bloom filter of 64-bit keys that is sent to all tasks, of one size whatever it holds."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from huntlake.llm.common import per_batch, small_batches
from huntlake.llm.recompression import STEP_A, STEP_B, mix

#: Bits of a filter, 16 MB; a power of two.
FILTER_BITS = 1 << 27


class KeyFilter:
    """A Bloom filter of keys, ``FILTER_BITS`` large whatever it holds."""

    def __init__(self, keys: DataFrame):
        def make(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            bits = np.concatenate(list(self.bits_of(batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64))))
            word = (bits >> np.uint64(6)).astype(np.int64)
            mask = (np.uint64(1) << (bits & np.uint64(63))).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(word), pa.array(mask)], ["word", "mask"])

        placed = keys.mapInArrow(per_batch(make, 1 << 16), "word long, mask long")
        with small_batches(keys.sparkSession):
            held = placed.groupBy("word").agg(F.bit_or("mask").alias("mask")).toArrow()
        words = np.zeros(FILTER_BITS >> 6, np.int64)
        words[held.column("word").to_numpy()] = held.column("mask").to_numpy()
        self.sent = keys.sparkSession.sparkContext.broadcast(words.tobytes())

    @staticmethod
    def bits_of(keys: np.ndarray) -> Iterator[np.ndarray]:
        for seed in (STEP_A, STEP_B, 1):
            yield mix(keys ^ np.uint64(seed)) & np.uint64(FILTER_BITS - 1)

    def __enter__(self) -> KeyFilter:
        return self

    def __exit__(self, *_: object) -> None:
        """Take the filter from driver and executors; what was made with it must be written by then."""
        self.sent.destroy()

    def may_hold(self, *columns: Column | str) -> Column:
        """Whether the hash of ``columns`` may be among the keys; the hashes alone go through Python."""

        @F.arrow_udf("boolean")
        def asked(keys: pa.Array) -> pa.Array:
            return pa.array(self.has(keys.to_numpy(zero_copy_only=False).view(np.uint64)))

        return asked(F.xxhash64(*columns))

    def has(self, keys: np.ndarray) -> np.ndarray:
        words, found = np.frombuffer(self.sent.value, np.uint64), np.ones(len(keys), bool)
        for bits in self.bits_of(keys):
            found &= (words[bits >> np.uint64(6)] >> (bits & np.uint64(63)) & np.uint64(1)).astype(bool)
        return found
