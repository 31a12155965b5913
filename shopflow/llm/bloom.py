"""Bloom filters built and tested by Spark tasks."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopflow.llm.common import python_ready

#: bits of a filter that only saves work; fixed, so that its broadcast is bounded
MOST_BITS = 1 << 26


def positions(keys: np.ndarray, seed: int, j: int, bits: int) -> np.ndarray:
    """Bit number of each 64-bit key for hash j of the filter with that seed."""
    x = keys.astype(np.uint64) + np.uint64(((seed * 64 + j + 1) * 0x9E3779B97F4A7C15) % 2 ** 64)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return (x ^ (x >> np.uint64(31))) % np.uint64(bits)


@dataclass
class Bloom:
    bits: int
    hashes: int
    seed: int
    words: np.ndarray

    def passes(self, keys: np.ndarray) -> np.ndarray:
        out = np.ones(len(keys), bool)
        for j in range(self.hashes):
            at = positions(keys, self.seed, j, self.bits)
            out &= (self.words[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) == 1
        return out


def sized(n: int, wrong: float) -> tuple[int, int]:
    """Bits and hashes of a filter of n keys with that false positive rate."""
    bits = max(64, math.ceil(n * -math.log(wrong) / math.log(2) ** 2))
    return bits, max(1, min(60, round(bits / max(n, 1) * math.log(2))))


def build(keys: DataFrame, bits: int, hashes: int, seed: int = 0) -> Bloom:
    """Filter of the table's one column (long). Each task sets bits for its
    keys; the words are combined by a partial bit_or, so at most bits / 64
    numbers reach the driver."""
    python_ready(keys.sparkSession)

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column(0).to_numpy(zero_copy_only=False)
            at = np.unique(np.concatenate([positions(own, seed, j, bits) for j in range(hashes)]))
            word, bit = (at >> np.uint64(6)).astype(np.int64), np.uint64(1) << (at & np.uint64(63))
            starts = np.flatnonzero(np.diff(word, prepend=-1))
            mask = np.bitwise_or.reduceat(bit, starts) if len(starts) else bit
            yield pa.RecordBatch.from_arrays(
                [pa.array(word[starts]), pa.array(mask.view(np.int64))], ["word", "mask"])

    got = keys.mapInArrow(words, "word long, mask long").groupBy("word").agg(F.bit_or("mask").alias("mask"))
    table = got.toPandas()
    out = np.zeros(bits // 64 + 1, np.uint64)
    out[table["word"].to_numpy(np.int64)] = table["mask"].to_numpy(np.int64).view(np.uint64)
    return Bloom(bits, hashes, seed, out)


def covering(ids: DataFrame, n: int) -> Bloom:
    """Filter that accepts every id in ``ids`` (n rows of one long column) and
    few others. It has at most ``MOST_BITS`` bits: with more ids it lets more
    through, so an exact join has to follow."""
    bits, hashes = sized(n, 0.01)
    if bits > MOST_BITS:
        bits, hashes = MOST_BITS, max(1, round(MOST_BITS / n * math.log(2)))
    return build(ids, bits, hashes)


def may_hold(ids: DataFrame, column: Column, n: int) -> Column:
    """Condition on ``column`` that ``covering`` accepts it."""
    shared = ids.sparkSession.sparkContext.broadcast(covering(ids, n))

    @F.pandas_udf("boolean")
    def test(keys: pd.Series) -> pd.Series:
        return pd.Series(shared.value.passes(keys.to_numpy(np.int64)))
    return test(column)
