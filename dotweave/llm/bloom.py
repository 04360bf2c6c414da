"""A Bloom filter of a table's keys, of bounded size, that executors test before they shuffle rows.

The filter has about 16 bits a key and at most ``MOST_BITS``: beyond some millions of
keys it lets more and more rows through that have no match, which costs their shuffle
and never a row. Its words are put together by grouped aggregation; what reaches the
driver and the executors is the filter alone, 4 MB at most.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import mix64

LEAST_BITS, MOST_BITS = 1 << 16, 1 << 25
_SALTS = (0x9AE16A3B2F90404F, 0xC949D7C7509E6557)


def _places(keys: np.ndarray, bits: int) -> np.ndarray:
    """The bits of each key: (salts, keys)."""
    h = np.asarray(keys, np.int64).view(np.uint64)
    return np.stack([mix64(h ^ np.uint64(salt)) & np.uint64(bits - 1) for salt in _SALTS]).astype(np.int64)


def build(keys: DataFrame, column: str) -> Callable[[np.ndarray], np.ndarray]:
    """``test(keys)`` -> whether each may be among the non-null longs of ``column``; it can be used on executors."""
    count = keys.count()
    bits = min(MOST_BITS, max(LEAST_BITS, 1 << (16 * max(count, 1) - 1).bit_length()))

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.unique(_places(np.asarray(batch.column(0).drop_null()), bits).ravel())
            word, start = np.unique(at >> 5, return_index=True)
            mask = np.bitwise_or.reduceat(np.int64(1) << (at & 31), start) if len(at) else at
            yield pa.RecordBatch.from_arrays([pa.array(word), pa.array(mask)], ["word", "mask"])

    made = keys.select(F.col(column).cast("long").alias("k")).mapInArrow(words, "word long, mask long").groupBy("word").agg(F.bit_or("mask").alias("mask")).toPandas()
    table = np.zeros(bits >> 5, np.uint32)
    table[made["word"].to_numpy(np.int64)] = made["mask"].to_numpy(np.int64).astype(np.uint32)
    shared = keys.sparkSession.sparkContext.broadcast(table)

    def test(some: np.ndarray) -> np.ndarray:
        at = _places(some, bits)
        return ((shared.value[at >> 5] >> (at & 31).astype(np.uint32)) & 1).all(axis=0)

    return test


def may_be_among(test: Callable[[np.ndarray], np.ndarray], column: Column) -> Column:
    """``test`` of a non-null long column; only that column is handed to Python."""

    @F.pandas_udf("boolean")
    def run(keys: pd.Series) -> pd.Series:
        return pd.Series(test(keys.to_numpy(np.int64)).astype(bool))

    return run(column)
