"""A filter of fixed size for 64-bit keys: it passes all of them, and some others.

Tasks use it to leave out rows that a later join would drop; it grows with nothing, so that
it may be broadcast at any data size. A fuller filter only leaves out less.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partledger.llm.words import mix

#: Bits of the filter; 8 MB.
FILTER_BITS = 26


def bit_of(keys: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (mix(keys) >> np.uint64(64 - FILTER_BITS)).astype(np.int64)


def in_filter(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    bit = bit_of(keys)
    return (bits[bit >> 6] >> (bit & 63).astype(np.uint64)) & np.uint64(1) == 1


def filter_of(keys: DataFrame) -> np.ndarray:
    """The bits set by the only column, a long: 2**20 words of 64 at most reach the driver."""
    (name,) = keys.columns

    def set_bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bit = bit_of(batch.column(0).to_numpy().view(np.uint64))
            ones = (np.uint64(1) << (bit & 63).astype(np.uint64)).view(np.int64)
            yield pa.RecordBatch.from_pydict({"place": pa.array(bit >> 6), "ones": pa.array(ones)})

    given = keys.filter(F.col(name).isNotNull())
    words = given.mapInArrow(set_bits, "place long, ones long").groupBy("place").agg(F.bit_or("ones").alias("ones"))
    table = words.toArrow()
    bits = np.zeros(1 << (FILTER_BITS - 6), np.uint64)
    bits[table["place"].to_numpy()] = table["ones"].to_numpy().view(np.uint64)
    return bits
