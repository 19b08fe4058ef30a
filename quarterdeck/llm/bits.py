"""A bitmap of fixed size over a table's keys: lets a pass over the texts leave out what a join would drop.

It only saves work: a key that is in the table always passes, others may, and with a full bitmap all do.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITS = 1 << 26


def bitmap(keys: DataFrame, column: str) -> np.ndarray:
    """BITS bits, as words of 64; ``column`` holds 64-bit hashes. Words are combined before they reach the driver (8 MB at most)."""
    place = F.shiftrightunsigned(F.col(column), 64 - 26)
    words = keys.groupBy(F.shiftright(place, 6).alias("word")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), (place % 64).cast("int"))).alias("bits")
    )
    out = np.zeros(BITS >> 6, np.uint64)
    got = words.toArrow()
    out[got.column("word").to_numpy()] = got.column("bits").to_numpy().view(np.uint64)
    return out


def passes(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    place = keys.view(np.uint64) >> np.uint64(64 - 26)
    return (bits[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1) != 0


def with_bits(texts: DataFrame, bits, among: bool, column: str = "mark") -> DataFrame:
    """The documents that pass (or that do not) by their mark; no shuffle."""

    def run(batches):
        for batch in batches:
            hit = passes(bits.value, batch.column(column).to_numpy())
            yield batch.filter(pa.array(hit if among else ~hit))

    return texts.mapInArrow(run, texts.schema)
