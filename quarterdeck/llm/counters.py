"""Corpus-wide counts in a fixed number of hashed cells, added up without gathering them in one group."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterdeck.llm.common import batch_of

CELLS, SLICES = 1 << 20, 64


def cells(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(44)).astype(np.int64)


def sliced(counts: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """A task's counters as rows (slice, counts)."""
    return enumerate(p.astype("<i8").tobytes() for p in np.split(counts, SLICES))


def added(rows: DataFrame) -> np.ndarray:
    """The sum of all tasks' counters; rows has slice and counts. In two steps, each by groups of a few MB."""
    kinds = pa.schema([("slice", pa.int32()), ("counts", pa.binary())])

    def add(group: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(c.as_py(), "<i8") for c in group.column("counts"))
        return pa.Table.from_batches([batch_of(kinds, ([group.column("slice")[0].as_py()], [total.tobytes()]))])

    some = F.pmod(F.xxhash64("counts"), F.lit(256)).cast("int")
    partial = rows.select("slice", "counts", some.alias("part")).groupBy("slice", "part").applyInArrow(add, "slice int, counts binary")
    out, width = np.zeros(CELLS, np.int64), CELLS // SLICES
    for row in partial.groupBy("slice").applyInArrow(add, "slice int, counts binary").collect():  # CELLS numbers
        out[row["slice"] * width : (row["slice"] + 1) * width] = np.frombuffer(row["counts"], "<i8")
    return out
