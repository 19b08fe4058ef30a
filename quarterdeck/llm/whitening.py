"""Whitening of embeddings by shifted CholeskyQR.

The rows are vectors of whole numbers x, centred on their exact mean. To find the components of their covariance without
ever forming it (which would square the condition number) the centred matrix A is orthogonalised:

* A pass over all rows adds up the Gram matrix A'A; with a small multiple of its trace added to the diagonal ("shifted") it has
  a Cholesky factor R even if A lacks rank, and A R^-1, by triangular solves on each row, is closer to orthogonal than A.
* ``PASSES`` such passes give Q with orthonormal columns and R as the product of the factors: A = Q R. The first pass brings
  any condition number below that of the shift, the second and third make Q orthonormal to rounding.
* The singular values of R are those of A and its right singular vectors are the components: one SVD of a d x d matrix.
  The same rows meet the factors anew in each pass; Q is never stored.

Whitened coordinates are (x - mean) . component / sqrt(eigenvalue), and a last pass measures their covariance over all rows.

Scale: the vectors are written once, as whole numbers, and read by five passes (exact sums, ``PASSES`` Gram passes, check) without
a shuffle of rows. A task adds up the Gram matrix of its rows in blocks, only the d (d + 1) / 2 sums of each task are shuffled,
and Spark adds them by cell; the driver gets one matrix of d x d, and tasks get the factors by closure (d x d numbers).

Defined cases: rows whose vector is null, or holds null or non-finite entries, or entries whose x would exceed 2^40 in size, are dropped; so are
vectors of another length than the most common one (the shorter of equally common ones) and empty ones. Repeated rows and rows with a null id
count and are returned each. Components without variance (below rounding: the d-th part of 1e-12 of the largest singular value)
are not returned, so a table of one distinct vector, or without usable rows, gives no rows. Equal eigenvalues leave their components
free up to a rotation: any orthonormal choice is right, and the same one holds for all rows. The sign makes a component's largest entry positive.
``deviation`` is null where a long cannot hold it; ``deviation_exact``, a decimal, holds it always up to 10^38. Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarterdeck.llm.common import batch_of, staged, table

SCALE, OFFSET = 1024, 100_000
COMPONENTS = 8
PASSES = 3
BLOCK = 8192
LARGEST = float(1 << 40)
ROUNDING = 1e-12


def whole_numbers(vectors: DataFrame, scale: int = SCALE, offset: int = OFFSET) -> DataFrame:
    """vec_id and x (array of long) of the usable rows, written once to the shared folder."""
    v = F.col("v")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
    # NaN compares as larger than any number, and a null entry gives null: both are refused.
    fits = F.forall(v, lambda c: F.coalesce(F.abs(c) < F.lit(LARGEST / scale), F.lit(False)))
    rows = rows.where(v.isNotNull() & (F.size(v) > 0) & fits)
    x = F.transform(v, lambda c: F.floor(c * F.lit(float(scale))).cast("long") + F.lit(offset).cast("long"))
    rows = staged(rows.select("vec_id", x.alias("x")), "whole-vectors")
    widths = rows.groupBy(F.size("x").alias("width")).count().orderBy(F.desc("count"), "width").limit(1).collect()
    return rows.where(F.size("x") == (widths[0]["width"] if widths else 0))


def matrix(column: pa.Array, kind: type = np.int64) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def exact_mean(rows: DataFrame) -> tuple[int, list[int]]:
    """Number of rows and their sum in each dimension, as exact whole numbers."""
    kinds = pa.schema([("cell", pa.int32()), ("value", pa.int64()), ("n", pa.int64())])

    def run(batches):
        for b in batches:
            x = matrix(b.column(0))
            for start in range(0, len(x), BLOCK):  # BLOCK numbers below 2^41 cannot overflow
                total = x[start : start + BLOCK].sum(axis=0)
                yield batch_of(kinds, (np.arange(len(total), dtype=np.int32), total, np.full(len(total), len(x[start : start + BLOCK]))))

    sums = rows.select("x").mapInArrow(run, "cell int, value long, n long").groupBy("cell")
    found = sums.agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value"), F.sum("n").alias("n")).orderBy("cell").collect()
    return (found[0]["n"], [int(r["value"]) for r in found]) if found else (0, [])


class Centre:
    """x - S/n: the whole part of the mean is taken off exactly, the rest in double precision."""

    def __init__(self, n: int, sums: list[int]):
        self.n = n
        self.whole = np.array([s // n for s in sums], np.int64)
        self.left = np.array([s % n for s in sums], np.int64)
        self.rest = np.array([(s % n) / n for s in sums])

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return (x - self.whole) - self.rest

    def deviations(self, x: np.ndarray) -> list[int]:
        """Sums of (n x - S)^2 over the dimensions, exact."""
        near = x - self.whole
        largest = (int(np.abs(near).max()) + 1) * self.n if near.size else 0
        if largest * largest * max(1, x.shape[1]) < 2**63:
            d = near * self.n - self.left
            return (d * d).sum(axis=1).tolist()
        d = near.astype(object) * self.n - self.left.astype(object)
        return [int(v) for v in (d * d).sum(axis=1)]


def divided(rows: np.ndarray, factor: np.ndarray) -> np.ndarray:
    """rows . factor^-1 for an upper triangular factor, column by column."""
    out = np.empty_like(rows)
    for j in range(factor.shape[1]):
        out[:, j] = (rows[:, j] - out[:, :j] @ factor[:j, j]) / factor[j, j]
    return out


def gram(rows: DataFrame, width: int, shape) -> np.ndarray:
    """M'M over all rows, M being what ``shape`` makes of a block of x (``width`` columns)."""
    upper = np.triu_indices(width)
    kinds = pa.schema([("cell", pa.int32()), ("value", pa.float64())])

    def run(batches):
        total = np.zeros((width, width))
        for b in batches:
            x = matrix(b.column(0))
            for start in range(0, len(x), BLOCK):
                m = shape(x[start : start + BLOCK])
                total += m.T @ m
        yield batch_of(kinds, (np.arange(len(upper[0]), dtype=np.int32), total[upper]))

    cells = rows.select("x").mapInArrow(run, "cell int, value double").groupBy("cell").agg(F.sum("value").alias("value")).collect()
    out = np.zeros((width, width))
    for r in cells:
        i, j = upper[0][r["cell"]], upper[1][r["cell"]]
        out[i, j] = out[j, i] = r["value"]
    return out


def shifted_factor(g: np.ndarray, first: bool) -> np.ndarray:
    """Upper triangular R with R'R = g + s I; s is a rounding-sized part of the trace, and 0 in a later pass over rows of full rank."""
    trace = float(np.trace(g))
    sound = not first and np.linalg.eigvalsh(g)[0] * len(g) > 1e-8 * trace
    shift = 0.0 if sound else 11 * len(g) * np.finfo(float).eps * trace
    return np.linalg.cholesky(g + shift * np.eye(len(g))).T


def triangular_factor(rows: DataFrame, centre: Centre, passes: int = PASSES) -> np.ndarray:
    """R of the centred rows' QR decomposition."""
    width = len(centre.whole)
    factors: list[np.ndarray] = []
    for _ in range(passes):

        def shape(x: np.ndarray, done=tuple(factors)) -> np.ndarray:
            q = centre(x)
            for r in done:
                q = divided(q, r)
            return q

        g = gram(rows, width, shape)
        if not np.trace(g) > 0:
            return np.zeros((width, width))
        factors.append(shifted_factor(g, not factors))
    total = np.eye(width)
    for r in factors:
        total = r @ total
    return total


def components(factor: np.ndarray, n: int, most: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray, float]:
    """Components as columns, their eigenvalues, and the trace of the covariance."""
    _, sizes, right = np.linalg.svd(factor)
    kept = min(most, int((sizes > ROUNDING * len(sizes) * sizes[0]).sum())) if len(sizes) and sizes[0] > 0 else 0
    axes = right[:kept].T
    axes = axes * np.where(axes[np.abs(axes).argmax(axis=0), np.arange(kept)] < 0, -1.0, 1.0) if kept else axes
    return axes, sizes[:kept] ** 2 / n, float((sizes**2).sum() / n)


def whiten(vectors: DataFrame, most: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error, deviation_exact, by usable row and component."""
    spark = vectors.sparkSession
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double, deviation_exact decimal(38,0)"
    rows = whole_numbers(vectors)
    n, sums = exact_mean(rows)
    if not n:
        return spark.createDataFrame([], schema)
    centre = Centre(n, sums)
    axes, values, trace = components(triangular_factor(rows, centre), n, most)
    k = len(values)
    if not k:
        return spark.createDataFrame([], schema)
    scale = np.sqrt(values)

    def whitened(x: np.ndarray) -> np.ndarray:
        return (centre(x) @ axes) / scale

    error = float(np.abs(gram(rows, k, whitened) / n - np.eye(k)).max())
    explained = values / trace
    kinds = pa.schema([("vec_id", pa.int64()), ("component", pa.int32()), ("deviation_exact", pa.decimal128(38, 0)), ("whitened", pa.float64()), ("explained", pa.float64())])

    def run(batches):
        import decimal

        for b in batches:
            for start in range(0, b.num_rows, BLOCK):
                part = b.slice(start, BLOCK)
                x = matrix(part.column(1))
                far = pa.array([decimal.Decimal(d) if d < 10**38 else None for d in centre.deviations(x)], pa.decimal128(38, 0))
                at = np.repeat(np.arange(len(x)), k)
                yield batch_of(kinds, (part.column(0).take(pa.array(at)), np.tile(np.arange(1, k + 1, dtype=np.int32), len(x)), far.take(pa.array(at)), whitened(x).ravel(), np.tile(explained, len(x))))

    out = rows.mapInArrow(run, "vec_id long, component int, deviation_exact decimal(38,0), whitened double, explained double")
    exact = F.col("deviation_exact")
    fits = F.when(exact < F.lit(str(2**63)).cast("decimal(38,0)"), exact.cast("long"))
    return out.select("vec_id", "component", F.lit(n).cast("long").alias("n"), fits.alias("deviation"), "whitened", "explained", F.lit(error).alias("identity_error"), "deviation_exact")


def op12_shifted_cholesky_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))
