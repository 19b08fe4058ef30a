"""Shared helpers of the training-data operators."""

from __future__ import annotations

import os
import shutil
import tempfile
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarterdeck.plans.storage import checkpoint_root, staging_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Bytes of a batch that crosses to a Python worker: Spark's own 10,000 rows and 64 MB stand several times over in an executor's and its workers' memory.
BATCH_BYTES = 4 << 20
BATCH_LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"
#: glibc raises its limits by itself and then keeps what a worker has freed; fixed ones let it go, also while the worker idles.
GIVEN_BACK = {"MALLOC_MMAP_THRESHOLD_": str(4 << 20), "MALLOC_TRIM_THRESHOLD_": str(4 << 20)}


def importable(spark: SparkSession) -> SparkSession:
    """Let Python workers find this package where it lies (a cluster may ship it with --py-files instead).

    Batches for them are at most ``BATCH_BYTES`` from here on (a smaller limit of the session stays), and they give freed memory back.
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])
    for name, value in GIVEN_BACK.items():
        spark.sparkContext.environment.setdefault(name, value)
    limit = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(BATCH_LIMIT))
    if not 0 < limit <= BATCH_BYTES:
        spark.conf.set(BATCH_LIMIT, BATCH_BYTES)
    return spark


def free_prefix(columns: list[str]) -> str:
    """Underscores, more than any of the columns starts with: names with it clash with none of them."""
    return "_" * (1 + max((len(c) - len(c.lstrip("_")) for c in columns), default=0))


def text_or_empty(column: str = "text") -> Column:
    """The whole text; null counts as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def held_out(column: str = "doc_id") -> Column:
    """Rows never learned from: crc32 of the id as text is a multiple of five (a null id counts as empty text)."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def remove_on_exit(spark: SparkSession, path: str) -> None:
    """A folder of the shared store that goes when the application ends."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(target)


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back; the copy goes when the application ends."""
    spark = df.sparkSession
    path = staging_path(spark, label)
    df.write.parquet(path)
    remove_on_exit(spark, path)
    return spark.read.parquet(path)


def checkpointed(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the cluster's shared folder, for narrow tables."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_slices(batches: Iterable[pa.RecordBatch], column: int, limit: int = 1_000_000) -> Iterator[pa.RecordBatch]:
    """The batches again, cut so that a text column holds about ``limit`` bytes, one row at least."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        start, ends = 0, np.cumsum(sizes, dtype=np.int64)
        while start < batch.num_rows:
            base = int(ends[start - 1]) if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop
    pa.default_memory_pool().release_unused()  # a worker lives on with the next stage's tasks


def batch_of(schema: pa.Schema, columns: Iterable) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)],
        schema=schema,
    )


def ragged_arange(lengths: np.ndarray) -> np.ndarray:
    """0..n-1 for every n of ``lengths``, joined."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total, dtype=np.int64) - np.repeat(ends - lengths, lengths)


@contextmanager
def scratch_folder() -> Iterator[str]:
    """A task's own spill folder, removed when the task leaves it; nothing else reads it."""
    path = tempfile.mkdtemp(prefix="quarterdeck-spill-", dir=os.environ.get("TMPDIR") or None)
    try:
        yield path
    finally:
        shutil.rmtree(path, ignore_errors=True)


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, rounds: int = 100) -> np.ndarray:
    """Weights of a logistic regression with the constant last, on raw columns; Newton steps with a ridge.

    A step is halved until the loss falls: on classes that are nearly parted whole steps overshoot and never settle.
    """
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    z = np.column_stack([(x - mean) / scale, np.ones(len(x))])
    side = np.where(y > 0, -1.0, 1.0)

    def loss(w: np.ndarray) -> float:
        return float(np.logaddexp(0.0, side * (z @ w)).sum() + ridge / 2 * (w @ w))

    w = np.zeros(z.shape[1])
    now = loss(w)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        slope = z.T @ (y - p) - ridge * w
        step = np.linalg.solve((z.T * (p * (1 - p))) @ z + ridge * np.eye(len(w)), slope)
        size = 1.0
        while (then := loss(w + size * step)) > now - 1e-4 * size * (slope @ step) and size > 1e-9:
            size /= 2
        if size <= 1e-9:
            break
        w, now = w + size * step, then
        if np.abs(step).max() < 1e-8:
            break
    raw = w[:-1] / scale
    return np.append(raw, w[-1] - raw @ mean)


def logistic(columns: list[Column], weights: np.ndarray) -> Column:
    z = F.lit(float(weights[-1]))
    for c, w in zip(columns, weights[:-1], strict=True):
        z = z + c * F.lit(float(w))
    return 1.0 / (1.0 + F.exp(-F.greatest(F.least(z, F.lit(700.0)), F.lit(-700.0))))


def labelled_ids(labels: DataFrame, label: str, rows: int) -> DataFrame:
    """doc_id and label of at most ``rows`` labelled documents that may be learned from, in order of a hash of the id.

    Repeated ids with the same label count once; ids with both labels, null ids and null labels are left out.
    """
    known = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
    known = known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min(label).alias("label"), F.max(label).alias("other"))
    known = known.where(F.col("label") == F.col("other")).select("doc_id", F.col("label").cast("int").alias("label"))
    return known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
