"""Incremental statement loading with Structured Streaming.

Statement files keep landing in a directory; re-running a batch load would read
everything again. Here a file-source stream picks up only files it has not seen
(its checkpoint records them), cleans the header names, coerces the cells like
the batch reader, and appends to a parquet table through the file sink, whose
commit log makes the append exactly-once even if the job is retried.
``availableNow`` processes whatever has landed and stops, so the same code runs
as a scheduled job or as a continuous stream (``processing_time``).

Files are parsed with the batch reader's options. CSV streams take one schema, applied by
position; a file whose header has other names or another order stops the stream
(``enforceSchema`` is off) instead of loading values under the wrong names.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from quarterdeck.functions.coerce import clean_name, try_date
from quarterdeck.operators.reshape import coerce_types
from quarterdeck.plans.storage import checkpoint_root
from quarterdeck.schemas import LONG_ITEMS
from quarterdeck.sources.delimited import parse_options


def landing_schema(spark: SparkSession, landing_dir: str, sep: str = "\t") -> T.StructType:
    """All-text schema from the header of the files already landed (one small read)."""
    header = spark.read.options(**parse_options(sep)).csv(landing_dir).columns
    return T.StructType([T.StructField(c, T.StringType()) for c in header])


def stream_statements(
    spark: SparkSession,
    landing_dir: str,
    target_path: str,
    section: str,
    checkpoint_location: str | None = None,
    processing_time: str | None = None,
    sep: str = "\t",
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Start the incremental load; returns the running query (``awaitTermination`` to wait).

    The checkpoint defaults to a folder under the shared ``spark.checkpoint.dir``.
    """
    schema = landing_schema(spark, landing_dir, sep)
    reader = spark.readStream.schema(schema).options(**parse_options(sep)).option("enforceSchema", False)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    raw = reader.csv(landing_dir)
    cleaned = raw.toDF(*[clean_name(c) for c in raw.columns])
    types = {c: "bigint" for c in LONG_ITEMS.get(section, ())}
    typed = coerce_types(cleaned, types, default="double").withColumn("report_date", try_date("report_date"))
    ckpt = checkpoint_location or f"{checkpoint_root(spark)}/streams/{section}"
    writer = typed.writeStream.format("parquet").option("path", target_path).option("checkpointLocation", ckpt)
    writer = writer.trigger(processingTime=processing_time) if processing_time else writer.trigger(availableNow=True)
    return writer.outputMode("append").start()


def run_available(query: StreamingQuery, timeout_seconds: float | None = None) -> None:
    """Wait until an ``availableNow`` run ends, however long that takes, and raise its error if it failed.

    With ``timeout_seconds`` the run is stopped after that time and ``TimeoutError`` raised.
    """
    if timeout_seconds is None:
        query.awaitTermination()
    elif not query.awaitTermination(timeout_seconds):
        query.stop()
        raise TimeoutError(f"stream {query.name or query.id} did not finish within {timeout_seconds} s")
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
