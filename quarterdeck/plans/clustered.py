"""Tables clustered by date and ticker at once: rows in the order of interleaved bits, with value ranges per file.

A table that is sorted by date skips files for a date range and reads them all for one ticker, and the other way round. Here both columns
are first mapped to ``1 << BITS`` steps of about equally many rows (dates and tickers alike by sampled bounds), and the bits of
both steps are interleaved: rows near each other in the order are near in both columns. ``write_clustered`` writes ranges of that order as files and
keeps each file's smallest and largest date and ticker in a table beside them; ``read_clustered`` opens only files whose ranges can hold what is asked
for, and filters exactly. Years stay folders of the data, so date filters prune directories too.

Scale: one range shuffle; ``SAMPLE`` rows at most reach the driver for the bounds, and a row per file for the ranges when reading.
A heavy ticker, or date, is several files. Rows with a NULL date or ticker have files' ranges of their own and are found by no range.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BITS = 6
SAMPLE = 20_000


def _bounds(values: list) -> list:
    """At most ``2 ** BITS - 1`` values that divide the sorted sample evenly, each once."""
    steps = 1 << BITS
    return sorted({values[len(values) * i // steps] for i in range(1, steps)}) if values else []


def step_of(column: str, bounds: Sequence) -> Column:
    """How many bounds are not above the value: 0 to ``2 ** BITS - 1``; NULL is 0."""
    if not bounds:
        return F.lit(0)
    held = F.array(*[F.lit(b) for b in bounds])
    return F.coalesce(F.size(F.filter(held, lambda b: b <= F.col(column))), F.lit(0))


def interleaved(first: Column, second: Column) -> Column:
    """The bits of two steps in turn, those of ``first`` leading."""
    out = F.lit(0)
    for i in range(BITS):
        for c, place in ((first, 2 * i + 1), (second, 2 * i)):
            out = out.bitwiseOR(F.shiftleft(F.shiftright(c, i).bitwiseAND(F.lit(1)), place))
    return out


def write_clustered(df: DataFrame, path: str, files: int, date: str = "report_date", ticker: str = "ticker") -> None:
    """Write ``df`` as about ``files`` files under ``path/data`` (a folder per year) and their ranges under ``path/ranges``."""
    sample = df.select(date, ticker).orderBy(F.xxhash64(date, ticker)).limit(SAMPLE).collect()
    days, names = (_bounds(sorted(r[c] for r in sample if r[c] is not None)) for c in (date, ticker))
    placed = df.withColumns({"__day": step_of(date, days), "__name": step_of(ticker, names)})
    placed = placed.withColumn("__order", interleaved(F.col("__day"), F.col("__name"))).drop("__day", "__name")
    ordered = placed.repartitionByRange(files, "__order", ticker, date).sortWithinPartitions("__order", ticker, date).drop("__order")
    ordered.withColumn("report_year", F.year(date)).write.partitionBy("report_year").parquet(f"{path}/data")
    spark = df.sparkSession
    stored = spark.read.schema(df.schema).parquet(f"{path}/data")
    ranges = stored.groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.min(date).alias("min_date"),
        F.max(date).alias("max_date"),
        F.min(ticker).alias("min_ticker"),
        F.max(ticker).alias("max_ticker"),
    )
    ranges.coalesce(1).write.parquet(f"{path}/ranges")


def files_for(spark: SparkSession, path: str, since: dt.date | None = None, until: dt.date | None = None, ticker: str | None = None) -> DataFrame:
    """file, rows and ranges of the files that can hold rows of the dates and the ticker."""
    ranges = spark.read.parquet(f"{path}/ranges")
    if since is not None:
        ranges = ranges.where(F.col("max_date") >= F.lit(since))
    if until is not None:
        ranges = ranges.where(F.col("min_date") <= F.lit(until))
    if ticker is not None:
        ranges = ranges.where((F.col("min_ticker") <= ticker) & (F.col("max_ticker") >= ticker))
    return ranges


def read_clustered(
    spark: SparkSession, path: str, schema, since: dt.date | None = None, until: dt.date | None = None, ticker: str | None = None,
    date: str = "report_date", ticker_column: str = "ticker",
) -> DataFrame:
    """The rows of a date range (both ends included) and a ticker; only files that can hold them are opened."""
    jvm = spark.sparkContext._jvm
    uris = [r["file"] for r in files_for(spark, path, since, until, ticker).select("file").orderBy("file").collect()]
    names = [jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(u)).toString() for u in uris]  # paths as readers take them
    rows = spark.read.schema(schema).parquet(*names) if names else spark.createDataFrame([], schema)
    if since is not None:
        rows = rows.where(F.col(date) >= F.lit(since))
    if until is not None:
        rows = rows.where(F.col(date) <= F.lit(until))
    return rows.where(F.col(ticker_column) == ticker) if ticker is not None else rows
