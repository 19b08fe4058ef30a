"""Data-quality checks, row counts and table summaries.

All checks are single aggregations per table (partial aggregation on the map
side, one tiny shuffle), unioned by name. Distinct counts are exact by default;
``approx=True`` switches to HyperLogLog++ (``approx_count_distinct``), which
keeps a fixed-size sketch per task instead of shuffling every distinct key.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def data_quality_checks(
    tables: Mapping[str, DataFrame],
    key: str = "ticker",
    date: str = "report_date",
    approx: bool = False,
    stamp: bool = True,
) -> DataFrame:
    """One row per table: rows, distinct tickers, first and last report date."""
    distinct = F.approx_count_distinct if approx else F.count_distinct
    parts = [
        df.agg(
            F.count(F.lit(1)).alias("row_count"),
            distinct(F.col(key)).alias("distinct_tickers"),
            F.min(date).alias("min_date"),
            F.max(date).alias("max_date"),
        ).select(F.lit(name).alias("table_name"), "*")
        for name, df in tables.items()
    ]
    out = _union(parts)
    return out.withColumn("check_time", F.current_timestamp()) if stamp else out


def duplicate_keys(df: DataFrame, keys: Sequence[str] = ("ticker", "report_date")) -> DataFrame:
    """Keys that occur more than once, with their count (the tables assume uniqueness)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``(table_name, row_count)``; parquet answers a bare count from its footers."""
    return _union([df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(n).alias("table_name"), "*") for n, df in tables.items()])


def table_summary(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``(table_name, row_count, column_count)``; the column count comes from the schema."""
    return _union(
        [
            df.agg(F.count(F.lit(1)).alias("row_count")).select(
                F.lit(n).alias("table_name"), "row_count", F.lit(len(df.columns)).cast("bigint").alias("column_count")
            )
            for n, df in tables.items()
        ]
    )


def load_check(inserted: DataFrame, table: DataFrame, name: str) -> DataFrame:
    """Rows inserted by a load against rows now in the table (one pass over a tagged union)."""
    tagged = inserted.select(F.lit(True).alias("_new")).unionByName(table.select(F.lit(False).alias("_new")))
    return tagged.agg(
        F.count_if("_new").alias("inserted_rows"), F.count_if(~F.col("_new")).alias("total_rows")
    ).select(F.lit(name).alias("table_name"), "inserted_rows", "total_rows")
