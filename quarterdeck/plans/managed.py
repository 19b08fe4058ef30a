"""Managed (typed, curated) statement and profile tables.

The managed layer fixes each table's column list. A listed column the input does
not have is added as a typed NULL (the warehouse would reject the statement;
statement files differ per company, so we keep the load going and the schema
stable). Every table gets ``loaded_at`` unless ``stamp=False``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from quarterdeck.operators.reshape import lenient
from quarterdeck.schemas import (
    LONG_ITEMS,
    MANAGED_BALANCE_COLUMNS,
    MANAGED_INCOME_COLUMNS,
    PROFILE_ATTRIBUTES,
)


def _col_or_null(df: DataFrame, name: str, dtype: str) -> Column:
    if name in df.columns:
        if isinstance(df.schema[name].dataType, StringType):  # text of a file: what does not parse is NULL
            return lenient(F.col(f"`{name}`"), dtype).alias(name)
        return F.col(f"`{name}`").cast(dtype).alias(name)
    return F.lit(None).cast(dtype).alias(name)


def _stamp(df: DataFrame, stamp: bool) -> DataFrame:
    return df.withColumn("loaded_at", F.current_timestamp()) if stamp else df


def managed_statement(df: DataFrame, columns: Sequence[str], section: str, stamp: bool = True) -> DataFrame:
    """``report_date`` as DATE, ``ticker``, then ``columns`` in order (share counts BIGINT, rest DOUBLE)."""
    longs = set(LONG_ITEMS.get(section, ()))
    out = df.select(
        F.col("report_date").cast("date").alias("report_date"),
        F.col("ticker"),
        *[_col_or_null(df, c, "bigint" if c in longs else "double") for c in columns],
    )
    return _stamp(out, stamp)


def managed_balance(df: DataFrame, stamp: bool = True) -> DataFrame:
    return managed_statement(df, MANAGED_BALANCE_COLUMNS, "balance_sheet", stamp)


def managed_income(df: DataFrame, stamp: bool = True) -> DataFrame:
    return managed_statement(df, MANAGED_INCOME_COLUMNS, "income_statement", stamp)


def managed_cash_flow(df: DataFrame, stamp: bool = True) -> DataFrame:
    """Keys first, then every other column as it is (``* EXCEPT (report_date, ticker)``)."""
    rest = [c for c in df.columns if c not in ("report_date", "ticker")]
    out = df.select(F.col("report_date").cast("date").alias("report_date"), "ticker", *[F.col(f"`{c}`") for c in rest])
    return _stamp(out, stamp)


def managed_profile(df: DataFrame, stamp: bool = True) -> DataFrame:
    """The 28-column profile: attributes renamed (``displayName`` -> ``company``,
    ``address1`` -> ``address``) and typed. Accepts source or managed names."""
    cols = [F.col("report_date").cast("date").alias("report_date"), F.col("ticker")]
    for src, dtype, dst in PROFILE_ATTRIBUTES:
        name = src if src in df.columns else dst
        cols.append(_col_or_null(df, name, dtype).alias(dst))
    return _stamp(df.select(*cols), stamp)
