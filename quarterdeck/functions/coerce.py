"""Lenient type coercion and column-name cleaning.

Statement cells arrive as text; ``""`` marks a missing value. Parsing is lenient:
anything unparseable becomes NULL instead of failing the job (a plain ``CAST``
raises under ANSI mode).
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def try_double(col: Column | str) -> Column:
    """Text to DOUBLE; ``""``, junk and NULL give NULL."""
    return _c(col).cast("string").try_cast("double")


def try_long(col: Column | str) -> Column:
    """Text to BIGINT without losing digits above 2**53.

    ``"0.0"`` is accepted (it is how a float-typed writer prints integers), a
    fractional value gives NULL.
    """
    d = _c(col).cast("string").try_cast("decimal(38,6)")
    return F.when(d == F.floor(d), d.try_cast("bigint"))


def try_bool(col: Column | str) -> Column:
    return _c(col).cast("string").try_cast("boolean")


def try_date(col: Column | str) -> Column:
    """ISO date or timestamp text (``2024-09-30`` or ``2024-09-30T00:00:00.000``) to DATE; the whole text must parse."""
    return _c(col).cast("string").try_cast("timestamp_ntz").cast("date")


_BAD = re.compile(r"[^A-Za-z0-9_]")


def clean_name(name: str) -> str:
    """Warehouse-safe column name: every character outside ``[A-Za-z0-9_]`` becomes ``_``,
    and a leading digit gets a ``_`` prefix (``52WeekChange`` -> ``_52WeekChange``)."""
    out = _BAD.sub("_", name)
    if out and out[0].isdigit():
        out = "_" + out
    return out


def clean_columns(df):
    """Rename every column of ``df`` with :func:`clean_name` (metadata only, no job)."""
    return df.toDF(*[clean_name(c) for c in df.columns])
