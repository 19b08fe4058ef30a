"""Date helpers: look-back windows, fiscal quarter ends, year tests."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

AsOf = _dt.date | str | Column | None


def as_of_col(as_of: AsOf = None) -> Column:
    """The reference date of a report; ``None`` means ``current_date()``.

    Reports relative to "now" are not reproducible, so every report takes the
    date as a parameter and tests pass a fixed one.
    """
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, Column):
        return as_of
    if isinstance(as_of, str):
        as_of = _dt.date.fromisoformat(as_of)
    return F.lit(as_of)


def years_before(as_of: AsOf, years: int) -> Column:
    """``DATE_SUB(as_of, INTERVAL n YEAR)``: Feb 29 clamps to Feb 28."""
    return F.add_months(as_of_col(as_of), -12 * int(years))


def lookback(col: Column | str, years: int, as_of: AsOf = None) -> Column:
    """Predicate ``col >= as_of - n years``. On a stored table it reaches the parquet scan."""
    c = F.col(col) if isinstance(col, str) else col
    return c >= years_before(as_of, years)


def quarter_end(d: Column | str) -> Column:
    """Last day of the calendar quarter that contains ``d``."""
    c = F.col(d) if isinstance(d, str) else d
    return F.last_day(F.make_date(F.year(c), F.quarter(c) * 3, F.lit(1)))


def year_of_label(label: Column | str) -> Column:
    """Year of a date label by its first four characters; NULL if not a number."""
    c = F.col(label) if isinstance(label, str) else label
    return F.substring(c.cast("string"), 1, 4).try_cast("int")
