"""Null-safe arithmetic helpers, all plain Column expressions (JVM side, codegen'd).

The warehouse dialect the queries were written for has three behaviours that
Spark does not share out of the box:

* ``SAFE_DIVIDE(a, b)`` gives NULL for a zero divisor, a NULL side, or a result
  that overflows. Spark's ``/`` raises under ANSI mode, ``try_divide`` returns
  NULL for zero but lets a double overflow through as +-Infinity.
* ``LEAST`` / ``GREATEST`` return NULL as soon as one argument is NULL; Spark
  skips NULL arguments.
* Percent columns are ``SAFE_DIVIDE(...) * 100``.
"""

from __future__ import annotations

from pyspark.sql import Column, WindowSpec
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(x: ColumnOrName | float | int) -> Column:
    if isinstance(x, Column):
        return x
    if isinstance(x, str):
        return F.col(x)
    return F.lit(x)


def safe_divide(a: ColumnOrName, b: ColumnOrName) -> Column:
    """``a / b``; NULL when ``b`` is 0, either side is NULL, or the quotient is infinite."""
    q = F.try_divide(_c(a).cast("double"), _c(b).cast("double"))
    return F.when(F.abs(q) != F.lit(float("inf")), q)


def pct(a: ColumnOrName, b: ColumnOrName) -> Column:
    """``SAFE_DIVIDE(a, b) * 100``."""
    return safe_divide(a, b) * 100


def growth_pct(x: ColumnOrName, window: WindowSpec) -> Column:
    """Period-over-period growth in percent against the previous row of ``window``.

    ``SAFE_DIVIDE(x - LAG(x), LAG(x)) * 100``: a negative base keeps its raw sign.
    All LAG calls over one spec share a single Window operator in the plan.
    """
    prev = F.lag(_c(x)).over(window)
    return safe_divide(_c(x) - prev, prev) * 100


def _strict(fn, cols) -> Column:
    cs = [_c(c) for c in cols]
    any_null = cs[0].isNull()
    for c in cs[1:]:
        any_null = any_null | c.isNull()
    return F.when(~any_null, fn(*cs))


def strict_least(*cols: ColumnOrName | float | int) -> Column:
    """LEAST that returns NULL if any argument is NULL."""
    return _strict(F.least, cols)


def strict_greatest(*cols: ColumnOrName | float | int) -> Column:
    """GREATEST that returns NULL if any argument is NULL."""
    return _strict(F.greatest, cols)


def bytes_to_mb(col: ColumnOrName) -> Column:
    return _c(col) / F.lit(1024 * 1024)
