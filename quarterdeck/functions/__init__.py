"""Column-expression helpers shared by every operator."""

from quarterdeck.functions.arith import (
    bytes_to_mb,
    growth_pct,
    pct,
    safe_divide,
    strict_greatest,
    strict_least,
)
from quarterdeck.functions.coerce import (
    clean_columns,
    clean_name,
    try_bool,
    try_date,
    try_double,
    try_long,
)
from quarterdeck.functions.dates import as_of_col, lookback, quarter_end, year_of_label, years_before

__all__ = [
    "as_of_col",
    "bytes_to_mb",
    "clean_columns",
    "clean_name",
    "growth_pct",
    "lookback",
    "pct",
    "quarter_end",
    "safe_divide",
    "strict_greatest",
    "strict_least",
    "try_bool",
    "try_date",
    "try_double",
    "try_long",
    "year_of_label",
    "years_before",
]
