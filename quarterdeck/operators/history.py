"""Quality checks over time: a sketch per table and month, merged instead of read again.

``period_sketches`` reduces a table to one small row per month: rows, first and last date, a HyperLogLog sketch of the tickers and a KLL
sketch of one measure. Sketches merge, so the check of a whole table is the merge of its months, and after an append only
the new rows have to be read. ``add_period_sketches`` keeps them in a table of a store; ``checks_from_sketches`` gives the check row per table that
:func:`quarterdeck.operators.quality.data_quality_checks` gives, with distinct tickers within the sketch's error
(about 1.04 / sqrt(2 ** ``HLL_BITS``), 1.6 per cent) and quantiles of the measure within a KLL sketch's rank error (about 1.3 per cent for k = 200).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterdeck.plans.releases import Draft, Table

HLL_BITS = 12
QUANTILES = (0.1, 0.5, 0.9)


def period_sketches(df: DataFrame, name: str, measure: str, key: str = "ticker", date: str = "report_date") -> DataFrame:
    """table_name, period (first day of the month, NULL for rows without a date), rows, dates, and the sketches."""
    return df.groupBy(F.trunc(date, "month").alias("period")).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.min(date).alias("min_date"),
        F.max(date).alias("max_date"),
        F.hll_sketch_agg(F.col(key).cast("string"), HLL_BITS).alias("tickers"),
        F.count(measure).alias("measured"),
        F.kll_sketch_agg_double(F.col(measure).cast("double")).alias("measure"),
    ).select(F.lit(name).alias("table_name"), "*")


def add_period_sketches(draft: Draft, new_rows: Mapping[str, tuple[DataFrame, str]], table: str = "quality_sketches") -> None:
    """Add the sketches of newly appended rows, ``{name: (rows, measure)}``, to those stored; stored rows are not read."""
    parts = [period_sketches(df, name, measure) for name, (df, measure) in new_rows.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionAll(part)
    pieces = draft.write_pieces(table, out.coalesce(1))
    old = draft.tables.get(table)
    draft.set(table, replace(old, pieces=old.pieces + pieces) if old else Table(pieces[0].columns, pieces))


def checks_from_sketches(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One check row per table (and ``by``, e.g. period): rows, distinct tickers, dates and quantiles, merged from the sketches."""
    kll = F.filter(F.collect_list("measure"), lambda s: F.kll_sketch_get_n_double(s) > 0)  # one small sketch per load and month
    merged = sketches.groupBy("table_name", *by).agg(
        F.sum("row_count").alias("row_count"),
        F.hll_sketch_estimate(F.hll_union_agg("tickers")).alias("distinct_tickers"),
        F.min("min_date").alias("min_date"),
        F.max("max_date").alias("max_date"),
        F.sum("measured").alias("measured"),
        kll.alias("parts"),
    )
    whole = F.when(F.size("parts") > 0, F.reduce(F.slice("parts", 2, F.greatest(F.size("parts"), F.lit(1))), F.element_at("parts", 1), F.kll_sketch_merge_double))
    return merged.withColumn("whole", whole).select(
        "table_name",
        *by,
        "row_count",
        "distinct_tickers",
        "min_date",
        "max_date",
        "measured",
        *[F.when(F.col("whole").isNotNull(), F.kll_sketch_get_quantile_double("whole", F.lit(q))).alias(f"measure_p{int(q * 100)}") for q in QUANTILES],
    )
