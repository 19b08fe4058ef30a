"""Refreshing the analytics tables of a store from what a load changed.

All five derived tables are computed ticker by ticker (ratios join reports of one ticker, trends look at its neighbouring reports, the
snapshot at its latest, the comparison at its year before). So after a keyed load only the tickers with new or changed reports are computed again,
from their stored rows: a report that arrives late changes the growth, rank and comparison of its neighbours like any other.

``load_batch`` merges statement batches by key, refreshes the derived tables and publishes everything as one release. Statements and derived tables are
dealt to buckets by ticker; a refresh reads and rewrites the buckets of changed tickers only and leaves the files of all others.
``rolling_window`` keeps a table's last months in a folder for each month.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Collection, Mapping, Sequence
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterdeck.functions.lattice import as_types, types_of
from quarterdeck.operators import metrics as M
from quarterdeck.plans.merge import Merged, merge_rows
from quarterdeck.plans.releases import Draft, Piece, Release, Table, TableStore, bucket_of, rows_of

KEYS = ("ticker", "report_date")
TICKER = ("ticker",)
STATEMENTS = ("income_statement", "balance_sheet", "cash_flow_statement", "company_info")
#: Derived table -> statements that it is made from, and how.
DERIVED: dict[str, tuple[tuple[str, ...], Callable[..., DataFrame]]] = {
    "financial_ratios": (("income_statement", "balance_sheet"), M.financial_ratios),
    "balance_sheet_trends": (("balance_sheet",), M.balance_sheet_trends),
    "income_statement_trends": (("income_statement",), M.income_statement_trends),
    "company_snapshot_latest": (("income_statement", "balance_sheet", "company_info"), M.company_snapshot_latest),
    "yoy_comparison": (("income_statement",), M.yoy_comparison),
}


def pieces_of(draft: Draft, name: str, buckets: Collection[int]) -> list[Piece]:
    return [p for p in draft.tables[name].pieces if p.bucket in buckets]


def of_tickers(draft: Draft, name: str, tickers: DataFrame, buckets: Collection[int]) -> DataFrame:
    """A table's rows of some tickers; only the files of their buckets are read. NULL counts as a ticker of its own."""
    rows = rows_of(draft.spark, draft.store.root, draft.tables[name], pieces_of(draft, name, buckets))
    wanted = tickers.select(F.col("ticker").alias("__ticker"))
    return rows.join(wanted, F.col("ticker").eqNullSafe(F.col("__ticker")), "left_semi")


def replace_tickers(draft: Draft, name: str, rows: DataFrame, tickers: DataFrame, touched: Collection[int], buckets: int) -> Table:
    """Put ``rows`` in the place of all rows of ``tickers``; buckets (by ticker) without any of them keep their files."""
    old = draft.tables.get(name)
    if old is None:
        return draft.set(name, Table(types_of(rows), draft.write_pieces(name, rows, TICKER, buckets, TICKER), buckets=buckets, deal=TICKER))
    gone = tickers.select(F.col("ticker").alias("__ticker"))
    kept = rows_of(draft.spark, draft.store.root, old, pieces_of(draft, name, touched))
    kept = kept.join(gone, F.col("ticker").eqNullSafe(F.col("__ticker")), "left_anti")
    both = kept.unionAll(rows.select(*as_types(rows, old.columns)))
    new = draft.write_pieces(name, both, TICKER, buckets, TICKER)
    return draft.set(name, replace(old, pieces=(*(p for p in old.pieces if p.bucket not in touched), *new)))


def refresh(draft: Draft, tickers: DataFrame, buckets: int, stamp: bool = True) -> tuple[int, ...]:
    """Compute the derived tables of ``tickers`` again; returns the buckets that were touched."""
    touched = {r[0] for r in tickers.select(bucket_of(TICKER, buckets).alias("b")).distinct().collect()}
    if not touched:
        return ()
    for name, (sources, make) in DERIVED.items():
        if all(s in draft.tables for s in sources):
            made = make(*[of_tickers(draft, s, tickers, touched) for s in sources], stamp=stamp)
            replace_tickers(draft, name, made, tickers, touched, buckets)
    return tuple(sorted(touched))


def load_batch(store: TableStore, batches: Mapping[str, DataFrame], buckets: int = 32, stamp: bool = True, note: str = "") -> tuple[Release, dict[str, Merged]]:
    """Merge statement batches by ticker and date, refresh what follows from them, publish it all in one step.

    ``batches``: any of ``income_statement``, ``balance_sheet``, ``cash_flow_statement`` and ``company_info``. A batch without news publishes nothing.
    """
    unknown = sorted(set(batches) - set(STATEMENTS))
    if unknown:
        raise ValueError(f"no statement tables: {', '.join(unknown)}")
    with store.draft() as draft:
        done: dict[str, Merged] = {}
        changed = None
        for name, df in batches.items():
            done[name] = merged = merge_rows(draft, name, df, KEYS, buckets, deal_by=TICKER)
            if merged.changed is not None:
                own = merged.changed.select("ticker")
                changed = own if changed is None else changed.unionAll(own)
        if changed is not None:
            numbers = {t.buckets for n, t in draft.tables.items() if n in STATEMENTS}
            if len(numbers) > 1:
                raise ValueError(f"the statements are dealt to different numbers of buckets: {sorted(numbers)}")
            refresh(draft, changed.distinct(), numbers.pop(), stamp)
        return draft.commit(note), done


def month_of(day: dt.date) -> int:
    return day.year * 12 + day.month - 1


def rolling_window(draft: Draft, name: str, rows: DataFrame, as_of: dt.date, months: int = 12, changed: Sequence[dt.date] | None = None, date: str = "report_date") -> tuple[int, ...]:
    """Keep ``rows`` of the ``months`` months up to ``as_of`` as a table with one piece a month; returns the months written.

    ``changed`` lists dates whose months have new rows since the last call (None: all). Months that left the window are dropped
    without being read, months that entered it or changed are written, all others keep their files. The window begins on the
    first day of its first month and ends with ``as_of``; the last month is written anew until it is complete.
    """
    last = month_of(as_of)
    window = range(last - months + 1, last + 1)
    old = draft.tables.get(name)
    have = {p.bucket: p for p in old.pieces} if old else {}
    dirty = {m for m in window if m not in have or m == last or changed is None} | {month_of(d) for d in changed or ()} & set(window)
    write = sorted(dirty)
    first = dt.date(write[0] // 12, write[0] % 12 + 1, 1)
    month = (F.year(date) * 12 + F.month(date) - 1).cast("int")
    fresh = rows.where((F.col(date) >= F.lit(first)) & (F.col(date) <= F.lit(as_of)) & month.isin(*write))
    pieces = draft.write_pieces(name, fresh, place=month)
    kept = tuple(p for m, p in sorted(have.items()) if m in window and m not in dirty)
    draft.set(name, Table(types_of(rows), kept + pieces))
    return tuple(write)
