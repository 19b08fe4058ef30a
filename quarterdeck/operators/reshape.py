"""Reshaping and schema alignment: nested documents <-> long form <-> wide statement tables.

The long form ``(ticker, report_date, line_item, value)`` is the scalable
internal shape: it needs no fixed column set, new line items are just new rows,
and unions across companies need no column alignment. Wide tables are built from
it with one conditional aggregation over an explicit item list (no extra job to
discover the values) and typed with lenient coercion.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarterdeck.functions.coerce import try_bool, try_date, try_double, try_long
from quarterdeck.functions.dates import year_of_label
from quarterdeck.schemas import PROFILE_ATTRIBUTES, item_type

MISSING_TICKER = "N/A"

_CASTERS = {
    "double": try_double,
    "bigint": try_long,
    "long": try_long,
    "boolean": try_bool,
    "date": try_date,
    "string": lambda c: (F.col(c) if isinstance(c, str) else c).cast("string"),
}


def _clean_item(col: Column) -> Column:
    """Column-side twin of :func:`quarterdeck.functions.clean_name` for item names held in data."""
    cleaned = F.regexp_replace(col, r"[^A-Za-z0-9_]", "_")
    return F.when(cleaned.rlike(r"^[0-9]"), F.concat(F.lit("_"), cleaned)).otherwise(cleaned)


def with_ticker(df: DataFrame, ticker: str | Column = "ticker") -> DataFrame:
    """Key column ``ticker`` first; a missing ticker becomes ``"N/A"``."""
    t = F.col(ticker) if isinstance(ticker, str) else ticker
    rest = [c for c in df.columns if c != "ticker"]
    return df.select(F.coalesce(t, F.lit(MISSING_TICKER)).alias("ticker"), *rest)


def _document(docs: DataFrame) -> list[str]:
    return ["document"] if "document" in docs.columns else []


def _cells(cells: DataFrame, keep_missing: bool) -> DataFrame:
    """``""`` is a missing value: dropped, or kept as NULL."""
    value = F.nullif(F.col("value"), F.lit(""))
    return cells.withColumn("value", value) if keep_missing else cells.where(value.isNotNull())


def statement_long(docs: DataFrame, section: str, period: str | None = None, keep_missing: bool = False) -> DataFrame:
    """Unpivot a map-shaped statement ``{item: {date: value}}`` to
    ``(ticker, report_date, line_item, value)``; ``""`` values are dropped (missing).

    Two ``explode`` generators, no shuffle. Item names are cleaned to column names.
    ``period`` (e.g. ``"annual"`` / ``"quarterly"``) adds a ``period`` column so that
    annual and quarterly sections can share one long table. With ``keep_missing`` a
    missing cell is a row with a NULL value, so that a report without any value stays a report. A ``document``
    column of ``docs`` is carried along.
    """
    own = _document(docs)
    items = docs.select(
        *own,
        F.coalesce(F.col("ticker"), F.lit(MISSING_TICKER)).alias("ticker"),
        F.explode(F.col(section)).alias("item", "dates"),
    )
    cells = items.select(*own, "ticker", "item", F.explode("dates").alias("date", "value"))
    out = _cells(cells, keep_missing).select(
        *own,
        "ticker",
        try_date("date").alias("report_date"),
        _clean_item(F.col("item")).alias("line_item"),
        F.col("value"),
    )
    return out.withColumn("period", F.lit(period)) if period else out


def wide_to_long(df: DataFrame, keys: Sequence[str] = ("ticker", "report_date"), value_type: str = "double") -> DataFrame:
    """Unpivot a wide statement into ``(*keys, line_item, value)``; NULL cells are dropped."""
    values = [c for c in df.columns if c not in keys]
    long = df.select(*keys, *[F.col(c).cast(value_type).alias(c) for c in values]).unpivot(
        list(keys), values, "line_item", "value"
    )
    return long.where(F.col("value").isNotNull())


def statement_wide(
    long: DataFrame,
    items: Sequence[str],
    section: str | None = None,
    types: Mapping[str, str] | None = None,
) -> DataFrame:
    """Pivot the long form to one row per ``(ticker, report_date)`` and one column per item.

    ``items`` is the explicit column list. The pivot is one conditional aggregation
    (``max(value) FILTER (line_item = item)`` per item): one exchange, combined
    map-side, where ``pivot`` plans two aggregations. Values are coerced leniently
    before aggregating (so numeric items use hash-aggregate buffers): DOUBLE by
    default, BIGINT for the section's share-count items, or whatever ``types`` says.
    A ``document`` column of ``long`` is part of the key and of the result: a row per document and
    date. Of several values of one cell the greatest counts.
    """
    own = _document(long)
    item = F.col("line_item")
    types = dict(types or {})

    def typed(it: str) -> Column:
        t = types.get(it) or (item_type(section, it) if section else "double")
        return _CASTERS[t](F.col("value"))

    # Cast inside the condition: numeric items then aggregate in fixed-width (hash) buffers.
    wide = long.groupBy(*own, "ticker", "report_date").agg(
        *[F.max(F.when(item == F.lit(it), typed(it))).alias(it) for it in items]
    )
    return wide.select(*own, "ticker", "report_date", *[F.col(f"`{it}`") for it in items])


def unparseable_dates(docs: DataFrame, section: str) -> DataFrame:
    """``(ticker, labels)``: how many date labels of a map-shaped section are no dates; their cells have a NULL report_date."""
    ticker = F.coalesce(F.col("ticker"), F.lit(MISSING_TICKER)).alias("ticker")
    labels = F.array_distinct(F.flatten(F.transform(F.map_values(F.col(section)), F.map_keys)))
    found = docs.select(ticker, F.explode(labels).alias("label")).where(try_date("label").isNull())
    return found.groupBy("ticker").agg(F.count(F.lit(1)).alias("labels"))


def lenient(col: Column, dtype: str) -> Column:
    """``col`` as ``dtype``; text that does not parse is NULL."""
    return _CASTERS[dtype](col)


def coerce_types(df: DataFrame, types: Mapping[str, str], default: str | None = None) -> DataFrame:
    """Lenient coercion driven by a dictionary, applied only to columns that exist.

    Unparseable text becomes NULL (the warehouse loader's ``errors='coerce'``).
    ``default`` (e.g. ``"double"``) types every other non-key column as well.
    """
    out = []
    for c in df.columns:
        t = types.get(c, default if c not in ("ticker", "report_date") else None)
        out.append(_CASTERS[t](F.col(f"`{c}`")).alias(c) if t else F.col(f"`{c}`"))
    return df.select(*out)


def union_by_name(*dfs: DataFrame) -> DataFrame:
    """Union by column name, NULL-filling columns a frame lacks.

    Column order: the first frame's columns, then every newly seen column in
    sorted order (deterministic, unlike a set difference). One ``Union`` node,
    no shuffle.
    """
    if not dfs:
        raise ValueError("union_by_name needs at least one DataFrame")
    first = list(dfs[0].columns)
    seen = set(first)
    new: set[str] = set()
    for d in dfs[1:]:
        new.update(c for c in d.columns if c not in seen)
    order = first + sorted(new)
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d, allowMissingColumns=True)
    return out.select(*[F.col(f"`{c}`") for c in order])


def _year_set(years: Iterable[int]) -> list[int]:
    return sorted({int(y) for y in years})


def filter_years(docs: DataFrame, years: Iterable[int], sections: Sequence[str]) -> DataFrame:
    """Keep, inside each map-shaped statement, only dates whose year is in ``years``.

    Date labels whose first four characters are not a number are dropped. An
    empty ``years`` keeps everything. Runs as ``transform_values``/``map_filter``
    inside each row: no explode, no shuffle.
    """
    ys = _year_set(years)
    if not ys:
        return docs
    keep = F.array(*[F.lit(y) for y in ys])

    def dates_in(m: Column) -> Column:
        return F.map_filter(m, lambda d, v: F.array_contains(keep, year_of_label(d)))

    return docs.withColumns({s: F.transform_values(F.col(s), lambda k, m: dates_in(m)) for s in sections})


def filter_years_records(docs: DataFrame, years: Iterable[int], sections: Sequence[str]) -> DataFrame:
    """Record-shaped sections: keep a record if its ``calendarYear`` (compared as a
    number) or the first four characters of its ``date`` are in ``years``."""
    ys = _year_set(years)
    if not ys:
        return docs
    keep = F.array(*[F.lit(y) for y in ys])

    def wanted(r: Column) -> Column:
        by_year = F.array_contains(keep, r["calendarYear"].try_cast("int"))
        by_date = F.array_contains(keep, year_of_label(r["date"]))
        return F.coalesce(by_year, F.lit(False)) | F.coalesce(by_date, F.lit(False))

    return docs.withColumns({s: F.filter(F.col(s), wanted) for s in sections})


def records_long(docs: DataFrame, section: str, keep_missing: bool = False) -> DataFrame:
    """Record-shaped section to the long form: one row per record and item (see :func:`statement_long`)."""
    own = _document(docs)
    recs = docs.select(
        *own,
        F.coalesce(F.col("ticker"), F.lit(MISSING_TICKER)).alias("ticker"),
        F.explode(F.col(section)).alias("r"),
    )
    cells = recs.select(
        *own,
        "ticker",
        try_date(F.col("r")["date"]).alias("report_date"),
        F.explode(F.map_filter("r", lambda k, v: ~k.isin("date", "calendarYear", "period"))).alias("item", "value"),
    )
    return _cells(cells, keep_missing).select(
        *own, "ticker", "report_date", _clean_item(F.col("item")).alias("line_item"), "value"
    )


def company_profile(
    docs: DataFrame,
    attributes: Sequence[tuple[str, str, str]] = PROFILE_ATTRIBUTES,
    report_date: _dt.date | None = None,
) -> DataFrame:
    """One typed profile row per document.

    The nested officer list is removed from the attribute map first; each
    attribute is then read by name and coerced to its type. ``report_date`` is
    1970-01-01 unless an as-of date is given (the warehouse files carry that
    artefact of a row index turned into a date).
    """
    info = F.map_filter(F.col("company_info"), lambda k, v: k != "companyOfficers")
    rd = report_date or _dt.date(1970, 1, 1)
    base = docs.select(F.coalesce(F.col("ticker"), F.lit(MISSING_TICKER)).alias("ticker"), info.alias("_info"))
    return base.select(
        "ticker",
        F.lit(rd).alias("report_date"),
        *[_CASTERS[t](F.col("_info")[src]).alias(dst) for src, t, dst in attributes],
    )
