"""Company documents (JSON): map shape and record shape, read and write.

Map shape (one document per company): each statement is ``{line item: {date: value}}``
with ``""`` for a missing value, and ``company_info`` is a flat attribute map.
Record shape: each section is a list of records holding ``date`` and
``calendarYear`` next to the items; a section that could not be fetched is an object
``{"error": text}`` instead.

Writers pack a report's cells into one row before the shuffle and build the nesting inside the
row. ``split_years=True`` writes a document per company and year, so that no company is one task's work;
readers treat every document alike.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarterdeck.schemas import MAP_DOCUMENT_SCHEMA, RECORD_DOCUMENT_SCHEMA

_RECORD_LIST = "array<map<string,string>>"


def read_documents(
    spark: SparkSession,
    path: str,
    shape: str = "map",
    multiline: bool = False,
    extra_sections: Sequence[str] = (),
) -> DataFrame:
    """Read company documents with an explicit schema (no inference pass).

    ``multiline=True`` reads a file holding one JSON array (each element becomes a
    row); the default reads JSON lines, which Spark can split. ``extra_sections``
    adds provider sections beyond the known ones with
    the same shape as the statements, so the same long/wide operators apply.

    In the record shape a section that holds an error object is NULL, and its text is in the map
    ``section_errors`` (section -> text), so that a failed fetch differs from one without data.
    """
    schema = {"map": MAP_DOCUMENT_SCHEMA, "records": RECORD_DOCUMENT_SCHEMA}[shape]
    section_type = schema[schema.fieldNames()[-1]].dataType
    for name in extra_sections:
        if name not in schema.fieldNames():
            schema = schema.add(name, section_type)
    if shape == "map":
        return spark.read.schema(schema).option("multiLine", multiline).json(path)
    sections = [f.name for f in schema.fields if f.dataType == section_type]
    raw = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    docs = spark.read.schema(raw).option("multiLine", multiline).json(path)
    is_list = {s: F.ltrim(F.col(s)).startswith("[") for s in sections}
    errors = F.create_map(*[x for s in sections for x in (F.lit(s), F.when(~is_list[s], F.get_json_object(s, "$.error")))])
    errors = F.map_filter(errors, lambda k, v: v.isNotNull()).alias("section_errors")
    known = [c for c in docs.columns if c not in sections]
    return docs.select(*known, *[F.when(is_list[s], F.from_json(s, _RECORD_LIST)).alias(s) for s in sections], errors)


def with_document(docs: DataFrame) -> DataFrame:
    """Adds ``document``, an id of each document, so that documents without a ticker stay apart when they are reshaped."""
    return docs.withColumn("document", F.monotonically_increasing_id())


def section_errors(docs: DataFrame) -> DataFrame:
    """``(ticker, section, error)`` of every section that holds an error object."""
    return docs.select("ticker", F.explode("section_errors").alias("section", "error"))


def write_documents(docs: DataFrame, path: str, mode: str = "overwrite", pretty: bool = False) -> None:
    """One JSON document per line, one file per partition (splittable for readers).

    ``pretty=True`` indents documents for people to read, one document per file; read such files with
    ``multiline=True``.
    """
    writer = docs.write.mode(mode).option("pretty", pretty)
    (writer.option("maxRecordsPerFile", 1) if pretty else writer).json(path)


def _label(name: str) -> str:
    # Providers label items in words: "Total Revenue" rather than "Total_Revenue".
    return name.replace("_", " ")


def _text(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def _value(df: DataFrame, name: str) -> Column:
    """A cell as text: whole numbers and text as they are (a double would lose digits above 2^53), other numbers as doubles."""
    kind, c = dict(df.dtypes)[name], F.col(f"`{name}`")
    return c.cast("string") if kind in ("tinyint", "smallint", "int", "bigint", "string") else c.cast("double").cast("string")


def _date() -> Column:
    return _text(F.date_format("report_date", "yyyy-MM-dd"))


def _cell(k: int) -> Callable[[Column], Column]:
    return lambda row: row["cells"][k]


def _by(split_years: bool) -> list[Column]:
    return [F.col("ticker"), *([F.year("report_date").alias("_year")] if split_years else [])]


def map_documents(
    statements: Mapping[str, DataFrame],
    profile: DataFrame | None = None,
    profile_attributes: Mapping[str, str] | None = None,
    source: str = "provider_1",
    split_years: bool = False,
) -> DataFrame:
    """Build map-shaped documents from wide statement tables (and a profile table).

    ``statements`` maps a section name (``income_statement`` ...) to a wide table
    keyed by ``(ticker, report_date)``; of several rows with one key the greatest cells are
    written. NULL cells are written as ``""``. ``profile_attributes`` maps document attribute names to
    profile columns. With ``split_years`` the profile is a document of its own.
    """
    keys = ["ticker", *(["_year"] if split_years else [])]
    docs = None
    for section, df in statements.items():
        items = [c for c in df.columns if c not in ("ticker", "report_date")]
        # A report is one row in the shuffle: its date and its cells.
        row = F.struct(_date().alias("date"), F.array(*[_text(_value(df, c)) for c in items]).alias("cells"))
        per = df.select(*_by(split_years), row.alias("row")).groupBy(*keys).agg(F.array_sort(F.collect_list("row")).alias("rows"))
        rows = F.col("rows")
        once = F.filter(rows, lambda r, i: F.coalesce(F.get(rows, i + 1)["date"] != r["date"], F.lit(True)))
        per = per.withColumn("rows", once)
        dates = F.transform("rows", lambda r: r["date"])
        cells = [F.map_from_arrays(dates, F.transform("rows", _cell(k))) for k in range(len(items))]
        per = per.select(*keys, F.map_from_arrays(F.array(*[F.lit(_label(c)) for c in items]), F.array(*cells)).alias(section))
        docs = per if docs is None else docs.join(per, keys, "full_outer")
    info = None
    if profile is not None:
        attrs = profile_attributes or {c: c for c in profile.columns if c not in ("ticker", "report_date")}
        kv = [x for name, col in attrs.items() for x in (F.lit(name), F.col(col).cast("string"))]
        info = profile.select("ticker", F.create_map(*kv).alias("company_info"))
    if docs is None:
        docs = info
    elif info is None or split_years:
        docs = docs.withColumn("company_info", F.lit(None).cast("map<string,string>"))
        docs = docs if info is None else docs.drop("_year").unionByName(info, allowMissingColumns=True)
    else:
        docs = docs.join(info, "ticker", "full_outer")
    return docs.select("ticker", F.lit(source).alias("source"), "company_info", *statements.keys())


def record_documents(statements: Mapping[str, DataFrame], source: str = "provider_2", split_years: bool = False) -> DataFrame:
    """Build record-shaped documents: per section a list of per-date records."""
    parts = None
    for section, df in statements.items():
        kv: list[Column] = [F.lit("date"), _date(), F.lit("calendarYear"), F.year("report_date").cast("string")]
        for c in df.columns:
            if c not in ("ticker", "report_date"):
                kv += [F.lit(c), _value(df, c)]
        part = df.select(*_by(split_years), F.lit(section).alias("section"), F.create_map(*kv).alias("rec"))
        parts = part if parts is None else parts.unionByName(part)
    docs = parts.groupBy("ticker", *(["_year"] if split_years else [])).agg(
        *[F.collect_list(F.when(F.col("section") == s, F.col("rec"))).alias(s) for s in statements]
    )
    return docs.select("ticker", F.lit(source).alias("source"), F.lit(None).cast("string").alias("error"), *statements.keys())
