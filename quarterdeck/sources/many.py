"""Many delimited files at once: one scan, a dictionary of headers, no plan node per file.

Files of one table may differ in columns and in their order. ``read_headers`` looks at the first line of each file only (a few kilobytes,
opened through Hadoop); ``scan_together`` then reads all files by position in one scan, each row with its file's path; ``union_files`` puts the values under their names
by the header dictionary (one small row per file, joined by path) and gives what a chain of unions by name would give, with a plan whose size
depends on the number of columns only.

``type_states`` counts, for each column, the values and those that each type can hold. These counts add up: states of any parts of the data
merge into the state of the whole, so new files need not have the old ones read again. ``decide`` picks the narrowest type that holds all
values, or all but a given share; ``typed`` applies it, and rows with a value that contradicts its column's type go to a table of rejects.
"""

from __future__ import annotations

import csv
import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarterdeck.functions.coerce import clean_name
from quarterdeck.sources.delimited import parse_options

#: From the narrowest to the widest; a value's text decides, so that "1" is a BIGINT, "1.0" a DOUBLE and "2024-01-31" a DATE.
TYPES = ("bigint", "double", "boolean", "date", "timestamp")
_SHAPES = {
    "bigint": r"^\s*[+-]?[0-9]+\s*$",
    "double": r"^\s*([+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?|NaN|[+-]?Infinity)\s*$",
    "boolean": r"^(?i)(true|false)$",
    "date": r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$",
    "timestamp": r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([T ][0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]+)?)?(Z|[+-][0-9]{2}:[0-9]{2})?)?$",
}


def location(spark: SparkSession, path: str) -> str:
    """A path as :func:`file_location` shows it."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    whole = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(target)
    return re.sub("^file:/+", "file:/", whole.toUri().toString())


def file_location() -> Column:
    """The file a row was read from; local paths are written with one or three slashes, here with one."""
    return F.regexp_replace("_metadata.file_path", "^file:/+", "file:/")


def _known(column: str) -> Column:
    """The column, which a join with the header dictionary has filled; a row of a file that is not in it is an error, not a lost row."""
    return F.coalesce(F.col(column), F.raise_error(F.concat(F.lit("no header known for "), F.col("path"))))


def _first_line(spark: SparkSession, path: str) -> str | None:
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(path)
    stream = target.getFileSystem(conf).open(target)
    try:
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(target)
        plain = codec.createInputStream(stream) if codec else stream
        lines = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(plain, "UTF-8"))
        line = lines.readLine()
        while line is not None and line.count('"') % 2:  # a quoted name with a line break in it
            more = lines.readLine()
            if more is None:
                break
            line += "\n" + more
        return line
    finally:
        stream.close()


def read_headers(spark: SparkSession, paths: Sequence[str], sep: str = "\t") -> tuple[dict[str, list[str]], dict[str, str]]:
    """Cleaned column names by path, and by path why a file has none that can be used."""
    good, bad = {}, {}
    for path in paths:
        try:
            line = _first_line(spark, path)
            names = next(csv.reader([line], delimiter=sep)) if line and line.strip() else []
            names = [clean_name(n.removeprefix("﻿")) or f"_c{i}" for i, n in enumerate(names)]
            if not names:
                raise ValueError("no header")
            if "�" in line or "\x00" in line:
                raise ValueError("the header is not text")
            twice = sorted({n for n in names if [m.lower() for m in names].count(n.lower()) > 1})
            if twice:
                raise ValueError(f"columns occur twice: {', '.join(twice)}")
            good[path] = names
        except Exception as exc:  # noqa: BLE001 - reported per file
            bad[path] = str(exc).split("\n")[0] or type(exc).__name__
    return good, bad


def scan_together(spark: SparkSession, headers: Mapping[str, Sequence[str]], sep: str = "\t", multiline: bool = False) -> DataFrame:
    """``path``, ``values`` (by position) and ``spill`` of all files' rows.

    ``spill`` is the text of a row with more values than its file's header has names, else NULL.
    """
    width = max(len(h) for h in headers.values())
    schema = ", ".join([*(f"_{i} string" for i in range(width)), "_text string"])
    options = parse_options(sep, multiline) | {"enforceSchema": "true", "columnNameOfCorruptRecord": "_text"}
    rows = spark.read.schema(schema).options(**options).csv(list(headers))
    path, values = file_location().alias("path"), F.array(*[F.col(f"_{i}") for i in range(width)])
    sizes = spark.createDataFrame([(location(spark, p), len(h)) for p, h in headers.items()], "path string, width int")
    # The parser hands over the text of rows that are shorter or longer than the widest header. Quoted parts count as one value.
    parts = F.split(F.regexp_replace("_text", '"([^"]|"")*"', "q"), re.escape(sep), -1)
    beyond = F.exists(F.slice(parts, _known("width") + 1, F.greatest(F.size(parts), F.lit(1))), lambda v: F.trim(v) != "")
    text = F.when(F.col("_text").isNotNull() & beyond, F.col("_text"))
    return rows.select(path, values.alias("values"), "_text").join(sizes, "path", "left").select("path", "values", text.alias("spill"))


def column_order(headers: Mapping[str, Sequence[str]]) -> list[str]:
    """The first file's columns, then new ones sorted, as a chain of unions by name has them."""
    listed = list(headers.values())
    first = list(listed[0]) if listed else []
    return first + sorted({c for h in listed for c in h} - set(first))


def by_name(rows: DataFrame, headers: Mapping[str, Sequence[str]], columns: Sequence[str] | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """Rows of :func:`scan_together` under their names, by a join with the header dictionary (one row per file)."""
    spark = rows.sparkSession
    columns = list(columns or column_order(headers))
    places = [(location(spark, p), [h.index(c) if c in h else -1 for c in columns]) for p, h in headers.items()]
    dictionary = spark.createDataFrame(places, "path string, places array<int>")
    met = rows.join(dictionary, "path", "left").withColumn("places", _known("places"))
    value = [F.get("values", F.get("places", i)).alias(c) for i, c in enumerate(columns)]  # a place of -1 gives NULL
    return met.select(*value, *keep)


def staged_states(rows: DataFrame, headers: Mapping[str, Sequence[str]], by: Sequence[str]) -> DataFrame:
    """Type states of the columns of all files' rows, by group, in one aggregate; rows that spill do not count."""
    spark = rows.sparkSession
    dictionary = spark.createDataFrame([(location(spark, p), list(h)) for p, h in headers.items()], "path string, names array<string>")
    met = rows.where(F.col("spill").isNull()).join(dictionary, "path")
    pair = F.explode(F.arrays_zip(F.col("names").alias("column"), F.col("values").alias("value"))).alias("cell")
    cells = met.select(*by, pair).select(*by, F.col("cell.column").alias("column"), F.col("cell.value").alias("value"))
    return cell_states(cells.where(F.col("column").isNotNull()), by)


def union_files(spark: SparkSession, paths: Sequence[str], sep: str = "\t", multiline: bool = False) -> DataFrame:
    """All files' rows under all files' columns, as text; a file that cannot be read is an error."""
    headers, bad = read_headers(spark, paths, sep)
    if bad:
        raise ValueError("; ".join(f"{p}: {why}" for p, why in bad.items()))
    if not headers:
        raise ValueError("no files")
    rows = scan_together(spark, headers, sep, multiline)
    return by_name(rows, headers)


def _holds(text: Column, kind: str) -> Column:
    return F.coalesce(text.rlike(_SHAPES[kind]) & F.trim(text).try_cast(kind).isNotNull(), F.lit(False))


def type_states(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``column``, ``filled`` (values) and ``as_<type>`` (values that the type holds), by group of ``by`` if given.

    One pass; the counts are added up before the shuffle, which moves a row per column, group and task.
    """
    names = [c for c in df.columns if c not in by]
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias("value")) for c in names]))
    return cell_states(df.select(*by, pairs.alias("cell")).select(*by, "cell.column", "cell.value"), by)


def cell_states(cells: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """:func:`type_states` of rows of (``by``, column, value)."""
    counts = [F.count_if(_holds(F.col("value"), t)).alias(f"as_{t}") for t in TYPES]
    return cells.groupBy(*by, "column").agg(F.count("value").alias("filled"), *counts)


def merge_states(*states: DataFrame) -> DataFrame:
    """The state of all parts together."""
    out = states[0]
    for s in states[1:]:
        out = out.unionByName(s)
    return out.groupBy("column").agg(*[F.sum(c).alias(c) for c in ("filled", *(f"as_{t}" for t in TYPES))])


def decide(state: Mapping[str, int], tolerance: float = 0.0) -> str:
    """A column's type: the narrowest that all values fit, or all but a share of ``tolerance``; no values give DOUBLE."""
    filled = state["filled"]
    if not filled:
        return "double"
    for kind in TYPES:
        if filled - state[f"as_{kind}"] <= tolerance * filled:
            return kind
    return "string"


def decided(states: DataFrame, tolerance: float = 0.0) -> dict[str, str]:
    """Type by column; the driver gets one row per column."""
    return {r["column"]: decide(r.asDict(), tolerance) for r in states.collect()}


def typed(df: DataFrame, types: Mapping[str, str]) -> tuple[DataFrame, DataFrame]:
    """Rows under their types, and the rows (as text, with ``contradicting`` columns) of which a value does not fit its type.

    Rejects are kept whole and apart: no value is turned into NULL. Columns that ``types`` does not name stay text.
    """
    kinds = {c: types.get(c, "string") for c in df.columns}
    wrong = [F.when(F.col(f"`{c}`").isNotNull() & ~_holds(F.col(f"`{c}`"), t), F.lit(c)) for c, t in kinds.items() if t in TYPES]
    clash = F.array_compact(F.array(*wrong)) if wrong else F.array().cast("array<string>")
    fits = df.where(F.size(clash) == 0)
    cast = [F.trim(F.col(f"`{c}`")).try_cast(t).alias(c) if t in TYPES else F.col(f"`{c}`") for c, t in kinds.items()]
    return fits.select(*cast), df.withColumn("contradicting", clash).where(F.size("contradicting") > 0)
