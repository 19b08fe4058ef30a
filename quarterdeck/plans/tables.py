"""Table sinks and loaders: replace (with backup), append by name, partitioned layout.

* ``save_table``: ``CREATE OR REPLACE TABLE ... AS SELECT`` as ``saveAsTable`` in
  overwrite mode (parquet). Optional layout: ``partition_by`` (use a coarse
  column such as the report year; daily partitions make too many small files)
  and ``bucket_by`` (bucketing by ``ticker`` and sorting by ``report_date`` lets
  later windows and joins on ``ticker`` skip their shuffle).
* ``load_replace``: the new rows are written under a staging name first; then the
  previous table becomes ``<name>_backup`` (an older backup is dropped, so
  repeated runs do not fail) and the staged table takes the name.
* ``load_append``: creates the table if missing, else inserts after aligning the
  new rows to the table's columns *by name* (a positional insert would shift
  values when column order differs). Values never change by it: rows that do not fit the table's columns and types are
  refused, or with ``widen=True`` the table is widened (new columns are added in the catalog, types follow
  :mod:`quarterdeck.functions.lattice`; only a type that widens has the table rewritten).
* ``load_directory``: all files of a folder, read together in one scan.

For several tables that must change in one step, and for loads by key, see :mod:`quarterdeck.plans.releases`.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from quarterdeck.functions.coerce import clean_name
from quarterdeck.functions.lattice import as_types, exactly_wider, merged_types, types_of
from quarterdeck.plans.storage import remove_on_exit, staging_path


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def save_table(
    df: DataFrame,
    name: str,
    partition_by: Sequence[str] = (),
    bucket_by: tuple[int, str] | None = None,
    sort_by: Sequence[str] = (),
    mode: str = "overwrite",
) -> None:
    w = df.write.mode(mode).format("parquet")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if bucket_by:
        n, col = bucket_by
        w = w.bucketBy(n, col)
        if sort_by:
            w = w.sortBy(*sort_by)
    w.saveAsTable(name)


def counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    """The same rows, and where their number is to be found once they have been written."""
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def store_incoming(spark: SparkSession, df: DataFrame, name: str, **layout) -> int:
    """Write ``df`` as ``<name>_incoming`` and return how many rows were written."""
    spark.sql(f"DROP TABLE IF EXISTS {name}_incoming")
    rows, seen = counted(df)
    save_table(rows, f"{name}_incoming", **layout)
    return seen.get["rows"]


def swap_incoming(spark: SparkSession, names: Sequence[str], keep_backup: bool = False) -> dict[str, str]:
    """Give every ``<name>_incoming`` its name; previous tables become ``<name>_backup`` or are dropped in the end.

    Only catalog entries are renamed. If one rename fails, those done before are undone. Between a table's two renames its name is not
    there: readers should not run meanwhile. Returns the backup's name for each table that had a previous one.
    """
    aside = {n: f"{n}_backup" if keep_backup else f"{n}_outgoing" for n in names if table_exists(spark, n)}
    for old in aside.values():
        spark.sql(f"DROP TABLE IF EXISTS {old}")
    done: list[tuple[str, str]] = []
    try:
        for n in names:
            for source, target in [*([(n, aside[n])] if n in aside else []), (f"{n}_incoming", n)]:
                spark.sql(f"ALTER TABLE {source} RENAME TO {target}")
                done.append((source, target))
    except Exception:
        for source, target in reversed(done):
            spark.sql(f"ALTER TABLE {target} RENAME TO {source}")
        raise
    if not keep_backup:
        for old in aside.values():
            spark.sql(f"DROP TABLE IF EXISTS {old}")
        return {}
    return aside


def load_replace(spark: SparkSession, df: DataFrame, name: str, keep_backup: bool = True, **layout) -> str | None:
    """Replace ``name`` with ``df``; the previous version becomes ``<name>_backup``.

    The new rows are written to ``<name>_incoming`` first; only after that write has succeeded are the catalog entries
    renamed (:func:`swap_incoming`). A job that fails while writing leaves the current table as it was.
    With ``keep_backup=False`` the previous version is dropped after the swap, under a name of its own: a
    backup that another call made stays.
    Returns the backup name, or ``None`` when there was no previous table (or no backup is kept).
    """
    store_incoming(spark, df, name, **layout)
    return swap_incoming(spark, [name], keep_backup).get(name)


def layout_of(spark: SparkSession, name: str) -> dict:
    """A stored table's partitioning and buckets, as ``save_table`` takes them."""
    listed = spark.catalog.listColumns(name)
    detail = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
    out: dict = {"partition_by": [c.name for c in listed if c.isPartition]}
    if any(c.isBucket for c in listed):
        sort = detail.get("Sort Columns", "[]").strip("[]").replace("`", "")
        out["bucket_by"] = (int(detail["Num Buckets"]), next(c.name for c in listed if c.isBucket))
        out["sort_by"] = [c.strip() for c in sort.split(",") if c.strip()]
    return out


def align_to(df: DataFrame, columns: Sequence[str], types: Mapping[str, str] | None = None) -> DataFrame:
    """Reorder ``df`` to ``columns`` by name; missing columns become typed NULLs.

    With ``types`` values are cast to wider types only; a column whose type ``types`` cannot hold is refused.
    """
    extra = [c for c in df.columns if c not in columns]
    if extra:
        raise ValueError(f"columns not in target table: {extra}")
    have = types_of(df)
    if types:
        wide = merged_types(types, have)
        wide = exactly_wider([(df, have)], wide)
        narrow = [f"{c} ({have[c]} does not fit {t})" for c, t in types.items() if wide[c] != t]
        if narrow:
            raise ValueError(f"values would change: {', '.join(narrow)}")
    return df.select(*as_types(df, {c: (types or have).get(c, "string") for c in columns}))


def load_append(spark: SparkSession, df: DataFrame, name: str, widen: bool = False) -> int:
    """Create ``name`` from ``df``, or append ``df`` aligned by column name; returns the rows inserted.

    ``widen=False`` refuses columns that the table lacks and types that it cannot hold. ``widen=True`` adds the columns (earlier rows
    have NULL there) and, if a type has to widen, rewrites the table with its layout; the name keeps its old rows until that is complete.
    """
    if not table_exists(spark, name):
        rows, seen = counted(df)
        save_table(rows, name)
        return seen.get["rows"]
    target = spark.table(name)
    stored, have = types_of(target), types_of(df)
    if widen:
        wanted = exactly_wider([(target, stored), (df, have)], merged_types(stored, have))
        if any(wanted[c] != t for c, t in stored.items()):
            added, seen = counted(df.select(*as_types(df, wanted)))
            whole = target.select(*as_types(target, wanted)).unionAll(added)
            load_replace(spark, whole, name, keep_backup=False, **layout_of(spark, name))
            return seen.get["rows"]
        new = [c for c in wanted if c not in stored]
        if new:
            spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({', '.join(f'`{c}` {wanted[c]}' for c in new)})")
            target = spark.table(name)
            stored = types_of(target)
    rows, seen = counted(align_to(df, target.columns, stored))
    save_table(rows, name, mode="append", **layout_of(spark, name))
    return seen.get["rows"]


def write_partitioned(df: DataFrame, path: str, year_col: str = "report_date", mode: str = "overwrite") -> None:
    """Files laid out by report year (directory pruning on date filters) and sorted by
    ``ticker`` inside each file (tight min/max statistics for ticker lookups).

    Range partitioning on ``(report_year, ticker)`` keeps each task on few year
    directories while splitting a heavy year across several tasks.
    """
    (
        df.withColumn("report_year", F.year(year_col))
        .repartitionByRange("report_year", "ticker")
        .sortWithinPartitions("ticker", year_col)
        .write.mode(mode)
        .partitionBy("report_year")
        .parquet(path)
    )


def content_checksum(df: DataFrame) -> tuple[Column, Column]:
    """Rows, and the sum of all rows' hashes modulo 2^64: equal for equal rows in any order, and adding up over parts.

    Maps have no hash; they are taken as sorted entries. Values count with their place, so that exchanged columns differ.
    """
    parts = [F.array_sort(F.map_entries(F.col(f"`{c}`"))) if t.startswith("map<") else F.col(f"`{c}`") for c, t in types_of(df).items()]
    nulls = [F.col(f"`{c}`").isNull() for c in df.columns]  # a NULL does not enter the hash by itself
    digest = F.xxhash64(F.lit(len(df.columns)), *parts, *nulls).cast("decimal(20,0)")
    return F.count(F.lit(1)).alias("rows"), F.pmod(F.coalesce(F.sum(digest), F.lit(0)), F.lit(str(2**64)).cast("decimal(20,0)")).cast("string").alias("checksum")


def copy_tables(spark: SparkSession, tables: Mapping[str, DataFrame], target_root: str) -> DataFrame:
    """Copy each table to ``target_root/<name>``; return ``(name, status, rows, error, checksum)``.

    A copy is written beside the target, read back and compared with the source by row count and :func:`content_checksum`; only then does it
    take the target's place, so a copy that fails leaves the old target as it was. One table failing does not stop the others.
    The source is read twice if it is lazy; pass stored tables where that costs much.
    """
    results = [(name, *copy_table(spark, df, f"{target_root}/{name}")) for name, df in tables.items()]
    return spark.createDataFrame(results, "name string, status string, rows bigint, error string, checksum string")


def copy_table(spark: SparkSession, df: DataFrame, target: str) -> tuple[str, int | None, str | None, str | None]:
    """One table of :func:`copy_tables`: ``(status, rows, error, checksum)``."""
    import uuid

    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    place, fresh, old = (hadoop.Path(f"{target}{suffix}") for suffix in ("", f"__{uuid.uuid4().hex}", f"__{uuid.uuid4().hex}"))
    fs = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    try:
        source = Observation()
        df.observe(source, *content_checksum(df)).write.parquet(fresh.toString())
        copied = spark.read.schema(df.schema).parquet(fresh.toString())
        found = copied.agg(*content_checksum(copied)).first()
        if (source.get["rows"], source.get["checksum"]) != (found["rows"], found["checksum"]):
            raise ValueError(f"the copy differs: {found['rows']} rows, checksum {found['checksum']}, not {source.get['rows']}, {source.get['checksum']}")
        if fs.exists(place) and not fs.rename(place, old):
            raise OSError(f"cannot move {target} aside")
        if not fs.rename(fresh, place):
            fs.rename(old, place)
            raise OSError(f"cannot put the copy in the place of {target}")
        fs.delete(old, True)
        return "success", found["rows"], None, found["checksum"]
    except Exception as exc:  # noqa: BLE001 - reported per table
        fs.delete(fresh, True)
        return "failed", None, str(exc), None


def verify_copies(sources: Mapping[str, DataFrame], copies: Mapping[str, DataFrame]) -> DataFrame:
    """``(name, rows, copied_rows, equal)`` for each source: a missing, shortened or changed copy is not equal."""
    spark = next(iter(sources.values())).sparkSession
    rows = []
    for name, df in sources.items():
        want = df.agg(*content_checksum(df)).first()
        got = copies[name].agg(*content_checksum(copies[name])).first() if name in copies else None
        rows.append((name, want["rows"], got and got["rows"], got is not None and tuple(want) == tuple(got)))
    return spark.createDataFrame(rows, "name string, rows bigint, copied_rows bigint, equal boolean")


def tables_of_files(paths: Sequence[str]) -> tuple[dict[str, list[str]], dict[str, str]]:
    """Files by table name, and by path why a file has none.

    A folder of part files (how Spark writes a table) is one table named after the folder. Names are compared as the catalog
    compares them, cleaned and without case: of files whose names clash each is named with its folder, and if names clash then too, none is loaded.
    """
    sources: dict[str, list[str]] = {}
    for p in sorted(paths):
        folder, file = p.rsplit("/", 1)
        sources.setdefault(folder if file.startswith("part-") else p, []).append(p)

    def named(source: str, depth: int) -> str:
        return clean_name("__".join(source.rsplit("/", depth)[1:]).removesuffix(".csv")).lower()

    stems = [named(s, 1) for s in sources]
    names = {s: named(s, 1) if stems.count(named(s, 1)) == 1 else named(s, 2) for s in sources}
    shown = {s: clean_name("__".join(s.rsplit("/", 1 if stems.count(named(s, 1)) == 1 else 2)[1:]).removesuffix(".csv")) for s in sources}
    listed, out, bad = list(names.values()), {}, {}
    for s, files in sources.items():
        if listed.count(names[s]) == 1:
            out[shown[s]] = files
        else:
            bad |= {f: f"another source is called {shown[s]} too" for f in files}
    return out, bad


def load_directory(
    spark: SparkSession, root: str, db: str, mode: str = "replace", glob: str = "*.csv", sep: str = "\t", multiline: bool = True, tolerance: float = 0.0
) -> DataFrame:
    """Load every matching file under ``root`` into a table of ``db`` named after it, types inferred.

    All files are read by one scan (:mod:`quarterdeck.sources.many`) into staged columns, which give the types of all tables' columns in one
    aggregate and the rows of each table's write; the files themselves are read once. ``mode="replace"`` keeps the previous table as a backup,
    ``"append"`` aligns by name and widens the table where the rows need it. Returns ``(table_name, path, status, inserted_rows, total_rows,
    error, rejected_rows)`` per table, and per file that could not be loaded. One file failing does not stop the others.

    Rows with more values than their header, and with ``tolerance > 0`` rows with a value that contradicts the type of all but that share of
    the column's values, go as text to ``<table>__rejects`` (replaced by each load), never to the table.
    """
    from quarterdeck.sources.files import file_manifest
    from quarterdeck.sources.many import decide, staged_states

    if mode not in ("replace", "append"):
        raise ValueError("mode must be replace or append")
    files = [f.path for f in file_manifest(spark, root, glob).select("path").orderBy("path").collect()]  # file names only
    tables, bad = tables_of_files(files)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}")
    table_of = {p: t for t, paths in tables.items() for p in paths}
    staged, headers, unread = stage_files(spark, table_of, sep, multiline)
    report = [(table_of.get(p) or tables_of_files([p])[0].popitem()[0], p, "failed", None, None, why, None) for p, why in sorted((bad | unread).items())]
    states: dict[str, dict[str, str]] = {}
    if staged is not None:
        for r in staged_states(staged, headers, ("table_name",)).collect():  # a row per table and column
            states.setdefault(r["table_name"], {})[r["column"]] = decide(r.asDict(), tolerance)
    for table, paths in tables.items():
        own = {p: headers[p] for p in paths if p in headers}
        if not own:
            continue
        source = paths[0] if len(paths) == 1 else paths[0].rsplit("/", 1)[0]
        try:
            inserted, rejected = _load_staged(spark, staged, f"{db}.{table}", table, own, states.get(table, {}), mode)
            report.append((table, source, "loaded", inserted, spark.table(f"{db}.`{table}`").count(), None, rejected))
        except Exception as exc:  # noqa: BLE001 - reported per table
            report.append((table, source, "failed", None, None, str(exc), None))
    return spark.createDataFrame(
        report, "table_name string, path string, status string, inserted_rows bigint, total_rows bigint, error string, rejected_rows bigint"
    )


def stage_files(spark: SparkSession, table_of: Mapping[str, str], sep: str, multiline: bool) -> tuple[DataFrame | None, dict[str, list[str]], dict[str, str]]:
    """Rows of all files in one staged table by table name; headers by path; and why files could not be read.

    If the scan fails, the files are tried in halves, so that only those that cannot be read are left out.
    """
    from quarterdeck.sources.many import location, read_headers, scan_together

    headers, bad = read_headers(spark, list(table_of), sep)
    place = staging_path(spark, "files")
    remove_on_exit(spark, place)

    def write(paths: list[str], part: str) -> list[str]:
        if not paths:
            return []
        try:
            rows = scan_together(spark, {p: headers[p] for p in paths}, sep, multiline)
            names = spark.createDataFrame([(location(spark, p), table_of[p]) for p in paths], "path string, table_name string")
            rows.join(names, "path").write.partitionBy("table_name").parquet(f"{place}/{part}")
            return [f"{place}/{part}"]
        except Exception as exc:  # noqa: BLE001 - isolated per file
            if len(paths) == 1:
                bad[paths[0]] = str(exc).split("\n")[0]
                headers.pop(paths[0])
                return []
            half = len(paths) // 2
            return write(paths[:half], f"{part}0") + write(paths[half:], f"{part}1")

    staged = None
    for part in write(list(headers), "part"):
        more = spark.read.schema("path string, values array<string>, spill string, table_name string").parquet(part)
        staged = more if staged is None else staged.unionAll(more)
    return staged, headers, bad


def _load_staged(spark: SparkSession, staged: DataFrame, name: str, table: str, headers: Mapping[str, list[str]], types: Mapping[str, str], mode: str) -> tuple[int, int]:
    """One table from the staged rows; rows inserted and rows rejected."""
    from quarterdeck.sources.many import by_name, column_order, typed

    own = staged.where(F.col("table_name") == table)
    columns = column_order(headers)
    text = by_name(own.where(F.col("spill").isNull()), headers, columns)
    fits, contradicting = typed(text, {c: types.get(c, "double") for c in columns})
    if mode == "replace":
        inserted = store_incoming(spark, fits, name)
        swap_incoming(spark, [name], keep_backup=True)
    else:
        inserted = load_append(spark, fits, name, widen=True)
    rejected = own.count() - inserted
    spark.sql(f"DROP TABLE IF EXISTS {name}__rejects")
    if rejected:
        why = F.concat_ws(", ", "contradicting").alias("contradicting")
        cells = F.to_json(F.struct(*[F.col(f"`{c}`") for c in columns]))
        spilled = own.where(F.col("spill").isNotNull()).select(F.col("spill").alias("row"), F.lit("more values than the header has names").alias("contradicting"))
        save_table(contradicting.select(cells.alias("row"), why).unionAll(spilled), f"{name}__rejects")
    return inserted, rejected
