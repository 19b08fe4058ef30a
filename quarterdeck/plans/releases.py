"""Versioned tables: whole sets of tables change in one step.

A store is a folder:

* ``data/<table>/<version>/`` holds Parquet files that are never changed once written;
* ``releases/<number>.json`` names, for every table of that release, its columns and the folders ("pieces") with its rows.

Writers fill folders nobody reads yet (:class:`Draft`); :meth:`Draft.commit` then puts one small manifest in place by a rename that
never replaces a file. The newest manifest is the current release, so all tables switch together: a reader works on the release
it opened and sees all old or all new tables, and a build that dies at any point leaves the current release as it was.
Two writers that started from the same release cannot both commit changes of the same table: the later one gets a :class:`Conflict`; changes of
other tables are carried over. The rename is atomic on HDFS-like and local file systems; on object stores without such a rename, let one
application at a time publish. Earlier releases stay readable (they are the backups) until :meth:`TableStore.vacuum` drops them.

A table's pieces may differ in columns and types, as the table was widened: each piece is read with its own types and cast to the
table's, one scan for each distinct set of columns, not for each piece. ``buckets`` divides a table by a hash of its keys, which lets a
keyed load (:mod:`quarterdeck.plans.merge`) replace single buckets.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from quarterdeck.functions.lattice import as_types, types_of

BUCKET = "__bucket"  # folder names only; no table may have a column of this name


class Conflict(RuntimeError):
    pass


@dataclass(frozen=True)
class Piece:
    """One folder of rows; ``keys`` is the folder of its key bits where the table has keys."""

    path: str
    rows: int
    columns: dict[str, str]
    bucket: int | None = None
    keys: str | None = None


@dataclass(frozen=True)
class Table:
    columns: dict[str, str]
    pieces: tuple[Piece, ...] = ()
    key: tuple[str, ...] = ()
    buckets: int | None = None
    words: int | None = None  # of the key bits, a bucket
    deal: tuple[str, ...] = ()  # columns whose hash gives a row's bucket

    @property
    def rows(self) -> int:
        return sum(p.rows for p in self.pieces)


@dataclass(frozen=True)
class Release:
    number: int
    tables: dict[str, Table] = field(default_factory=dict)
    note: str = ""
    published_at: float = 0.0

    def to_json(self) -> str:
        tables = {n: {"columns": t.columns, "key": t.key, "buckets": t.buckets, "words": t.words, "deal": t.deal, "pieces": [vars(p) for p in t.pieces]} for n, t in self.tables.items()}
        return json.dumps({"number": self.number, "note": self.note, "published_at": self.published_at, "tables": tables})

    @staticmethod
    def from_json(text: str) -> Release:
        raw = json.loads(text)
        tables = {n: Table(t["columns"], tuple(Piece(**p) for p in t["pieces"]), tuple(t["key"]), t["buckets"], t["words"], tuple(t["deal"])) for n, t in raw["tables"].items()}
        return Release(raw["number"], tables, raw["note"], raw["published_at"])


class Files:
    """The few file-system calls a store needs, through Hadoop, so that any store Spark reads will do."""

    def __init__(self, spark: SparkSession, root: str):
        self.sc = spark.sparkContext
        self.hadoop = self.sc._jvm.org.apache.hadoop.fs
        self.fs = self.path(root).getFileSystem(self.sc._jsc.hadoopConfiguration())

    def path(self, name: str):
        return self.hadoop.Path(name)

    def names(self, folder: str) -> list[tuple[str, int, bool]]:
        """Name, time of change (ms) and whether it is a folder, of everything in ``folder``."""
        if not self.fs.exists(self.path(folder)):
            return []
        return [(s.getPath().getName(), s.getModificationTime(), s.isDirectory()) for s in self.fs.listStatus(self.path(folder))]

    def read(self, name: str) -> str:
        stream = self.fs.open(self.path(name))
        try:
            return self.sc._jvm.org.apache.hadoop.shaded.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write_new(self, name: str, text: str) -> bool:
        """Put a whole file in place at once; False if there is one of that name."""
        folder = name.rsplit("/", 1)[0]
        self.fs.mkdirs(self.path(folder))
        draft = self.path(f"{folder}/.{uuid.uuid4().hex}")
        stream = self.fs.create(draft)
        stream.write(bytearray(text.encode()))
        stream.close()
        context = self.hadoop.FileContext.getFileContext(self.fs.getUri(), self.sc._jsc.hadoopConfiguration())
        options = self.sc._jvm.java.lang.Class.forName("org.apache.hadoop.fs.Options$Rename")
        try:  # without options a rename refuses to replace
            context.rename(draft, self.path(name), self.sc._jvm.java.lang.reflect.Array.newInstance(options, 0))
            return True
        except Exception:
            if self.fs.exists(self.path(name)):
                return False
            raise
        finally:
            self.fs.delete(draft, False)

    def remove(self, folder: str) -> None:
        self.fs.delete(self.path(folder), True)


class TableStore:
    """The releases under ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.files = Files(spark, self.root)

    def numbers(self) -> list[int]:
        names = (n for n, _, _ in self.files.names(f"{self.root}/releases"))
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def release(self, number: int | None = None) -> Release:
        """A release, the current one by default; a store without any has the empty release 0."""
        if number is None:
            number = (self.numbers() or [0])[-1]
        if number == 0:
            return Release(0)
        return Release.from_json(self.files.read(self._manifest(number)))

    def _manifest(self, number: int) -> str:
        return f"{self.root}/releases/{number:012d}.json"

    def read(self, name: str, release: Release | None = None) -> DataFrame:
        """A table of a release. Hold on to the release to read several tables of one state."""
        tables = (release or self.release()).tables
        if name not in tables:
            raise KeyError(f"no table {name} in this release")
        return rows_of(self.spark, self.root, tables[name])

    def register(self, release: Release | None = None, prefix: str = "") -> Release:
        """Temporary views on every table of one release, for SQL."""
        release = release or self.release()
        for name in release.tables:
            self.read(name, release).createOrReplaceTempView(prefix + name)
        return release

    def history(self) -> DataFrame:
        """number, published_at, note, table_name, rows, pieces of every release that is there."""
        rows = [(r.number, r.published_at, r.note, n, t.rows, len(t.pieces)) for r in map(self.release, self.numbers()) for n, t in r.tables.items()]
        raw = self.spark.createDataFrame(rows, "number long, published_at double, note string, table_name string, rows long, pieces int")
        return raw.withColumn("published_at", F.timestamp_millis((F.col("published_at") * 1000).cast("long")))

    def draft(self) -> Draft:
        return Draft(self)

    def rollback(self, number: int) -> Release:
        """Publish the tables of an earlier release again, as a new one."""
        draft = self.draft()
        draft.tables = dict(self.release(number).tables)
        draft.touched = set(draft.tables) | set(draft.base.tables)
        return draft.commit(f"rollback to {number}")

    def vacuum(self, keep: int = 2, older_than_hours: float = 24.0) -> list[str]:
        """Remove releases but the last ``keep``, and folders that no kept release names, if they are old enough.

        The age spares folders of drafts that are still being written and releases that readers may have open.
        """
        numbers, limit = self.numbers(), (time.time() - 3600 * older_than_hours) * 1000
        changed = {n: t for n, t, _ in self.files.names(f"{self.root}/releases")}
        old = [n for n in numbers[: max(0, len(numbers) - max(1, keep))] if changed[f"{n:012d}.json"] <= limit]
        kept = [self.release(n) for n in numbers if n not in old]
        used = {_version(p.path) for r in kept for t in r.tables.values() for p in t.pieces}
        gone = []
        for n in old:
            self.files.remove(self._manifest(n))
        for table, _, folder in self.files.names(f"{self.root}/data"):
            for version, when, _ in self.files.names(f"{self.root}/data/{table}") if folder else []:
                if when <= limit and f"data/{table}/{version}" not in used:
                    self.files.remove(f"{self.root}/data/{table}/{version}")
                    gone.append(f"data/{table}/{version}")
        return gone


def _version(path: str) -> str:
    return "/".join(path.split("/")[:3])


def scan(spark: SparkSession, root: str, paths: Iterable[str], columns: Mapping[str, str]) -> DataFrame:
    schema = ", ".join(f"`{c}` {t}" for c, t in columns.items())
    return spark.read.schema(schema).parquet(*[f"{root}/{p}" for p in paths])


def rows_of(spark: SparkSession, root: str, table: Table, pieces: Sequence[Piece] | None = None) -> DataFrame:
    """The table's rows (or those of some of its pieces) under its columns; a scan per distinct set of columns and types."""
    by_columns: dict[tuple, list[str]] = {}
    for p in table.pieces if pieces is None else pieces:
        by_columns.setdefault(tuple(p.columns.items()), []).append(p.path)
    parts = [scan(spark, root, paths, dict(columns)) for columns, paths in by_columns.items()]
    if not parts:
        return spark.createDataFrame([], ", ".join(f"`{c}` {t}" for c, t in table.columns.items()))
    out = parts[0].select(*as_types(parts[0], table.columns))
    for part in parts[1:]:
        out = out.unionAll(part.select(*as_types(part, table.columns)))
    return out


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    """Keys are hashed as text: a key column that widens to text, or to more digits, keeps its rows' places where the text stays."""
    return F.pmod(F.xxhash64(*[F.col(f"`{k}`").cast("string") for k in keys]), F.lit(buckets)).cast("int")


class Draft:
    """Tables written for the next release; nobody sees them before :meth:`commit`.

    As a context manager it removes what it wrote if the block raises.
    """

    def __init__(self, store: TableStore):
        self.store, self.spark, self.base = store, store.spark, store.release()
        self.tables: dict[str, Table] = dict(self.base.tables)
        self.touched: set[str] = set()
        self.written: list[str] = []

    def __enter__(self) -> Draft:
        return self

    def __exit__(self, kind, *_) -> None:
        if kind:
            self.abort()

    def read(self, name: str) -> DataFrame:
        """A table as this draft has it: its own writes, else the release it started from."""
        return rows_of(self.spark, self.store.root, self.tables[name])

    def put(self, name: str, df: DataFrame, key: Sequence[str] = (), buckets: int | None = None, sort_by: Sequence[str] = ()) -> Table:
        """Replace a table by ``df``. With ``buckets`` rows are divided by a hash of ``key``."""
        pieces = self.write_pieces(name, df, tuple(key), buckets, sort_by)
        return self.set(name, Table(types_of(df), pieces, tuple(key), buckets, deal=tuple(key)))

    def set(self, name: str, table: Table) -> Table:
        self.tables[name] = table
        self.touched.add(name)
        return table

    def write_pieces(
        self, name: str, df: DataFrame, key: tuple[str, ...] = (), buckets: int | None = None, sort_by: Sequence[str] = (), place: Column | None = None
    ) -> tuple[Piece, ...]:
        """Write rows to a folder of this draft's own and return it as pieces, one for each bucket that has rows.

        Rows are dealt by a hash of ``key``, or to the numbers that ``place`` gives.
        """
        if BUCKET in df.columns:
            raise ValueError(f"no column may be called {BUCKET}")
        columns, folder = types_of(df), f"data/{name}/{uuid.uuid4().hex}"
        self.written.append(folder)
        if not buckets and place is None:
            seen = Observation()
            out = df.observe(seen, F.count(F.lit(1)).alias("rows"))
            (out.sortWithinPartitions(*sort_by) if sort_by else out).write.parquet(f"{self.store.root}/{folder}")
            return (Piece(folder, seen.get["rows"], columns),)
        number = bucket_of(key, buckets) if place is None else place
        placed = df.withColumn(BUCKET, number).repartition(BUCKET).sortWithinPartitions(BUCKET, *(sort_by or key))
        placed.write.partitionBy(BUCKET).parquet(f"{self.store.root}/{folder}")
        schema = ", ".join([*(f"`{c}` {t}" for c, t in columns.items()), f"`{BUCKET}` int"])
        found = self.spark.read.schema(schema).parquet(f"{self.store.root}/{folder}").groupBy(BUCKET).count().collect()  # a row per bucket, from the footers
        return tuple(Piece(f"{folder}/{BUCKET}={r[BUCKET]}", r["count"], columns, r[BUCKET]) for r in sorted(found))

    def drop(self, name: str) -> None:
        del self.tables[name]
        self.touched.add(name)

    def commit(self, note: str = "") -> Release:
        """Publish; without any change the release stays as it is."""
        while self.touched:
            now = self.store.release()
            changed = {n for n in set(now.tables) | set(self.base.tables) if now.tables.get(n) != self.base.tables.get(n)}
            if changed & self.touched:
                raise Conflict(f"published meanwhile: {', '.join(sorted(changed & self.touched))}")
            tables = {n: t for n, t in now.tables.items() if n not in self.touched} | {n: t for n, t in self.tables.items() if n in self.touched}
            new = replace(now, number=now.number + 1, tables=tables, note=note, published_at=time.time())
            if self.store.files.write_new(self.store._manifest(new.number), new.to_json()):
                self.base, self.tables, self.touched, self.written = new, dict(tables), set(), []
                return new
        return self.base

    def abort(self) -> None:
        """Remove what this draft wrote. A draft that dies without this leaves folders that ``vacuum`` removes."""
        for folder in self.written:
            self.store.files.remove(f"{self.store.root}/{folder}")
        self.tables, self.touched, self.written = dict(self.base.tables), set(), []
