"""Loads of many files at once, drifting columns and types, name clashes, verified copies: nothing is lost or changed silently."""

import datetime as dt
import gzip

import pytest
from pyspark.sql import functions as F

from quarterdeck.functions.lattice import types_of
from quarterdeck.operators.reshape import union_by_name
from quarterdeck.plans.tables import copy_tables, load_append, load_directory, load_replace, save_table, tables_of_files, verify_copies
from quarterdeck.sources.delimited import infer_delimited, read_delimited_text
from quarterdeck.sources.many import TYPES, decide, decided, merge_states, read_headers, type_states, typed, union_files


@pytest.fixture
def db(spark, request):
    name = "t_" + request.node.name.split("[")[0][-40:].lower()
    spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")
    spark.sql(f"CREATE DATABASE {name}")
    yield name
    spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


# --- appends ---


def test_append_widens_types_and_adds_columns(spark, db):
    name = f"{db}.x"
    assert load_append(spark, spark.createDataFrame([("A", 1)], "ticker string, x bigint"), name, widen=True) == 1
    with pytest.raises(ValueError, match="values would change"):
        load_append(spark, spark.createDataFrame([("B", 1.5)], "ticker string, x double"), name)
    assert load_append(spark, spark.createDataFrame([(1.5, "B")], "x double, ticker string"), name, widen=True) == 1
    assert rows_of(spark.table(name)) == [("A", 1.0), ("B", 1.5)]
    assert load_append(spark, spark.createDataFrame([("C", 7)], "ticker string, added int"), name, widen=True) == 1
    assert rows_of(spark.table(name)) == [("A", 1.0, None), ("B", 1.5, None), ("C", None, 7)]
    assert load_append(spark, spark.createDataFrame([("D", 2)], "ticker string, x int"), name) == 1  # narrower: the table stays
    load_append(spark, spark.createDataFrame([("E", "n/a")], "ticker string, x string"), name, widen=True)
    assert [r[1] for r in rows_of(spark.table(name))] == ["1.0", "1.5", None, "2.0", "n/a"]


def test_widening_keeps_long_numbers_and_the_layout(spark, db):
    name = f"{db}.x"
    long = 2**53 + 1
    save_table(spark.createDataFrame([("A", long)], "ticker string, x bigint"), name, bucket_by=(4, "ticker"), sort_by=("ticker",))
    load_append(spark, spark.createDataFrame([("B", 1.5)], "ticker string, x double"), name, widen=True)
    assert rows_of(spark.table(name)) == [("A", str(long)), ("B", "1.5")]  # a double would have changed it
    detail = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
    assert detail["Num Buckets"] == "4"
    load_append(spark, spark.createDataFrame([("C", "z")], "ticker string, note string"), name, widen=True)
    assert rows_of(spark.table(name)) == [("A", str(long), None), ("B", "1.5", None), ("C", None, "z")]


def test_a_failing_append_changes_nothing(spark, db):
    name = f"{db}.x"
    load_append(spark, spark.createDataFrame([("A", 1)], "ticker string, x int"), name)
    broken = spark.createDataFrame([("B", 1.5)], "ticker string, x double").withColumn("x", F.raise_error(F.lit("lost")).cast("double"))
    with pytest.raises(Exception, match="lost"):
        load_append(spark, broken, name, widen=True)
    assert rows_of(spark.table(name)) == [("A", 1)]


# --- many files in one plan ---


def drifting(folder, files=40):
    for i in range(files):
        extra = ("\tZeta" if i % 5 == 0 else "") + ("\tAlpha Beta" if i % 7 == 3 else "")
        names = ("ticker\tx" if i % 2 else "x\tticker") + extra
        cells = ([f"T{i}", str(i)] if i % 2 else [str(i), f"T{i}"]) + (["z"] if i % 5 == 0 else []) + (["a b"] if i % 7 == 3 else [])
        (folder / f"f{i:03d}.csv").write_text(names + "\n" + "\t".join(cells) + "\n" + ("" if i % 3 else "\t".join(cells[:1]) + "\n"))
    return [str(folder / f"f{i:03d}.csv") for i in range(files)]


def test_one_scan_equals_the_fold(spark, tmp_path):
    paths = drifting(tmp_path)
    got = union_files(spark, paths)
    fold = union_by_name(*[read_delimited_text(spark, p) for p in paths])
    assert got.columns == fold.columns == ["x", "ticker", "Zeta", "Alpha_Beta"]
    assert rows_of(got) == rows_of(fold)


def test_the_plan_does_not_grow_with_the_files(spark, tmp_path):
    paths = drifting(tmp_path, 60)
    plans = [union_files(spark, p)._jdf.queryExecution().optimizedPlan().toString() for p in (paths[:14], paths)]
    nodes = [p.count("Relation ") + p.count("Union") + p.count("Join") + p.count("Project") for p in plans]
    assert nodes[0] == nodes[1] and all("Union" not in p and p.count("Relation [") == 1 for p in plans)


def test_odd_files_in_one_scan(spark, tmp_path):
    (tmp_path / "cash flow+100%.csv").write_text('ticker\tnote\nA\t"two\tvalues"\nB\t"say ""hi"""\n')
    with gzip.open(tmp_path / "b.csv.gz", "wt") as f:
        f.write("note\tticker\n\tC\n")
    (tmp_path / "c.csv").write_text("ticker\tnote\n")
    paths = [str(tmp_path / n) for n in ("cash flow+100%.csv", "b.csv.gz", "c.csv")]
    assert rows_of(union_files(spark, paths)) == [("A", "two\tvalues"), ("B", 'say "hi"'), ("C", None)]
    (tmp_path / "lines.csv").write_text('ticker\tnote\nA\t"two\nlines"\n')
    assert rows_of(union_files(spark, [str(tmp_path / "lines.csv")], multiline=True)) == [("A", "two\nlines")]
    (tmp_path / "twice.csv").write_text("a\tA\n1\t2\n")
    headers, bad = read_headers(spark, [*paths, str(tmp_path / "twice.csv"), str(tmp_path / "gone.csv")])
    assert len(headers) == 3 and "twice" in bad[str(tmp_path / "twice.csv")] and str(tmp_path / "gone.csv") in bad
    with pytest.raises(ValueError):
        union_files(spark, [str(tmp_path / "twice.csv")])


# --- inference ---


def test_type_states_add_up(spark):
    rows = [("1", "1", "true", "2024-01-31", "2024-01-31 10:00:00", None, "a", "0.5"), ("-2", "2.5e3", "FALSE", "1999-12-01", "2024-01-31", None, "1", None)]
    df = spark.createDataFrame(rows * 3, "i string, d string, b string, day string, at string, none string, t string, half string").repartition(4)
    whole = decided(type_states(df))
    assert whole == {"i": "bigint", "d": "double", "b": "boolean", "day": "date", "at": "timestamp", "none": "double", "t": "string", "half": "double"}
    tagged = df.withColumn("part", F.monotonically_increasing_id() % 3)
    parts = [type_states(tagged.where(F.col("part") == i).drop("part")) for i in range(3)]
    assert decided(merge_states(*parts)) == whole
    assert decide({"filled": 100, **{f"as_{t}": 0 for t in TYPES}, "as_double": 99}, 0.01) == "double"
    assert decide({"filled": 100, **{f"as_{t}": 0 for t in TYPES}, "as_double": 99}) == "string"


def test_values_that_only_look_like_numbers_stay_text(spark):
    df = spark.createDataFrame([("1d", "0x1p3", "99999999999999999999", "2024", "98052-6399")], "a string, b string, c string, y string, zip string")
    assert decided(type_states(df)) == {"a": "string", "b": "string", "c": "double", "y": "bigint", "zip": "string"}


def test_rejects_are_kept(spark):
    df = spark.createDataFrame([("1", "2024-01-01"), ("x", "2024-01-01"), ("3", "soon"), (None, None)], "n string, day string")
    fits, rejects = typed(df, {"n": "bigint", "day": "date"})
    assert rows_of(fits) == [(1, dt.date(2024, 1, 1)), (None, None)]
    assert rows_of(rejects) == [("3", "soon", ["day"]), ("x", "2024-01-01", ["n"])]


# --- whole folders ---


def report_of(df):
    return {r.table_name: r for r in df.collect()}


def test_one_bad_file_among_many(spark, tmp_path, db):
    folder = tmp_path / "cash"
    folder.mkdir()
    for i in range(60):
        (folder / f"part-{i:03d}.csv").write_text(f"ticker\tx\nT{i}\t{i}\n")
    (folder / "part-017.csv").write_bytes(b"\x00\xff\xfe\n\x01")
    with gzip.open(tmp_path / "late.csv.gz", "wb") as f:
        f.write(b"ticker\tx\n" + b"A\t1\n" * 60000)
    cut = (tmp_path / "late.csv.gz").read_bytes()
    (tmp_path / "late.csv.gz").write_bytes(cut[: len(cut) // 2])  # its header can be read, its end cannot
    (tmp_path / "ok.csv").write_text("ticker\ty\nA\t2.5\n")
    rows = load_directory(spark, str(tmp_path), db, glob="*.csv*", multiline=False).collect()
    good = {r.table_name: r for r in rows if r.status == "loaded"}
    assert (good["cash"].inserted_rows, good["cash"].total_rows, good["cash"].rejected_rows) == (59, 59, 0)
    assert good["ok"].inserted_rows == 1
    assert sorted(r.path.rsplit("/", 1)[-1] for r in rows if r.status == "failed") == ["late.csv.gz", "part-017.csv"]


def test_names_that_clash_are_told_apart(spark, tmp_path, db):
    (tmp_path / "cash flow.csv").write_text("ticker\tx\nA\t1\n")
    (tmp_path / "cash_flow.csv").write_text("ticker\tx\nB\t2\n")
    for folder in ("one", "two"):
        (tmp_path / folder).mkdir()
        (tmp_path / folder / "Income.csv").write_text(f"ticker\tx\n{folder}\t1\n")
    rows = load_directory(spark, str(tmp_path), db).collect()
    by_status = {s: sorted(r.path.rsplit("/", 1)[-1] for r in rows if r.status == s) for s in ("loaded", "failed")}
    assert by_status == {"loaded": ["Income.csv", "Income.csv"], "failed": ["cash flow.csv", "cash_flow.csv"]}
    assert all("too" in r.error for r in rows if r.status == "failed")
    assert {t.name.lower() for t in spark.catalog.listTables(db)} == {"one__income", "two__income"}
    assert tables_of_files(["/a/x.csv", "/a/X.csv"])[0] == {}


def test_appending_folders_drifts_without_loss(spark, tmp_path, db):
    for n, text in enumerate(["ticker\tx\nA\t1\n", "x\tticker\tnew\n1.5\tB\t2024-01-31\n", "ticker\tx\nC\t\n"]):
        (tmp_path / f"{n}").mkdir()
        (tmp_path / f"{n}" / "income.csv").write_text(text)
        one = report_of(load_directory(spark, str(tmp_path / f"{n}"), db, "append"))["income"]
        assert (one.status, one.inserted_rows, one.total_rows) == ("loaded", 1, n + 1)
    table = spark.table(f"{db}.income")
    assert types_of(table) == {"ticker": "string", "x": "double", "new": "date"}
    assert rows_of(table) == [("A", 1.0, None), ("B", 1.5, dt.date(2024, 1, 31)), ("C", None, None)]


def test_rows_that_do_not_fit_go_to_rejects(spark, tmp_path, db):
    lines = [f"T{i}\t{i}" for i in range(50)] + ["X\tnot a number", "Y\t1\tone too many", 'Z\t"quoted\ttab"']
    (tmp_path / "x.csv").write_text("ticker\tx\n" + "\n".join(lines) + "\n")
    one = report_of(load_directory(spark, str(tmp_path), db, tolerance=0.05))["x"]
    assert (one.inserted_rows, one.total_rows, one.rejected_rows) == (50, 50, 3)
    rejects = {r.row: r.contradicting for r in spark.table(f"{db}.x__rejects").collect()}
    assert rejects == {
        '{"ticker":"X","x":"not a number"}': "x",
        '{"ticker":"Z","x":"quoted\\ttab"}': "x",
        "Y\t1\tone too many": "more values than the header has names",
    }
    (tmp_path / "x.csv").write_text("ticker\tx\nA\t1\n")
    load_directory(spark, str(tmp_path), db)
    assert not spark.catalog.tableExists(f"{db}.x__rejects") and spark.table(f"{db}.x_backup").count() == 50


def test_loaded_types_are_those_of_inference(spark, tmp_path, db):
    (tmp_path / "x.csv").write_text("t\tn\td\tday\tb\tempty\tat\nA\t1\t1.5\t2024-01-31\ttrue\t\t2024-01-31 10:00:00\nB\t-7\t2\t2023-12-31\tfalse\t\t2024-01-31 11:00:00\n")
    load_directory(spark, str(tmp_path), db)
    assert types_of(spark.table(f"{db}.x")) == types_of(infer_delimited(spark, str(tmp_path / "x.csv")))


# --- verified copies ---


def test_copies_are_verified(spark, tmp_path):
    df = spark.createDataFrame([("A", 1.0, {"k": 1}), ("A", 1.0, {"k": 1}), (None, None, None)], "t string, x double, m map<string,int>")
    swapped = spark.createDataFrame([("x", "y")], "a string, b string")
    source = {"one": df, "two": swapped}
    first = {r.name: r for r in copy_tables(spark, source, str(tmp_path / "c")).collect()}
    assert {r.status for r in first.values()} == {"success"} and first["one"].rows == 3
    copies = {n: spark.read.parquet(str(tmp_path / "c" / n)) for n in source}
    assert {r.name: r.equal for r in verify_copies(source, copies).collect()} == {"one": True, "two": True}
    changed = {"one": df.limit(2).unionByName(df.limit(1)), "two": swapped.select(F.col("b").alias("a"), F.col("a").alias("b"))}
    assert {r.name: r.equal for r in verify_copies(source, changed).collect()} == {"one": False, "two": False}
    assert [r.equal for r in verify_copies({"one": df}, {}).collect()] == [False]


def test_a_failed_copy_leaves_the_old_target(spark, tmp_path):
    good = spark.createDataFrame([(1,)], "v int")
    copy_tables(spark, {"t": good}, str(tmp_path))
    bad = good.withColumn("v", F.raise_error(F.lit("boom")).cast("int"))
    assert copy_tables(spark, {"t": bad}, str(tmp_path)).first().status == "failed"
    assert spark.read.parquet(str(tmp_path / "t")).first().v == 1 and [p.name for p in tmp_path.iterdir()] == ["t"]
    assert copy_tables(spark, {"t": good.withColumn("v", F.lit(2))}, str(tmp_path)).first().status == "success"
    assert spark.read.parquet(str(tmp_path / "t")).first().v == 2 and [p.name for p in tmp_path.iterdir()] == ["t"]


def test_replace_counts_and_restores(spark, db, monkeypatch):
    from quarterdeck.plans import tables as T

    load_replace(spark, spark.createDataFrame([(1,)], "v int"), f"{db}.a")
    load_replace(spark, spark.createDataFrame([(1,)], "v int"), f"{db}.b")
    assert T.store_incoming(spark, spark.createDataFrame([(2,), (3,)], "v int"), f"{db}.a") == 2
    with pytest.raises(Exception):  # b has nothing incoming: a's renames are undone
        T.swap_incoming(spark, [f"{db}.a", f"{db}.b"])
    assert spark.table(f"{db}.a").first().v == 1 and spark.table(f"{db}.b").first().v == 1
