"""Versioned tables: all change in one step; keyed loads write only what changes; stored tables widen without losing values."""

import datetime as dt
import threading

import pytest
from pyspark.sql import functions as F

from quarterdeck.functions.lattice import exactly_wider, merged_types, types_of, wider
from quarterdeck.plans import build as B
from quarterdeck.plans.merge import merge_rows
from quarterdeck.plans.releases import Conflict, Draft, TableStore

D = dt.date


def stamped(spark, n, tables=("a", "b", "c")):
    return {t: spark.createDataFrame([(n, t)], "stamp int, name string") for t in tables}


def publish(store, tables, note=""):
    with store.draft() as draft:
        for name, df in tables.items():
            draft.put(name, df)
        return draft.commit(note)


def test_tables_switch_together(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "store"))
    assert store.release().number == 0 and store.history().count() == 0
    publish(store, stamped(spark, 1), "first")
    opened = store.release()
    publish(store, stamped(spark, 2))
    assert {store.read(t).first().stamp for t in "abc"} == {2}
    assert {store.read(t, opened).first().stamp for t in "abc"} == {1}  # a reader keeps the release it opened
    assert store.rollback(1).number == 3 and {store.read(t).first().stamp for t in "abc"} == {1}
    assert [(r.number, r.table_name, r.rows) for r in store.history().where("number = 1").orderBy("table_name").collect()] == [(1, t, 1) for t in "abc"]
    store.register(prefix="now_")
    assert spark.sql("SELECT count(*) AS n FROM now_a JOIN now_b USING (stamp)").first().n == 1
    with pytest.raises(KeyError):
        store.read("missing")


def test_a_reader_during_publishing_sees_one_release(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "store"))
    publish(store, stamped(spark, 0))
    seen, stop = [], threading.Event()

    def reader():
        while not stop.is_set():
            release = store.release()
            seen.append({store.read(t, release).first().stamp for t in "abc"})

    thread = threading.Thread(target=reader)
    thread.start()
    try:
        for n in range(1, 5):
            publish(store, stamped(spark, n))
    finally:
        stop.set()
        thread.join()
    assert len(seen) > 3 and all(len(s) == 1 for s in seen)


def test_a_draft_that_fails_changes_nothing(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "store"))
    publish(store, stamped(spark, 1))
    files = sorted(str(p) for p in tmp_path.rglob("*.parquet"))
    failing = spark.range(3).select(F.raise_error(F.lit("lost")).cast("int").alias("stamp"))
    with pytest.raises(Exception, match="lost"):
        publish(store, {**stamped(spark, 2), "d": failing})
    assert store.release().number == 1 and {store.read(t).first().stamp for t in "abc"} == {1}
    assert sorted(str(p) for p in tmp_path.rglob("*.parquet")) == files


def test_two_writers(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "store"))
    publish(store, stamped(spark, 1))
    one, two, three = store.draft(), store.draft(), store.draft()
    one.put("a", spark.createDataFrame([(7, "a")], "stamp int, name string"))
    two.put("b", spark.createDataFrame([(8, "b")], "stamp int, name string"))
    three.put("a", spark.createDataFrame([(9, "a")], "stamp int, name string"))
    one.commit()
    two.commit()  # another table: carried over
    with pytest.raises(Conflict):
        three.commit()
    assert [store.read(t).first().stamp for t in "abc"] == [7, 8, 1]
    assert not store.files.write_new(store._manifest(1), "{}") and store.release(1).tables  # a manifest is never replaced


def test_vacuum_keeps_what_is_named(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "store"))
    for n in range(4):
        publish(store, stamped(spark, n))
    publish(store, {"a": stamped(spark, 9)["a"]})  # b and c keep their files of the release before
    assert store.vacuum(keep=2, older_than_hours=24) == []  # too young
    gone = store.vacuum(keep=2, older_than_hours=-1)
    assert len(gone) == 9 and store.numbers() == [4, 5]
    assert [store.read(t).first().stamp for t in "abc"] == [9, 3, 3]


# --- keyed loads ---

KEYED = "ticker string, report_date date, x bigint, note string"


def load(store, rows, schema=KEYED, **more):
    with store.draft() as draft:
        merged = merge_rows(draft, "statements", store.spark.createDataFrame(rows, schema).repartition(3), **more)
        draft.commit()
    return merged


def stored(store):
    return sorted((tuple(r) for r in store.read("statements").collect()), key=str)


def test_the_same_file_twice_changes_nothing(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "store"))
    rows = [(f"T{i:03d}", D(2020, 3, 31), i, None) for i in range(200)] + [(None, D(2020, 3, 31), 1, "x"), ("T000", None, 2, None)]
    first = load(store, rows, buckets=8)
    assert (first.inserted, first.updated) == (202, 0)
    before = store.release()
    again = load(store, rows)
    assert (again.inserted, again.updated, again.unchanged, again.rewritten, again.extended) == (0, 0, 202, (), ())
    assert store.release() == before and stored(store) == sorted(rows, key=str)


def test_only_touched_buckets_are_written(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "store"))
    rows = {(f"T{i:03d}", D(2020, 3, 31)): (i, None) for i in range(300)}
    load(store, [(*k, *v) for k, v in rows.items()], buckets=16)
    before = store.release().tables["statements"]
    batch = [("T007", D(2020, 3, 31), -7, "changed"), ("T008", D(2020, 3, 31), 8, None), ("NEW", D(2021, 3, 31), 1, "new")]
    merged = load(store, batch)
    assert (merged.inserted, merged.updated, merged.unchanged) == (1, 1, 1)
    assert len(merged.rewritten) == 1 and len(merged.rewritten) + len(merged.extended) <= 2
    after = store.release().tables["statements"]
    touched = {*merged.rewritten, *merged.extended}
    assert [p for p in after.pieces if p.bucket not in touched] == [p for p in before.pieces if p.bucket not in touched]
    for bucket in merged.extended:
        assert {p.path for p in before.pieces if p.bucket == bucket} < {p.path for p in after.pieces if p.bucket == bucket}
    rows[("T007", D(2020, 3, 31))], rows[("NEW", D(2021, 3, 31))] = (-7, "changed"), (1, "new")
    assert stored(store) == sorted(((*k, *v) for k, v in rows.items()), key=str)
    assert after.rows == len(rows)


def test_random_batches_equal_a_dictionary(spark, tmp_path):
    import random

    rng, model = random.Random(4), {}
    store = TableStore(spark, str(tmp_path / "store"))
    for n in range(5):
        batch = {}
        for _ in range(rng.randrange(1, 60)):
            key = (rng.choice(["A", "B", "C", None, "hot", "hot", "hot"]), D(2000 + rng.randrange(12), 12, 31))
            batch.setdefault(key, []).append((rng.randrange(3), rng.choice([None, "n"])))
        merged = load(store, [(*k, *v) for k, vs in batch.items() for v in vs], buckets=4)
        largest = {k: max(vs, key=lambda v: (v[0], v[1] or "")) for k, vs in batch.items()}
        assert merged.duplicates == sum(len(vs) - 1 for vs in batch.values())
        assert merged.inserted == len(largest.keys() - model.keys()) and merged.updated == sum(model[k] != v for k, v in largest.items() if k in model)
        model.update(largest)
        assert stored(store) == sorted(((*k, *v) for k, v in model.items()), key=str), n


def test_crowded_key_bits_are_dealt_anew(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "store"))
    load(store, [("A", D(2020, 1, 1), 1, None)], buckets=2)
    few = store.release().tables["statements"].words
    rows = [(f"T{i}", D(2020, 1, 1), i, None) for i in range(400)]
    load(store, rows)
    load(store, [("B", D(2020, 1, 1), 2, None), ("C", D(2020, 1, 1), 2, None), ("E", D(2020, 1, 1), 2, None)])
    assert store.release().tables["statements"].words > few and store.release().tables["statements"].rows == 404
    assert load(store, rows).unchanged == 400


def test_merge_widens_and_adds_columns(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "store"))
    load(store, [("A", D(2020, 1, 1), 1, "a"), ("B", D(2020, 1, 1), 2, "b")], buckets=4)
    files = {p.path for p in store.release().tables["statements"].pieces}
    merged = load(store, [("C", D(2020, 1, 1), 1.5, 7)], "ticker string, report_date date, x double, added int")
    assert merged.inserted == 1 and files < {p.path for p in store.release().tables["statements"].pieces}  # nothing rewritten
    assert types_of(store.read("statements")) == {"ticker": "string", "report_date": "date", "x": "double", "note": "string", "added": "int"}
    assert stored(store) == [("A", D(2020, 1, 1), 1.0, "a", None), ("B", D(2020, 1, 1), 2.0, "b", None), ("C", D(2020, 1, 1), 1.5, None, 7)]
    load(store, [("A", D(2020, 1, 1), 9)], "ticker string, report_date date, added int")  # columns that the file lacks stay
    assert stored(store)[0] == ("A", D(2020, 1, 1), 1.0, "a", 9)
    load(store, [(5, "2020", "z")], "ticker bigint, report_date string, note string")  # a key column becomes text: the hash does not change
    assert load(store, [("A", "2020-01-01", "a")], "ticker string, report_date string, note string").unchanged == 1


def test_merge_refuses_what_has_no_key(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "store"))
    with pytest.raises(ValueError):
        load(store, [("A", 1)], "ticker string, x int")
    publish(store, {"statements": spark.createDataFrame([("A", D(2020, 1, 1), 1, None)], KEYED)})
    with pytest.raises(ValueError):
        load(store, [("A", D(2020, 1, 1), 1, None)])
    empty = TableStore(spark, str(tmp_path / "empty"))
    assert load(empty, []).inserted == 0 and load(empty, [("A", D(2020, 1, 1), 1, None)]).inserted == 1


# --- types ---


def test_lattice():
    names = ["tinyint", "int", "bigint", "float", "double", "date", "timestamp", "boolean", "string", "void"]
    for a in names:
        for b in names:
            up = wider(a, b)
            assert up == wider(b, a) and wider(up, a) == up
            assert all(wider(wider(a, b), c) == wider(a, wider(b, c)) for c in names)
    assert wider("int", "double") == "double" and wider("date", "timestamp") == "timestamp" and wider("date", "double") == "string"
    with pytest.raises(ValueError):
        wider("array<int>", "int")
    assert list(merged_types({"b": "int", "a": "date"}, {"z": "int", "c": "int", "a": "date"})) == ["b", "a", "c", "z"]
    with pytest.raises(ValueError):
        merged_types({"EBITDA": "double"}, {"ebitda": "double"})


def test_long_numbers_become_text_instead_of_doubles(spark):
    small, large = (spark.createDataFrame([(v,)], "x bigint") for v in (2**53, 2**53 + 1))
    assert exactly_wider([(small, {"x": "bigint"})], {"x": "double"}) == {"x": "double"}
    assert exactly_wider([(small, {"x": "bigint"}), (large, {"x": "bigint"})], {"x": "double"}) == {"x": "string"}


# --- the staged build as one release ---


def statement_files(spark, sf_dir, folder):
    from quarterdeck.sources.delimited import write_delimited
    from quarterdeck.sources.testdata import statement_tables

    st = statement_tables(spark, sf_dir)
    for stem, key in {"balance_sheet": "balance", "income_statement": "income", "cash_flow_statement": "cash_flow"}.items():
        write_delimited(st[key].coalesce(1), f"{folder}/{stem}.csv")
    write_delimited(st["company_info"].withColumnRenamed("company", "displayName").coalesce(1), f"{folder}/company_info.csv")


def test_a_build_killed_at_any_stage_leaves_the_old_release(spark, sf_small, tmp_path, monkeypatch):
    statement_files(spark, sf_small, str(tmp_path / "src"))
    root = str(tmp_path / "store")
    summary = {r.table_name: r.rows for r in B.build_release(spark, str(tmp_path / "src"), root, buckets=4).collect()}
    assert len(summary) == 9 and summary["financial_ratios"] > 0
    store = TableStore(spark, root)
    first = store.release()
    assert {n: t.rows for n, t in first.tables.items()} == summary
    put = Draft.put
    for stage in (0, 3, 4, 8):  # the first table, the last managed one, the first and the last analytics one
        calls = []

        def dying(self, name, *args, calls=calls, stage=stage, **more):
            calls.append(name)
            if len(calls) > stage:
                raise RuntimeError("killed")
            return put(self, name, *args, **more)

        monkeypatch.setattr(Draft, "put", dying)
        with pytest.raises(B.StageError, match="killed"):
            B.build_release(spark, str(tmp_path / "src"), root, buckets=4)
        assert store.release() == first
    monkeypatch.setattr(Draft, "put", put)
    B.build_release(spark, str(tmp_path / "src"), root, buckets=4)
    assert store.release().number == 2 and store.read("yoy_comparison").count() == summary["yoy_comparison"]


def test_a_catalog_build_that_fails_keeps_all_old_tables(spark, sf_small, tmp_path, monkeypatch):
    statement_files(spark, sf_small, str(tmp_path / "src"))
    B.build_all(spark, str(tmp_path / "src"), "t_kept")
    stamps = {t: spark.table(f"t_kept.{t}").agg(F.max(F.col(c))).first()[0] for t, c in (("income_statement", "loaded_at"), ("financial_ratios", "calculated_at"))}
    real = B.M.yoy_comparison
    monkeypatch.setattr(B.M, "yoy_comparison", lambda *a, **k: real(*a, **k).withColumn("prior_eps", F.raise_error(F.lit("late"))))
    with pytest.raises(B.StageError, match="late"):
        B.build_all(spark, str(tmp_path / "src"), "t_kept")
    monkeypatch.setattr(B.M, "yoy_comparison", real)
    for t, c in (("income_statement", "loaded_at"), ("financial_ratios", "calculated_at")):
        assert spark.table(f"t_kept.{t}").agg(F.max(F.col(c))).first()[0] == stamps[t]
    assert not [t.name for t in spark.catalog.listTables("t_kept") if t.name.endswith("_incoming")]


def test_command_line(spark, sf_small, tmp_path, capsys):
    from quarterdeck.cli import main

    statement_files(spark, sf_small, str(tmp_path / "src"))
    for name, root in (("publish", "p"), ("merge", "m")):
        assert main([name, "--src", str(tmp_path / "src"), "--store", str(tmp_path / root), "--buckets", "4"], spark=spark) == 0
    one, two = (TableStore(spark, str(tmp_path / root)) for root in "pm")
    assert {n: t.rows for n, t in one.release().tables.items()} == {n: t.rows for n, t in two.release().tables.items()}
    assert main(["merge", "--src", str(tmp_path / "src"), "--store", str(tmp_path / "m")], spark=spark) == 0
    assert two.numbers() == [1] and "updated 0" in capsys.readouterr().out
    assert main(["rollback", "--store", str(tmp_path / "p"), "--number", "1"], spark=spark) == 0 and one.numbers() == [1, 2]
    assert main(["releases", "--store", str(tmp_path / "p")], spark=spark) == 0


def test_raw_files_are_copied_with_a_status(spark, tmp_path):
    from quarterdeck.sources.files import copy_files

    (tmp_path / "a b.csv").write_text("x" * 100_000)
    (tmp_path / "out").mkdir()
    (tmp_path / "out" / "keep.csv").write_text("old")
    files = {str(tmp_path / "a b.csv"): str(tmp_path / "out" / "a b.csv"), str(tmp_path / "gone.csv"): str(tmp_path / "out" / "keep.csv")}
    got = {r.name: (r.status, r.size_bytes) for r in copy_files(spark, files).collect()}
    assert got == {"a b.csv": ("success", 100_000), "keep.csv": ("failed", None)}
    assert (tmp_path / "out" / "a b.csv").read_text() == "x" * 100_000 and (tmp_path / "out" / "keep.csv").read_text() == "old"
    assert copy_files(spark, {str(tmp_path / "a b.csv"): str(tmp_path / "out" / "keep.csv")}).first().status == "success"
    assert (tmp_path / "out" / "keep.csv").read_text() == "x" * 100_000
    assert not [p.name for p in (tmp_path / "out").iterdir() if p.name.endswith(".part")]
