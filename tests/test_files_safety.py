"""What must not be lost: text through delimited files, files on append, columns of streams, documents and failed sections."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from quarterdeck.functions.coerce import try_date
from quarterdeck.operators.ranking import latest_per_key
from quarterdeck.operators.reshape import records_long, statement_long, statement_wide, unparseable_dates
from quarterdeck.plans.export import statement_tables_of
from quarterdeck.plans.managed import managed_profile
from quarterdeck.plans.tables import load_directory, load_replace
from quarterdeck.sources.delimited import append_delimited, infer_delimited, read_delimited_text, read_directory, write_delimited
from quarterdeck.sources.documents import map_documents, read_documents, record_documents, section_errors, with_document, write_documents
from quarterdeck.sources.files import json_record_counts, file_manifest, required_inputs
from quarterdeck.streaming import run_available, stream_statements


def test_text_survives_a_round_trip(spark, tmp_path):
    texts = ['He said "hi" to\tBob', " pad ", "two\nlines", '"', "", None, "back\\slash", "\\", 'a\\"b', "x'y", "#no comment"]
    df = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "id string, text string")
    write_delimited(df, str(tmp_path / "t"))
    back = {r.id: r.text for r in read_delimited_text(spark, str(tmp_path / "t"), multiline=True).collect()}
    assert back == {str(i): t or None for i, t in enumerate(texts)}  # an empty field is a missing one


def test_append_never_replaces_files(spark, tmp_path):
    path = tmp_path / "app"
    two = spark.createDataFrame([("A", 1.0), ("B", 2.0)], "ticker string, x double")
    append_delimited(spark, two.coalesce(1), str(path))
    (path / "broken.csv").mkdir()
    (path / "broken.csv" / "part-0.csv").write_bytes(b"\x00\xff\xfe")
    before = sorted(p.name for p in path.rglob("part-*") if not p.name.endswith(".crc"))
    try:
        append_delimited(spark, two.coalesce(1), str(path))
    except Exception:  # noqa: BLE001, S110 - an unreadable neighbour may stop the append, but must not cost a file
        pass
    assert set(before) <= {p.name for p in path.rglob("part-*")}
    empty = tmp_path / "headless"
    empty.mkdir()
    (empty / "part-0.csv").write_text("")
    with pytest.raises(Exception):
        append_delimited(spark, two, str(empty))
    assert (empty / "part-0.csv").exists()
    with pytest.raises(ValueError):
        append_delimited(spark, two.withColumn("new", F.lit(1)), str(tmp_path / "app2")) or append_delimited(
            spark, two.withColumn("newer", F.lit(1)), str(tmp_path / "app2")
        )


def test_directory_keeps_equal_stems_apart_and_isolates_a_bad_file(spark, tmp_path):
    for folder in ("y1", "y2"):
        (tmp_path / folder).mkdir()
        (tmp_path / folder / "balance_sheet.csv").write_text(f"ticker\tv\n{folder}\t1\n")
    (tmp_path / "empty.csv").write_text("\n\n")
    tables, report = read_directory(spark, str(tmp_path))
    assert sorted(tables) == ["y1__balance_sheet", "y2__balance_sheet"]
    status = {r.table_name: (r.status, r.error) for r in report.collect()}
    assert status["empty"][0] == "failed" and status["empty"][1]
    assert tables["y2__balance_sheet"].first().ticker == "y2"


def test_stream_stops_at_another_header(spark, tmp_path):
    landing, target, ckpt = tmp_path / "in", tmp_path / "out", tmp_path / "ckpt"
    landing.mkdir()
    (landing / "a.csv").write_text('report_date\tticker\tTotal Revenue\n2024-03-31\t"A\t1"\t10.5\n')
    run_available(stream_statements(spark, str(landing), str(target), "income_statement", checkpoint_location=str(ckpt)))
    assert spark.read.parquet(str(target)).first().ticker == "A\t1"
    (landing / "b.csv").write_text("ticker\treport_date\tTotal Revenue\nB\t2024-06-30\t3\n")
    with pytest.raises(Exception):
        run_available(stream_statements(spark, str(landing), str(target), "income_statement", checkpoint_location=str(ckpt)))
    assert spark.read.parquet(str(target)).count() == 1


def test_dates_parse_whole(spark):
    texts = ["2024-09-30", "2024-09-30T00:00:00.000", "2024-09-30 01:02:03", "2024-09-301", "2024-09-30garbage", "", None, "x"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, s string").withColumn("d", try_date("s"))
    day = dt.date(2024, 9, 30)
    assert [r.d for r in rows.orderBy("i").collect()] == [day, day, day, None, None, None, None, None]


def test_documents_stay_apart_and_keep_empty_reports(spark, tmp_path):
    docs = [
        {"income_statement": {"Total Revenue": {"2024-12-31": "1"}, "Net Income": {"2024-12-31": ""}}},
        {"income_statement": {"Total Revenue": {"2024-12-31": ""}, "Net Income": {"2024-12-31": "2"}}},
        {"ticker": "A", "income_statement": {"Total Revenue": {"2024-12-31": "", "2023-12-31": "3", "soon": "4"}}},
    ]
    (tmp_path / "d.json").write_text("\n".join(map(json.dumps, docs)))
    read = with_document(read_documents(spark, str(tmp_path / "d.json")))
    wide = statement_wide(statement_long(read, "income_statement", keep_missing=True), ["Total_Revenue", "Net_Income"])
    got = [(r.ticker, str(r.report_date), r.Total_Revenue, r.Net_Income) for r in wide.collect()]
    want = [("N/A", "2024-12-31", 1.0, None), ("N/A", "2024-12-31", None, 2.0), ("A", "2024-12-31", None, None), ("A", "2023-12-31", 3.0, None)]
    assert sorted(map(str, got)) == sorted(map(str, [*want, ("A", "None", 4.0, None)]))
    assert [tuple(r) for r in unparseable_dates(read, "income_statement").collect()] == [("A", 1)]
    tables = statement_tables_of(read, sections=("income_statement",))
    assert tables["income_statement"].columns == ["ticker", "report_date", "Net_Income", "Total_Revenue"]
    assert tables["income_statement"].count() == 5


def test_failed_sections_keep_their_error(spark, tmp_path):
    docs = [
        {"ticker": "A", "source": "p2", "balance_sheet": {"error": "HTTP 429"}, "ratios": [{"date": "2024-12-31", "x": 1.5}]},
        {"ticker": "B", "source": "p2", "balance_sheet": []},
    ]
    (tmp_path / "r.json").write_text(json.dumps(docs))
    read = read_documents(spark, str(tmp_path / "r.json"), "records", multiline=True)
    assert [tuple(r) for r in section_errors(read).collect()] == [("A", "balance_sheet", "HTTP 429")]
    rows = {r.ticker: r for r in read.collect()}
    assert rows["A"].balance_sheet is None and rows["B"].balance_sheet == []
    assert [(r.line_item, r.value) for r in records_long(read, "ratios").collect()] == [("x", "1.5")]


def test_provider_names_of_quarterly_sections(spark, tmp_path):
    doc = {"ticker": "A", "quarterly_financials": {"Total Revenue": {"2024-09-30": "1"}}, "quarterly_cashflow": {"Capex": {"2024-09-30": "2"}},
           "earnings": {"Earnings": {"2024": "3"}}}
    (tmp_path / "q.json").write_text(json.dumps(doc))
    read = read_documents(spark, str(tmp_path / "q.json"))
    assert statement_long(read, "quarterly_financials").count() == statement_long(read, "quarterly_cashflow").count() == 1
    assert read.first().earnings == {"Earnings": {"2024": "3"}}


def test_records_of_array_files(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([{"ticker": "A", "x": [1]}, {"x": 2}], indent=2))
    got = {r.file_name: r.records for r in json_record_counts(spark, str(tmp_path), multiline=True).collect()}
    assert got == {"a.json": 2}


def test_pretty_documents_all_come_back(spark, tmp_path):
    docs = spark.createDataFrame([("A",), ("B",), ("C",)], "ticker string").coalesce(1)
    write_documents(docs, str(tmp_path / "p"), pretty=True)
    assert sorted(r.ticker for r in read_documents(spark, str(tmp_path / "p"), multiline=True).collect()) == ["A", "B", "C"]


def test_document_writers_take_repeated_keys_and_split_years(spark, tmp_path):
    rows = [("A", dt.date(2023, 12, 31), 1.0), ("A", dt.date(2023, 12, 31), 2.0), ("A", dt.date(2024, 12, 31), None), (None, dt.date(2024, 12, 31), 5.0)]
    wide = spark.createDataFrame(rows, "ticker string, report_date date, Total_Revenue double")
    profile = spark.createDataFrame([("A", dt.date(1970, 1, 1), "x")], "ticker string, report_date date, company string")
    docs = map_documents({"income_statement": wide}, profile, split_years=True)
    cells = {(r.ticker, d): v for r in docs.collect() if r.income_statement for d, v in r.income_statement["Total Revenue"].items()}
    assert cells == {("A", "2023-12-31"): "2.0", ("A", "2024-12-31"): "", (None, "2024-12-31"): "5.0"}
    assert [r.company_info for r in docs.collect() if r.company_info] == [{"company": "x"}]
    assert record_documents({"income_statement": wide}, split_years=True).count() == 3


def test_latest_row_does_not_depend_on_partitions(spark):
    rows = [("k", dt.date(2024, 1, 1), float(i)) for i in range(400)]
    df = spark.createDataFrame(rows, "ticker string, report_date date, v double")
    assert {latest_per_key(df.repartition(n), "ticker").first().v for n in (1, 3, 7, 16)} == {399.0}


def test_profile_text_is_typed_leniently(spark):
    rows = [("A", "1970-01-01", "164000.0"), ("B", "1970-01-01", "many"), ("C", "1970-01-01", "")]
    df = spark.createDataFrame(rows, "ticker string, report_date string, fullTimeEmployees string")
    assert {r.ticker: r.fullTimeEmployees for r in managed_profile(df).collect()} == {"A": 164000, "B": None, "C": None}


def test_directory_loader_replaces_and_appends(spark, tmp_path):
    (tmp_path / "cash.csv").write_text("ticker\tx\tnote\nA\t1.5\t\nB\t2\t\n")
    (tmp_path / "bad.csv").write_text("\n\n")
    one = {r.table_name: r for r in load_directory(spark, str(tmp_path), "t_dir").collect()}
    assert (one["cash"].status, one["cash"].inserted_rows, one["cash"].total_rows) == ("loaded", 2, 2)
    assert one["bad"].status == "failed"
    two = {r.table_name: r for r in load_directory(spark, str(tmp_path), "t_dir", mode="append").collect()}
    assert (two["cash"].inserted_rows, two["cash"].total_rows) == (2, 4)
    assert dict(spark.table("t_dir.cash").dtypes)["note"] == "double"  # no value yet: numbers can come later


def test_replace_without_backup_keeps_an_older_backup(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS t_keep")
    for v in (1, 2):
        load_replace(spark, spark.createDataFrame([(v,)], "v int"), "t_keep.t")
    load_replace(spark, spark.createDataFrame([(3,)], "v int"), "t_keep.t", keep_backup=False)
    assert spark.table("t_keep.t").first().v == 3 and spark.table("t_keep.t_backup").first().v == 1


def test_required_inputs_join_no_more_than_the_list(spark, tmp_path):
    for i in range(30):
        (tmp_path / f"f{i}.csv").write_text("x")
    check = required_inputs(file_manifest(spark, str(tmp_path)), ["f1.csv", "f99.csv"])
    assert {r.name: r.present for r in check.collect()} == {"f1.csv": True, "f99.csv": False}
    assert infer_delimited(spark, str(tmp_path / "f1.csv")).columns == ["x"]
