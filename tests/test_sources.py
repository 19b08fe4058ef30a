"""Readers and writers on hand-made files holding the edge rows of FIXTURES.md (group A)."""

import datetime as dt
import json

from pyspark.sql import functions as F

from quarterdeck.operators.reshape import (
    company_profile,
    filter_years,
    filter_years_records,
    records_long,
    statement_long,
    statement_wide,
)
from quarterdeck.sources.delimited import infer_delimited, read_delimited_text, read_statement, write_delimited
from quarterdeck.sources.documents import read_documents
from quarterdeck.sources.files import file_manifest, file_stats, json_record_counts, required_inputs, required_summary, verify_files

TSV = (
    "report_date\tticker\tTotal Revenue\tNet Income\tDiluted Average Shares\n"
    "2025-09-30\tAAPL\t416161000000.0\t\t15004697000\n"
    "2024-09-30\tAAPL\t391035000000.0\t93736000000.0\n"  # jagged: last field missing
    '2023-09-30\t"MS\nFT"\tjunk\t1.0\t0.0\n'  # newline inside quotes, junk number
)


def test_tsv_statement_reader(spark, tmp_path):
    p = tmp_path / "income_statement.csv"
    p.write_text(TSV)
    df = read_statement(spark, str(p), section="income_statement")
    assert df.columns == ["report_date", "ticker", "Total_Revenue", "Net_Income", "Diluted_Average_Shares"]
    assert dict(df.dtypes)["Diluted_Average_Shares"] == "bigint" and dict(df.dtypes)["report_date"] == "date"
    rows = {r.report_date: r for r in df.collect()}
    assert rows[dt.date(2025, 9, 30)].Net_Income is None
    assert rows[dt.date(2025, 9, 30)].Diluted_Average_Shares == 15004697000
    assert rows[dt.date(2024, 9, 30)].Diluted_Average_Shares is None
    assert rows[dt.date(2023, 9, 30)].ticker == "MS\nFT"
    assert rows[dt.date(2023, 9, 30)].Total_Revenue is None
    assert rows[dt.date(2023, 9, 30)].Diluted_Average_Shares == 0


def test_tsv_profile_keeps_text_and_cleans_names(spark, tmp_path):
    p = tmp_path / "company_info.csv"
    p.write_text("report_date\tticker\tzip\t52WeekChange\n1970-01-01\tMSFT\t98052-6399\t0.1\n1970-01-01\tAAPL\t95014\t0.2\n")
    df = read_delimited_text(spark, str(p))
    assert df.columns == ["report_date", "ticker", "zip", "_52WeekChange"]
    assert sorted(r.zip for r in df.collect()) == ["95014", "98052-6399"]
    inferred = infer_delimited(spark, str(p))
    assert dict(inferred.dtypes)["report_date"] == "date"


def test_tsv_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("A", dt.date(2020, 3, 31), 1.25, None)], "ticker string, report_date date, x double, y double")
    write_delimited(df, str(tmp_path / "out"))
    back = read_statement(spark, str(tmp_path / "out"))
    assert back.select("ticker", "report_date", "x", "y").collect() == df.collect()


def _map_docs(tmp_path):
    docs = [
        {
            "ticker": "AAPL",
            "source": "p1",
            "company_info": {"displayName": "Apple", "zip": "95014", "fullTimeEmployees": "164000",
                             "companyOfficers": "[{\"name\": \"x\"}]"},
            "income_statement": {
                "Total Revenue": {"2025-09-30T00:00:00.000": "416161000000.0", "2024-09-30": "391035000000.0",
                                  "junk-date": "1"},
                "Interest Expense": {"2025-09-30": "", "2024-09-30": ""},
            },
            "balance_sheet": None,
        },
        {
            "source": "p1",
            "income_statement": {"Total Revenue": {"2023-06-30": "211915000000.0"}, "Net Income": {"2023-06-30": "72361000000.0"}},
        },
    ]
    p = tmp_path / "docs.json"
    p.write_text(json.dumps(docs))
    return str(p)


def test_map_documents(spark, tmp_path):
    docs = read_documents(spark, _map_docs(tmp_path), "map", multiline=True)
    long = statement_long(docs, "income_statement")
    got = {(r.ticker, r.report_date, r.line_item): r.value for r in long.collect()}
    assert got[("AAPL", dt.date(2025, 9, 30), "Total_Revenue")] == "416161000000.0"
    assert ("N/A", dt.date(2023, 6, 30), "Net_Income") in got  # item only in the second document, no ticker
    assert not any(k[2] == "Interest_Expense" for k in got)  # "" is missing
    wide = statement_wide(long.where(F.col("report_date").isNotNull()), ["Total_Revenue", "Net_Income"], "income_statement")
    assert wide.count() == 3
    prof = company_profile(docs.where(F.col("ticker") == "AAPL")).collect()[0]
    assert prof.company == "Apple" and prof.zip == "95014" and prof.fullTimeEmployees == 164000
    assert prof.report_date == dt.date(1970, 1, 1)
    kept = filter_years(docs, [2024], ["income_statement"]).where(F.col("ticker") == "AAPL").collect()[0]
    assert set(kept.income_statement["Total Revenue"]) == {"2024-09-30"}  # junk label dropped
    assert filter_years(docs, [], ["income_statement"]) is docs


def test_record_documents(spark, tmp_path):
    docs = [
        {"ticker": "AAPL", "source": "p2", "income_statement": [
            {"date": "2024-09-28", "calendarYear": "2024", "revenue": "391035000000"},
            {"date": "2023-09-30", "calendarYear": "2023", "revenue": "383285000000"}]},
        {"ticker": "BAD", "source": "p2", "error": "HTTP 429"},
    ]
    p = tmp_path / "rec.json"
    p.write_text("\n".join(json.dumps(d) for d in docs))
    df = read_documents(spark, str(p), "records")
    assert df.where(F.col("error").isNotNull()).count() == 1
    kept = filter_years_records(df, [2024], ["income_statement"])
    long = records_long(kept, "income_statement").collect()
    assert [(r.ticker, r.report_date, r.line_item, r.value) for r in long] == [
        ("AAPL", dt.date(2024, 9, 28), "revenue", "391035000000")
    ]


def test_file_inventory(spark, tmp_path):
    (tmp_path / "raw").mkdir()
    for name, size in (("balance_sheet.csv", 10), ("income_statement.csv", 20), (".hidden.csv", 5), ("notes.txt", 3)):
        (tmp_path / "raw" / name).write_bytes(b"x" * size)
    m = file_manifest(spark, str(tmp_path / "raw"), "*.csv")
    assert sorted(r.name for r in m.collect()) == ["balance_sheet.csv", "income_statement.csv"]
    st = file_stats(m).collect()[0]
    assert st.file_count == 2 and st.total_mb == 0.0
    v = {r.prefix: r.file_count for r in verify_files(m, ["balance", "income", "cash"]).collect()}
    assert v == {"balance": 1, "income": 1, "cash": 0}
    req = required_inputs(m, ["balance_sheet.csv", "cash_flow_statement.csv"])
    assert {r.name: r.present for r in req.collect()} == {"balance_sheet.csv": True, "cash_flow_statement.csv": False}
    s = required_summary(req).collect()[0]
    assert (s.passed, s.failed, s.ok) == (1, 1, False)


def test_json_record_counts(spark, tmp_path):
    d = tmp_path / "j"
    d.mkdir()
    (d / "a.json").write_text('{"x": 1}\n{"x": 2}\n')
    (d / "b.json").write_text('{"x": 3}\n')
    got = {r.file_name: r.records for r in json_record_counts(spark, str(d)).collect()}
    assert got == {"a.json": 2, "b.json": 1}


def test_append_delimited_aligns_by_name(spark, tmp_path):
    from quarterdeck.sources.delimited import append_delimited

    path = str(tmp_path / "app")
    append_delimited(spark, spark.createDataFrame([("A", 1.0, 2.0)], "ticker string, x double, y double"), path)
    append_delimited(spark, spark.createDataFrame([(5.0, "B")], "y double, ticker string"), path)
    got = {r.ticker: (r.x, r.y) for r in read_statement(spark, path).collect()}
    assert got == {"A": (1.0, 2.0), "B": (None, 5.0)}


def test_read_directory_isolates_failures(spark, tmp_path):
    from quarterdeck.sources.delimited import read_directory

    d = tmp_path / "dir"
    d.mkdir()
    (d / "balance_sheet.csv").write_text("report_date\tticker\tTotal Assets\n2024-01-31\tA\t1\n")
    (d / "income_statement.csv").write_text("report_date\tticker\n")
    tables, report = read_directory(spark, str(d))
    assert sorted(tables) == ["balance_sheet", "income_statement"]
    assert {r.table_name: r.status for r in report.collect()} == {"balance_sheet": "loaded", "income_statement": "loaded"}
    assert tables["balance_sheet"].columns == ["report_date", "ticker", "Total_Assets"]


def test_quarterly_sections_share_the_long_form(spark, tmp_path):
    docs = [{"ticker": "A", "income_statement": {"Total Revenue": {"2024-12-31": "4"}},
             "quarterly_income_statement": {"Total Revenue": {"2024-09-30": "1", "2024-12-31": "1.5"}}}]
    p = tmp_path / "q.json"
    p.write_text(json.dumps(docs))
    d = read_documents(spark, str(p), "map", multiline=True)
    long = statement_long(d, "income_statement", "annual").unionByName(
        statement_long(d, "quarterly_income_statement", "quarterly")
    )
    assert sorted((r.period, r.value) for r in long.collect()) == [("annual", "4"), ("quarterly", "1"), ("quarterly", "1.5")]


def test_pretty_documents(spark, tmp_path):
    from quarterdeck.sources.documents import write_documents

    df = spark.createDataFrame([("A", "p")], "ticker string, source string")
    write_documents(df.coalesce(1), str(tmp_path / "pretty"), pretty=True)
    text = "".join(p.read_text() for p in (tmp_path / "pretty").glob("part-*"))
    assert '"ticker" : "A"' in text and text.count("\n") > 2
    assert read_documents(spark, str(tmp_path / "pretty"), "map", multiline=True).first().ticker == "A"


def test_extra_provider_sections(spark, tmp_path):
    docs = [{"ticker": "A", "ratios": [{"date": "2024-12-31", "calendarYear": "2024", "currentRatio": "1.5"}]}]
    p = tmp_path / "extra.json"
    p.write_text("\n".join(json.dumps(d) for d in docs))
    d = read_documents(spark, str(p), "records", extra_sections=["ratios"])
    rows = records_long(d, "ratios").collect()
    assert [(r.line_item, r.value) for r in rows] == [("currentRatio", "1.5")]


def test_missing_ticker_becomes_na(spark):
    from quarterdeck.operators import with_ticker

    df = spark.createDataFrame([(None, 1.0), ("A", 2.0)], "ticker string, x double")
    assert sorted(r.ticker for r in with_ticker(df).collect()) == ["A", "N/A"]
    assert with_ticker(df.select("x", "ticker")).columns == ["ticker", "x"]


def test_compare_file_stats(spark, tmp_path):
    from quarterdeck.sources.files import compare_file_stats

    for side, sizes in (("local", (10, 20)), ("remote", (10,))):
        (tmp_path / side).mkdir()
        for i, n in enumerate(sizes):
            (tmp_path / side / f"f{i}.csv").write_bytes(b"x" * n)
    r = compare_file_stats(
        file_manifest(spark, str(tmp_path / "local")), file_manifest(spark, str(tmp_path / "remote"))
    ).first()
    assert (r.local_files, r.uploaded_files) == (2, 1)
