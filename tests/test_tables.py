"""Loaders, sinks and the staged build against a throw-away warehouse."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from quarterdeck.plans.build import StageError, build_all, list_tables, table_info
from quarterdeck.plans.tables import copy_tables, load_append, load_replace, write_partitioned
from quarterdeck.sources.delimited import write_delimited
from quarterdeck.sources.testdata import statement_tables


def test_replace_keeps_one_backup(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS t_replace")
    name = "t_replace.income"
    for i in range(3):  # a third run must not fail on the existing backup
        backup = load_replace(spark, spark.createDataFrame([(i,)], "v int"), name)
    assert backup == f"{name}_backup"
    assert spark.table(name).collect()[0].v == 2
    assert spark.table(backup).collect()[0].v == 1
    failing = spark.createDataFrame([(9,)], "v int").withColumn("v", F.raise_error(F.lit("lost")).cast("int"))
    with pytest.raises(Exception):
        load_replace(spark, failing, name)
    assert spark.table(name).collect()[0].v == 2 and spark.table(backup).collect()[0].v == 1


def test_append_aligns_by_name(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS t_append")
    name = "t_append.balance"
    load_append(spark, spark.createDataFrame([("A", 1.0, 2.0)], "ticker string, x double, y double"), name)
    load_append(spark, spark.createDataFrame([(20.0, "B")], "y double, ticker string"), name)
    rows = {r.ticker: (r.x, r.y) for r in spark.table(name).collect()}
    assert rows == {"A": (1.0, 2.0), "B": (None, 20.0)}
    with pytest.raises(ValueError):
        load_append(spark, spark.createDataFrame([("C", 1)], "ticker string, unknown int"), name)


def test_partitioned_layout_prunes_years(spark, tmp_path):
    df = spark.createDataFrame(
        [("A", dt.date(1999, 3, 31), 1.0), ("B", dt.date(2000, 6, 30), 2.0), ("A", dt.date(2001, 9, 30), 3.0)],
        "ticker string, report_date date, v double",
    )
    write_partitioned(df, str(tmp_path / "p"))
    back = spark.read.parquet(str(tmp_path / "p")).where(F.col("report_year") >= 2000)
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and sorted(r.v for r in back.collect()) == [2.0, 3.0]


def test_copy_tables_reports_each_table(spark, tmp_path):
    ok = spark.createDataFrame([(1,)], "v int")
    bad = spark.createDataFrame([(1,)], "v int").withColumn("v", F.raise_error(F.lit("boom")))
    res = {r.name: (r.status, r.rows) for r in copy_tables(spark, {"ok": ok, "bad": bad}, str(tmp_path / "c")).collect()}
    assert res["ok"] == ("success", 1) and res["bad"][0] == "failed"


def test_build_all_from_statement_files(spark, sf_small, tmp_path):
    st = statement_tables(spark, sf_small)
    src = tmp_path / "raw"
    names = {"balance_sheet": "balance", "income_statement": "income", "cash_flow_statement": "cash_flow"}
    for file_stem, key in names.items():
        write_delimited(st[key].coalesce(1), str(src / f"{file_stem}.csv"))
    profile = st["company_info"].withColumnRenamed("company", "displayName")
    write_delimited(profile.coalesce(1), str(src / "company_info.csv"))
    summary = {r.table_name: r.rows for r in build_all(spark, str(src), "t_build", bucket_count=4).collect()}
    assert summary["t_build.income_statement"] == st["income"].count()
    assert summary["t_build.financial_ratios"] > 0 and summary["t_build.company_snapshot_latest"] > 0
    assert {r.table_name for r in list_tables(spark, "t_build").collect()} >= {"financial_ratios", "yoy_comparison"}
    prof = spark.table("t_build.company_info")
    assert prof.where(F.col("company").isNotNull()).count() == prof.count()
    info = table_info(spark, "t_build.balance_sheet")
    assert info["rows"] == st["balance"].count() and "Total_Assets" in info["schema"]
    assert "bytes" in (info["statistics"] or "")
    from quarterdeck.cli import REPORTS, main, run_report

    for name in REPORTS:
        assert run_report(spark, name, "t_build", "2001-12-31").columns
    assert run_report(spark, "health_score", "t_build", "2001-12-31").count() > 0
    assert main(["validate", "--src", str(src)], spark=spark) == 0
    assert main(["report", "cash_strength", "--db", "t_build", "--out", str(tmp_path / "cs")], spark=spark) == 0
    assert spark.read.parquet(str(tmp_path / "cs")).count() > 0
    # bucketed by ticker: the trend window reads the stored table without an exchange on ticker
    from quarterdeck.operators.metrics import balance_sheet_trends

    plan = balance_sheet_trends(spark.table("t_build.balance_sheet"), stamp=False)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning(ticker" not in plan
    from quarterdeck.operators.metrics import financial_ratios, yoy_comparison

    inc, bal = spark.table("t_build.income_statement"), spark.table("t_build.balance_sheet")
    for df in (financial_ratios(inc, bal, stamp=False), yoy_comparison(inc, stamp=False)):
        assert "Exchange hashpartitioning" not in df._jdf.queryExecution().executedPlan().toString()
    from quarterdeck.operators.reports import health_score

    stored_plan = health_score(spark.table("t_build.financial_ratios"), as_of="2001-12-31")._jdf.queryExecution()
    scan = [ln for ln in stored_plan.executedPlan().toString().splitlines() if "FileScan parquet" in ln][0]
    assert "PushedFilters: [IsNotNull(report_date), GreaterThanOrEqual(report_date," in scan
    with pytest.raises(StageError):
        build_all(spark, str(tmp_path / "missing"), "t_build_missing")


def test_quality_helpers(spark):
    from quarterdeck.operators.quality import data_quality_checks, load_check

    df = spark.createDataFrame(
        [("A", dt.date(2020, 3, 31)), ("A", dt.date(2020, 6, 30)), ("B", dt.date(2021, 3, 31))], "ticker string, report_date date"
    )
    exact = data_quality_checks({"t": df}, stamp=False).collect()[0]
    approx = data_quality_checks({"t": df}, approx=True).collect()[0]
    assert (exact.row_count, exact.distinct_tickers, exact.min_date, exact.max_date) == (3, 2, dt.date(2020, 3, 31), dt.date(2021, 3, 31))
    assert approx.distinct_tickers == 2 and approx.check_time is not None
    lc = load_check(df.limit(1), df, "t").collect()[0]
    assert (lc.inserted_rows, lc.total_rows) == (1, 3)


def test_grain_check_rejects_duplicates(spark):
    from quarterdeck.plans.build import check_grain

    ok = spark.createDataFrame([("A", dt.date(2020, 3, 31))], "ticker string, report_date date")
    check_grain(spark, {"ok": ok})
    with pytest.raises(StageError):
        check_grain(spark, {"dup": ok.unionByName(ok)})
