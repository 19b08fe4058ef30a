"""Checks merged from monthly sketches against exact counts, and what an append reads."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarterdeck.operators.history import QUANTILES, add_period_sketches, checks_from_sketches, period_sketches
from quarterdeck.operators.quality import data_quality_checks
from quarterdeck.plans.releases import TableStore
from quarterdeck.sources.testdata import statement_tables


@pytest.fixture(scope="module")
def income(spark, sf_small):
    many = F.explode(F.sequence(F.lit(0), F.lit(9)))  # ten companies out of each, each with its own revenue
    inc = statement_tables(spark, sf_small)["income"].withColumn("i", many)
    return inc.select(F.concat_ws("-", "ticker", "i").alias("ticker"), "report_date", (F.col("Total_Revenue") * (1 + F.col("i") / 7)).alias("Total_Revenue")).cache()


def test_merged_sketches_are_near_the_exact_checks(spark, income, tmp_path):
    store = TableStore(spark, str(tmp_path / "store"))
    parts = [F.col("report_date") < "1995-01-01", (F.col("report_date") >= "1995-01-01") & (F.col("report_date") < "1999-01-01"), F.col("report_date") >= "1999-01-01"]
    for part in parts:
        before = store.release().tables.get("quality_sketches")
        with store.draft() as draft:
            add_period_sketches(draft, {"income": (income.where(part), "Total_Revenue")})
            draft.commit()
        after = store.release().tables["quality_sketches"]
        assert before is None or after.pieces[: len(before.pieces)] == before.pieces  # stored sketches are not written again
        scanned = [line for line in draft.store.read("quality_sketches").inputFiles()]
        assert len(scanned) == len(after.pieces)
    got = checks_from_sketches(store.read("quality_sketches")).first()
    exact = data_quality_checks({"income": income}, stamp=False).first()
    assert (got.row_count, got.min_date, got.max_date) == (exact.row_count, exact.min_date, exact.max_date)
    assert abs(got.distinct_tickers / exact.distinct_tickers - 1) < 0.05
    values = np.sort([r.Total_Revenue for r in income.where("Total_Revenue IS NOT NULL").collect()])
    assert got.measured == len(values)
    for q in QUANTILES:
        assert abs(np.searchsorted(values, got[f"measure_p{int(q * 100)}"]) / len(values) - q) < 0.03


def test_months_and_odd_rows(spark):
    rows = spark.createDataFrame([("A", "2020-01-05", 1.0), ("A", "2020-01-31", None), ("B", "2020-02-01", 3.0), (None, None, None)], "ticker string, d string, x double")
    rows = rows.withColumn("report_date", F.col("d").cast("date"))
    by_month = {str(r.period): r for r in checks_from_sketches(period_sketches(rows, "t", "x"), ["period"]).collect()}
    assert [(m, by_month[m].row_count, by_month[m].distinct_tickers, by_month[m].measured) for m in ("2020-01-01", "2020-02-01", "None")] == [
        ("2020-01-01", 2, 1, 1),
        ("2020-02-01", 1, 1, 1),
        ("None", 1, 0, 0),
    ]
    assert by_month["None"].measure_p50 is None and by_month["2020-02-01"].measure_p50 == 3.0
    whole = checks_from_sketches(period_sketches(rows, "t", "x")).first()
    assert (whole.row_count, whole.distinct_tickers, whole.measured) == (4, 2, 2)
    assert checks_from_sketches(period_sketches(rows.limit(0), "t", "x")).count() == 0
