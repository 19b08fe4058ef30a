"""Golden values for the two-company sample (hand-typed inputs; expected values
computed independently from the formulas, see FIXTURES.md section D)."""

import datetime as dt
import math

from pyspark.sql import functions as F

from quarterdeck.operators.metrics import BALANCE_RATIO_INPUTS, INCOME_RATIO_INPUTS, financial_ratios, income_statement_trends
from quarterdeck.operators.reports import health_score_expr

# ticker, date, revenue, net income, EBIT, interest, assets, equity, current assets, inventory, current liabilities, debt
ROWS = [
    ("AAPL", "2022-09-30", 394328e6, 99803e6, 119437e6, 2931e6, 352755e6, 50672e6, 135405e6, 4946e6, 153982e6, 132480e6),
    ("AAPL", "2023-09-30", 383285e6, 96995e6, 114301e6, 3933e6, 352583e6, 62146e6, 143566e6, 6331e6, 145308e6, 111088e6),
    ("AAPL", "2024-09-30", 391035e6, 93736e6, 123216e6, None, 364980e6, 56950e6, 152987e6, 7286e6, 176392e6, 106629e6),
    ("AAPL", "2025-09-30", 416161e6, 112010e6, 133050e6, None, 359241e6, 73733e6, 147957e6, 5718e6, 165631e6, 98657e6),
    ("MSFT", "2022-06-30", 198270e6, 72738e6, 85779e6, 2063e6, 364840e6, 166542e6, 169684e6, 3742e6, 95082e6, 61270e6),
    ("MSFT", "2023-06-30", 211915e6, 72361e6, 91279e6, 1968e6, 411976e6, 206223e6, 184257e6, 2500e6, 104149e6, 59965e6),
    ("MSFT", "2024-06-30", 245122e6, 88136e6, 110722e6, 2935e6, 512163e6, 268477e6, 159734e6, 1246e6, 125286e6, 67127e6),
    ("MSFT", "2025-06-30", 281724e6, 101832e6, 126012e6, 2385e6, 619003e6, 343479e6, 191131e6, 938e6, 141218e6, 60588e6),
]

# profit_margin, roa, roe, current_ratio, quick_ratio, debt_to_equity, interest_coverage, revenue growth %, score
EXPECTED = {
    ("AAPL", "2022-09-30"): (0.253096, 0.282924, 1.969589, 0.879356, 0.847235, 2.614462, 40.749574, None, 56.84),
    ("AAPL", "2023-09-30"): (0.253062, 0.275098, 1.560760, 0.988012, 0.944442, 1.787533, 29.062039, -2.800461, 61.38),
    ("AAPL", "2024-09-30"): (0.239713, 0.256825, 1.645935, 0.867313, 0.826007, 1.872327, None, 2.021994, 59.68),
    ("AAPL", "2025-09-30"): (0.269151, 0.311796, 1.519130, 0.893293, 0.858770, 1.338030, None, 6.425512, 64.18),
    ("MSFT", "2022-06-30"): (0.366863, 0.199370, 0.436755, 1.784607, 1.745251, 0.367895, 41.579738, None, 77.93),
    ("MSFT", "2023-06-30"): (0.341462, 0.175644, 0.350887, 1.769167, 1.745163, 0.290777, 46.381606, 6.882030, 77.76),
    ("MSFT", "2024-06-30"): (0.359560, 0.172086, 0.328281, 1.274955, 1.265010, 0.250029, 37.724702, 15.669962, 72.82),
    ("MSFT", "2025-06-30"): (0.361460, 0.164510, 0.296472, 1.353446, 1.346804, 0.176395, 52.835220, 14.932156, 73.59),
}


def _tables(spark):
    raw = spark.createDataFrame(
        ROWS,
        "ticker string, d string, rev double, ni double, ebit double, intexp double, ta double, se double, "
        "ca double, inv double, cl double, td double",
    ).withColumn("report_date", F.to_date("d"))
    income = raw.select(
        "ticker", "report_date",
        *[
            {"Net_Income": F.col("ni"), "Total_Revenue": F.col("rev"), "EBIT": F.col("ebit"),
             "Interest_Expense": F.col("intexp")}.get(c, F.lit(None).cast("double")).alias(c)
            for c in INCOME_RATIO_INPUTS
        ],
        F.lit(None).cast("double").alias("Gross_Profit"),
        F.lit(None).cast("double").alias("Pretax_Income"),
        F.lit(None).cast("double").alias("Tax_Provision"),
    )
    balance = raw.select(
        "ticker", "report_date",
        *[
            {"Total_Assets": F.col("ta"), "Stockholders_Equity": F.col("se"), "Current_Assets": F.col("ca"),
             "Inventory": F.col("inv"), "Current_Liabilities": F.col("cl"), "Total_Debt": F.col("td")}
            .get(c, F.lit(None).cast("double")).alias(c)
            for c in BALANCE_RATIO_INPUTS
        ],
    )
    return income, balance


def _close(a, b, tol=5e-6):
    if a is None or b is None:
        return a is None and b is None
    return math.isclose(a, b, rel_tol=tol, abs_tol=tol)


def test_golden_ratios_growth_and_score(spark):
    income, balance = _tables(spark)
    ratios = financial_ratios(income, balance, stamp=False).withColumn("score", health_score_expr())
    trends = income_statement_trends(income, stamp=False)
    got = {
        (r.ticker, r.report_date.isoformat()): r
        for r in ratios.join(trends.select("ticker", "report_date", "revenue_growth_pct"), ["ticker", "report_date"]).collect()
    }
    assert set(got) == set(EXPECTED)
    for k, exp in EXPECTED.items():
        r = got[k]
        vals = (r.profit_margin, r.roa, r.roe, r.current_ratio, r.quick_ratio, r.debt_to_equity,
                r.interest_coverage_ratio, r.revenue_growth_pct)
        for v, e in zip(vals, exp[:8]):
            assert _close(v, e), (k, vals, exp)
        assert r.score == exp[8], (k, r.score)


def test_null_input_gives_null_score(spark):
    income, balance = _tables(spark)
    balance = balance.withColumn(
        "Current_Liabilities",
        F.when(F.col("report_date") == dt.date(2024, 9, 30), None).otherwise(F.col("Current_Liabilities")),
    )
    ratios = financial_ratios(income, balance, stamp=False).withColumn("score", health_score_expr())
    row = ratios.where(F.col("report_date") == dt.date(2024, 9, 30)).collect()[0]
    assert row.current_ratio is None and row.score is None
