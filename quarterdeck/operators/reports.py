"""Analyst reports Q1-Q15 over the statement and derived tables.

Every report takes ``as_of`` (default ``current_date()``) instead of reading "now"
itself, so results are reproducible. Reports end with their ``ORDER BY``; the
one ``LIMIT`` report plans as ``TakeOrderedAndProject`` (per-task top-k, no
global sort).

Where the warehouse text referred to columns its source table does not have
(liquidity, leverage, efficiency, capital structure, key metrics, peer
comparison), the report is built from the tables that do hold them; the README
lists each repair.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterdeck.functions.arith import pct, safe_divide, strict_greatest, strict_least
from quarterdeck.functions.dates import AsOf, lookback
from quarterdeck.operators.ranking import global_row_number, latest_per_key

def _newest_first() -> list:
    return [F.col("ticker").asc(), F.col("report_date").desc()]


def _order(df: DataFrame, ordered: bool, *cols) -> DataFrame:
    """The report's ORDER BY. ``ordered=False`` skips it for results that go into a
    table (where row order has no meaning) and saves a global sort."""
    return df.orderBy(*cols) if ordered else df


def key_metrics(snapshot: DataFrame, ordered: bool = True) -> DataFrame:
    """Q1: latest key figures per company, largest revenue first."""
    return snapshot.select(
        "ticker",
        F.col("latest_report_date").alias("report_date"),
        "Total_Revenue",
        "Net_Income",
        "EBITDA",
        "Diluted_EPS",
        "Total_Assets",
        "Stockholders_Equity",
        "Total_Debt",
    ).transform(lambda d: _order(d, ordered, F.col("Total_Revenue").desc()))


def margin_trends(income_trends: DataFrame, as_of: AsOf = None, years: int = 3, ordered: bool = True) -> DataFrame:
    """Q2: margin trends over the last ``years`` years."""
    return (
        income_trends.where(lookback("report_date", years, as_of))
        .select(
            "ticker",
            "report_date",
            "gross_profit_margin_pct",
            "operating_margin_pct",
            pct("Net_Income", "Total_Revenue").alias("net_margin_pct"),
            "Operating_Income",
            "Net_Income",
        )
        .transform(lambda d: _order(d, ordered, *_newest_first()))
    )


def liquidity(balance: DataFrame, as_of: AsOf = None, years: int = 2, ordered: bool = True) -> DataFrame:
    """Q3: liquidity ratios over the last ``years`` years.

    The trend table lacks ``current_ratio``/``quick_ratio``; they are computed from
    the balance sheet rows the trend table is made of (``Total_Assets`` not NULL).
    """
    return (
        balance.where(F.col("Total_Assets").isNotNull() & lookback("report_date", years, as_of))
        .select(
            "ticker",
            "report_date",
            safe_divide("Current_Assets", "Current_Liabilities").alias("current_ratio"),
            safe_divide(F.col("Current_Assets") - F.col("Inventory"), F.col("Current_Liabilities")).alias("quick_ratio"),
            safe_divide("Cash_And_Cash_Equivalents", "Current_Liabilities").alias("cash_ratio"),
            "Working_Capital",
            "Current_Assets",
            "Current_Liabilities",
        )
        .transform(lambda d: _order(d, ordered, *_newest_first()))
    )


def _ratios_with(income: DataFrame, balance: DataFrame, keep_income, keep_balance):
    from quarterdeck.operators.metrics import financial_ratios

    return financial_ratios(income, balance, stamp=False, keep_income=keep_income, keep_balance=keep_balance)


def leverage(income: DataFrame, balance: DataFrame, as_of: AsOf = None, years: int = 2, ordered: bool = True) -> DataFrame:
    """Q4: leverage and solvency. Raw columns ride along the ratio join."""
    r = _ratios_with(income, balance, ("EBIT", "Interest_Expense"), ("Total_Debt", "Total_Assets", "Stockholders_Equity"))
    return (
        r.where(lookback("report_date", years, as_of))
        .select(
            "ticker",
            "report_date",
            "debt_to_equity",
            "debt_to_assets",
            "interest_coverage_ratio",
            "Total_Debt",
            "Total_Assets",
            "EBIT",
            "Interest_Expense",
            "Stockholders_Equity",
        )
        .transform(lambda d: _order(d, ordered, *_newest_first()))
    )


def efficiency(income: DataFrame, balance: DataFrame, as_of: AsOf = None, years: int = 2, ordered: bool = True) -> DataFrame:
    """Q5: efficiency and profitability ratios with their raw inputs."""
    r = _ratios_with(income, balance, ("Total_Revenue", "Net_Income"), ("Total_Assets", "Stockholders_Equity"))
    return (
        r.where(lookback("report_date", years, as_of))
        .select(
            "ticker",
            "report_date",
            "asset_turnover",
            "equity_multiplier",
            "roa",
            "roe",
            "profit_margin",
            "Total_Revenue",
            "Net_Income",
            "Total_Assets",
            "Stockholders_Equity",
        )
        .transform(lambda d: _order(d, ordered, *_newest_first()))
    )


def revenue_growth(income_trends: DataFrame, as_of: AsOf = None, years: int = 3, ordered: bool = True) -> DataFrame:
    """Q6: revenue, growth and cost of revenue share."""
    return (
        income_trends.where(lookback("report_date", years, as_of))
        .select(
            "ticker",
            "report_date",
            "Total_Revenue",
            "revenue_growth_pct",
            "Gross_Profit",
            "gross_profit_margin_pct",
            "Cost_Of_Revenue",
            pct("Cost_Of_Revenue", "Total_Revenue").alias("cogs_ratio"),
        )
        .transform(lambda d: _order(d, ordered, *_newest_first()))
    )


def opex_analysis(income_trends: DataFrame, limit: int = 100) -> DataFrame:
    """Q7: operating expense structure, first ``limit`` rows by ticker and newest report."""
    return (
        income_trends.select(
            "ticker",
            "report_date",
            "Total_Revenue",
            "Cost_Of_Revenue",
            "Research_And_Development",
            "Selling_General_And_Administration",
            "Operating_Expense",
            pct("Research_And_Development", "Total_Revenue").alias("rd_ratio"),
            pct("Selling_General_And_Administration", "Total_Revenue").alias("sga_ratio"),
        )
        .orderBy(*_newest_first())
        .limit(limit)
    )


def tax_analysis(income: DataFrame, ordered: bool = True) -> DataFrame:
    """Q8: effective tax rate (percent) and after-tax rate (fraction) where pre-tax income is positive."""
    return (
        income.where(F.col("Pretax_Income") > 0)
        .select(
            "ticker",
            "report_date",
            "Pretax_Income",
            "Tax_Provision",
            "Net_Income",
            pct("Tax_Provision", "Pretax_Income").alias("effective_tax_rate"),
            safe_divide("Net_Income", "Pretax_Income").alias("after_tax_rate"),
        )
        .transform(lambda d: _order(d, ordered, *_newest_first()))
    )


def capital_structure(balance: DataFrame, ordered: bool = True) -> DataFrame:
    """Q9: asset composition. Built from the balance sheet rows of the trend table."""
    return (
        balance.where(F.col("Total_Assets").isNotNull())
        .select(
            "ticker",
            "report_date",
            "Total_Assets",
            "Current_Assets",
            "Cash_And_Cash_Equivalents",
            "Net_PPE",
            "Goodwill_And_Other_Intangible_Assets",
            "Stockholders_Equity",
            "Total_Liabilities_Net_Minority_Interest",
            pct("Cash_And_Cash_Equivalents", "Total_Assets").alias("cash_to_assets"),
            pct("Net_PPE", "Total_Assets").alias("ppe_to_assets"),
            pct("Goodwill_And_Other_Intangible_Assets", "Total_Assets").alias("intangibles_to_assets"),
        )
        .transform(lambda d: _order(d, ordered, *_newest_first()))
    )


def shareholder_eps(income: DataFrame, ordered: bool = True) -> DataFrame:
    """Q10: earnings per share and share counts."""
    return income.select(
        "ticker",
        "report_date",
        "Net_Income",
        "Diluted_Average_Shares",
        "Diluted_EPS",
        "Basic_EPS",
        "Diluted_NI_Availto_Com_Stockholders",
    ).transform(lambda d: _order(d, ordered, *_newest_first()))


def last_8_reports(income_trends: DataFrame, n: int = 8, ordered: bool = True) -> DataFrame:
    """Q11: margins of each company's ``n`` most recent reports (``report_rank <= n``).

    With only the rank column needed from the trend table, Spark plans the rank
    filter as a ``WindowGroupLimit`` that trims each ticker before the shuffle.
    """
    return (
        income_trends.where(F.col("report_rank") <= n)
        .select(
            "ticker",
            "report_date",
            "Total_Revenue",
            "Gross_Profit",
            "Operating_Income",
            "Net_Income",
            "EBITDA",
            pct("Gross_Profit", "Total_Revenue").alias("gross_margin"),
            pct("Operating_Income", "Total_Revenue").alias("operating_margin"),
            pct("Net_Income", "Total_Revenue").alias("net_margin"),
            pct("EBITDA", "Total_Revenue").alias("ebitda_margin"),
        )
        .transform(lambda d: _order(d, ordered, *_newest_first()))
    )


def peer_comparison(income: DataFrame, balance: DataFrame, ordered: bool = True) -> DataFrame:
    """Q12: latest report per company (income and balance of the same date), ranked.

    The ranks are global ROW_NUMBERs; ``ticker`` breaks ties so that they are
    deterministic. They are computed by :func:`global_row_number` (range
    partitioned), never in a single task.
    """
    i = income.select("ticker", "report_date", "Total_Revenue", "Net_Income", "EBITDA")
    b = balance.select("ticker", "report_date", "Total_Assets", "Stockholders_Equity", "Total_Debt")
    latest = latest_per_key(i.join(b, ["ticker", "report_date"]), "ticker", "report_date")
    base = latest.select(
        "ticker",
        "Total_Revenue",
        "Net_Income",
        "EBITDA",
        "Total_Assets",
        pct("Net_Income", "Total_Revenue").alias("net_margin"),
        pct("Net_Income", "Total_Assets").alias("roa"),
        safe_divide("Total_Debt", "Stockholders_Equity").alias("debt_to_equity"),
    )
    by_rev = [F.col("Total_Revenue").desc_nulls_last(), F.col("ticker").asc_nulls_last()]
    by_ni = [F.col("Net_Income").desc_nulls_last(), F.col("ticker").asc_nulls_last()]
    ranked = global_row_number(base, by_rev, "revenue_rank")
    ranked = global_row_number(ranked, by_ni, "net_income_rank")
    return _order(ranked, ordered, "revenue_rank")


def yoy_growth(yoy: DataFrame, as_of: AsOf = None, years: int = 2, ordered: bool = True) -> DataFrame:
    """Q13: year-over-year growth of the last ``years`` years."""
    return (
        yoy.where(lookback(F.col("current_date"), years, as_of))
        .select(
            "ticker",
            F.col("current_date"),
            "current_revenue",
            "prior_revenue",
            "revenue_yoy_growth_pct",
            "current_net_income",
            "prior_net_income",
            "net_income_yoy_growth_pct",
            "current_diluted_eps",
            "prior_diluted_eps",
            "eps_yoy_growth_pct",
        )
        .transform(lambda d: _order(d, ordered, F.col("ticker").asc(), F.col("current_date").desc()))
    )


def cash_strength(income: DataFrame, balance: DataFrame, ordered: bool = True) -> DataFrame:
    """Q14: cash against debt and earnings where both cash and net income are positive."""
    b = balance.where(F.col("Cash_And_Cash_Equivalents") > 0).select(
        "ticker", "report_date", "Cash_And_Cash_Equivalents", "Total_Debt"
    )
    i = income.where(F.col("Net_Income") > 0).select("ticker", "report_date", "Net_Income")
    return (
        b.join(i, ["ticker", "report_date"])
        .select(
            "ticker",
            "report_date",
            "Net_Income",
            "Cash_And_Cash_Equivalents",
            "Total_Debt",
            safe_divide("Cash_And_Cash_Equivalents", "Total_Debt").alias("cash_to_debt_ratio"),
            safe_divide("Cash_And_Cash_Equivalents", "Net_Income").alias("cash_to_earnings_ratio"),
        )
        .transform(lambda d: _order(d, ordered, *_newest_first()))
    )


def health_score_expr() -> F.Column:
    """Composite 0-100 style score; NULL when any input ratio is NULL.

    ``roe`` is already a fraction, so its term is divided by 100 once more, and
    there is no lower clamp: both as in the warehouse query.
    """
    c = F.col
    liquidity_term = strict_least("current_ratio", 2) / 2 * 20
    leverage_term = strict_least(F.lit(1) / strict_greatest("debt_to_equity", 0.01), 1) * 20
    profit_term = strict_least(c("roe") / 100, 1) * 20
    margin_term = strict_least(c("profit_margin") / 0.2, 1) * 20
    return F.round(liquidity_term + leverage_term + profit_term + margin_term + 20, 2)


def health_score(ratios: DataFrame, as_of: AsOf = None, years: int = 1, ordered: bool = True) -> DataFrame:
    """Q15: composite financial health score of the last ``years`` years."""
    return (
        ratios.where(lookback("report_date", years, as_of))
        .select("ticker", "report_date", health_score_expr().alias("financial_health_score"))
        .transform(lambda d: _order(d, ordered, *_newest_first()))
    )


def ratios_last_year(ratios: DataFrame, as_of: AsOf = None) -> DataFrame:
    """The one-year slice of the ratio table that the docs keep as a materialised view."""
    return ratios.where(lookback("report_date", 1, as_of))
