"""Derived analytics tables D1-D5: ratios, two trend tables, latest snapshot, year over year.

Every function takes statement DataFrames keyed by ``(ticker, report_date)`` and
returns a lazy DataFrame. ``stamp=True`` adds the audit timestamp column
(``calculated_at`` / ``snapshot_at``) the warehouse tables carry; it is the same
value for every row of one query.

Partitioning notes (checked with ``explain``):

* the trend windows partition by ``ticker``. Statement tables have one row per
  ticker and reporting period, so a window group holds at most the number of
  periods a company has reported (four a year), whatever the table size. All
  LAG columns and the growth percentages share one Window operator; the DESC
  rank adds a second one over the same exchange.
* joins are equi-joins on ``(ticker, report_date)`` or ``(ticker, year, quarter)``;
  filters that sit on one side are applied before the join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarterdeck.functions.arith import growth_pct, pct, safe_divide
from quarterdeck.operators.ranking import order_key, previous_and_rank, report_rank

KEYS = ["ticker", "report_date"]

INCOME_RATIO_INPUTS = [
    "Net_Income",
    "Total_Revenue",
    "EBITDA",
    "Operating_Income",
    "EBIT",
    "Interest_Expense",
    "Cost_Of_Revenue",
    "Operating_Expense",
    "Research_And_Development",
    "Selling_General_And_Administration",
    "Diluted_EPS",
    "Basic_EPS",
]
BALANCE_RATIO_INPUTS = [
    "Total_Assets",
    "Stockholders_Equity",
    "Current_Assets",
    "Current_Liabilities",
    "Inventory",
    "Cash_And_Cash_Equivalents",
    "Total_Debt",
]

RATIO_COLUMNS = [
    "profit_margin",
    "ebitda_margin",
    "operating_margin",
    "roa",
    "roe",
    "current_ratio",
    "quick_ratio",
    "cash_ratio",
    "debt_to_assets",
    "debt_to_equity",
    "interest_coverage_ratio",
    "asset_turnover",
    "equity_multiplier",
    "cost_of_goods_sold_ratio",
    "operating_expense_ratio",
    "rd_expense_ratio",
    "sga_expense_ratio",
]


def _stamp(df: DataFrame, name: str, stamp: bool) -> DataFrame:
    return df.withColumn(name, F.current_timestamp()) if stamp else df


def financial_ratios(
    income: DataFrame,
    balance: DataFrame,
    stamp: bool = True,
    keep_income: tuple[str, ...] = (),
    keep_balance: tuple[str, ...] = (),
) -> DataFrame:
    """D1: 17 ratios per income report that has a balance sheet of the same date.

    ``income LEFT JOIN balance ... WHERE b.Total_Assets IS NOT NULL`` rejects the
    unmatched rows, so Catalyst plans an inner join. ``keep_*`` carries extra raw
    columns through the same join (used by the leverage and efficiency reports
    instead of joining the result back to its inputs).
    """
    i_cols = list(dict.fromkeys(INCOME_RATIO_INPUTS + list(keep_income)))
    b_cols = list(dict.fromkeys(BALANCE_RATIO_INPUTS + list(keep_balance)))
    i = income.select(*KEYS, *i_cols).alias("i")
    b = balance.select(*KEYS, *b_cols).alias("b")
    j = i.join(
        b,
        (F.col("i.ticker") == F.col("b.ticker")) & (F.col("i.report_date") == F.col("b.report_date")),
        "left",
    ).where(F.col("i.Net_Income").isNotNull() & F.col("b.Total_Assets").isNotNull())

    def ic(n):
        return F.col(f"i.{n}")

    def bc(n):
        return F.col(f"b.{n}")

    out = j.select(
        ic("report_date").alias("report_date"),
        ic("ticker").alias("ticker"),
        bc("report_date").alias("balance_sheet_date"),
        safe_divide(ic("Net_Income"), ic("Total_Revenue")).alias("profit_margin"),
        safe_divide(ic("EBITDA"), ic("Total_Revenue")).alias("ebitda_margin"),
        safe_divide(ic("Operating_Income"), ic("Total_Revenue")).alias("operating_margin"),
        safe_divide(ic("Net_Income"), bc("Total_Assets")).alias("roa"),
        safe_divide(ic("Net_Income"), bc("Stockholders_Equity")).alias("roe"),
        safe_divide(bc("Current_Assets"), bc("Current_Liabilities")).alias("current_ratio"),
        safe_divide(bc("Current_Assets") - bc("Inventory"), bc("Current_Liabilities")).alias("quick_ratio"),
        safe_divide(bc("Cash_And_Cash_Equivalents"), bc("Current_Liabilities")).alias("cash_ratio"),
        safe_divide(bc("Total_Debt"), bc("Total_Assets")).alias("debt_to_assets"),
        safe_divide(bc("Total_Debt"), bc("Stockholders_Equity")).alias("debt_to_equity"),
        safe_divide(ic("EBIT"), ic("Interest_Expense")).alias("interest_coverage_ratio"),
        safe_divide(ic("Total_Revenue"), bc("Total_Assets")).alias("asset_turnover"),
        # Revenue over equity, as defined by the warehouse table (not assets over equity).
        safe_divide(ic("Total_Revenue"), bc("Stockholders_Equity")).alias("equity_multiplier"),
        safe_divide(ic("Cost_Of_Revenue"), ic("Total_Revenue")).alias("cost_of_goods_sold_ratio"),
        safe_divide(ic("Operating_Expense"), ic("Total_Revenue")).alias("operating_expense_ratio"),
        safe_divide(ic("Research_And_Development"), ic("Total_Revenue")).alias("rd_expense_ratio"),
        safe_divide(ic("Selling_General_And_Administration"), ic("Total_Revenue")).alias("sga_expense_ratio"),
        ic("Diluted_EPS").alias("Diluted_EPS"),
        ic("Basic_EPS").alias("Basic_EPS"),
        *[ic(c).alias(c) for c in keep_income if c not in ("Diluted_EPS", "Basic_EPS")],
        *[bc(c).alias(c) for c in keep_balance if c not in keep_income],
    )
    return _stamp(out, "calculated_at", stamp)


def _trend_windows(key: str = "ticker", order: str = "report_date"):
    return Window.partitionBy(key).orderBy(order)


class _Trend:
    """LAG / growth / rank columns for one trend table, by window or by position.

    ``strategy="window"``: one ``partitionBy(ticker)`` window (one exchange; a group
    holds one ticker's reports, bounded by the statement grain).
    ``strategy="range"``: :func:`previous_and_rank`, which never places a whole
    ticker in one task, for inputs whose grain is not guaranteed.
    """

    def __init__(self, df: DataFrame, lag_columns: list[str], strategy: str):
        if strategy not in ("window", "range"):
            raise ValueError(f"unknown strategy {strategy!r}")
        self.strategy = strategy
        self.w = _trend_windows()
        self.df = df if strategy == "window" else previous_and_rank(df, "ticker", "report_date", lag_columns)

    def lag(self, c: str):
        return F.lag(c).over(self.w) if self.strategy == "window" else F.col(f"_prev_{c}")

    def growth(self, c: str):
        if self.strategy == "window":
            return growth_pct(c, self.w)
        return safe_divide(F.col(c) - F.col(f"_prev_{c}"), F.col(f"_prev_{c}")) * 100

    def rank(self):
        return report_rank() if self.strategy == "window" else F.col("report_rank")


def balance_sheet_trends(balance: DataFrame, stamp: bool = True, strategy: str = "window") -> DataFrame:
    """D2: balance sheet with previous-report values, growth in percent and report rank."""
    b = balance.where(F.col("Total_Assets").isNotNull())
    t = _Trend(b, ["Total_Assets", "Total_Liabilities_Net_Minority_Interest", "Stockholders_Equity", "Working_Capital"], strategy)
    out = t.df.select(
        "ticker",
        "report_date",
        "Total_Assets",
        t.lag("Total_Assets").alias("prev_total_assets"),
        t.growth("Total_Assets").alias("total_assets_growth_pct"),
        "Total_Liabilities_Net_Minority_Interest",
        t.lag("Total_Liabilities_Net_Minority_Interest").alias("prev_total_liabilities"),
        "Stockholders_Equity",
        t.lag("Stockholders_Equity").alias("prev_stockholders_equity"),
        t.growth("Stockholders_Equity").alias("equity_growth_pct"),
        "Current_Assets",
        "Current_Liabilities",
        "Working_Capital",
        t.lag("Working_Capital").alias("prev_working_capital"),
        "Cash_And_Cash_Equivalents",
        "Total_Debt",
        "Net_Debt",
        t.rank().alias("report_rank"),
    )
    return _stamp(out, "calculated_at", stamp)


def income_statement_trends(income: DataFrame, stamp: bool = True, strategy: str = "window") -> DataFrame:
    """D3: income statement with previous-report values, margins, growth and report rank."""
    i = income.where(F.col("Total_Revenue").isNotNull())
    t = _Trend(i, ["Total_Revenue", "Net_Income", "EBITDA"], strategy)
    out = t.df.select(
        "ticker",
        "report_date",
        "Total_Revenue",
        t.lag("Total_Revenue").alias("prev_revenue"),
        t.growth("Total_Revenue").alias("revenue_growth_pct"),
        "Gross_Profit",
        pct("Gross_Profit", "Total_Revenue").alias("gross_profit_margin_pct"),
        "Operating_Income",
        pct("Operating_Income", "Total_Revenue").alias("operating_margin_pct"),
        "Net_Income",
        t.lag("Net_Income").alias("prev_net_income"),
        t.growth("Net_Income").alias("ni_growth_pct"),
        "EBITDA",
        t.lag("EBITDA").alias("prev_ebitda"),
        "Tax_Provision",
        pct("Tax_Provision", "Pretax_Income").alias("effective_tax_rate_pct"),
        "Cost_Of_Revenue",
        "Operating_Expense",
        "Research_And_Development",
        "Selling_General_And_Administration",
        "Diluted_EPS",
        "Basic_EPS",
        t.rank().alias("report_rank"),
    )
    return _stamp(out, "calculated_at", stamp)


SNAPSHOT_INCOME = ["Total_Revenue", "Gross_Profit", "Operating_Income", "EBITDA", "Net_Income", "Diluted_EPS", "Tax_Provision"]
SNAPSHOT_BALANCE = [
    "Total_Assets",
    "Current_Assets",
    "Current_Liabilities",
    "Total_Liabilities_Net_Minority_Interest",
    "Stockholders_Equity",
    "Cash_And_Cash_Equivalents",
    "Total_Debt",
    "Working_Capital",
]
SNAPSHOT_PROFILE = ["company", "industry", "sector", "country", "fullTimeEmployees"]


def company_snapshot_latest(
    income: DataFrame, balance: DataFrame, profile: DataFrame, stamp: bool = True
) -> DataFrame:
    """D4: latest income report, latest balance sheet and latest profile per ticker.

    The warehouse query ranks each table with ROW_NUMBER and full-outer-joins the
    rank-1 rows. Here the three tables are unioned into one tagged stream and
    reduced with one ``groupBy(ticker)`` of three ``max_by`` aggregates: one
    exchange instead of three window shuffles plus two join shuffles, and a hot
    ticker is combined map-side. ``latest_report_date`` is the income date when
    there is one, else the balance date, else the profile date (not the maximum).
    The latest income and balance rows may therefore have different dates.
    NULL tickers are not matched across tables, as with the join form.
    """

    parts = {"i": (income, SNAPSHOT_INCOME), "b": (balance, SNAPSHOT_BALANCE), "c": (profile, SNAPSHOT_PROFILE)}
    payloads = {t: F.struct(F.col("report_date"), *[F.col(n) for n in cols]) for t, (_, cols) in parts.items()}
    types = {t: df.select(payloads[t].alias(t)).schema[t].dataType for t, (df, _) in parts.items()}

    def branch(tag: str) -> DataFrame:
        df = parts[tag][0]
        slots = [
            (payloads[t] if t == tag else F.lit(None).cast(types[t])).alias(t) for t in ("i", "b", "c")
        ]
        return df.select("ticker", F.lit(tag).alias("_src"), F.col("report_date").alias("_d"), *slots)

    stream = branch("i").unionByName(branch("b")).unionByName(branch("c"))

    def latest(tag: str):
        on = F.col("_src") == tag
        return F.max_by(F.when(on, F.col(tag)), F.when(on, order_key("_d", F.col(tag)))).alias(tag)

    null_split = F.when(F.col("ticker").isNull(), F.col("_src")).alias("_null_src")
    g = stream.groupBy("ticker", null_split).agg(latest("i"), latest("b"), latest("c"))

    def ic(n):
        return F.col(f"i.{n}")

    def bc(n):
        return F.col(f"b.{n}")

    out = g.select(
        F.col("ticker"),
        F.coalesce(ic("report_date"), bc("report_date"), F.col("c.report_date")).alias("latest_report_date"),
        *[F.col(f"c.{n}").alias(n) for n in SNAPSHOT_PROFILE],
        *[ic(n).alias(n) for n in SNAPSHOT_INCOME],
        *[bc(n).alias(n) for n in SNAPSHOT_BALANCE],
        pct(ic("Net_Income"), ic("Total_Revenue")).alias("net_profit_margin_pct"),
        pct(ic("EBITDA"), ic("Total_Revenue")).alias("ebitda_margin_pct"),
        safe_divide(bc("Current_Assets"), bc("Current_Liabilities")).alias("current_ratio"),
        safe_divide(bc("Total_Debt"), bc("Stockholders_Equity")).alias("debt_to_equity"),
        # Named *_pct in the warehouse table but not multiplied by 100 there either.
        safe_divide(ic("Net_Income"), bc("Total_Assets")).alias("roa_pct"),
        safe_divide(ic("Net_Income"), bc("Stockholders_Equity")).alias("roe_pct"),
    )
    return _stamp(out, "snapshot_at", stamp)


def yoy_comparison(income: DataFrame, stamp: bool = True) -> DataFrame:
    """D5: each report against the report of the same calendar quarter one year earlier.

    An equi-join on ``(ticker, year, quarter)`` with ``year(prior) + 1`` as the key of
    the prior side. Both revenue filters are applied before the join. Several
    reports in one quarter match each other (fan-out), as in the warehouse query.
    ``income`` is read by both sides: pass a stored or checkpointed table, not an
    expensive plan (its two branches carry different pushed filters and would not
    share an exchange).
    """
    base = income.where(F.col("Total_Revenue").isNotNull()).select(
        "ticker", "report_date", "Total_Revenue", "Gross_Profit", "Net_Income", "EBITDA", "Diluted_EPS"
    )
    cur = base.select(
        F.col("ticker").alias("_t"),
        F.year("report_date").alias("_y"),
        F.quarter("report_date").alias("_q"),
        *[F.col(c).alias(f"c_{c}") for c in base.columns],
    )
    pri = base.select(
        F.col("ticker").alias("_t"),
        (F.year("report_date") + 1).alias("_y"),
        F.quarter("report_date").alias("_q"),
        *[F.col(c).alias(f"p_{c}") for c in base.columns if c != "ticker"],
    )
    j = cur.join(pri, ["_t", "_y", "_q"], "inner")

    def cc(n):
        return F.col(f"c_{n}")

    def pc(n):
        return F.col(f"p_{n}")

    def growth(n):
        return (safe_divide(cc(n) - pc(n), pc(n)) * 100)

    out = j.select(
        cc("ticker").alias("ticker"),
        cc("report_date").alias("current_date"),
        pc("report_date").alias("prior_year_date"),
        cc("Total_Revenue").alias("current_revenue"),
        pc("Total_Revenue").alias("prior_revenue"),
        growth("Total_Revenue").alias("revenue_yoy_growth_pct"),
        cc("Gross_Profit").alias("current_gross_profit"),
        pc("Gross_Profit").alias("prior_gross_profit"),
        growth("Gross_Profit").alias("gross_profit_yoy_growth_pct"),
        cc("Net_Income").alias("current_net_income"),
        pc("Net_Income").alias("prior_net_income"),
        growth("Net_Income").alias("net_income_yoy_growth_pct"),
        cc("EBITDA").alias("current_ebitda"),
        pc("EBITDA").alias("prior_ebitda"),
        cc("Diluted_EPS").alias("current_diluted_eps"),
        pc("Diluted_EPS").alias("prior_diluted_eps"),
        growth("Diluted_EPS").alias("eps_yoy_growth_pct"),
    )
    return _stamp(out, "calculated_at", stamp)
