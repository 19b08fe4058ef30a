
from quarterdeck.operators.metrics import (
    RATIO_COLUMNS,
    balance_sheet_trends,
    company_snapshot_latest,
    financial_ratios,
    income_statement_trends,
    yoy_comparison,
)
from quarterdeck.sources.testdata import statement_tables

D1 = ["report_date", "ticker", "balance_sheet_date", *RATIO_COLUMNS, "Diluted_EPS", "Basic_EPS", "calculated_at"]
D2 = (
    "ticker report_date Total_Assets prev_total_assets total_assets_growth_pct Total_Liabilities_Net_Minority_Interest "
    "prev_total_liabilities Stockholders_Equity prev_stockholders_equity equity_growth_pct Current_Assets "
    "Current_Liabilities Working_Capital prev_working_capital Cash_And_Cash_Equivalents Total_Debt Net_Debt "
    "report_rank calculated_at"
).split()
D3 = (
    "ticker report_date Total_Revenue prev_revenue revenue_growth_pct Gross_Profit gross_profit_margin_pct "
    "Operating_Income operating_margin_pct Net_Income prev_net_income ni_growth_pct EBITDA prev_ebitda Tax_Provision "
    "effective_tax_rate_pct Cost_Of_Revenue Operating_Expense Research_And_Development "
    "Selling_General_And_Administration Diluted_EPS Basic_EPS report_rank calculated_at"
).split()
D4 = (
    "ticker latest_report_date company industry sector country fullTimeEmployees Total_Revenue Gross_Profit "
    "Operating_Income EBITDA Net_Income Diluted_EPS Tax_Provision Total_Assets Current_Assets Current_Liabilities "
    "Total_Liabilities_Net_Minority_Interest Stockholders_Equity Cash_And_Cash_Equivalents Total_Debt Working_Capital "
    "net_profit_margin_pct ebitda_margin_pct current_ratio debt_to_equity roa_pct roe_pct snapshot_at"
).split()
D5 = (
    "ticker current_date prior_year_date current_revenue prior_revenue revenue_yoy_growth_pct current_gross_profit "
    "prior_gross_profit gross_profit_yoy_growth_pct current_net_income prior_net_income net_income_yoy_growth_pct "
    "current_ebitda prior_ebitda current_diluted_eps prior_diluted_eps eps_yoy_growth_pct calculated_at"
).split()


def test_derived_table_contracts(spark, sf_small):
    t = statement_tables(spark, sf_small)
    assert len(RATIO_COLUMNS) == 17
    assert financial_ratios(t["income"], t["balance"]).columns == D1
    assert balance_sheet_trends(t["balance"]).columns == D2
    assert balance_sheet_trends(t["balance"], strategy="range").columns == D2
    assert income_statement_trends(t["income"]).columns == D3
    assert company_snapshot_latest(t["income"], t["balance"], t["company_info"]).columns == D4
    assert yoy_comparison(t["income"]).columns == D5
    stamped = financial_ratios(t["income"], t["balance"]).select("calculated_at").first()[0]
    assert stamped is not None


def test_managed_table_contracts(spark, sf_small):
    from quarterdeck.plans.managed import managed_balance, managed_cash_flow, managed_income, managed_profile
    from quarterdeck.schemas import MANAGED_BALANCE_COLUMNS, MANAGED_INCOME_COLUMNS

    t = statement_tables(spark, sf_small)
    bal = managed_balance(t["balance"])
    assert bal.columns == ["report_date", "ticker", *MANAGED_BALANCE_COLUMNS, "loaded_at"] and len(bal.columns) == 88
    inc = managed_income(t["income"])
    assert len(inc.columns) == 50 and dict(inc.dtypes)["Basic_Average_Shares"] == "bigint"
    prof = managed_profile(t["company_info"])
    assert len(prof.columns) == 29 and prof.columns[2:4] == ["company", "address"] and dict(prof.dtypes)["zip"] == "string"
    cf = managed_cash_flow(t["cash_flow"])
    assert cf.columns[:2] == ["report_date", "ticker"] and cf.columns[-1] == "loaded_at"
