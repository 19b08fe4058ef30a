"""DataFrame operators: reshaping, derived tables, reports, ranking and checks."""

from quarterdeck.operators.metrics import (
    balance_sheet_trends,
    company_snapshot_latest,
    financial_ratios,
    income_statement_trends,
    yoy_comparison,
)
from quarterdeck.operators.quality import data_quality_checks, duplicate_keys, load_check, table_counts, table_summary
from quarterdeck.operators.ranking import global_row_number, latest_per_key, previous_and_rank, report_rank
from quarterdeck.operators.reshape import (
    coerce_types,
    company_profile,
    filter_years,
    filter_years_records,
    records_long,
    statement_long,
    statement_wide,
    union_by_name,
    wide_to_long,
    with_ticker,
)

__all__ = [
    "balance_sheet_trends",
    "coerce_types",
    "company_profile",
    "company_snapshot_latest",
    "data_quality_checks",
    "duplicate_keys",
    "filter_years",
    "filter_years_records",
    "financial_ratios",
    "global_row_number",
    "income_statement_trends",
    "latest_per_key",
    "load_check",
    "previous_and_rank",
    "records_long",
    "report_rank",
    "statement_long",
    "statement_wide",
    "table_counts",
    "table_summary",
    "union_by_name",
    "wide_to_long",
    "with_ticker",
    "yoy_comparison",
]
