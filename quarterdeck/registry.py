"""Every query the library registers: ``name -> (spark, sf_dir) -> DataFrame``.

Each callable builds its inputs from the given test tables (statement tables are
derived from ``lineitem``/``supplier``/``nation``/``region``), so its work grows
with the data. Audit timestamps are left out so that results are comparable.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarterdeck.functions.coerce import try_double
from quarterdeck.operators import metrics as M
from quarterdeck.operators import quality as Q
from quarterdeck.operators import reports as R
from quarterdeck.operators import reshape as RS
from quarterdeck.oracle import AS_OF
from quarterdeck.plans import managed as MG
from quarterdeck.operators.ranking import latest_per_key
from quarterdeck.plans.export import export_documents
from quarterdeck.plans.storage import remove_on_exit, staging_path
from quarterdeck.plans.tables import load_directory, write_partitioned
from quarterdeck.registry_stored import STORED_QUERIES
from quarterdeck.schemas import FULL_PROFILE_ATTRIBUTES
from quarterdeck.sources import delimited as DL
from quarterdeck.sources import documents as DOC
from quarterdeck.sources import files as FL
from quarterdeck.sources.testdata import TABLES, read_table, statement_tables

QueryFn = Callable[[SparkSession, str], DataFrame]


def _st(spark: SparkSession, sf_dir: str, shared: bool = False, years: int | None = None) -> dict[str, DataFrame]:
    """Statement tables; ``years`` bounds the scan for a report that looks back so far from ``AS_OF``."""
    day = _dt.date.fromisoformat(AS_OF)
    since = None if years is None else day.replace(year=day.year - years)  # AS_OF is no February 29
    return statement_tables(spark, sf_dir, shared, since)


def q_financial_ratios(spark, sf_dir, years=None):
    t = _st(spark, sf_dir, years=years)
    return M.financial_ratios(t["income"], t["balance"], stamp=False)


def q_balance_sheet_trends(spark, sf_dir):
    return M.balance_sheet_trends(_st(spark, sf_dir)["balance"], stamp=False)


def q_income_statement_trends(spark, sf_dir):
    return M.income_statement_trends(_st(spark, sf_dir)["income"], stamp=False)


def q_company_snapshot_latest(spark, sf_dir):
    t = _st(spark, sf_dir)
    return M.company_snapshot_latest(t["income"], t["balance"], t["company_info"], stamp=False)


def q_yoy_comparison(spark, sf_dir, years=None):
    # The self join reads income twice: share one staged table.
    return M.yoy_comparison(_st(spark, sf_dir, shared=True, years=years)["income"], stamp=False)


def q_key_metrics(spark, sf_dir):
    return R.key_metrics(q_company_snapshot_latest(spark, sf_dir))


def q_margin_trends(spark, sf_dir):
    return R.margin_trends(q_income_statement_trends(spark, sf_dir), as_of=AS_OF)


def q_liquidity(spark, sf_dir):
    return R.liquidity(_st(spark, sf_dir, years=2)["balance"], as_of=AS_OF)


def q_leverage(spark, sf_dir):
    t = _st(spark, sf_dir, years=2)
    return R.leverage(t["income"], t["balance"], as_of=AS_OF)


def q_efficiency(spark, sf_dir):
    t = _st(spark, sf_dir, years=2)
    return R.efficiency(t["income"], t["balance"], as_of=AS_OF)


def q_revenue_growth(spark, sf_dir):
    return R.revenue_growth(q_income_statement_trends(spark, sf_dir), as_of=AS_OF)


def q_opex_analysis(spark, sf_dir):
    return R.opex_analysis(q_income_statement_trends(spark, sf_dir))


def q_tax_analysis(spark, sf_dir):
    return R.tax_analysis(_st(spark, sf_dir)["income"])


def q_capital_structure(spark, sf_dir):
    return R.capital_structure(_st(spark, sf_dir)["balance"])


def q_shareholder_eps(spark, sf_dir):
    return R.shareholder_eps(_st(spark, sf_dir)["income"])


def q_last_8_reports(spark, sf_dir):
    return R.last_8_reports(q_income_statement_trends(spark, sf_dir))


def q_peer_comparison(spark, sf_dir):
    t = _st(spark, sf_dir)
    return R.peer_comparison(t["income"], t["balance"])


def q_yoy_growth(spark, sf_dir):
    return R.yoy_growth(q_yoy_comparison(spark, sf_dir, years=4), as_of=AS_OF)


def q_cash_strength(spark, sf_dir):
    t = _st(spark, sf_dir)
    return R.cash_strength(t["income"], t["balance"])


def q_health_score(spark, sf_dir):
    return R.health_score(q_financial_ratios(spark, sf_dir, years=1), as_of=AS_OF)


QUERIES: dict[str, QueryFn] = {
    "financial_ratios": q_financial_ratios,
    "balance_sheet_trends": q_balance_sheet_trends,
    "income_statement_trends": q_income_statement_trends,
    "company_snapshot_latest": q_company_snapshot_latest,
    "yoy_comparison": q_yoy_comparison,
    "key_metrics": q_key_metrics,
    "margin_trends": q_margin_trends,
    "liquidity": q_liquidity,
    "leverage": q_leverage,
    "efficiency": q_efficiency,
    "revenue_growth": q_revenue_growth,
    "opex_analysis": q_opex_analysis,
    "tax_analysis": q_tax_analysis,
    "capital_structure": q_capital_structure,
    "shareholder_eps": q_shareholder_eps,
    "last_8_reports": q_last_8_reports,
    "peer_comparison": q_peer_comparison,
    "yoy_growth": q_yoy_growth,
    "cash_strength": q_cash_strength,
    "health_score": q_health_score,
}


# ---------------------------------------------------------------------------
# Sources, reshaping, managed layer and checks. Round trips write to a fresh
# directory under the shared checkpoint root, then read back with our readers.
# ---------------------------------------------------------------------------
PROFILE_DOC_ATTRIBUTES = {
    "displayName": "company",
    "country": "country",
    "sector": "sector",
    "industry": "industry",
    "fullTimeEmployees": "fullTimeEmployees",
    "companyOfficers": "companyOfficers",
}
PROFILE_DOC_ATTRIBUTES_PLAIN = {k: v for k, v in PROFILE_DOC_ATTRIBUTES.items() if k != "companyOfficers"}
PROFILE_FIXTURE_ATTRIBUTES = [
    ("displayName", "string", "company"),
    ("country", "string", "country"),
    ("sector", "string", "sector"),
    ("industry", "string", "industry"),
    ("fullTimeEmployees", "bigint", "fullTimeEmployees"),
]
EVEN = ("0", "2", "4", "6", "8")
FILTER_YEARS = (1996, 1998, 2000)
FILTER_RECORD_YEARS = (1995, 1999, 2001)


def _items(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c not in ("ticker", "report_date")]


def _sections(t: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {"income_statement": t["income"], "balance_sheet": t["balance"], "cash_flow_statement": t["cash_flow"]}


def _scratch(spark: SparkSession, label: str, write: Callable[[str], None]) -> str:
    """A path of this query's own that ``write`` fills; it goes when the application ends."""
    path = staging_path(spark, label)
    write(path)
    remove_on_exit(spark, path)
    return path


def _map_docs(spark: SparkSession, statements: dict[str, DataFrame], profile: DataFrame | None = None, attributes=None) -> DataFrame:
    docs = DOC.map_documents(statements, profile, attributes, split_years=bool(statements))
    return DOC.read_documents(spark, _scratch(spark, "map-docs", lambda p: DOC.write_documents(docs, p)), "map")


def _record_docs(spark: SparkSession, statements: dict[str, DataFrame]) -> DataFrame:
    docs = DOC.record_documents(statements, split_years=True)
    return DOC.read_documents(spark, _scratch(spark, "record-docs", lambda p: DOC.write_documents(docs, p)), "records")


def q_scan_nested_json(spark, sf_dir):
    t = _st(spark, sf_dir)
    long = RS.statement_long(_map_docs(spark, _sections(t)), "income_statement")
    return RS.statement_wide(long, _items(t["income"]), "income_statement")


def q_scan_record_json(spark, sf_dir):
    t = _st(spark, sf_dir)
    long = RS.records_long(_record_docs(spark, _sections(t)), "balance_sheet")
    return RS.statement_wide(long, _items(t["balance"]), "balance_sheet")


def q_filter_years(spark, sf_dir):
    t = _st(spark, sf_dir)
    kept = RS.filter_years(_map_docs(spark, _sections(t)), FILTER_YEARS, ["income_statement", "balance_sheet", "cash_flow_statement"])
    return RS.statement_wide(RS.statement_long(kept, "cash_flow_statement"), _items(t["cash_flow"]), "cash_flow_statement")


def q_filter_years_records(spark, sf_dir):
    t = _st(spark, sf_dir)
    docs = _record_docs(spark, _sections(t))
    kept = RS.filter_years_records(docs, FILTER_RECORD_YEARS, ["income_statement", "balance_sheet", "cash_flow_statement"])
    return RS.statement_wide(RS.records_long(kept, "income_statement"), _items(t["income"]), "income_statement")


def q_company_profile(spark, sf_dir):
    profile = _st(spark, sf_dir)["company_info"].withColumn("companyOfficers", F.lit('[{"name": "officer"}]'))
    docs = _map_docs(spark, {}, profile, PROFILE_DOC_ATTRIBUTES)
    return RS.company_profile(docs.where(F.col("company_info").isNotNull()), PROFILE_FIXTURE_ATTRIBUTES)


def q_profile_full(spark, sf_dir):
    """All 182 attributes; employee counts come as text with an empty, a decimal and an unreadable form among them."""
    n = F.col("fullTimeEmployees").cast("string")
    last = F.substring("ticker", -1, 1)
    text = F.when(last == "1", F.lit("")).when(last == "3", F.concat(n, F.lit(".0"))).when(last == "5", F.lit("many")).otherwise(n)
    profile = _st(spark, sf_dir)["company_info"].withColumn("fullTimeEmployees", text)
    docs = _map_docs(spark, {}, profile, PROFILE_DOC_ATTRIBUTES_PLAIN)
    return RS.company_profile(docs, FULL_PROFILE_ATTRIBUTES)


def q_documents_without_ticker(spark, sf_dir):
    """Documents that lack a ticker stay apart: a row per document and date, all under N/A."""
    t = _st(spark, sf_dir)
    docs = DOC.map_documents({"income_statement": t["income"]})
    lost = F.substring("ticker", -1, 1).isin(*EVEN)
    docs = docs.withColumn("ticker", F.when(~lost, F.col("ticker")))
    read = DOC.read_documents(spark, _scratch(spark, "lost-docs", lambda p: DOC.write_documents(docs, p)), "map")
    long = RS.statement_long(DOC.with_document(read), "income_statement", keep_missing=True)
    return RS.statement_wide(long, _items(t["income"]), "income_statement").drop("document")


def q_quarterly_long(spark, sf_dir):
    docs = _map_docs(spark, {"quarterly_financials": _st(spark, sf_dir)["income"]})
    long = RS.statement_long(docs, "quarterly_financials", period="quarterly")
    return long.withColumn("value", try_double("value"))


def q_profile_records(spark, sf_dir):
    """Profile records of the second provider: numbers with 17 digits, ratios and text under their own types."""
    info = _st(spark, sf_dir)["company_info"]
    n = F.col("fullTimeEmployees").cast("bigint")
    profile = info.select(
        "ticker", "report_date", n.alias("Full Time Employees"), (n + F.lit(2**53 + 1)).alias("Overall Risk"), (n * 1.5).alias("Market Cap"), F.col("sector").alias("Sector")
    )
    items = ["Full_Time_Employees", "Overall_Risk", "Market_Cap", "Sector"]
    return RS.statement_wide(RS.records_long(_record_docs(spark, {"profile": profile}), "profile"), items, "profile")


def q_section_errors(spark, sf_dir):
    """Balance sheets of every second company could not be fetched; their sections hold an error object."""
    bal = DOC.record_documents({"balance_sheet": _st(spark, sf_dir)["balance"]})
    failed = F.to_json(F.struct(F.concat(F.lit("limit reached for "), F.col("ticker")).alias("error")))
    section = F.when(F.substring("ticker", -1, 1).isin(*EVEN), failed).otherwise(F.to_json("balance_sheet"))
    line = F.concat(F.lit('{"ticker":'), F.to_json(F.array("ticker")), F.lit(',"balance_sheet":'), section, F.lit("}"))
    line = F.regexp_replace(line, r'^\{"ticker":\[("[^"]*")\]', '{"ticker":$1')
    path = _scratch(spark, "error-docs", lambda p: bal.select(line.alias("value")).write.text(p))
    docs = DOC.read_documents(spark, path, "records")
    error = F.col("section_errors")["balance_sheet"]
    return docs.select("ticker", error.alias("error"), F.coalesce(F.size("balance_sheet"), F.lit(0)).cast("bigint").alias("records"))


def q_json_counts(spark, sf_dir):
    """Records of the document files, added up per folder (one for each last digit of the tickers)."""
    docs = DOC.record_documents({"balance_sheet": _st(spark, sf_dir)["balance"]})
    docs = docs.withColumn("digit", F.substring("ticker", -1, 1))
    path = _scratch(spark, "counted-docs", lambda p: docs.write.partitionBy("digit").json(p))
    counts = FL.json_record_counts(spark, path)
    digit = F.regexp_extract("path", r"digit=([^/]*)/", 1)
    return counts.groupBy(digit.alias("digit")).agg(F.sum("records").alias("records"))


def q_export_statements(spark, sf_dir):
    """Documents to statement files in one step; the income file read back."""
    t = _st(spark, sf_dir)
    docs = _map_docs(spark, _sections(t))
    path = _scratch(spark, "exported", lambda p: export_documents(docs, p))
    back = DL.read_statement(spark, f"{path}/income_statement.csv", section="income_statement", multiline=False)
    return back.select("ticker", "report_date", *_items(t["income"]))


def _loaded(spark: SparkSession, folders: list[tuple[str, DataFrame]], mode: str, name: str) -> DataFrame:
    """Write each table as ``<name>.csv`` files and load them one after the other into one database."""
    db = "quarterdeck_" + uuid.uuid4().hex
    place = staging_path(spark, db)
    spark.sql(f"CREATE DATABASE {db} LOCATION '{place}'")
    for label, df in folders:
        root = _scratch(spark, label, lambda p, df=df: DL.write_delimited(df, f"{p}/{name}.csv"))
        load_directory(spark, root, db, mode, multiline=False)
    remove_on_exit(spark, place)
    return spark.table(f"{db}.{name}")


def q_load_replace(spark, sf_dir):
    cash = _st(spark, sf_dir)["cash_flow"]
    return _loaded(spark, [("half", cash.where(F.substring("ticker", -1, 1).isin(*EVEN))), ("whole", cash)], "replace", "cash_flow")


def q_load_append(spark, sf_dir):
    cash = _st(spark, sf_dir)["cash_flow"]
    even = F.substring("ticker", -1, 1).isin(*EVEN)
    turned = cash.select(*reversed(cash.columns))
    out = _loaded(spark, [("even", cash.where(even)), ("odd", turned.where(~even))], "append", "cash_flow")
    return out.select(*cash.columns)


def q_roundtrip_delimited(spark, sf_dir):
    """Whole document texts with quotes, tabs, line breaks and outer blanks through a delimited file."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    path = _scratch(spark, "documents-tsv", lambda p: DL.write_delimited(docs, p))
    back = DL.read_delimited_text(spark, path, multiline=True)
    return RS.coerce_types(back, {"doc_id": "bigint", "n_chars": "bigint"})


def q_append_delimited(spark, sf_dir):
    """Two appends with different column orders make one table."""
    inc = _st(spark, sf_dir)["income"]
    even = F.substring("ticker", -1, 1).isin(*EVEN)

    def write(path):
        DL.append_delimited(spark, inc.where(even), path)
        DL.append_delimited(spark, inc.where(~even).select(*reversed(inc.columns)), path)

    return DL.read_statement(spark, _scratch(spark, "appended", write), section="income_statement", multiline=False)


def q_latest_with_duplicates(spark, sf_dir):
    """The latest report per ticker where some reports occur twice with other values."""
    inc = _st(spark, sf_dir, shared=True)["income"]
    again = inc.where(F.substring("ticker", -1, 1).isin(*EVEN)).withColumn("Total_Revenue", F.col("Total_Revenue") + 1)
    return latest_per_key(inc.unionByName(again), "ticker")


def q_statement_long(spark, sf_dir):
    return RS.wide_to_long(_st(spark, sf_dir)["income"])


def q_statement_wide(spark, sf_dir):
    inc = _st(spark, sf_dir)["income"]
    return RS.statement_wide(RS.wide_to_long(inc), _items(inc), "income_statement")


def q_union_by_name(spark, sf_dir):
    bal = _st(spark, sf_dir, shared=True)["balance"]
    even = F.substring("ticker", -1, 1).isin(*EVEN)
    return RS.union_by_name(bal.where(even).drop("Net_PPE"), bal.where(~even).drop("Inventory"))


def _spaced(df: DataFrame) -> DataFrame:
    # Files carry item names in words; the reader cleans them back.
    return df.toDF(*[c.replace("_", " ") if c not in ("ticker", "report_date") else c for c in df.columns])


def q_scan_delimited(spark, sf_dir):
    spaced = _spaced(_st(spark, sf_dir)["balance"])
    path = _scratch(spark, "balance-tsv", lambda p: DL.write_delimited(spaced, p))
    return DL.read_statement(spark, path, section="balance_sheet", multiline=False)


def q_infer_schema(spark, sf_dir):
    cash = _st(spark, sf_dir)["cash_flow"]
    path = _scratch(spark, "cash-flow-tsv", lambda p: DL.write_delimited(cash, p))
    return DL.infer_delimited(spark, path, multiline=False)


def q_coerce_types(spark, sf_dir):
    inc = _st(spark, sf_dir)["income"]
    dirty = inc.select(
        "ticker", "report_date", *[F.coalesce(F.col(c).cast("string"), F.lit("n/a")).alias(c) for c in _items(inc)]
    )
    path = _scratch(spark, "income-text", lambda p: DL.write_delimited(dirty, p))
    return DL.read_statement(spark, path, section="income_statement", multiline=False)


def q_managed_income(spark, sf_dir):
    return MG.managed_income(_st(spark, sf_dir)["income"], stamp=False)


def q_managed_balance(spark, sf_dir):
    return MG.managed_balance(_st(spark, sf_dir)["balance"], stamp=False)


def q_managed_cash_flow(spark, sf_dir):
    return MG.managed_cash_flow(_st(spark, sf_dir)["cash_flow"], stamp=False)


def q_managed_profile(spark, sf_dir):
    return MG.managed_profile(_st(spark, sf_dir)["company_info"], stamp=False)


def q_data_quality_checks(spark, sf_dir):
    return Q.data_quality_checks(_st(spark, sf_dir), stamp=False)


def q_duplicate_keys(spark, sf_dir):
    inc = _st(spark, sf_dir, shared=True)["income"]
    doubled = inc.unionByName(inc.where(F.substring("ticker", -2, 2) == "07"))
    return Q.duplicate_keys(doubled)


def _given(spark, sf_dir) -> dict[str, DataFrame]:
    return {t: read_table(spark, sf_dir, t) for t in TABLES}


def q_table_counts(spark, sf_dir):
    return Q.table_counts(_given(spark, sf_dir))


def q_table_summary(spark, sf_dir):
    return Q.table_summary(_given(spark, sf_dir))


def q_ratios_last_year(spark, sf_dir):
    return R.ratios_last_year(q_financial_ratios(spark, sf_dir, years=1), as_of=AS_OF)


def q_partitioned_lookup(spark, sf_dir):
    ratios = q_financial_ratios(spark, sf_dir)
    path = _scratch(spark, "ratios-by-year", lambda p: write_partitioned(ratios, p))
    stored = spark.read.parquet(path)
    # The year predicate prunes directories; the date predicate is the exact filter.
    since = (F.col("report_year") >= 2000) & (F.col("report_date") >= F.lit("2000-01-01").cast("date"))
    return stored.where(since).withColumn(
        "report_year", F.col("report_year").cast("bigint")
    )


def q_stream_statements(spark, sf_dir):
    """Statement files land in two batches; the stream loads each file exactly once."""
    from quarterdeck.streaming import run_available, stream_statements

    inc = _spaced(_st(spark, sf_dir)["income"])
    landing, target = staging_path(spark, "landing"), staging_path(spark, "income-stream")
    ckpt = staging_path(spark, "income-stream-ckpt")
    early = F.col("report_date") < F.lit("1998-01-01").cast("date")
    DL.write_delimited(inc.where(early), f"{landing}/batch1")
    run_available(stream_statements(spark, f"{landing}/batch1", target, "income_statement", checkpoint_location=ckpt))
    # second landing: same directory layout, only the new files are read
    DL.write_delimited(inc.where(~early), f"{landing}/batch2")
    run_available(stream_statements(spark, f"{landing}/batch*", target, "income_statement", checkpoint_location=ckpt))
    for path in (landing, target, ckpt):
        remove_on_exit(spark, path)
    return spark.read.parquet(target)


def q_balance_sheet_trends_range(spark, sf_dir):
    return M.balance_sheet_trends(_st(spark, sf_dir)["balance"], stamp=False, strategy="range")


def q_income_statement_trends_range(spark, sf_dir):
    return M.income_statement_trends(_st(spark, sf_dir)["income"], stamp=False, strategy="range")


QUERIES.update(
    {
        "scan_nested_json": q_scan_nested_json,
        "scan_record_json": q_scan_record_json,
        "filter_years": q_filter_years,
        "filter_years_records": q_filter_years_records,
        "company_profile": q_company_profile,
        "statement_long": q_statement_long,
        "statement_wide": q_statement_wide,
        "union_by_name": q_union_by_name,
        "scan_delimited": q_scan_delimited,
        "infer_schema": q_infer_schema,
        "coerce_types": q_coerce_types,
        "managed_income": q_managed_income,
        "managed_balance": q_managed_balance,
        "managed_cash_flow": q_managed_cash_flow,
        "managed_profile": q_managed_profile,
        "data_quality_checks": q_data_quality_checks,
        "duplicate_keys": q_duplicate_keys,
        "table_counts": q_table_counts,
        "table_summary": q_table_summary,
        "ratios_last_year": q_ratios_last_year,
        "partitioned_lookup": q_partitioned_lookup,
        "stream_statements": q_stream_statements,
        "balance_sheet_trends_range": q_balance_sheet_trends_range,
        "income_statement_trends_range": q_income_statement_trends_range,
        "profile_full": q_profile_full,
        "documents_without_ticker": q_documents_without_ticker,
        "quarterly_long": q_quarterly_long,
        "profile_records": q_profile_records,
        "section_errors": q_section_errors,
        "json_counts": q_json_counts,
        "export_statements": q_export_statements,
        "load_replace": q_load_replace,
        "load_append": q_load_append,
        "roundtrip_delimited": q_roundtrip_delimited,
        "append_delimited": q_append_delimited,
        "latest_with_duplicates": q_latest_with_duplicates,
    }
)
QUERIES.update(STORED_QUERIES)
