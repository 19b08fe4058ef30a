"""Statement tables derived from the TPC-H-style test tables (see FIXTURES.md, group B).

Grain: one row per supplier (``ticker = s_name``) and calendar quarter of ``l_shipdate``
(``report_date`` = last day of the quarter). Money is summed as DECIMAL, as the fixture defines it, and turned
into DOUBLE only at the end, so results are exact and engine independent.

Every statement has a plan of its own:

1. a scan of ``lineitem`` with the statement's columns only and its filters (line status, supplier key and, for
   look-backs, a bound on the ship date) pushed down;
2. an aggregation by ``(supplier key, quarter)``, combined before the shuffle, so a hot supplier is one row per
   quarter and task;
3. a join of that much smaller table with ``supplier`` (the strategy is Spark's choice) and a small aggregation by
   ``(ticker, report_date)``, which keeps the fixture's ``GROUP BY ticker`` exact even if two keys share a name.

Sums that a consumer does not read are pruned by Catalyst. A consumer that reads one statement twice asks
for ``shared=True`` and reads a staged parquet copy (see :class:`StatementTables`).
"""

from __future__ import annotations

import datetime as _dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarterdeck.functions.dates import quarter_end
from quarterdeck.plans.storage import remove_on_exit, staging_path

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


_SCHEMAS: dict[str, object] = {}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet table; the footer schema is read once per path and then passed explicitly,
    which spares Spark a schema-inference job on every later read."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    schema = _SCHEMAS.get(path)
    if schema is None:
        df = spark.read.parquet(path)
        _SCHEMAS[path] = df.schema
        return df
    return spark.read.schema(schema).parquet(path)


_PX = "CAST(l_extendedprice AS DECIMAL(12,2))"
_DISC = "CAST(l_discount AS DECIMAL(4,2))"
_TAX = "CAST(l_tax AS DECIMAL(4,2))"
_RF = "l_returnflag"

#: Of each statement: which lines count, and what is summed per supplier and quarter.
STATEMENTS = {
    "income": (
        "l_suppkey % 10 <> 1",
        {
            "Total_Revenue": _PX,
            "Cost_Of_Revenue": f"CASE WHEN {_RF} = 'N' THEN {_PX} END",
            "Operating_Expense": f"CASE WHEN {_RF} = 'A' THEN {_PX} END",
            "Research_And_Development": f"{_PX} * {_DISC}",
            "Interest_Expense": f"CASE WHEN {_RF} = 'R' AND {_TAX} >= 0.07 THEN {_PX} * {_TAX} END",
            "Tax_Provision": f"{_PX} * {_TAX}",
            "Diluted_Average_Shares": "CAST(rint(l_quantity) AS BIGINT)",
        },
    ),
    "balance": (
        "l_linestatus = 'F' AND l_suppkey % 10 <> 0",
        {
            "Total_Assets": _PX,
            "Current_Assets": f"CASE WHEN {_RF} <> 'N' THEN {_PX} END",
            "Inventory": f"CASE WHEN {_RF} = 'A' AND {_DISC} >= 0.05 THEN {_PX} END",
            "Cash_And_Cash_Equivalents": f"CASE WHEN {_RF} = 'R' THEN {_PX} END",
            "Current_Liabilities": f"CASE WHEN {_RF} = 'R' AND {_TAX} <= 0.04 THEN {_PX} END",
            "Total_Debt": f"CASE WHEN {_RF} = 'N' AND {_TAX} <= 0.03 THEN {_PX} END",
            "Net_PPE": f"CASE WHEN {_RF} = 'N' AND {_DISC} <= 0.05 THEN {_PX} END",
            "Goodwill_And_Other_Intangible_Assets": f"CASE WHEN {_RF} = 'N' AND {_DISC} > 0.05 THEN {_PX} END",
        },
    ),
    "cash_flow": (
        "l_suppkey % 10 <> 3",
        {
            "Operating_Cash_Flow": f"CASE WHEN {_RF} <> 'A' THEN {_PX} END",
            "Capital_Expenditure": f"CASE WHEN {_RF} = 'A' AND {_DISC} < 0.03 THEN -{_PX} END",
            "Cash_Dividends_Paid": f"CASE WHEN {_RF} = 'N' THEN -{_PX} * {_TAX} END",
        },
    ),
}


def statement_sums(spark: SparkSession, sf_dir: str, kind: str, since: _dt.date | None = None) -> DataFrame:
    """The sums of one statement per ``(ticker, report_date)``; ``since`` leaves out quarters that end before it."""
    lines, sums = STATEMENTS[kind]
    li = read_table(spark, sf_dir, "lineitem").where(lines)
    if since is not None:  # a quarter that ends on or after the bound has no line before its own first day
        first = _dt.date(since.year, 3 * ((since.month - 1) // 3) + 1, 1)
        li = li.where(F.col("l_shipdate") >= F.lit(first)).where(quarter_end("l_shipdate") >= F.lit(since))
    per_key = li.groupBy(F.col("l_suppkey").alias("k"), quarter_end("l_shipdate").alias("report_date")).agg(
        *[F.expr(f"sum({e})").alias(n) for n, e in sums.items()]
    )
    names = read_table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("k"), F.col("s_name").alias("ticker"))
    whole = per_key.join(names, "k").groupBy("ticker", "report_date").agg(*[F.sum(n).alias(n) for n in sums])
    kinds = {n: "bigint" if n == "Diluted_Average_Shares" else "double" for n in sums}
    values = {n: F.coalesce(F.col(n), F.lit(0)) if n == "Total_Debt" else F.col(n) for n in sums}
    return whole.select("ticker", "report_date", *[values[n].cast(kinds[n]).alias(n) for n in sums])


def income_from(agg: DataFrame) -> DataFrame:
    c = F.col
    opi = c("Total_Revenue") - c("Cost_Of_Revenue") - c("Operating_Expense")
    net = opi - F.coalesce(c("Interest_Expense"), F.lit(0.0)) - c("Tax_Provision")
    return (
        agg.select(
            "ticker",
            "report_date",
            "Total_Revenue",
            "Cost_Of_Revenue",
            "Operating_Expense",
            "Research_And_Development",
            "Interest_Expense",
            "Tax_Provision",
            "Diluted_Average_Shares",
            (c("Total_Revenue") - c("Cost_Of_Revenue")).alias("Gross_Profit"),
            (c("Operating_Expense") - c("Research_And_Development")).alias("Selling_General_And_Administration"),
            opi.alias("Operating_Income"),
            opi.alias("EBIT"),
            (opi + c("Research_And_Development")).alias("EBITDA"),
            (opi - F.coalesce(c("Interest_Expense"), F.lit(0.0))).alias("Pretax_Income"),
            net.alias("Net_Income"),
            net.alias("Diluted_NI_Availto_Com_Stockholders"),
            (net / F.nullif(c("Diluted_Average_Shares"), F.lit(0))).alias("Diluted_EPS"),
            (net / F.nullif(c("Diluted_Average_Shares") - 1, F.lit(0))).alias("Basic_EPS"),
        )
    )


def balance_from(agg: DataFrame) -> DataFrame:
    c = F.col
    cl0 = F.coalesce(c("Current_Liabilities"), F.lit(0.0))
    return (
        agg.select(
            "ticker",
            "report_date",
            "Total_Assets",
            "Current_Assets",
            "Inventory",
            "Cash_And_Cash_Equivalents",
            "Current_Liabilities",
            "Total_Debt",
            "Net_PPE",
            "Goodwill_And_Other_Intangible_Assets",
            (cl0 + c("Total_Debt")).alias("Total_Liabilities_Net_Minority_Interest"),
            (c("Total_Assets") - cl0 - c("Total_Debt")).alias("Stockholders_Equity"),
            (c("Current_Assets") - c("Current_Liabilities")).alias("Working_Capital"),
            (c("Total_Debt") - c("Cash_And_Cash_Equivalents")).alias("Net_Debt"),
        )
    )


def cash_flow_from(agg: DataFrame) -> DataFrame:
    c = F.col
    return (
        agg.select(
            "ticker",
            "report_date",
            "Operating_Cash_Flow",
            "Capital_Expenditure",
            "Cash_Dividends_Paid",
            (c("Operating_Cash_Flow") + F.coalesce(c("Capital_Expenditure"), F.lit(0.0))).alias("Free_Cash_Flow"),
        )
    )


def company_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profile rows: one per supplier. ``nation`` (25 rows) and ``region`` (5 rows) are
    fixed-size dimensions, so their broadcast is bounded whatever the scale."""
    s = read_table(spark, sf_dir, "supplier")
    n = read_table(spark, sf_dir, "nation")
    r = read_table(spark, sf_dir, "region")
    return (
        s.filter(F.col("s_suppkey") % 10 != 2)
        .join(n, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(r, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("s_name").alias("ticker"),
            F.lit(_dt.date(1970, 1, 1)).alias("report_date"),
            F.col("s_name").alias("company"),
            F.col("n_name").alias("country"),
            F.col("r_name").alias("sector"),
            F.concat(F.lit("IND_"), (F.col("s_suppkey") % 5).cast("string")).alias("industry"),
            (F.col("s_suppkey") * 100).alias("fullTimeEmployees"),
        )
    )


class StatementTables(dict):
    """``income``, ``balance``, ``cash_flow`` and ``company_info``, built on first access.

    A table is only planned when a consumer asks for it, and nothing runs until that consumer acts. ``since`` (a date)
    bounds the statements' report dates at the scan, for reports that look back.

    ``shared=True`` is for consumers that read one statement more than once, whose branches Catalyst would plan
    apart: each statement asked for is then computed when it is asked for and staged as parquet, bucketed by its keys, in the shared
    folder, so that joins on the keys need no exchange. The files go when the application ends.
    """

    VIEWS = {"income": income_from, "balance": balance_from, "cash_flow": cash_flow_from}

    def __init__(self, spark: SparkSession, sf_dir: str, shared: bool = False, since: _dt.date | None = None):
        super().__init__()
        self._spark, self._dir, self._shared, self._since = spark, sf_dir, shared, since

    def _statement(self, kind: str) -> DataFrame:
        df = self.VIEWS[kind](statement_sums(self._spark, self._dir, kind, self._since))
        if not self._shared:
            return df
        name = f"quarterdeck_{kind}_{uuid.uuid4().hex}"
        buckets = int(self._spark.conf.get("spark.sql.shuffle.partitions"))
        path = staging_path(self._spark, name)
        writer = df.write.format("parquet").option("path", path)
        writer.bucketBy(buckets, "ticker", "report_date").sortBy("ticker", "report_date").saveAsTable(name)
        remove_on_exit(self._spark, path)
        stored = self._spark.table(name)
        self._spark.sql(f"DROP TABLE {name}")  # the catalog entry only: the files are external to it
        return stored

    def __missing__(self, key: str) -> DataFrame:
        if key == "company_info":
            self[key] = company_info(self._spark, self._dir)
        elif key in self.VIEWS:
            self[key] = self._statement(key)
        else:
            raise KeyError(key)
        return self[key]

    def items(self):  # all four, in a fixed order
        return [(k, self[k]) for k in ("income", "balance", "cash_flow", "company_info")]

    def keys(self):
        return ["income", "balance", "cash_flow", "company_info"]

    def __iter__(self):
        return iter(self.keys())


def statement_tables(spark: SparkSession, sf_dir: str, shared: bool = False, since: _dt.date | None = None) -> StatementTables:
    """Statement tables of one scale directory (see :class:`StatementTables`)."""
    return StatementTables(spark, sf_dir, shared, since)
