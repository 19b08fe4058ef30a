"""The staged build: statement files -> managed tables -> analytics tables.

Stages run in order and stop at the first failure (an exception names the stage).
``build_release`` publishes all nine tables in one step (:mod:`quarterdeck.plans.releases`): a reader, or a build that dies,
sees all old or all new tables. ``build_all`` writes catalog tables: all are written under staging names first and renamed only when the last one
is complete, so a failed build leaves every old table; readers should not run during the renames.
Each table is a DataFrame function; the only driver/executor boundary is the
table write. Catalog helpers list tables and describe them.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarterdeck.operators import metrics as M
from quarterdeck.operators.quality import duplicate_keys
from quarterdeck.plans import managed as MG
from quarterdeck.plans.releases import TableStore
from quarterdeck.plans.tables import store_incoming, swap_incoming
from quarterdeck.sources.delimited import read_delimited_text, read_statement

STATEMENT_FILES = {
    "balance_sheet": "balance_sheet.csv",
    "income_statement": "income_statement.csv",
    "cash_flow_statement": "cash_flow_statement.csv",
    "company_info": "company_info.csv",
}


ANALYTICS = ("financial_ratios", "balance_sheet_trends", "income_statement_trends", "company_snapshot_latest", "yoy_comparison")


class StageError(RuntimeError):
    pass


def ensure_database(spark: SparkSession, db: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}")


def list_tables(spark: SparkSession, db: str) -> DataFrame:
    rows = [(t.name, t.tableType) for t in spark.catalog.listTables(db)]
    return spark.createDataFrame(rows, "table_name string, table_type string")


def table_info(spark: SparkSession, name: str) -> dict:
    """Rows, size in bytes, creation time and schema.

    ``ANALYZE ... NOSCAN`` records the size from file metadata only (no data read).
    """
    df = spark.table(name)
    spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS NOSCAN")
    detail = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
    return {
        "table": name,
        "rows": df.count(),
        "created": detail.get("Created Time"),
        "statistics": detail.get("Statistics"),
        "schema": df.schema.simpleString(),
    }


def external_tables(spark: SparkSession, src: str) -> dict[str, DataFrame]:
    """Schema-on-read views over the four statement files under ``src``."""
    out = {}
    for name, file in STATEMENT_FILES.items():
        if name == "company_info":
            out[name] = read_delimited_text(spark, f"{src}/{file}")
        else:
            out[name] = read_statement(spark, f"{src}/{file}", section=name, multiline=False)
    return out


def managed_tables(ext: Mapping[str, DataFrame], stamp: bool = True) -> dict[str, DataFrame]:
    return {
        "balance_sheet": MG.managed_balance(ext["balance_sheet"], stamp),
        "income_statement": MG.managed_income(ext["income_statement"], stamp),
        "company_info": MG.managed_profile(ext["company_info"], stamp),
        "cash_flow_statement": MG.managed_cash_flow(ext["cash_flow_statement"], stamp),
    }


def analytics_tables(t: Mapping[str, DataFrame], stamp: bool = True) -> dict[str, DataFrame]:
    inc, bal, prof = t["income_statement"], t["balance_sheet"], t["company_info"]
    made = (
        M.financial_ratios(inc, bal, stamp),
        M.balance_sheet_trends(bal, stamp),
        M.income_statement_trends(inc, stamp),
        M.company_snapshot_latest(inc, bal, prof, stamp),
        M.yoy_comparison(inc, stamp),
    )
    return dict(zip(ANALYTICS, made, strict=True))


def check_grain(spark: SparkSession, tables: Mapping[str, DataFrame]) -> None:
    """Raise if a statement table has more than one row per ``(ticker, report_date)``.

    The grain is what bounds every per-ticker window: a ticker has at most one row
    per reporting period, so it can only hold a large share of a table that is
    itself small. One aggregation per table (map-side combined); nothing is
    collected but the first offending key.
    """
    for name, df in tables.items():
        dup = duplicate_keys(df).limit(1).collect()
        if dup:
            raise StageError(f"{name}: duplicate key {dup[0]['ticker']!r}, {dup[0]['report_date']} ({dup[0]['n']} rows)")


def build_all(
    spark: SparkSession,
    src: str,
    db: str,
    bucket_count: int | None = None,
    verify_grain: bool = True,
) -> DataFrame:
    """Run every stage; return ``(stage, table_name, rows)`` for the tables written.

    With ``bucket_count`` the managed statements are bucketed by ``ticker`` and
    sorted by ``report_date``, so the trend windows read them without a shuffle.
    ``verify_grain`` checks the one-row-per-period grain of the statements before
    the analytics stage.
    """
    ensure_database(spark, db)
    layout = {"bucket_by": (bucket_count, "ticker"), "sort_by": ("report_date",)} if bucket_count else {}
    incoming: dict[str, str] = {}

    def write(stage: str, name: str, df: DataFrame) -> None:
        store_incoming(spark, df, f"{db}.{name}", **(layout if name in STATEMENT_FILES and name != "company_info" else {}))
        incoming[name] = stage

    try:
        _stages(external_tables(spark, src), write, lambda name: spark.table(f"{db}.{name}_incoming"), verify_grain)
        swap_incoming(spark, [f"{db}.{name}" for name in incoming])
    except Exception as exc:
        for name in (*STATEMENT_FILES, *ANALYTICS):
            spark.sql(f"DROP TABLE IF EXISTS {db}.{name}_incoming")
        raise StageError(f"build stopped after staging {', '.join(incoming) or 'nothing'}: {exc}") from exc
    summary = [(stage, f"{db}.{name}", spark.table(f"{db}.{name}").count()) for name, stage in incoming.items()]
    return _summary(spark, summary)


def build_release(spark: SparkSession, src: str, root: str, buckets: int = 32, verify_grain: bool = True) -> DataFrame:
    """Every stage into one new release of the store at ``root``; return ``(stage, table_name, rows, built_at)``.

    The statements are dealt to ``buckets`` by ticker. The release is published when all tables are written and checked.
    """
    done: dict[str, str] = {}
    try:
        with TableStore(spark, root).draft() as draft:

            def write(stage: str, name: str, df: DataFrame) -> None:
                keyed = name in STATEMENT_FILES and name != "company_info"
                draft.put(name, df, *((("ticker",), buckets, ("ticker", "report_date")) if keyed else ()))
                done[name] = stage

            _stages(external_tables(spark, src), write, draft.read, verify_grain)
            release = draft.commit(f"build from {src}")
    except Exception as exc:
        raise StageError(f"build stopped after {', '.join(done) or 'nothing'}; nothing was published: {exc}") from exc
    return _summary(spark, [(stage, name, release.tables[name].rows) for name, stage in done.items()])


def _stages(ext: Mapping[str, DataFrame], write: Callable[[str, str, DataFrame], object], stored: Callable[[str], DataFrame], verify_grain: bool) -> None:
    """Managed tables, the grain check, analytics tables from what was stored."""
    for name, df in managed_tables(ext).items():
        write("managed", name, df)
    managed = {n: stored(n) for n in STATEMENT_FILES}
    if verify_grain:
        check_grain(managed["balance_sheet"].sparkSession, {n: managed[n] for n in managed if n != "company_info"})
    for name, df in analytics_tables(managed).items():
        write("analytics", name, df)


def _summary(spark: SparkSession, rows: list[tuple[str, str, int]]) -> DataFrame:
    return spark.createDataFrame(rows, "stage string, table_name string, rows bigint").withColumn("built_at", F.current_timestamp())
