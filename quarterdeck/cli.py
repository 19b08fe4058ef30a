"""Command line: the staged build, catalog listings and analyst reports over stored tables.

    python -m quarterdeck.cli validate --src DIR
    python -m quarterdeck.cli build    --src DIR --db NAME [--buckets N]
    python -m quarterdeck.cli list     --db NAME
    python -m quarterdeck.cli info     --table DB.NAME
    python -m quarterdeck.cli report   NAME --db NAME [--as-of YYYY-MM-DD] [--out PATH] [--show N]
    python -m quarterdeck.cli export   --docs PATH --out DIR [--shape map|records] [--multiline]
    python -m quarterdeck.cli load     --src DIR --db NAME [--mode replace|append]
    python -m quarterdeck.cli publish  --src DIR --store DIR [--buckets N]
    python -m quarterdeck.cli merge    --src DIR --store DIR [--buckets N]
    python -m quarterdeck.cli releases --store DIR
    python -m quarterdeck.cli rollback --store DIR --number N

The session comes from ``SparkSession.builder.getOrCreate()``, so ``spark-submit``
settings (master, executors, ``spark.checkpoint.dir``) apply unchanged. Only the
driver imports this package: every operator compiles to JVM expressions, so
executors need no Python code from it.
"""

from __future__ import annotations

import argparse
import json
import os
import sys
from collections.abc import Callable, Sequence

if __package__ in (None, ""):  # run as a file (spark-submit quarterdeck/cli.py): make the package importable
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import DataFrame, SparkSession

from quarterdeck.operators import reports as R
from quarterdeck.plans.build import STATEMENT_FILES, build_all, build_release, external_tables, list_tables, managed_tables, table_info
from quarterdeck.plans.export import export_documents
from quarterdeck.plans.incremental import load_batch
from quarterdeck.plans.releases import TableStore
from quarterdeck.plans.tables import load_directory
from quarterdeck.sources.documents import read_documents
from quarterdeck.sources.files import file_manifest, required_inputs, required_summary


def _stored(spark: SparkSession, db: str) -> dict[str, DataFrame]:
    names = [
        "income_statement",
        "balance_sheet",
        "company_info",
        "financial_ratios",
        "income_statement_trends",
        "company_snapshot_latest",
        "yoy_comparison",
    ]
    return {n: spark.table(f"{db}.{n}") for n in names}


def _reports(as_of, ordered: bool = True) -> dict[str, Callable[[dict[str, DataFrame]], DataFrame]]:
    o = ordered
    return {
        "key_metrics": lambda t: R.key_metrics(t["company_snapshot_latest"], ordered=o),
        "margin_trends": lambda t: R.margin_trends(t["income_statement_trends"], as_of, ordered=o),
        "liquidity": lambda t: R.liquidity(t["balance_sheet"], as_of, ordered=o),
        "leverage": lambda t: R.leverage(t["income_statement"], t["balance_sheet"], as_of, ordered=o),
        "efficiency": lambda t: R.efficiency(t["income_statement"], t["balance_sheet"], as_of, ordered=o),
        "revenue_growth": lambda t: R.revenue_growth(t["income_statement_trends"], as_of, ordered=o),
        "opex_analysis": lambda t: R.opex_analysis(t["income_statement_trends"]),
        "tax_analysis": lambda t: R.tax_analysis(t["income_statement"], ordered=o),
        "capital_structure": lambda t: R.capital_structure(t["balance_sheet"], ordered=o),
        "shareholder_eps": lambda t: R.shareholder_eps(t["income_statement"], ordered=o),
        "last_8_reports": lambda t: R.last_8_reports(t["income_statement_trends"], ordered=o),
        "peer_comparison": lambda t: R.peer_comparison(t["income_statement"], t["balance_sheet"], ordered=o),
        "yoy_growth": lambda t: R.yoy_growth(t["yoy_comparison"], as_of, ordered=o),
        "cash_strength": lambda t: R.cash_strength(t["income_statement"], t["balance_sheet"], ordered=o),
        "health_score": lambda t: R.health_score(t["financial_ratios"], as_of, ordered=o),
    }


REPORTS = sorted(_reports(None))


def run_report(spark: SparkSession, name: str, db: str, as_of: str | None = None, ordered: bool = True) -> DataFrame:
    """One analyst report over the tables a build wrote into ``db``; ``ordered=False``
    drops the final ORDER BY when the result is written to a table."""
    return _reports(as_of, ordered)[name](_stored(spark, db))


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> int:
    p = argparse.ArgumentParser(prog="quarterdeck")
    sub = p.add_subparsers(dest="cmd", required=True)
    v = sub.add_parser("validate", help="check that the statement files are present")
    v.add_argument("--src", required=True)
    b = sub.add_parser("build", help="statement files -> managed tables -> analytics tables")
    b.add_argument("--src", required=True)
    b.add_argument("--db", required=True)
    b.add_argument("--buckets", type=int, default=None)
    b.add_argument("--no-grain-check", action="store_true")
    ls = sub.add_parser("list", help="tables of a database")
    ls.add_argument("--db", required=True)
    i = sub.add_parser("info", help="rows, size, creation time and schema of a table")
    i.add_argument("--table", required=True)
    r = sub.add_parser("report", help="run an analyst report over stored tables")
    r.add_argument("name", choices=REPORTS)
    r.add_argument("--db", required=True)
    r.add_argument("--as-of", default=None)
    r.add_argument("--out", default=None, help="write parquet here instead of printing")
    r.add_argument("--show", type=int, default=20, help="rows to print; the number of all rows is printed with them")
    e = sub.add_parser("export", help="documents -> statement files")
    e.add_argument("--docs", required=True)
    e.add_argument("--out", required=True)
    e.add_argument("--shape", choices=("map", "records"), default="map")
    e.add_argument("--multiline", action="store_true")
    d = sub.add_parser("load", help="statement files -> tables, with inserted and total rows")
    d.add_argument("--src", required=True)
    d.add_argument("--db", required=True)
    d.add_argument("--mode", choices=("replace", "append"), default="replace")
    for name, text in (
        ("publish", "statement files -> all nine tables as one release of a store"),
        ("merge", "statement files -> keyed load into a store, derived tables refreshed, one release"),
    ):
        m = sub.add_parser(name, help=text)
        m.add_argument("--src", required=True)
        m.add_argument("--store", required=True)
        m.add_argument("--buckets", type=int, default=32)
    sub.add_parser("releases", help="releases of a store and their tables").add_argument("--store", required=True)
    back = sub.add_parser("rollback", help="publish the tables of an earlier release again")
    back.add_argument("--store", required=True)
    back.add_argument("--number", type=int, required=True)
    args = p.parse_args(argv)

    spark = spark or SparkSession.builder.appName("quarterdeck").getOrCreate()
    if args.cmd == "validate":
        check = required_inputs(file_manifest(spark, args.src, "*.csv"), STATEMENT_FILES.values())
        check.show(truncate=False)
        return 0 if required_summary(check).first()["ok"] else 1
    if args.cmd == "build":
        summary = build_all(spark, args.src, args.db, bucket_count=args.buckets, verify_grain=not args.no_grain_check)
        summary.show(truncate=False)
        return 0
    if args.cmd == "list":
        list_tables(spark, args.db).show(truncate=False)
        return 0
    if args.cmd == "info":
        print(json.dumps(table_info(spark, args.table), indent=2, default=str))
        return 0
    if args.cmd == "export":
        for name, path in export_documents(read_documents(spark, args.docs, args.shape, args.multiline), args.out, args.shape).items():
            print(f"{name}\t{path}")
        return 0
    if args.cmd == "load":
        report = load_directory(spark, args.src, args.db, args.mode).collect()
        for row in report:
            print("\t".join(str(v) for v in row))
        return 0 if all(row["status"] == "loaded" for row in report) else 1
    if args.cmd == "publish":
        build_release(spark, args.src, args.store, args.buckets).show(truncate=False)
        return 0
    if args.cmd == "merge":
        release, done = load_batch(TableStore(spark, args.store), managed_tables(external_tables(spark, args.src), stamp=False), args.buckets)
        for name, m in done.items():
            print(f"{name}\tinserted {m.inserted}\tupdated {m.updated}\tunchanged {m.unchanged}\tduplicates {m.duplicates}")
        print(f"release {release.number}")
        return 0
    if args.cmd == "releases":
        TableStore(spark, args.store).history().orderBy("number", "table_name").show(1000, truncate=False)
        return 0
    if args.cmd == "rollback":
        print(f"release {TableStore(spark, args.store).rollback(args.number).number}")
        return 0
    df = run_report(spark, args.name, args.db, args.as_of, ordered=not args.out)
    if args.out:
        df.write.mode("overwrite").parquet(args.out)
    else:
        df = df.cache()
        print(f"{df.count()} rows, of which the first {args.show} at most:")
        df.show(args.show, truncate=False)
        df.unpersist()
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
