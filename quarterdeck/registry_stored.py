"""Registered queries over stored tables: releases, keyed and incremental loads, many files at once, verified copies."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarterdeck.operators import metrics as M
from quarterdeck.operators import reshape as RS
from quarterdeck.operators.history import add_period_sketches, checks_from_sketches
from quarterdeck.plans.clustered import read_clustered, write_clustered
from quarterdeck.plans.incremental import load_batch, rolling_window
from quarterdeck.plans.merge import merge_rows
from quarterdeck.plans.releases import TableStore
from quarterdeck.plans.storage import remove_on_exit, staging_path
from quarterdeck.plans.tables import copy_tables, load_directory, verify_copies
from quarterdeck.sources import delimited as DL
from quarterdeck.sources.files import file_manifest
from quarterdeck.sources.many import decide, merge_states, type_states, union_files
from quarterdeck.sources.testdata import statement_tables

EVEN = ("0", "2", "4", "6", "8")
KEYS = ("ticker", "report_date")


def _even():
    return F.substring("ticker", -1, 1).isin(*EVEN)


def _since(day: str):
    return F.col("report_date") >= F.lit(day).cast("date")


def _store(spark: SparkSession, label: str) -> TableStore:
    path = staging_path(spark, label)
    remove_on_exit(spark, path)
    return TableStore(spark, path)


def _database(spark: SparkSession) -> str:
    db = "quarterdeck_" + uuid.uuid4().hex
    place = staging_path(spark, db)
    remove_on_exit(spark, place)
    spark.sql(f"CREATE DATABASE {db} LOCATION '{place}'")
    return db


def _folder(spark: SparkSession, label: str) -> str:
    path = staging_path(spark, label)
    remove_on_exit(spark, path)
    return path


def q_publish_release(spark, sf_dir):
    """Two releases of two tables; the ratios of the current one."""
    t = statement_tables(spark, sf_dir, shared=True)
    store = _store(spark, "releases")
    for part in (_even(), F.lit(True)):
        with store.draft() as draft:
            for name in ("income", "balance"):
                draft.put(name, t[name].where(part), ("ticker",), 8, KEYS)
            release = draft.commit()
    return M.financial_ratios(store.read("income", release), store.read("balance", release), stamp=False)


def q_merge_load(spark, sf_dir):
    """Reports with wrong revenues since 1998, then a batch that corrects them and brings the rest, twice."""
    inc = statement_tables(spark, sf_dir, shared=True)["income"]
    store = _store(spark, "merged")
    wrong = inc.where(_even()).withColumn("Total_Revenue", F.when(_since("1998-01-01"), F.col("Total_Revenue") + 1).otherwise(F.col("Total_Revenue")))
    for batch in (wrong, inc.where(_since("1998-01-01") | ~_even()), inc.where(_since("1998-01-01"))):
        with store.draft() as draft:
            merge_rows(draft, "income", batch, KEYS, 8)
            draft.commit()
    return store.read("income")


def q_incremental_trends(spark, sf_dir):
    """Statements in three batches, one of them late; the trend table as the batches left it."""
    inc = statement_tables(spark, sf_dir, shared=True)["income"]
    store = _store(spark, "incremental")
    late = _even() & ~_since("1996-01-01")
    for batch in (inc.where(~late & ~_since("1999-01-01")), inc.where(_since("1999-01-01")), inc.where(late)):
        load_batch(store, {"income_statement": batch}, buckets=8, stamp=False)
    return store.read("income_statement_trends")


def q_rolling_ratios(spark, sf_dir):
    """The last twelve months of ratios by month, moved on by half a year."""
    t = statement_tables(spark, sf_dir, shared=True)
    ratios = M.financial_ratios(t["income"], t["balance"], stamp=False)
    store = _store(spark, "rolling")
    for as_of in (dt.date(2000, 6, 30), dt.date(2000, 12, 31)):
        with store.draft() as draft:
            rolling_window(draft, "ratios", ratios, as_of, changed=[])
            draft.commit()
    return store.read("ratios")


def q_load_append_widened(spark, sf_dir):
    """Whole-number revenues of some companies, then decimal ones of the others and a new column."""
    inc = statement_tables(spark, sf_dir, shared=True)["income"]
    db = _database(spark)
    whole = inc.where(_even()).select(*KEYS, F.floor("Total_Revenue").cast("bigint").alias("Total Revenue"))
    decimal = inc.where(~_even()).select("Net_Income", F.col("Total_Revenue").alias("Total Revenue"), *KEYS)
    for label, df in (("whole", whole), ("decimal", decimal)):
        root = _folder(spark, label)
        DL.write_delimited(df, f"{root}/income.csv")
        load_directory(spark, root, db, "append", multiline=False)
    return spark.table(f"{db}.income")


def q_load_name_clash(spark, sf_dir):
    """Two sources whose names clean to one are not loaded; the third is."""
    t = statement_tables(spark, sf_dir, shared=True)
    root, db = _folder(spark, "clash"), _database(spark)
    for name, df in (("cash flow", t["cash_flow"]), ("cash_flow", t["cash_flow"].where(_even())), ("income", t["income"])):
        DL.write_delimited(df, f"{root}/{name}.csv")
    report = load_directory(spark, root, db, multiline=False)
    return report.groupBy("status").agg(F.sum("inserted_rows").alias("inserted_rows"), F.max("total_rows").alias("total_rows"), F.max("rejected_rows").alias("rejected_rows"))


def _drifting_files(spark: SparkSession, inc: DataFrame) -> list[str]:
    """Income files of some companies lack a column, those of the others have theirs in another order."""
    root = _folder(spark, "drifting")
    DL.write_delimited(inc.where(_even()).drop("Gross_Profit"), f"{root}/a")
    DL.write_delimited(inc.where(~_even()).select(*reversed(inc.columns)), f"{root}/b")
    return [r.path for r in file_manifest(spark, root, "part-*").select("path").orderBy("path").collect()]


def q_union_files(spark, sf_dir):
    inc = statement_tables(spark, sf_dir, shared=True)["income"]
    text = union_files(spark, _drifting_files(spark, inc))
    types = {f.name: f.dataType.simpleString() for f in inc.schema.fields if f.name not in KEYS}
    out = RS.coerce_types(text, types).withColumn("report_date", F.col("report_date").try_cast("date"))
    return out.select(*inc.columns)


def q_infer_merged(spark, sf_dir):
    """Column types from the merged states of two parts, with the number of values."""
    inc = statement_tables(spark, sf_dir, shared=True)["income"]
    text = inc.select(*[F.col(c).cast("string").alias(c) for c in inc.columns])
    states = merge_states(type_states(text.where(_even())), type_states(text.where(~_even())))
    rows = [(r["column"], decide(r.asDict()), r["filled"]) for r in states.collect()]  # a row per column
    return spark.createDataFrame(rows, "column_name string, column_type string, filled bigint")


def q_copy_verified(spark, sf_dir):
    """Copies of the statement tables, verified by content; one of them was changed afterwards."""
    t = statement_tables(spark, sf_dir, shared=True)
    root = _folder(spark, "copies")
    copy_tables(spark, t, root)
    copies = {n: spark.read.schema(df.schema).parquet(f"{root}/{n}") for n, df in t.items()}
    changed = F.when(_even(), F.col("Total_Assets")).otherwise(F.col("Total_Assets") + 1)
    copies["balance"] = copies["balance"].withColumn("Total_Assets", changed)
    return verify_copies(t, copies)


def q_quality_from_sketches(spark, sf_dir):
    """Checks of two statements from monthly sketches that two loads stored."""
    t = statement_tables(spark, sf_dir, shared=True)
    store = _store(spark, "sketches")
    for part in (~_since("1998-01-01"), _since("1998-01-01")):
        with store.draft() as draft:
            add_period_sketches(draft, {"income": (t["income"].where(part), "Total_Revenue"), "balance": (t["balance"].where(part), "Total_Assets")})
            draft.commit()
    checks = checks_from_sketches(store.read("quality_sketches"))
    return checks.select("table_name", "row_count", "distinct_tickers", "min_date", "max_date", "measured")


def q_clustered_lookup(spark, sf_dir):
    """Ratios clustered by date and ticker; a date range and one company's reports, each from the files that can hold them."""
    t = statement_tables(spark, sf_dir, shared=True)
    ratios = M.financial_ratios(t["income"], t["balance"], stamp=False)
    path = _folder(spark, "clustered")
    write_clustered(ratios, path, 16)
    range_rows = read_clustered(spark, path, ratios.schema, dt.date(1997, 1, 1), dt.date(1997, 12, 31))
    company = read_clustered(spark, path, ratios.schema, ticker="Supplier#000000007")
    return range_rows.withColumn("found_by", F.lit("date")).unionAll(company.withColumn("found_by", F.lit("ticker")))


STORED_QUERIES = {
    "publish_release": q_publish_release,
    "merge_load": q_merge_load,
    "incremental_trends": q_incremental_trends,
    "rolling_ratios": q_rolling_ratios,
    "load_append_widened": q_load_append_widened,
    "load_name_clash": q_load_name_clash,
    "union_files": q_union_files,
    "infer_merged": q_infer_merged,
    "copy_verified": q_copy_verified,
    "quality_from_sketches": q_quality_from_sketches,
    "clustered_lookup": q_clustered_lookup,
}
