"""Property tests: our plan shapes against plain models and window forms, on random data."""

import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from quarterdeck.operators.metrics import SNAPSHOT_BALANCE, SNAPSHOT_INCOME, SNAPSHOT_PROFILE, company_snapshot_latest
from quarterdeck.operators.ranking import global_row_number, latest_per_key
from quarterdeck.operators.reshape import statement_wide, union_by_name, wide_to_long


def _random_statements(spark, seed):
    rnd = random.Random(seed)
    tickers = [f"T{i}" for i in range(12)] + [None]

    def rows(cols, p_skip):
        out = set()
        for t in tickers:
            for q in range(rnd.randint(0, 6)):
                if rnd.random() < p_skip:
                    continue
                out.add((t, dt.date(1990 + q, 3 * rnd.randint(1, 4), 1)))
        return [(t, d, *[rnd.choice([None, rnd.uniform(-5, 100)]) for _ in cols]) for t, d in sorted(out, key=str)]

    def df(cols, p_skip):
        schema = "ticker string, report_date date, " + ", ".join(f"{c} double" for c in cols)
        return spark.createDataFrame(rows(cols, p_skip), schema)

    inc = df(SNAPSHOT_INCOME, 0.2)
    bal = df(SNAPSHOT_BALANCE, 0.3)
    prof = spark.createDataFrame(
        [(t, dt.date(1970, 1, 1), f"c{i}", "ind", "sec", "cty", i * 10) for i, t in enumerate(tickers) if rnd.random() < 0.7],
        "ticker string, report_date date, company string, industry string, sector string, country string, fullTimeEmployees bigint",
    )
    return inc, bal, prof


def _model_snapshot(inc, bal, prof):
    """Plain Python: the newest row of each table per ticker, side by side; rows without a ticker match nothing."""
    newest = []
    for table in (inc, bal, prof):
        best = {}
        for row in table.collect():
            if row.ticker not in best or row.report_date > best[row.ticker].report_date:
                best[row.ticker] = row
        newest.append(best)
    out = [tuple(t.get(k) for t in newest) for k in {k for t in newest for k in t if k is not None}]
    out += [tuple(t[None] if t is u else None for u in newest) for t in newest if None in t]
    return out


@pytest.mark.parametrize("seed", [1, 2, 3, 4])
def test_snapshot_equals_the_newest_rows_side_by_side(spark, seed):
    inc, bal, prof = _random_statements(spark, seed)
    want = []
    for i, b, c in _model_snapshot(inc, bal, prof):
        first = i or b or c
        values = [r and r[n] for r, names in ((c, SNAPSHOT_PROFILE), (i, SNAPSHOT_INCOME), (b, SNAPSHOT_BALANCE)) for n in names]
        want.append((first.ticker, first.report_date, *values))
    names = ["ticker", "latest_report_date", *SNAPSHOT_PROFILE, *SNAPSHOT_INCOME, *SNAPSHOT_BALANCE]
    ours = company_snapshot_latest(inc, bal, prof, stamp=False).select(*names)
    assert sorted(map(tuple, ours.collect()), key=str) == sorted(want, key=str)


def test_latest_per_key_matches_row_number(spark):
    rnd = random.Random(7)
    data = [(rnd.choice(["a", "b", "c", None]), rnd.randint(0, 10_000), rnd.random()) for _ in range(2000)]
    data = list({(k, d): (k, d, v) for k, d, v in data}.values())
    df = spark.createDataFrame(data, "k string, d int, v double")
    ours = latest_per_key(df, "k", "d")
    w = Window.partitionBy("k").orderBy(F.col("d").desc())
    ref = df.withColumn("rn", F.row_number().over(w)).where("rn = 1").drop("rn")
    assert sorted(map(tuple, ours.collect()), key=str) == sorted(map(tuple, ref.select(*ours.columns).collect()), key=str)


def test_global_row_number_matches_window_with_heavy_ties(spark):
    rnd = random.Random(11)
    # a third of the rows share one value of the leading sort column
    data = [(f"k{i:05d}", 7.0 if i % 3 == 0 else rnd.choice([None, rnd.uniform(0, 50)])) for i in range(3000)]
    df = spark.createDataFrame(data, "k string, v double").repartition(5)
    order = [F.col("v").desc_nulls_last(), F.col("k").asc()]
    ours = global_row_number(df, order, "rn", num_partitions=6)
    ref = df.withColumn("rn", F.row_number().over(Window.orderBy(*order)))
    assert sorted(ours.select("k", "rn").collect()) == sorted(ref.select("k", "rn").collect())


def test_long_wide_roundtrip_is_identity(spark):
    inc, _, _ = _random_statements(spark, 5)
    inc = inc.where(F.col("ticker").isNotNull())
    items = [c for c in inc.columns if c not in ("ticker", "report_date")]
    back = statement_wide(wide_to_long(inc), items)
    # rows whose every item is NULL vanish in the long form, as they should
    expected = inc.where(F.coalesce(*[F.col(c) for c in items]).isNotNull())
    assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, expected.collect()), key=str)


def test_union_by_name_is_order_insensitive(spark):
    a = spark.createDataFrame([(1, 2.0)], "k int, x double")
    b = spark.createDataFrame([(3.0, 2, "s")], "y double, k int, z string")
    ab = union_by_name(a, b)
    assert ab.columns == ["k", "x", "y", "z"]
    ba = union_by_name(b, a).select(*ab.columns)
    assert sorted(map(tuple, ab.collect()), key=str) == sorted(map(tuple, ba.collect()), key=str)


def test_statement_sums_equal_plain_sums(spark, sf_small):
    """Every column of one statement against exact sums of the lines in Python, and the look-back bound against a filter."""
    from decimal import Decimal

    from quarterdeck.sources.testdata import read_table, statement_sums

    names = {r.s_suppkey: r.s_name for r in read_table(spark, sf_small, "supplier").collect()}
    cents = lambda x: Decimal(str(x)).quantize(Decimal("0.01"))
    want = {}
    for r in read_table(spark, sf_small, "lineitem").where("l_linestatus = 'F'").collect():
        if r.l_suppkey % 10 != 0 and r.l_suppkey in names:
            q = (r.l_shipdate.year, (r.l_shipdate.month - 1) // 3)
            row = want.setdefault((names[r.l_suppkey], q), {"Total_Assets": Decimal(0), "Total_Debt": Decimal(0)})
            row["Total_Assets"] += cents(r.l_extendedprice)
            if r.l_returnflag == "N" and cents(r.l_tax) <= Decimal("0.03"):
                row["Total_Debt"] += cents(r.l_extendedprice)
    got = statement_sums(spark, sf_small, "balance")
    rows = {(r.ticker, (r.report_date.year, (r.report_date.month - 1) // 3)): r for r in got.collect()}
    assert set(rows) == set(want)
    assert all(float(want[k][c]) == rows[k][c] for k in want for c in ("Total_Assets", "Total_Debt"))
    since = dt.date(1995, 5, 17)
    late = statement_sums(spark, sf_small, "balance", since)
    assert sorted(map(tuple, late.collect()), key=str) == sorted((tuple(r) for r in rows.values() if r.report_date >= since), key=str)
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    try:
        plan = statement_sums(spark, sf_small, "balance", since)._jdf.queryExecution().sparkPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "GreaterThanOrEqual(l_shipdate" in plan and "EqualTo(l_linestatus,F)" in plan


@pytest.mark.parametrize("seed", [21, 22])
def test_range_strategy_equals_window_with_a_hot_ticker(spark, seed):
    from quarterdeck.operators.metrics import balance_sheet_trends, income_statement_trends

    rnd = random.Random(seed)
    keys = set()
    # one ticker holds a third of the rows; plus NULL tickers and NULL dates
    for i in range(600):
        t = "HOT" if i % 3 == 0 else rnd.choice([f"T{j}" for j in range(40)] + [None])
        d = None if rnd.random() < 0.02 else dt.date(1900, 1, 1) + dt.timedelta(days=rnd.randint(0, 40000))
        keys.add((t, d))
    rows = [(t, d, rnd.uniform(-10, 100), rnd.choice([None, rnd.uniform(0, 50)])) for t, d in sorted(keys, key=str)]
    base = spark.createDataFrame(rows, "ticker string, report_date date, a double, b double").repartition(7)
    bal = base.select(
        "ticker", "report_date", F.col("a").alias("Total_Assets"), F.col("b").alias("Total_Liabilities_Net_Minority_Interest"),
        (F.col("a") - F.coalesce("b", F.lit(0.0))).alias("Stockholders_Equity"), F.col("b").alias("Current_Assets"),
        F.col("a").alias("Current_Liabilities"), (F.col("a") * 2).alias("Working_Capital"),
        F.col("b").alias("Cash_And_Cash_Equivalents"), F.col("a").alias("Total_Debt"), F.col("b").alias("Net_Debt"),
    )
    w = balance_sheet_trends(bal, stamp=False)
    r = balance_sheet_trends(bal, stamp=False, strategy="range").select(*w.columns)
    assert sorted(map(tuple, w.collect()), key=str) == sorted(map(tuple, r.collect()), key=str)
    inc = base.select(
        "ticker", "report_date", F.col("a").alias("Total_Revenue"), F.col("b").alias("Gross_Profit"),
        F.col("b").alias("Operating_Income"), (F.col("a") / 3).alias("Net_Income"), F.col("b").alias("EBITDA"),
        F.col("b").alias("Tax_Provision"), F.col("a").alias("Pretax_Income"), F.col("b").alias("Cost_Of_Revenue"),
        F.col("b").alias("Operating_Expense"), F.col("b").alias("Research_And_Development"),
        F.col("b").alias("Selling_General_And_Administration"), F.col("b").alias("Diluted_EPS"), F.col("b").alias("Basic_EPS"),
    )
    w = income_statement_trends(inc, stamp=False)
    r = income_statement_trends(inc, stamp=False, strategy="range").select(*w.columns)
    assert sorted(map(tuple, w.collect()), key=str) == sorted(map(tuple, r.collect()), key=str)


def test_shared_statements_join_without_exchange(spark, sf_small):
    from quarterdeck.operators.metrics import financial_ratios
    from quarterdeck.sources.testdata import statement_tables

    t = statement_tables(spark, sf_small, shared=True)
    plan = financial_ratios(t["income"], t["balance"], stamp=False)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "Exchange rangepartitioning" not in plan
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"


def test_ranking_edge_cases(spark):
    from quarterdeck.operators.ranking import previous_and_rank

    empty = spark.createDataFrame([], "k string, v double")
    assert global_row_number(empty, [F.col("k").asc()], "rn").count() == 0

    # all dates NULL for one key: latest_per_key still returns a row, as ROW_NUMBER would
    df = spark.createDataFrame([("a", None, 1.0), ("a", None, 2.0), ("b", dt.date(2020, 1, 1), 3.0)], "k string, d date, v double")
    got = {r.k: r.v for r in latest_per_key(df, "k", "d").collect()}
    assert set(got) == {"a", "b"} and got["b"] == 3.0 and got["a"] in (1.0, 2.0)

    # tied dates share a rank, like RANK()
    ties = spark.createDataFrame(
        [("a", dt.date(2020, 1, 1), 1.0), ("a", dt.date(2020, 1, 1), 2.0), ("a", dt.date(2019, 1, 1), 3.0), ("a", None, 4.0)],
        "ticker string, report_date date, x double",
    )
    ours = {r.x: r.report_rank for r in previous_and_rank(ties, "ticker", "report_date", ["x"]).collect()}
    ref = ties.withColumn("r", F.rank().over(Window.partitionBy("ticker").orderBy(F.col("report_date").desc())))
    assert ours == {r.x: r.r for r in ref.collect()}
