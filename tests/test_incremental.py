"""Derived tables after batches equal a full rebuild, and only files of changed tickers are touched."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from quarterdeck.operators import metrics as M
from quarterdeck.operators.reports import ratios_last_year
from quarterdeck.plans.incremental import DERIVED, load_batch, rolling_window
from quarterdeck.plans.releases import TableStore
from quarterdeck.sources.testdata import statement_tables

NAMES = {"income_statement": "income", "balance_sheet": "balance", "company_info": "company_info"}


@pytest.fixture(scope="module")
def statements(spark, sf_small):
    st = statement_tables(spark, sf_small)
    return {n: st[key].cache() for n, key in NAMES.items()}


def rows_of(df):
    return sorted((tuple(r[c] for c in sorted(df.columns)) for r in df.collect()), key=str)


def rebuilt(store):
    return {n: make(*[store.read(s) for s in sources], stamp=False) for n, (sources, make) in DERIVED.items()}


def test_random_batches_equal_a_full_rebuild(spark, statements, tmp_path):
    """Three batches of random rows in random order; the last ones change values, empty one and bring late reports."""
    rng = random.Random(6)
    store = TableStore(spark, str(tmp_path / "store"))
    for n in range(3):
        pick = F.pmod(F.xxhash64("ticker", "report_date", F.lit(rng.randrange(10**6))), F.lit(3)) == 0
        batch = {name: df.where(pick) for name, df in statements.items()}
        if n:  # earlier values change, and some vanish, which takes rows out of the derived tables
            bump = F.pmod(F.xxhash64("report_date"), F.lit(2)) == 0
            income = batch["income_statement"].withColumn("Total_Revenue", F.col("Total_Revenue") + n)
            batch["income_statement"] = income.withColumn("Net_Income", F.when(bump, F.col("Net_Income")))
        load_batch(store, batch, buckets=4, stamp=False)
        for name, want in rebuilt(store).items():
            got = store.read(name)
            assert got.columns == want.columns and rows_of(got) == rows_of(want), (n, name)


def test_a_late_report_reopens_its_neighbours_and_nothing_else(spark, statements, tmp_path):
    store = TableStore(spark, str(tmp_path / "store"))
    income = statements["income_statement"]
    ticker, late = income.groupBy("ticker").agg(F.sort_array(F.collect_list("report_date"))[2]).orderBy("ticker").first()
    is_late = (F.col("ticker") == ticker) & (F.col("report_date") == F.lit(late))
    load_batch(store, {"income_statement": income.where(~is_late)}, buckets=8, stamp=False)
    before = store.release()
    _, done = load_batch(store, {"income_statement": income.where(is_late)}, stamp=False)
    assert done["income_statement"].inserted == 1
    after = store.release()
    assert set(after.tables) == {"income_statement", "income_statement_trends", "yoy_comparison"}
    for name in ("income_statement_trends", "yoy_comparison"):
        old, new = before.tables[name].pieces, after.tables[name].pieces
        assert len({p.bucket for p in new} - {p.bucket for p in old if p in new}) == 1  # one ticker: one bucket
    assert rows_of(store.read("income_statement_trends")) == rows_of(M.income_statement_trends(income, stamp=False))
    assert rows_of(store.read("yoy_comparison")) == rows_of(M.yoy_comparison(income, stamp=False))
    release, done = load_batch(store, {"income_statement": income.where(is_late)}, stamp=False)
    assert release == after and done["income_statement"].unchanged == 1


def test_batches_that_fail_publish_nothing(spark, statements, tmp_path):
    store = TableStore(spark, str(tmp_path / "store"))
    broken = statements["balance_sheet"].withColumn("Total_Assets", F.raise_error(F.lit("lost")).cast("double"))
    with pytest.raises(Exception, match="lost"):
        load_batch(store, {"income_statement": statements["income_statement"], "balance_sheet": broken}, buckets=4)
    assert store.release().number == 0 and not list(tmp_path.rglob("*.parquet"))
    with pytest.raises(ValueError):
        load_batch(store, {"other": statements["balance_sheet"]})


def test_a_rolling_window_equals_a_rebuild(spark, statements, tmp_path):
    """As the day moves on, months leave and enter; months in between keep their files unless they changed."""
    ratios = M.financial_ratios(statements["income_statement"], statements["balance_sheet"], stamp=False)
    store = TableStore(spark, str(tmp_path / "store"))
    before: dict = {}
    for as_of, changed in ((dt.date(1998, 6, 30), None), (dt.date(1998, 9, 15), []), (dt.date(1999, 3, 31), [dt.date(1998, 12, 31)]), (dt.date(2001, 1, 1), [])):
        draft = store.draft()
        written = rolling_window(draft, "ratios_last_year", ratios, as_of, changed=changed)
        draft.commit()
        first = dt.date(as_of.year - (as_of.month < 12), as_of.month % 12 + 1, 1)
        want = ratios.where((F.col("report_date") >= F.lit(first)) & (F.col("report_date") <= F.lit(as_of)))
        assert rows_of(store.read("ratios_last_year")) == rows_of(want), as_of
        now = {p.bucket: p.path for p in store.release().tables["ratios_last_year"].pieces}
        for month in before.keys() & now.keys() - set(written):
            assert now[month] == before[month]
        before = now
    assert rows_of(ratios_last_year(ratios, dt.date(1999, 12, 31))) is not None
