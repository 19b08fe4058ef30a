"""Every registered query against its DuckDB oracle on the smallest scale."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from quarterdeck.sources.testdata import TABLES

ORACLE = E.oracle_sql()
# union_by_name appends newly seen columns (sorted) after the first frame's: its order differs by design.
ORDER_EXEMPT = {"union_by_name"}
SPARK_TO_DUCK = {"string": "VARCHAR", "double": "DOUBLE", "bigint": "BIGINT", "date": "DATE", "int": "INTEGER",
                 "boolean": "BOOLEAN"}
NAMES = sorted(E.queries())


def _norm(v):
    # Exact: doubles are compared bit for bit (repr round-trips).
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    return v


@pytest.fixture(scope="module")
def duck(sf_small):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_small}/{t}.parquet')")
    return con


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "profit_margin" in df.columns


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, sf_small, name):
    df = E.queries()[name](spark, sf_small)
    cols = sorted(df.columns)
    got = sorted((tuple(_norm(r[c]) for c in cols) for r in df.collect()), key=str)
    if name not in ORACLE:
        assert len(got) > 0
        return
    rel = duck.sql(ORACLE[name])
    assert sorted(rel.columns) == cols
    if name not in ORDER_EXEMPT:
        assert df.columns == rel.columns  # same column order as the SQL definition
    duck_types = dict(zip(rel.columns, (str(t) for t in rel.types)))
    assert {c: SPARK_TO_DUCK.get(t, t) for c, t in df.dtypes} == duck_types
    idx = [rel.columns.index(c) for c in cols]
    want = sorted((tuple(_norm(r[i]) for i in idx) for r in rel.fetchall()), key=str)
    assert got == want


@pytest.mark.parametrize(
    "conf", [{"spark.sql.ansi.enabled": "false"}, {"spark.sql.session.timeZone": "America/Los_Angeles"}]
)
@pytest.mark.parametrize("name", ["financial_ratios", "scan_nested_json", "health_score"])
def test_results_do_not_depend_on_session_settings(spark, duck, sf_small, conf, name):
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        test_query_matches_oracle(spark, duck, sf_small, name)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
