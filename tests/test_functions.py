import datetime as dt
import math

from pyspark.sql import Window
from pyspark.sql import functions as F

from quarterdeck.functions import (
    clean_name,
    growth_pct,
    lookback,
    quarter_end,
    safe_divide,
    strict_greatest,
    strict_least,
    try_date,
    try_double,
    try_long,
    year_of_label,
)


def test_safe_divide_nulls_zero_and_overflow(spark):
    df = spark.createDataFrame(
        [(1.0, 2.0), (1.0, 0.0), (None, 2.0), (1.0, None), (1e308, 1e-308), (-0.0, 5.0), (3.0, -0.0)], "a double, b double"
    )
    got = [r[0] for r in df.select(safe_divide("a", "b")).collect()]
    assert got == [0.5, None, None, None, None, -0.0, None]


def test_strict_least_greatest(spark):
    df = spark.createDataFrame([(3.0,), (1.0,), (None,)], "x double")
    got = df.select(strict_least("x", 2).alias("l"), strict_greatest("x", 2).alias("g")).collect()
    assert [(r.l, r.g) for r in got] == [(2.0, 3.0), (1.0, 2.0), (None, None)]
    # Spark's own LEAST skips NULL; ours must not.
    assert df.select(F.least("x", F.lit(2.0))).collect()[2][0] == 2.0


def test_growth_pct_uses_previous_row(spark):
    df = spark.createDataFrame(
        [("A", 1, 100.0), ("A", 2, 110.0), ("A", 3, 0.0), ("A", 4, 5.0), ("B", 1, -10.0), ("B", 2, -5.0)],
        "t string, d int, x double",
    )
    w = Window.partitionBy("t").orderBy("d")
    got = {(r.t, r.d): r.g for r in df.select("t", "d", growth_pct("x", w).alias("g")).collect()}
    assert got[("A", 1)] is None
    assert math.isclose(got[("A", 2)], 10.0)
    assert math.isclose(got[("A", 3)], -100.0)
    assert got[("A", 4)] is None  # previous value 0: zero divisor
    assert math.isclose(got[("B", 2)], -50.0)  # negative base keeps the raw sign


def test_lenient_coercion(spark):
    df = spark.createDataFrame(
        [("1.5",), ("",), ("abc",), ("0.0",), ("12345678901234567",), ("2.5",), (None,)], "s string"
    )
    got = df.select(try_double("s").alias("d"), try_long("s").alias("l")).collect()
    assert [r.d for r in got][:4] == [1.5, None, None, 0.0]
    assert [r.l for r in got] == [None, None, None, 0, 12345678901234567, None, None]


def test_dates(spark):
    df = spark.createDataFrame([("2024-02-29",), ("2024-09-30T00:00:00.000",), ("junk",)], "s string")
    got = df.select(try_date("s").alias("d"), year_of_label("s").alias("y")).collect()
    assert got[0].d == dt.date(2024, 2, 29) and got[1].d == dt.date(2024, 9, 30) and got[2].d is None
    assert [r.y for r in got] == [2024, 2024, None]
    q = spark.createDataFrame([(dt.date(2001, 5, 17),), (dt.date(2000, 12, 1),)], "d date")
    assert [r[0] for r in q.select(quarter_end("d")).collect()] == [dt.date(2001, 6, 30), dt.date(2000, 12, 31)]


def test_lookback_clamps_leap_day(spark):
    df = spark.createDataFrame([(dt.date(2023, 2, 28),), (dt.date(2023, 2, 27),)], "d date")
    kept = df.where(lookback("d", 1, "2024-02-29")).collect()
    assert [r.d for r in kept] == [dt.date(2023, 2, 28)]


def test_clean_name():
    assert clean_name("Treasury Shares Number") == "Treasury_Shares_Number"
    assert clean_name("52WeekChange") == "_52WeekChange"
    assert clean_name("Other G and A") == "Other_G_and_A"
    assert clean_name("a-b.c") == "a_b_c"
