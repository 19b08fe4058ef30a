"""Interleaved clustering: a date range and a ticker lookup each open few files and lose no row."""

import datetime as dt
import random

from pyspark.sql import functions as F

from quarterdeck.plans.clustered import BITS, files_for, interleaved, read_clustered, write_clustered

SCHEMA = "ticker string, report_date date, x double"


def table(spark, hot=False):
    rng = random.Random(3)
    rows = []
    for t in range(120):
        for q in range(40):
            name = "T050" if hot and rng.random() < 0.4 else f"T{t:03d}"
            rows.append((name, dt.date(1995, 3, 31) + dt.timedelta(days=91 * q), float(t * q)))
    return rows + [(None, dt.date(2000, 1, 1), 1.0), ("T001", None, 2.0)]


def test_both_lookups_skip_most_files(spark, tmp_path):
    for hot in (False, True):
        rows, path = table(spark, hot), str(tmp_path / f"c{hot}")
        write_clustered(spark.createDataFrame(rows, SCHEMA).repartition(4), path, 64)
        every = files_for(spark, path).count()
        since, until = dt.date(1997, 1, 1), dt.date(1997, 12, 31)
        by_date = read_clustered(spark, path, SCHEMA, since, until)
        by_name = read_clustered(spark, path, SCHEMA, ticker="T007")
        assert sorted(map(tuple, by_date.collect())) == sorted(r for r in rows if r[0] and r[1] and since <= r[1] <= until)
        assert sorted(map(tuple, by_name.collect())) == sorted(r for r in rows if r[0] == "T007")
        opened = {"date": len(by_date.inputFiles()), "name": len(by_name.inputFiles())}
        assert opened["date"] < every / 3 and opened["name"] < every / 3, (opened, every)
        assert spark.read.parquet(f"{path}/data").count() == len(rows)
        largest = files_for(spark, path).agg(F.max("rows")).first()[0]
        assert largest < len(rows) / 16  # a heavy ticker is several files


def test_nothing_found_and_empty_tables(spark, tmp_path):
    write_clustered(spark.createDataFrame(table(spark), SCHEMA), str(tmp_path / "a"), 8)
    assert read_clustered(spark, str(tmp_path / "a"), SCHEMA, since=dt.date(2050, 1, 1)).count() == 0
    assert read_clustered(spark, str(tmp_path / "a"), SCHEMA, ticker="missing").count() == 0
    write_clustered(spark.createDataFrame([], SCHEMA), str(tmp_path / "b"), 8)
    assert read_clustered(spark, str(tmp_path / "b"), SCHEMA, ticker="T001").count() == 0


def test_interleaved_bits(spark):
    rows = spark.createDataFrame([(a, b) for a in range(0, 64, 7) for b in range(0, 64, 9)], "a int, b int").withColumn("z", interleaved(F.col("a"), F.col("b")))
    for r in rows.collect():
        want = sum(((r.a >> i & 1) << (2 * i + 1)) | ((r.b >> i & 1) << (2 * i)) for i in range(BITS))
        assert r.z == want
