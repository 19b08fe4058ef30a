"""Incremental load: only newly landed files are processed, each exactly once."""

from quarterdeck.streaming import stream_statements

HEADER = "report_date\tticker\tTotal Revenue\tDiluted Average Shares\n"


def _land(d, name, rows):
    (d / name).write_text(HEADER + "".join("\t".join(r) + "\n" for r in rows))


def test_stream_appends_new_files_once(spark, tmp_path):
    landing, target, ckpt = tmp_path / "landing", tmp_path / "income", tmp_path / "ckpt"
    landing.mkdir()
    _land(landing, "a.csv", [("2024-03-31", "A", "10.5", "7"), ("2024-06-30", "A", "", "8")])
    q = stream_statements(spark, str(landing), str(target), "income_statement", checkpoint_location=str(ckpt))
    q.awaitTermination(120)
    first = spark.read.parquet(str(target))
    assert dict(first.dtypes)["Diluted_Average_Shares"] == "bigint" and first.count() == 2
    assert first.where("Total_Revenue IS NULL").count() == 1

    _land(landing, "b.csv", [("2024-09-30", "B", "3.0", "x")])
    q = stream_statements(spark, str(landing), str(target), "income_statement", checkpoint_location=str(ckpt))
    q.awaitTermination(120)
    rows = spark.read.parquet(str(target)).collect()
    assert len(rows) == 3  # a.csv was not read again
    b = [r for r in rows if r.ticker == "B"][0]
    assert b.Total_Revenue == 3.0 and b.Diluted_Average_Shares is None
