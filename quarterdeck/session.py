"""Session construction for scripts and tests (a cluster passes its own session in)."""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(
    cores: int | str = "*", shuffle_partitions: int = 8, app: str = "quarterdeck", extra: dict | None = None
) -> SparkSession:
    """A local session with AQE on, the UI off and UTC as session time zone."""
    b = SparkSession.builder
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = (
        b.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
