"""File inventories: manifest, size statistics, presence checks, JSON record counts.

The manifest uses Spark's ``binaryFile`` source and projects only ``path``,
``length`` and ``modificationTime``; the ``content`` column is pruned, so no file
body is read. Listing is distributed by Spark's file index (parallel listing
above ``spark.sql.sources.parallelPartitionDiscovery.threshold`` paths), and
hidden files (names starting with ``.`` or ``_``) are skipped by the source.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarterdeck.functions.arith import bytes_to_mb


def file_manifest(
    spark: SparkSession,
    root: str,
    glob: str = "*",
    prefix: str | None = None,
    recursive: bool = True,
) -> DataFrame:
    """``(path, name, parent, size_bytes, size_mb, updated)`` per file under ``root``.

    ``glob`` filters file names; ``prefix`` keeps files whose name starts with it.
    """
    df = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", recursive)
        .load(root)
        .select("path", "length", "modificationTime")
    )
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    parent = F.regexp_extract("path", r"([^/]+)/[^/]+$", 1)
    out = df.select(
        "path",
        name.alias("name"),
        parent.alias("parent"),
        F.col("length").alias("size_bytes"),
        F.round(bytes_to_mb("length"), 2).alias("size_mb"),
        F.col("modificationTime").alias("updated"),
    )
    if prefix:
        out = out.where(F.col("name").startswith(prefix))
    return out


def file_stats(manifest: DataFrame) -> DataFrame:
    """One row: file count and total size in MB (bytes summed exactly, then scaled)."""
    return manifest.agg(
        F.count(F.lit(1)).alias("file_count"),
        F.round(bytes_to_mb(F.coalesce(F.sum("size_bytes"), F.lit(0))), 2).alias("total_mb"),
    )


def compare_file_stats(local: DataFrame, remote: DataFrame) -> DataFrame:
    """Local vs uploaded totals in one row (one pass over a tagged union of both manifests)."""
    tagged = local.select("size_bytes", F.lit(True).alias("_local")).unionByName(
        remote.select("size_bytes", F.lit(False).alias("_local"))
    )
    mb = lambda c: F.round(bytes_to_mb(F.coalesce(F.sum(F.when(c, F.col("size_bytes"))), F.lit(0))), 2)
    return tagged.agg(
        F.count_if("_local").alias("local_files"),
        mb(F.col("_local")).alias("local_mb"),
        F.count_if(~F.col("_local")).alias("uploaded_files"),
        mb(~F.col("_local")).alias("uploaded_mb"),
    )


def verify_files(manifest: DataFrame, prefixes: Iterable[str]) -> DataFrame:
    """Files present per expected name prefix, including prefixes with no file (count 0).

    Each file is tagged with the first prefix it starts with (a CASE over the
    short, hand-written prefix list), then counted per prefix: one aggregation,
    no nested-loop join.
    """
    prefixes = list(dict.fromkeys(prefixes))
    spark = manifest.sparkSession
    tag = F.coalesce(*[F.when(F.col("name").startswith(p), F.lit(p)) for p in prefixes], F.lit(None).cast("string"))
    counted = (
        manifest.select(tag.alias("prefix"), "size_bytes")
        .where(F.col("prefix").isNotNull())
        .groupBy("prefix")
        .agg(F.count(F.lit(1)).alias("file_count"), F.sum("size_bytes").alias("_bytes"))
    )
    wanted = spark.createDataFrame([(p,) for p in prefixes], "prefix string")
    return wanted.join(counted, "prefix", "left").select(
        "prefix",
        F.coalesce("file_count", F.lit(0)).alias("file_count"),
        F.round(bytes_to_mb(F.coalesce("_bytes", F.lit(0))), 2).alias("total_mb"),
    )


def required_inputs(manifest: DataFrame, expected: Iterable[str]) -> DataFrame:
    """``(name, present)`` for each expected file name: a left-anti test against the manifest.

    A name counts as present as a file or as the directory holding part files (how
    Spark writes a table). The expected list is small by construction (it is typed
    by a person), the manifest may be huge: it is filtered by the list first, so what
    is joined has at most as many rows as the list.
    """
    spark = manifest.sparkSession
    wanted = list(expected)
    names = manifest.select("name").unionByName(manifest.select(F.col("parent").alias("name")))
    seen = names.where(F.col("name").isin(*wanted)).distinct().withColumn("present", F.lit(True))
    exp = spark.createDataFrame([(e,) for e in wanted], "name string")
    return exp.join(seen, "name", "left").select("name", F.coalesce("present", F.lit(False)).alias("present"))


def required_summary(check: DataFrame) -> DataFrame:
    """Pass/fail tally of :func:`required_inputs`."""
    return check.agg(
        F.count_if("present").alias("passed"),
        F.count_if(~F.col("present")).alias("failed"),
        (F.count_if(~F.col("present")) == 0).alias("ok"),
    )


def json_record_counts(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """Records per JSON file, from the hidden ``_metadata`` column (one pass, no schema inference).

    A record is a line, or with ``multiline=True`` an element of the file's array (an indented object is one record).
    """
    df = spark.read.schema("ticker string").option("multiLine", multiline).json(path)
    names = df.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_name").alias("file_name"))
    return names.groupBy("path", "file_name").agg(F.count(F.lit(1)).alias("records")).select("file_name", "records", "path")


def copy_files(spark: SparkSession, files: Mapping[str, str]) -> DataFrame:
    """Copy raw files, ``{source: target}``, between any stores Spark reads; ``(name, status, size_bytes, error)`` for each.

    A file is copied beside its target and compared by length and, where both stores keep one of the same kind, by checksum; only then
    does it take the target's place. A copy that fails leaves the old target and does not stop the others.
    """
    rows = [(target.rsplit("/", 1)[-1], *copy_file(spark, source, target)) for source, target in files.items()]
    return spark.createDataFrame(rows, "name string, status string, size_bytes bigint, error string")


def copy_file(spark: SparkSession, source: str, target: str) -> tuple[str, int | None, str | None]:
    """One file of :func:`copy_files`: ``(status, size_bytes, error)``."""
    hadoop, conf = spark.sparkContext._jvm.org.apache.hadoop.fs, spark.sparkContext._jsc.hadoopConfiguration()
    origin, place, fresh = (hadoop.Path(p) for p in (source, target, f"{target}.{uuid.uuid4().hex}.part"))
    there = place.getFileSystem(conf)
    try:
        here = origin.getFileSystem(conf)
        size = here.getFileStatus(origin).getLen()
        hadoop.FileUtil.copy(here, origin, there, fresh, False, conf)
        if there.getFileStatus(fresh).getLen() != size:
            raise OSError("the copy has another length")
        one, two = here.getFileChecksum(origin), there.getFileChecksum(fresh)
        if one is not None and two is not None and one.getAlgorithmName() == two.getAlgorithmName() and not one.equals(two):
            raise OSError("the copy has another checksum")
        there.delete(place, False)
        if not there.rename(fresh, place):
            raise OSError(f"cannot put the copy in the place of {target}")
        return "success", size, None
    except Exception as exc:  # noqa: BLE001 - reported per file
        there.delete(fresh, False)
        return "failed", None, str(exc).split("\n")[0]
