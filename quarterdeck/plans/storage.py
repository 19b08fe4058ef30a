"""Shared-storage locations: checkpoints and staging directories.

On a cluster, lineage cuts and scratch outputs must live on storage every
executor can reach. The cluster names that place in ``spark.checkpoint.dir``; we
read it from the session and only choose our own when it is unset (local tests).
We never use ``localCheckpoint``: its blocks die with the executor that holds them.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint directory; set one only when the session has none."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to storage every executor can reach (HDFS, object store)")
        # Local mode only (tests): one machine, so a private temporary folder is shared by all tasks.
        conf_dir = tempfile.mkdtemp(prefix="quarterdeck-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return (sc.getCheckpointDir() or conf_dir).rstrip("/")


def remove_on_exit(spark: SparkSession, path: str) -> None:
    """Have the file system remove ``path`` when the application ends (a table's files once nothing reads them)."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(target)


def staging_path(spark: SparkSession, label: str) -> str:
    """A fresh directory under the shared checkpoint root for intermediate files; see :func:`remove_on_exit`."""
    return f"{checkpoint_root(spark)}/staging/{label}-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """Reliable, eager checkpoint: materialises ``df`` once in the shared folder and cuts its lineage."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)
