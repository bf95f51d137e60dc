"""Session helpers: the shared work folder, and partition-count repair."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL_ROOT_KEY = "spark.vexel.localWorkDir"


def work_root(spark: SparkSession) -> str:
    """Folder every executor can reach, for written intermediate tables.

    It is the cluster's ``spark.checkpoint.dir``.  Only a ``local[...]`` session
    may fall back to a temporary folder, since there driver and executors are
    one machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if not master.startswith("local"):
        raise RuntimeError(
            "set spark.checkpoint.dir to a folder that all executors share"
        )
    root = spark.conf.get(_LOCAL_ROOT_KEY, None)
    if not root:
        root = tempfile.mkdtemp(prefix="vexel-")
        spark.conf.set(_LOCAL_ROOT_KEY, root)
    return root


def work_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh, not yet existing folder below :func:`work_root`."""
    return f"{work_root(spark)}/vexel-{purpose}-{uuid.uuid4().hex}"


def range_count(spark: SparkSession, n_bytes: int, least: int = 1) -> int:
    """Ranges for a sort of ``n_bytes``, so that each is about 128 MB."""
    return max(least, -(-n_bytes // (128 << 20)))


def spread_if_narrow(df: DataFrame, *keys: str) -> DataFrame:
    """Hash-spread a scan that has fewer partitions than the cluster has cores.

    A handful of files, or files of one row group each, would leave most cores
    idle during CPU-heavy work.  Such an input is at most a few splits, so the
    shuffle is cheap; a wide scan is returned as it is and never shuffled.  Name
    enough ``keys`` that no value of them is frequent.
    ``df`` should be a scan with narrow steps on top.  The partition number is
    fixed and the keys are data, so two evaluations agree partition by partition.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    # Twice the cores, since texts differ in size.
    return df.repartition(2 * cores, *keys)
