"""Spark session helpers.

Cluster settings (shuffle partitions, checkpoint folder, memory) belong to the
cluster; these helpers only fill in what is unset, which is what tests and the
local bench need.
"""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import DataFrame, SparkSession

_LOCAL_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "heartspark") -> SparkSession:
    """Session for tests and the local bench (single JVM)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("HEARTSPARK_DRIVER_MEMORY", "16g"))
    )
    for k, v in _LOCAL_DEFAULTS.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def is_local(master: str) -> bool:
    """Whether driver and executors are one process, which sees its own temporary folders."""
    return master == "local" or master.startswith("local[")


def spread_out(df: DataFrame) -> DataFrame:
    """``df`` dealt to the cluster's cores if it has fewer partitions: for work on rows that costs far more than a shuffle."""
    tasks = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= tasks else df.repartition(tasks)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder; create a scratch one only when unset.

    On a cluster ``spark.checkpoint.dir`` names shared storage and is used as is.
    Only a local session without it gets a fresh scratch folder; elsewhere that is an error.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    if current:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(current)
        return current
    existing = sc.getCheckpointDir()
    if existing:
        return existing
    if not is_local(sc.master):
        raise RuntimeError("spark.checkpoint.dir isn't set: on a cluster it must name a folder that all executors share")
    path = tempfile.mkdtemp(prefix="heartspark-ckpt-", dir="/tmp")
    spark.conf.set("spark.checkpoint.dir", path)
    sc.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder for intermediate tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """A reliable checkpoint in the cluster's checkpoint folder: computed once, read by everything after it."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def ship_package(spark: SparkSession) -> None:
    """Sends this package's modules to the executors (once per session), as ``--py-files`` does: functions that
    run in Python workers import them there, wherever the driver has the package from."""
    sc = spark.sparkContext
    if getattr(sc, "_heartspark_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="heartspark-py-"), "heartspark.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.join("heartspark", os.path.relpath(full, root)))
    sc.addPyFile(path)
    sc._heartspark_shipped = True
