"""The session settings the operators rely on."""

from __future__ import annotations

import atexit
import shutil
import tempfile

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.parquet.compression.codec": "snappy",
    "spark.ui.showConsoleProgress": "false",
}


def session(master: str | None = None, **more: str) -> SparkSession:
    """A session with these settings; `more` wins (underscores stand for dots)."""
    builder = SparkSession.builder.appName("episodica")
    if master:
        builder = builder.master(master)
    for k, v in (SETTINGS | {k.replace("_", "."): v for k, v in more.items()}).items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir, which all executors share.

    Where it is unset and driver and executors are one process, a temporary folder that goes with it; on a cluster an
    unset folder is an error, as each machine would write its own disk."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir has to name a folder that all executors share")
        here = tempfile.mkdtemp(prefix="shared-")
        atexit.register(shutil.rmtree, here, ignore_errors=True)
        found = f"file://{here}"
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def checkpoints(spark: SparkSession) -> None:
    """Makes `DataFrame.checkpoint` usable."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
