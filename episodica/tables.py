"""Written intermediate tables, in the folder that all executors share."""

from __future__ import annotations

import atexit
import uuid

from pyspark.sql import DataFrame, SparkSession

from .session import shared_dir

_cleared: set[str] = set()


def fresh(spark: SparkSession, name: str) -> str:
    """A new path below the application's own part of the shared folder, which is deleted when the driver ends."""
    app = spark.sparkContext.applicationId
    own = f"{shared_dir(spark)}/{app}"
    if app not in _cleared:
        _cleared.add(app)
        atexit.register(_delete, spark, own)
    return f"{own}/{name}-{uuid.uuid4().hex}"


def lasting(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder that stays."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def _delete(spark: SparkSession, path: str) -> None:
    jvm = spark._jvm
    if spark.sparkContext._jsc is not None and jvm is not None:  # else the session is stopped
        there = jvm.org.apache.hadoop.fs.Path(path)
        there.getFileSystem(spark._jsc.hadoopConfiguration()).delete(there, True)


def written(df: DataFrame, name: str) -> DataFrame:
    """`df` as a table written to the shared folder: later work starts from it, whichever executor is lost."""
    path = fresh(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.written_at = path  # type: ignore[attr-defined]
    return out


def forget(*tables: DataFrame) -> None:
    """Delete tables of `written` that nothing will read again."""
    for df in tables:
        path = getattr(df, "written_at", None)
        if path:
            _delete(df.sparkSession, path)
