"""Arrow code in the executors, for what has no column expression: files by name, ordered streams of bytes."""

from __future__ import annotations

import hashlib
import io
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends the core package to the executors once, so that their Python need not have it installed."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    top, data = Path(__file__).parent, io.BytesIO()
    with zipfile.ZipFile(data, "w") as z:
        for p in sorted(top.rglob("*.py")):
            z.writestr(zipfile.ZipInfo(f"{top.name}/{p.relative_to(top)}"), p.read_bytes())
    name = f"{tempfile.mkdtemp(prefix='core-')}/{top.name}-{hashlib.sha256(data.getvalue()).hexdigest()[:12]}.zip"
    Path(name).write_bytes(data.getvalue())
    spark.sparkContext.addPyFile(name)
    _shipped.add(app)


def mapped(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str | T.StructType) -> DataFrame:
    """mapInArrow over columns of any name."""
    ship(df.sparkSession)
    names = df.columns
    if not any("." in c or "`" in c for c in names):
        return df.mapInArrow(run, schema)
    return df.toDF(*(f"c{k}" for k in range(len(names)))).mapInArrow(lambda it: run(b.rename_columns(names) for b in it), schema)


def rows(names: str, kinds: list[pa.DataType], values: list[tuple]) -> pa.RecordBatch:
    """A batch of a few rows."""
    columns = list(zip(*values, strict=True)) if values else [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names.split())
