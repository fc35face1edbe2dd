"""Written intermediate tables and small helpers: everything here lives in the folder all executors share."""

from __future__ import annotations

import ctypes
import gc
import hashlib
import io
import sys
import tempfile
import time
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..tables import forget, fresh, lasting, written  # noqa: F401


def release(spark: SparkSession) -> None:
    """Lets Spark delete the shuffle files of finished steps now, not when the driver happens to collect its garbage, and
    the executors give back the heap that these steps took.

    Twice: what a job leaves in the listeners' queue is free only after a moment."""
    for _ in range(2):
        gc.collect()
        spark._jvm.System.gc()
        time.sleep(0.3)
    lean_heaps(spark)


def lean_heaps(spark: SparkSession) -> None:
    """A collection in the executors, which shrinks heaps to what is live: beside them stand Python workers, and a heap
    once grown stays so."""
    sc = spark.sparkContext
    if not sc.master.startswith("local[") and sc.master != "local":
        n = max(1, sc.defaultParallelism)
        spark.range(0, n, 1, n).selectExpr("reflect('java.lang.System', 'gc') AS done").write.format("noop").mode("overwrite").save()


def remainder(doc_id: Column | str, n: int) -> Column:
    """crc32 of the id as text modulo n, as the held-out folds use it (null ids: as the empty text)."""
    text = (F.col(doc_id) if isinstance(doc_id, str) else doc_id).cast("string")
    return F.crc32(F.coalesce(text, F.lit("")).cast("binary")) % n


def texts(docs: DataFrame, *more: str) -> DataFrame:
    """doc_id, text and the named columns only, so that extra columns can't clash."""
    return docs.select("doc_id", *more, "text")


def unused(columns: list[str], *names: str) -> list[str]:
    """The names, each with as many underscores in front as keep it apart from the columns (whatever their case)."""
    taken, out = {c.lower() for c in columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        out.append(name)
    return out


def parts(spark: SparkSession, size: float = 0, each: int = 16 << 20) -> int:
    """Tasks of a shuffle: as the session is set, or more where `size` bytes would be more than `each` a task."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions", "200")), -(-int(size) // each))


def batches(it: Iterator[pa.RecordBatch], limit: int = 8 << 20, column: str = "text") -> Iterator[pa.RecordBatch]:
    """The batches again, cut so that each has about `limit` bytes of one column at most (or one row)."""
    from .kernel import column_bytes, slices

    for batch in it:
        if batch.num_rows:
            _, offsets = column_bytes(batch.column(column))
            for a, b in slices(offsets, limit):
                yield batch.slice(a, b - a)


def _trim() -> None:
    """Gives freed memory back to the system: Python workers live on between tasks, beside the executor's heap."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except AttributeError:  # another C library
        pass


#: Of a Python worker: the operator whose caches it holds.
_holds = ""


def _hold(module: str) -> None:
    """Drops what other operators' modules keep in this worker between tasks (see their `drop_caches`): workers live on from
    one stage of a pipeline to the next, and each would be left with the tables of all."""
    global _holds
    if module != _holds:
        for name, other in list(sys.modules.items()):
            if name.startswith(__package__) and name != module and hasattr(other, "drop_caches"):
                other.drop_caches()
        _holds = module
        gc.collect()
        _trim()


def arrow(df: DataFrame, run: Callable, schema) -> DataFrame:
    """mapInArrow that leaves no freed memory behind in the worker and takes columns of any name."""
    module = run.__module__
    kind = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    columns, names = df.columns, kind.names
    plain = not any("." in c or "`" in c for c in columns)

    def lean(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _hold(module)
        try:
            for batch in run(it if plain else (b.rename_columns(columns) for b in it)):
                yield batch if plain else batch.rename_columns([f"c{k}" for k in range(len(names))])
        finally:
            _trim()

    if plain:
        return df.mapInArrow(lean, kind)
    out = T.StructType([T.StructField(f"c{k}", f.dataType, f.nullable) for k, f in enumerate(kind.fields)])
    return df.toDF(*(f"c{k}" for k in range(len(columns)))).mapInArrow(lean, out).toDF(*names)


def bounded_batches(spark: SparkSession) -> SparkSession:
    """Arrow batches of at most 1,000 rows and about 4 MB, whatever a row holds; what came before gives back its heap."""
    lean_heaps(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20))
    ship(spark)
    return spark


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors once, so that their Python need not have it installed."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    top, data = Path(__file__).parents[1], io.BytesIO()
    with zipfile.ZipFile(data, "w") as z:
        for p in sorted(top.rglob("*.py")):
            z.writestr(zipfile.ZipInfo(f"{top.name}/{p.relative_to(top)}"), p.read_bytes())
    name = f"{tempfile.mkdtemp(prefix='package-')}/{top.name}-{hashlib.sha256(data.getvalue()).hexdigest()[:12]}.zip"
    Path(name).write_bytes(data.getvalue())
    spark.sparkContext.addPyFile(name)
    _shipped.add(app)


def by_group(it: Iterator[pa.RecordBatch], *keys: str) -> Iterator[pa.Table]:
    """Of rows sorted by the keys, a table for each group of equal keys."""
    held: list[pa.RecordBatch] = []
    now = None
    for batch in it:
        a = 0
        rows = list(zip(*(batch.column(k).to_pylist() for k in keys), strict=True))
        for r, key in enumerate(rows):
            if key != now:
                if r > a:
                    held.append(batch.slice(a, r - a))
                if held:
                    yield pa.Table.from_batches(held)
                held, now, a = [], key, r
        if batch.num_rows > a:
            held.append(batch.slice(a))
    if held:
        yield pa.Table.from_batches(held)
