"""File trees of any size: listed, read, hashed, copied and written by executors, through each path's own file system.

Contents are read in blocks of BLOCK bytes and never held whole; no file passes through the driver.  A path is a URI that
pyarrow.fs knows (file, hdfs, s3, gs) or a local path.  What is written appears under a name of its own first and takes its place when
it is complete, so that a task that is lost or runs twice leaves either nothing or the whole file.
"""

from __future__ import annotations

import hashlib
import json
import os
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..executors import mapped, rows
from ..tables import fresh, written

BLOCK = 8 << 20
#: Bytes of a row group that a sink writes, and files a task handles, about.
GROUP, FILES = 32 << 20, 64
_STAGE = ".part-"


def _uri(path: str) -> str:
    scheme, found, rest = path.partition("://")
    if found and scheme in ("s3a", "s3n"):  # Hadoop's names for what pyarrow knows as s3
        return f"s3://{rest}"
    if path.startswith("file:") and not path.startswith("file://"):
        return "file://" + path[5:]
    return path if "://" in path else "file://" + os.path.abspath(path)


def system(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(_uri(uri))


def blocks(uri: str, size: int = BLOCK) -> Iterator[bytes]:
    fs, path = system(uri)
    with fs.open_input_stream(path) as f:
        while block := f.read(size):
            yield block


def _tasks(df: DataFrame, each: int = FILES) -> DataFrame:
    """Rows of files dealt to tasks of about `each`, large and small ones mixed; a table of them is written, so counting is cheap."""
    least = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(max(least, -(-df.count() // each)))


# --- reading


def listing(spark: SparkSession, root: str) -> DataFrame:
    """(path below root, uri, bytes) of every file, hidden ones too.  Folders are listed level by level, each by a task of its own."""
    top = _uri(root).rstrip("/")

    def look(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for uri in batch.column("uri").to_pylist():
                fs, base = system(uri)
                found = [(x.type == pafs.FileType.Directory, f"{uri}/{x.base_name}", x.size or 0) for x in fs.get_file_info(pafs.FileSelector(base))]
                yield rows("folder uri bytes", [pa.bool_(), pa.string(), pa.int64()], found)

    level, files = spark.createDataFrame([(top,)], "uri string"), None
    while True:
        seen = written(mapped(_tasks(level), look, "folder boolean, uri string, bytes long"), "listing")
        here = seen.where("not folder").select(F.substr("uri", F.lit(len(top) + 2)).alias("path"), "uri", "bytes")
        files = here if files is None else files.unionAll(here)
        level = seen.where("folder").select("uri")
        if level.isEmpty():
            return files


def _spark_type(kind: pa.DataType) -> str:
    from pyspark.sql.pandas.types import from_arrow_type

    try:
        return from_arrow_type(kind, True).simpleString()
    except Exception:  # a type that Spark lacks
        return str(kind)


def _fields(metadata: pq.FileMetaData) -> list[tuple[str, str]]:
    schema = metadata.schema.to_arrow_schema()
    said = (metadata.metadata or {}).get(b"org.apache.spark.sql.parquet.row.metadata")
    if said:  # what Spark wrote, it reads so
        return [(f.name, f.dataType.simpleString()) for f in T.StructType.fromJson(json.loads(said)).fields]
    return [(f.name, _spark_type(f.type)) for f in schema]


def footers(files: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """(path, rows, row_groups, columns, types) of Parquet files (path, uri) from their footers alone, read by executors."""

    def read(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.string(), pa.int64(), pa.int32(), pa.list_(pa.string()), pa.list_(pa.string())]
        for batch in it:
            found = []
            for path, uri in zip(batch.column("path").to_pylist(), batch.column("uri").to_pylist(), strict=True):
                fs, at = system(uri)
                with fs.open_input_file(at) as f:
                    m = pq.read_metadata(f)
                fields = [x for x in _fields(m) if columns is None or x[0] in columns]
                found.append((path, m.num_rows, m.num_row_groups, [n for n, _ in fields], [f"{n} {t}" for n, t in fields]))
            yield rows("path rows row_groups columns types", kinds, found)

    return mapped(_tasks(files.select("path", "uri")), read, "path string, rows long, row_groups int, columns array<string>, types array<string>")


def contents(files: DataFrame) -> DataFrame:
    """(path, length, content) of small files (path, uri), read by executors."""

    def read(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for path, uri in zip(batch.column("path").to_pylist(), batch.column("uri").to_pylist(), strict=True):
                content = b"".join(blocks(uri))
                yield rows("path length content", [pa.string(), pa.int64(), pa.binary()], [(path, len(content), content)])

    return mapped(_tasks(files.select("path", "uri")), read, "path string, length long, content binary")


def hashes(files: DataFrame) -> DataFrame:
    """(path, bytes, sha256) of files (path, uri), each streamed once."""

    def read(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for path, uri in zip(batch.column("path").to_pylist(), batch.column("uri").to_pylist(), strict=True):
                h, n = hashlib.sha256(), 0
                for block in blocks(uri):
                    h.update(block)
                    n += len(block)
                yield rows("path bytes sha256", [pa.string(), pa.int64(), pa.string()], [(path, n, h.hexdigest())])

    return mapped(_tasks(files.select("path", "uri")), read, "path string, bytes long, sha256 string")


def stream_digest(parts: DataFrame, order: list[Column | str], name: str = "digest") -> DataFrame:
    """One row: the SHA-256 of all rows' bytes one after another in the order, and how many bytes these are.

    parts: data (binary), and optionally uri (the file whose bytes follow the row's own, or null).  Rows are sorted by ranges in parallel and
    written; then one task reads them in order and keeps nothing but the hash, as SHA-256 knows no other way."""
    spark = parts.sparkSession
    uri = F.col("uri") if "uri" in parts.columns else F.lit(None).cast("string")
    keys = {f"o{k}": F.col(o) if isinstance(o, str) else o for k, o in enumerate(order)}
    keyed = parts.select(F.col("data").cast("binary").alias("data"), uri.alias("uri"), *(c.alias(n) for n, c in keys.items()))
    where = fresh(spark, "ordered")
    keyed.repartitionByRange(*keys).sortWithinPartitions(*keys).select("data", "uri").write.parquet(where)

    def fold(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _ in it:
            h, n = hashlib.sha256(), 0
            fs, base = system(where)
            for file in sorted(x.path for x in fs.get_file_info(pafs.FileSelector(base)) if x.base_name.startswith("part-")):
                with fs.open_input_file(file) as f:
                    for batch in pq.ParquetFile(f).iter_batches(4096):
                        for data, of in zip(batch.column("data"), batch.column("uri").to_pylist(), strict=True):
                            value = data.as_py() or b""
                            h.update(value)
                            n += len(value)
                            for block in blocks(of) if of else ():
                                h.update(block)
                                n += len(block)
            yield rows("digest bytes", [pa.string(), pa.int64()], [(h.hexdigest(), n)])

    return mapped(spark.range(1).coalesce(1), fold, "digest string, bytes long").withColumnRenamed("digest", name)


# --- writing


def _replace(fs: pafs.FileSystem, temp: str, path: str) -> None:
    try:
        fs.move(temp, path)
    except OSError:  # a system that doesn't rename over a file: another run of this task wrote the same one
        fs.delete_file(path)
        fs.move(temp, path)


def _new(fs: pafs.FileSystem, path: str) -> str:
    folder, _, name = path.rpartition("/")
    fs.create_dir(folder, recursive=True)
    return f"{folder}/{_STAGE}{uuid.uuid4().hex}-{name}"


def keyed_parquet(df: DataFrame, root: str, file: str, order: list[str], parts: int | None = None) -> DataFrame:
    """Exactly one Parquet file for each value of the column `file` (a path below root), its rows in order; returns what was
    written: (path, rows, bytes).  A file's rows are streamed, a row group at a time."""
    top, columns = _uri(root).rstrip("/"), [c for c in df.columns if c != file]
    dealt = df.repartition(parts, file) if parts else df.repartition(file)

    def write(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = system(top)
        state: dict = {"file": None, "writer": None, "held": [], "size": 0, "rows": 0, "temp": ""}

        def flush() -> None:
            if state["held"]:
                state["writer"].write_table(pa.Table.from_batches(state["held"]), row_group_size=1 << 30)
                state["held"], state["size"] = [], 0

        def close() -> Iterator[pa.RecordBatch]:
            if state["file"] is not None:
                flush()
                state["writer"].close()
                path = f"{base}/{state['file']}"
                _replace(fs, state["temp"], path)
                yield rows("path rows bytes", [pa.string(), pa.int64(), pa.int64()], [(state["file"], state["rows"], fs.get_file_info(path).size)])
            state.update(file=None, writer=None, rows=0)

        try:
            for batch in it:
                names, a = batch.column(file).to_pylist(), 0
                body = batch.select(columns)
                for k in range(1, len(names) + 1):
                    if k == len(names) or names[k] != names[a]:
                        if names[a] != state["file"]:
                            yield from close()
                            state["file"], state["temp"] = names[a], _new(fs, f"{base}/{names[a]}")
                            state["writer"] = pq.ParquetWriter(state["temp"], body.schema, filesystem=fs, compression="snappy", use_dictionary=True)
                        piece = body.slice(a, k - a)
                        state["held"].append(piece)
                        state["rows"] += piece.num_rows
                        state["size"] += piece.nbytes
                        if state["size"] >= GROUP:
                            flush()
                        a = k
            yield from close()
        finally:
            if state["writer"] is not None:
                state["writer"].close()
                fs.delete_file(state["temp"])

    return written(mapped(dealt.sortWithinPartitions(file, *order), write, "path string, rows long, bytes long"), "commit")


def keyed_lines(df: DataFrame, root: str, file: str, line: str, order: list[str]) -> DataFrame:
    """Exactly one text file for each value of the column `file`, its lines in order; returns (path, rows, bytes)."""
    top = _uri(root).rstrip("/")

    def write(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = system(top)
        now, out, temp, n, size = None, None, "", 0, 0

        def close() -> Iterator[pa.RecordBatch]:
            if now is not None:
                out.close()
                _replace(fs, temp, f"{base}/{now}")
                yield rows("path rows bytes", [pa.string(), pa.int64(), pa.int64()], [(now, n, size)])

        for batch in it:
            for name, text in zip(batch.column(file).to_pylist(), batch.column(line).to_pylist(), strict=True):
                if name != now:
                    yield from close()
                    now, n, size, temp = name, 0, 0, _new(fs, f"{base}/{name}")
                    out = fs.open_output_stream(temp)
                data = (text or "").encode() + b"\n"
                out.write(data)
                n, size = n + 1, size + len(data)
        yield from close()

    dealt = df.select(file, line, *order).repartition(file).sortWithinPartitions(file, *order)
    return written(mapped(dealt, write, "path string, rows long, bytes long"), "commit")


def small_file(uri: str, text: str) -> None:
    """A small document, whole or not at all, and no checksum file beside it that a digest of the tree would count."""
    fs, path = system(uri)
    temp = _new(fs, path)
    with fs.open_output_stream(temp) as out:
        out.write(text.encode())
    _replace(fs, temp, path)


def copied(files: DataFrame, root: str) -> DataFrame:
    """Files (path, uri) copied below root by executors in blocks; returns (path, bytes, sha256) of what was written."""
    top = _uri(root).rstrip("/")

    def copy(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = system(top)
        for batch in it:
            for path, uri in zip(batch.column("path").to_pylist(), batch.column("uri").to_pylist(), strict=True):
                to, h, n = f"{base}/{path}", hashlib.sha256(), 0
                temp = _new(fs, to)
                with fs.open_output_stream(temp) as out:
                    for block in blocks(uri):
                        h.update(block)
                        out.write(block)
                        n += len(block)
                _replace(fs, temp, to)
                yield rows("path bytes sha256", [pa.string(), pa.int64(), pa.string()], [(path, n, h.hexdigest())])

    return written(mapped(_tasks(files.select("path", "uri")), copy, "path string, bytes long, sha256 string"), "commit")


def sized_files(sizes: DataFrame, limit: int, order: str, folder: str, chunk: int = 1000) -> DataFrame:
    """Of (order, bytes) a file for each: (order, chunk_index, file_index, file), filled in order, so that a file holds less than `limit`
    bytes and one entry more."""
    from ..operators.index import running_total

    number = F.floor(F.col("__before") / F.lit(limit)).cast("long")
    placed = running_total(sizes, order, F.col("bytes"), "__before").withColumn("__n", number)
    # numbers are dense where no entry is larger than the limit; elsewhere they are made so
    dense = running_total(placed.select("__n").distinct(), "__n", name="__k")
    out = placed.join(dense, "__n").select(order, F.floor(F.col("__k") / chunk).cast("long").alias("chunk_index"), (F.col("__k") % chunk).cast("long").alias("file_index"))
    return out.withColumn("file", F.format_string(f"{folder}/chunk-%03d/file-%03d.parquet", "chunk_index", "file_index"))
