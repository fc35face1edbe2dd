"""Writing: staged tables and documents that appear complete or not at all, and never over what is there."""

from __future__ import annotations

import hashlib
import json
import os
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(df: DataFrame, path: str, order: list[str] | None = None, files: int | None = None) -> None:
    """Parquet (snappy) in a staging folder, then renamed through the path's own file system; an existing path is an error."""
    out = df if files is None else df.repartitionByRange(files, *order) if order else df.coalesce(files)
    if order:
        out = out.sortWithinPartitions(*order)
    stage = f"{path.rstrip('/')}.staging"
    out.write.mode("overwrite").option("compression", "snappy").parquet(stage)
    promote(df, stage, path)


def promote(df: DataFrame, stage: str, path: str) -> None:
    jvm, conf = df.sparkSession._jvm, df.sparkSession._jsc.hadoopConfiguration()
    to, of = jvm.org.apache.hadoop.fs.Path(path), jvm.org.apache.hadoop.fs.Path(stage)
    fs = to.getFileSystem(conf)
    if fs.exists(to) or not fs.rename(of, to):
        fs.delete(of, True)
        raise FileExistsError(path)


def staged(spark: SparkSession, path: str) -> str:
    """A new place beside a path, for what is to become it."""
    return f"{path.rstrip('/')}.staging-{uuid.uuid4().hex[:12]}"


def small_text(spark: SparkSession, path: str, value: str) -> None:
    """A small document, written by the driver through the path's own file system."""
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = there.getFileSystem(spark._jsc.hadoopConfiguration()).create(there, True)
    try:
        out.write(bytearray(value.encode()))
    finally:
        out.close()


def vocabulary(df: DataFrame, path: str, columns: list[str]) -> None:
    """A vocabulary file: fixed column order, rows by index."""
    table(df.select(*columns), path, [columns[0]], 1)


def text(path: str | Path, value: str) -> None:
    path = Path(path)
    path.parent.mkdir(parents=True, exist_ok=True)
    handle, temp = tempfile.mkstemp(dir=path.parent, prefix=f".{path.name}.")
    try:
        with os.fdopen(handle, "w") as f:
            f.write(value)
            f.flush()
            os.fsync(f.fileno())
        os.replace(temp, path)
    except BaseException:
        Path(temp).unlink(missing_ok=True)
        raise


def document(path: str | Path, value: Any) -> None:
    text(path, json.dumps(value, indent=2, sort_keys=True) + "\n")


def yaml_document(path: str | Path, value: Any) -> None:
    try:
        import yaml
    except ImportError:
        document(path, value)  # JSON is YAML
    else:
        text(path, yaml.safe_dump(value, sort_keys=False))


def json_lines(df: DataFrame, path: str | Path, order: list[str]) -> None:
    """One file of JSON lines in order, for metadata tables that the driver may hold."""
    text(path, "".join(r.j + "\n" for r in df.orderBy(*order).select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("j")).toLocalIterator()))


def clone(source: str | Path, target: str | Path, link: tuple[str, ...] = (".mp4",)) -> dict[str, int]:
    """Copies a tree, hard-linking media; symbolic links are refused.  Counts of files linked and copied."""
    source, target, done = Path(source), Path(target), {"linked": 0, "copied": 0}
    target.mkdir(parents=True)
    for p in sorted(source.rglob("*")):
        to = target / p.relative_to(source)
        if p.is_symlink():
            raise ValueError(f"symbolic link {p}")
        if p.is_dir():
            to.mkdir(exist_ok=True)
        elif p.suffix.lower() in link:
            os.link(p, to)
            done["linked"] += 1
        else:
            shutil.copy2(p, to)
            done["copied"] += 1
    return done


def rolling_digest(root: str | Path) -> str:
    """One SHA-256 over path, NUL and bytes of every file below root, in path order."""
    h = hashlib.sha256()
    for p in sorted(x for x in Path(root).rglob("*") if x.is_file()):
        h.update(p.relative_to(root).as_posix().encode() + b"\0")
        with p.open("rb") as f:
            while block := f.read(8 << 20):
                h.update(block)
    return h.hexdigest()


def relink(pairs: list[tuple[str | Path, str | Path]]) -> dict[str, int]:
    """Of local (source, output) files with the same bytes, the output becomes a hard link to the source; none is touched
    unless all are the same."""
    pairs = [(Path(a), Path(b)) for a, b in pairs]
    for a, b in pairs:
        if a.stat().st_size != b.stat().st_size or file_digest(a) != file_digest(b):
            raise ValueError(f"{b} differs from {a}")
    for a, b in pairs:
        temp = b.with_name(f".{b.name}.link")
        temp.unlink(missing_ok=True)
        os.link(a, temp)
        os.replace(temp, b)
    return {"linked": len(pairs), "bytes": sum(a.stat().st_size for a, _ in pairs)}


def file_digest(path: str | Path) -> str:
    """SHA-256 of a local file, read in blocks."""
    with open(path, "rb") as f:
        return hashlib.file_digest(f, "sha256").hexdigest()


def append_rows(path: str | Path, columns: list[str], rows: list[tuple]) -> None:
    """Rows at the end of a tab-separated status file, whose first line names the columns."""
    path = Path(path)
    path.parent.mkdir(parents=True, exist_ok=True)
    with path.open("a") as f:
        if not f.tell():
            f.write("\t".join(columns) + "\n")
        f.writelines("\t".join(map(str, r)) + "\n" for r in rows)
        f.flush()
        os.fsync(f.fileno())


@contextmanager
def exclusive(path: str | Path) -> Iterator[None]:
    """Held by one process of a machine at a time; another one gets an error at once."""
    import fcntl

    Path(path).parent.mkdir(parents=True, exist_ok=True)
    with open(path, "a") as f:
        try:
            fcntl.flock(f, fcntl.LOCK_EX | fcntl.LOCK_NB)
        except BlockingIOError:
            raise RuntimeError(f"{path} is held by another process") from None
        try:
            yield
        finally:
            fcntl.flock(f, fcntl.LOCK_UN)
