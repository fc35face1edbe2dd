"""Scans of a dataset tree: frames, vocabularies, episodes, annotations, documents, manifests, logs, queues."""

from __future__ import annotations

import json
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import model
from ..executors import mapped, rows
from . import trees


def frames(spark: SparkSession, root: str, columns: list[str] | None = None) -> DataFrame:
    """All data files below root/data, with the file's path and the row's place in it; only `columns` are read if given."""
    df = spark.read.option("recursiveFileLookup", "true").parquet(f"{root}/data")
    return df.select(*(f"`{c}`" for c in columns or df.columns), F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.row_index").alias("row_index"))


def footers(spark: SparkSession, root: str, columns: list[str] | None = None) -> DataFrame:
    """(path below root, rows, row_groups, columns, types) of every Parquet file below a folder, from the footers alone, in one job."""
    return trees.footers(_parquet(spark, root), columns)


def _parquet(spark: SparkSession, root: str) -> DataFrame:
    """Listed Parquet files, without hidden ones and those in hidden folders."""
    return trees.listing(spark, root).where(F.endswith("path", F.lit(".parquet")) & ~F.col("path").rlike(r"(\A|/)[._]"))


def first_file(spark: SparkSession, root: str) -> DataFrame:
    """The rows of the first Parquet file below a folder, in path order, and of no other."""
    found = _parquet(spark, root).orderBy(F.split("path", "/")).first()
    if found is None:
        raise FileNotFoundError(f"no data below {root}")
    return spark.read.parquet(found.uri)


def vocabulary(spark: SparkSession, path: str, index: str, text: str, strict: bool = False) -> DataFrame:
    """(index, text) of a vocabulary file whose text is a column or, unless `strict`, the saved index of a data frame."""
    df = spark.read.parquet(path)
    names = (text,) if strict else (text, "__index_level_0__")
    name = next((c for c in names if c in df.columns), None)
    if index not in df.columns or name is None:
        raise ValueError(f"{path} lacks {index if index not in df.columns else text}")
    return df.select(F.col(index).cast("long").alias(index), F.col(name).alias(text))


def episodes(spark: SparkSession, root: str) -> DataFrame:
    df = spark.read.option("recursiveFileLookup", "true").parquet(f"{root}/meta/episodes")
    return df.select("*", F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.row_index").alias("row_index"))


def duplicate_episodes(rows: DataFrame, episode: str = "episode_index") -> DataFrame:
    return rows.groupBy(episode).agg(F.count("*").alias("rows")).where("rows > 1")


def last_episodes(rows: DataFrame, fields: list[str], episode: str = "episode_index") -> DataFrame:
    """The last row of each episode in (path, row) order."""
    picked = rows.groupBy(episode).agg(F.max_by(F.struct(*fields), F.struct("file_path", "row_index")).alias("r"))
    return picked.select(episode, "r.*")


def episode_of(path: Column) -> Column:
    """The episode that an annotation file is named after, in six digits at least; null for another name."""
    said = F.regexp_extract(path, r"(?:\A|/)episode_(\d+)\.json\z", 1)
    return F.when(said == F.format_string("%06d", said.try_cast("long")), said.try_cast("long"))


def annotations(spark: SparkSession, root: str) -> DataFrame:
    """One row an annotation file: episode_index from its name, its document, the text that didn't parse, and its path below root."""
    bad = "_corrupt_record"
    df = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "episode_*.json").text(f"{root}/annotations", wholetext=True)
    parsed = F.from_json("value", f"{model.ANNOTATION}, {bad} string", {"columnNameOfCorruptRecord": bad})
    path = F.col("_metadata.file_path")
    below = F.concat(F.lit("annotations/"), F.regexp_extract(path, r".*?/annotations/(.*)\z", 1))
    return df.select(episode_of(path).alias("episode_index"), parsed.alias("j"), below.alias("path")).select("episode_index", "j.*", "path")


def info(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(model.INFO).option("multiLine", "true").json(f"{root}/meta/info.json")


def stats(spark: SparkSession, root: str) -> DataFrame:
    """(feature, stat, dim, value) of meta/stats.json."""
    text = spark.read.text(f"{root}/meta/stats.json", wholetext=True).select(F.from_json("value", model.STATS).alias("s"))
    return text.select(F.explode("s").alias("feature", "m")).select("feature", F.explode("m").alias("stat", "v")).select("feature", "stat", F.posexplode("v").alias("dim", "value"))


def json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of a JSON-lines file; blank lines are skipped."""
    return spark.read.schema(schema).json(path)


def files(spark: SparkSession, root: str, pattern: str | None = None) -> DataFrame:
    """(path below root, length, content) of every file but hidden ones (see `hidden_files`)."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    df = (reader.option("pathGlobFilter", pattern) if pattern else reader).load(root)
    inner = root.split("://")[-1].removeprefix("file:").rstrip("/") + "/"
    return df.select(F.substring_index("path", inner, -1).alias("path"), "length", "content")


def key_values(spark: SparkSession, path: str) -> DataFrame:
    """(key, value) of key=value lines."""
    parts = F.split("value", "=", 2)
    return spark.read.text(path).where(F.contains("value", F.lit("="))).select(parts[0].alias("key"), parts[1].alias("value"))


#: A download's marker, its receipt of older times, and the receipt's line that names the commit.
MARKER, RECEIPT, COMMIT = ".groot_registry_download.json", "DOWNLOAD_RECEIPT.txt", "resolved_hub_commit"


def _opened(spark: SparkSession, path: str) -> tuple:
    jvm = spark._jvm
    there = jvm.org.apache.hadoop.fs.Path(path)
    return there.getFileSystem(spark._jsc.hadoopConfiguration()), there


def small_text(spark: SparkSession, path: str) -> str | None:
    """A small document's text, read on the driver through the path's own file system; None if it isn't there."""
    fs, there = _opened(spark, path)
    if not fs.exists(there):
        return None
    stream = fs.open(there)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def hidden_files(spark: SparkSession, root: str) -> DataFrame:
    """(path below root, length, content) of the files that Spark's readers pass over, as they or a folder above them begin
    with a point or an underscore: markers and caches, listed and read by executors."""
    return trees.contents(trees.listing(spark, root).where(F.col("path").rlike(r"(\A|/)[._]")))


def source_revision(spark: SparkSession, root: str) -> str | None:
    """The revision a source was downloaded at: its marker's, else its receipt's, else none."""
    marker = small_text(spark, f"{root}/{MARKER}")
    if marker is not None:
        return json.loads(marker).get("revision")
    lines = (small_text(spark, f"{root}/{RECEIPT}") or "").splitlines()
    return next((x.partition("=")[2] for x in lines if x.startswith(f"{COMMIT}=")), None)


def probes(spark: SparkSession, root: str) -> DataFrame:
    """(path, streams, packets) of a prober's documents, one a video, named after it with .json added."""
    df = spark.read.schema(model.PROBE).option("multiLine", "true").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json").json(root)
    return df.select(F.regexp_replace(F.col("_metadata.file_path"), r"\.json\z", "").alias("path"), "streams", "packets")


def queue_table(spark: SparkSession, path: str) -> DataFrame:
    """Tab-separated run definitions; # begins a comment line."""
    return spark.read.schema(
        "run_name string, action_mode string, seed long, learning_rate double, augmentation string, save_frequency long"
    ).option("sep", "\t").option("comment", "#").csv(path)


def results(spark: SparkSession, root: str) -> DataFrame:
    """All result documents below root, with the run's folder and the attempt's number (null: the run's own).

    A document is YAML, of which JSON is a part; where no YAML reader is installed only JSON documents can be read.  They are
    parsed by executors; one that is no mapping is an error."""
    found = files(spark, root, "result.{yaml,json}").select("path", F.col("content").cast("string").alias("text"))
    said = mapped(found, _parsed, "path string, text string").select("path", F.from_json("text", model.RESULT).alias("r")).select("path", "r.*")
    path = F.concat(F.lit("/"), F.col("path"))
    name = r"(?:attempt-\d+/)?result\.(?:yaml|json)\z"
    return said.select(
        "*",
        F.regexp_extract(path, rf"/([^/]+)/{name}", 1).alias("run"),
        F.regexp_extract(path, r"/attempt-(\d+)/result\.(?:yaml|json)\z", 1).try_cast("long").alias("attempt")
    )


def _parsed(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in it:
        paths = batch.column("path").to_pylist()
        found = [(p, json.dumps(_document(text, p))) for p, text in zip(paths, batch.column("text").to_pylist(), strict=True)]
        yield rows("path text", [pa.string(), pa.string()], found)


def _document(text: str, where: str) -> dict:
    try:
        import yaml
    except ImportError:
        value = json.loads(text)
    else:
        value = yaml.safe_load(text)
    if not isinstance(value, dict):
        raise ValueError(f"{where} is no mapping")
    return value


def yaml_documents(paths: list[str]) -> dict[str, dict]:
    """Configuration documents, read on the driver; each must be a mapping."""
    return {p: _document(Path(p).read_text(), p) for p in paths}
