"""File manifests: hashes, digests, comparison, required files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import trees
from ..tables import written


def hashed(files: DataFrame, path: str = "path", content: str = "content") -> DataFrame:
    """(path, bytes, sha256) of each file."""
    return files.select(F.col(path).alias("path"), F.octet_length(content).cast("long").alias("bytes"), F.sha2(F.col(content).cast("binary"), 256).alias("sha256"))


def excluded(files: DataFrame, names: list[str], folders: list[str] | None = None, path: str = "path") -> DataFrame:
    """Files but those named so, or in a folder at the top named so."""
    parts = F.split(path, "/")
    kept = files.where(~F.element_at(parts, -1).isin(names)) if names else files
    return kept.where(~F.get(parts, F.lit(0)).isin(folders)) if folders else kept


def lines(manifest: DataFrame) -> DataFrame:
    """One row: text "hash  path\n" sorted by path, folder by folder, its sha256, files, bytes.  A manifest of one dataset is one document."""
    pairs = F.array_sort(F.collect_list(F.struct(F.split("path", "/").alias("parts"), "path", "sha256", "bytes")))
    out = manifest.agg(pairs.alias("p"), F.count("*").alias("files"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"))
    out = out.withColumn("text", F.array_join(F.transform("p", lambda s: F.concat(s["sha256"], F.lit("  "), s["path"], F.lit("\n"))), ""))
    return out.select("text", F.sha2(F.col("text").cast("binary"), 256).alias("digest"), "files", "bytes")


def digest(manifest: DataFrame) -> DataFrame:
    """One row (digest, files, bytes): the digest of `lines`' text without the text, for manifests of any length."""
    rows = manifest.select(F.concat("sha256", F.lit("  "), "path", F.lit("\n")).alias("data"), F.split("path", "/").alias("parts"))
    total = manifest.agg(F.count("*").alias("files"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"))
    return trees.stream_digest(rows, ["parts"]).drop("bytes").join(total, F.lit(True), "inner")  # a row on either side


#: What each flavour of a payload's digest leaves out: files by name, folders at the top.
LEFT_OUT = {
    "registry": ([".groot_registry_download.json"], [".cache"]),
    "merge": (["MERGE_RECEIPT.json"], []),
    "correction": (["INSTRUCTION_CORRECTION_RECEIPT.json"], []),
    "language": (["LANGUAGE_VARIANT_RECEIPT.json", "DERIVATION_RECEIPT.json", "ISAAC_DERIVATION_RECEIPT.json", ".groot_registry_download.json"], []),
}


def payload(files: DataFrame, flavour: str, path: str = "path", content: str = "content") -> DataFrame:
    """The manifest of a payload as one of the flavours digests it."""
    names, folders = LEFT_OUT[flavour]
    return lines(hashed(excluded(files, names, folders, path), path, content))


def payload_digest(files: DataFrame, flavour: str, path: str = "path", content: str = "content") -> DataFrame:
    """The digest alone of a payload of any number of files.  files: path, content."""
    names, folders = LEFT_OUT[flavour]
    return digest(hashed(excluded(files, names, folders, path), path, content))


def tree_digest(spark: SparkSession, root: str, flavour: str) -> DataFrame:
    """The same of the files below root, of any size: hashed by executors in blocks."""
    names, folders = LEFT_OUT[flavour]
    return digest(written(trees.hashes(excluded(trees.listing(spark, root), names, folders)), "hashes"))


def tree_fingerprint(spark: SparkSession, root: str) -> DataFrame:
    """`fingerprint` of the files below root: the metadata's bytes are streamed from the files."""
    return fingerprint(trees.listing(spark, root))


def fingerprint(files: DataFrame) -> DataFrame:
    """One row: inventory_sha256 (paths and lengths), metadata_sha256 (paths and bytes of files below meta/), file_count, bytes.

    files: path and content, or path, bytes and the uri whose bytes are the content.  Both digests are folds over rows in
    path order."""
    size = F.col("bytes") if "bytes" in files.columns else F.octet_length("content").cast("long")
    zero, parts = F.lit(b"\0"), F.split("path", "/").alias("parts")
    text = lambda c: F.col(c).cast("string").cast("binary")
    inventory = trees.stream_digest(files.withColumn("n", size).select(F.concat(text("path"), zero, text("n"), F.lit(b"\n")).alias("data"), parts), ["parts"], "inventory_sha256")
    head = F.concat(text("path"), zero)
    body = [head.alias("data"), "uri"] if "uri" in files.columns else [F.concat(head, F.col("content").cast("binary")).alias("data")]
    metadata = trees.stream_digest(files.where(F.startswith("path", F.lit("meta/"))).select(*body, parts), ["parts"], "metadata_sha256")
    total = files.agg(F.count("*").alias("file_count"), F.coalesce(F.sum(size), F.lit(0)).alias("bytes"))
    return inventory.drop("bytes").join(metadata.drop("bytes"), F.lit(True), "inner").join(total, F.lit(True), "inner")  # a row each


def relink_differences(pairs: DataFrame) -> DataFrame:
    """Of `relinked` pairs: files without a partner or with other bytes, which must not be linked."""
    return pairs.where("source is null or output is null or not same").select("camera", "place", "source", "output")


def parsed(text_lines: DataFrame, line: str = "value") -> DataFrame:
    """(sha256, path) of manifest lines; blank lines are skipped."""
    parts = F.split(line, "  ", 2)
    return text_lines.where(F.trim(line) != "").select(parts[0].alias("sha256"), F.get(parts, F.lit(1)).alias("path"))


def verified(said: DataFrame, present: DataFrame) -> DataFrame:
    """(path, problem): missing files, checksum mismatches, files not listed."""
    a, b = said.select("path", F.col("sha256").alias("said"), F.lit(True).alias("in_a")), present.select("path", F.col("sha256").alias("found"), F.lit(True).alias("in_b"))
    problem = F.when(F.col("in_b").isNull(), "missing").when(F.col("in_a").isNull(), "not listed").when(~F.col("said").eqNullSafe(F.col("found")), "checksum mismatch")
    return a.join(b, "path", "full_outer").withColumn("problem", problem).where("problem is not null").select("path", "problem")


def missing(required: DataFrame, present: DataFrame, key: str = "path") -> DataFrame:
    return required.select(key).join(present.select(key), key, "left_anti")


def receipt_differences(expected: DataFrame, observed: DataFrame) -> DataFrame:
    """(key, expected, observed) where a key's values differ or it is absent; only expected keys count."""
    e, o = expected.select("key", F.col("value").alias("expected")), observed.select("key", F.col("value").alias("observed"))
    return e.join(o, "key", "left").where(~F.col("expected").eqNullSafe(F.col("observed")))


def relinked(source: DataFrame, output: DataFrame, group: str = "camera", order: str = "path") -> DataFrame:
    """Files of two trees paired by their place within the group: (group, place, source, output, same)."""
    from pyspark.sql import Window

    w = Window.partitionBy(group).orderBy(order)
    a = source.select(group, (F.row_number().over(w) - 1).alias("place"), F.col(order).alias("source"), F.col("sha256").alias("a"))
    b = output.select(group, (F.row_number().over(w) - 1).alias("place"), F.col(order).alias("output"), F.col("sha256").alias("b"))
    return a.join(b, [group, "place"], "full_outer").select(group, "place", "source", "output", F.col("a").eqNullSafe(F.col("b")).alias("same"))


def inventory_differences(a: DataFrame, b: DataFrame, key: str = "camera") -> DataFrame:
    """Groups whose file counts differ."""
    x, y = a.groupBy(key).agg(F.count("*").alias("left")), b.groupBy(key).agg(F.count("*").alias("right"))
    return x.join(y, key, "full_outer").select(key, F.coalesce("left", F.lit(0)).alias("left"), F.coalesce("right", F.lit(0)).alias("right")).where(F.col("left") != F.col("right"))


def megabytes(size: Column) -> Column:
    return F.sum(size) / F.lit(1e6)
