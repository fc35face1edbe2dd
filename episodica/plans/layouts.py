"""Dataset trees on disk: files planned by size, one file an episode, metadata as JSON lines, several trees published as one.

Frames are written by as many tasks as there are files, each file by one of them; what was written comes back as a commit
table (path, rows, bytes).  Trees are staged beside their place and renamed when they are whole.
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import model
from ..operators import index, manifest, segments, stats
from ..sources import files, sinks, trees
from . import documents, registry
from .datasets import INTEGERS, VARIANTS, Dataset, boundary_manifest, global_stats, line_view, variants, with_language_annotation, write_boundary_manifest

#: Bytes of a data file, about, and files in a chunk folder.
FILE_BYTES, CHUNK = 100 << 20, 1000
#: The paths of a tree with one file an episode.
EPISODE_FILE, VERSION = "data/chunk-{episode_chunk:03d}/episode_{episode_index:06d}.parquet", "v2.1"
ANNOTATION, RECEIPT = "annotation.human.task_description", "LANGUAGE_VARIANT_RECEIPT.json"


# --- files planned by size


def row_bytes(df: DataFrame) -> Column:
    """About how many bytes a row takes: the lengths of its strings and arrays, eight for everything else."""
    total = F.lit(0)
    for f in df.schema.fields:
        c, kind = F.col(f"`{f.name}`"), f.dataType.typeName()
        total = total + (F.octet_length(c.cast("binary") if kind == "binary" else c.cast("string")) if kind in ("string", "binary") else 8 * F.size(c) if kind in ("array", "map") else F.lit(8))
    return F.coalesce(total, F.lit(8)).cast("long")


def planned(frames: DataFrame, limit: int = FILE_BYTES, chunk: int = CHUNK, folder: str = "data") -> DataFrame:
    """(episode_index, chunk_index, file_index, file): whole episodes in order, in files of less than `limit` bytes and one episode more."""
    sizes = frames.groupBy("episode_index").agg(F.sum(row_bytes(frames)).alias("bytes"))
    return trees.sized_files(sizes, limit, "episode_index", folder, chunk)


def write(data: Dataset, root: str, limit: int = FILE_BYTES, chunk: int = CHUNK, stage: str | None = None) -> DataFrame:
    """A tree that `load` reads; an existing one is an error.  The episodes' rows say in which file their frames are.
    `stage`: writes there, for `publish`.  Returns the commit table of frames and episode rows."""
    spark, own = data.frames.sparkSession, stage is None
    stage = stage or sinks.staged(spark, root)
    frames = data.frames.drop("place")
    plan = planned(frames, limit, chunk)
    named = frames.join(plan.select("episode_index", "file"), "episode_index").select(*(f"`{c}`" for c in frames.columns), "file")
    done = trees.keyed_parquet(named, stage, "file", ["index"])
    at = [F.col("chunk_index").alias("data/chunk_index"), F.col("file_index").alias("data/file_index")]
    rows = data.episodes.drop("data/chunk_index", "data/file_index")
    rows = rows.join(plan.select(F.col("episode_index").alias("__e"), *at), F.col("episode_index") == F.col("__e"), "left").drop("__e")
    sizes = rows.select("episode_index", row_bytes(rows).alias("bytes"))
    place = trees.sized_files(sizes, limit, "episode_index", "meta/episodes", chunk).select("episode_index", "file")
    done = done.unionAll(trees.keyed_parquet(rows.join(place, "episode_index").select(*(f"`{c}`" for c in rows.columns), "file"), stage, "file", ["episode_index"]))
    for name, df, cols in (("tasks", data.tasks, ["task_index", "task"]), ("subtasks", data.subtasks, ["subtask_index", "subtask"])):
        sinks.vocabulary(df, f"{stage}/meta/{name}.parquet", cols)
    if own:
        publish(spark, [(stage, root)])
    return done


# --- one file an episode


@dataclass(frozen=True)
class LineTree:
    """A tree with one file an episode and metadata as JSON lines."""

    frames: DataFrame
    tasks: DataFrame
    episodes: DataFrame
    episode_stats: DataFrame
    info: dict[str, Any]


_EPISODES = "episode_index long, length long, tasks array<string>"
_EPISODE_STATS = "episode_index long, stats map<string, map<string, array<double>>>"


def load_lines(spark: SparkSession, root: str) -> LineTree:
    said = files.small_text(spark, f"{root}/meta/info.json")
    if said is None:
        raise FileNotFoundError(f"{root}/meta/info.json")
    frames = spark.read.option("recursiveFileLookup", "true").parquet(f"{root}/data")
    lines = lambda name, schema: files.json_lines(spark, f"{root}/meta/{name}.jsonl", schema)
    return LineTree(frames, lines("tasks", model.TASKS), lines("episodes", _EPISODES), lines("episodes_stats", _EPISODE_STATS), json.loads(said))


def _json(df: DataFrame, *columns: str) -> Column:
    return F.to_json(F.struct(*(F.col(c) for c in sorted(columns))), {"ignoreNullFields": "false"})


def episode_statistics(frames: DataFrame, episodes: DataFrame) -> DataFrame:
    """(episode_index, stats) of integer columns from the frames, and of other features from the episodes' own columns."""
    own = stats.column_stats(frames, [c for c in INTEGERS if c in frames.columns], ["episode_index"])
    one = F.create_map(*(x for n in ("mean", "std", "min", "max", "count") for x in (F.lit(n), F.array(F.col(n).cast("double")))))
    entries = F.array_sort(F.collect_list(F.struct("feature", one.alias("v"))), lambda a, b: F.when(a["feature"] < b["feature"], -1).otherwise(1))
    out = own.groupBy("episode_index").agg(F.map_from_entries(entries).alias("stats"))
    names = sorted({c.split("/")[1] for c in episodes.columns if c.startswith("stats/")} - set(INTEGERS))
    if not names:
        return out
    said = [x for f in names for x in (F.lit(f), F.create_map(*(y for n in ("mean", "std", "min", "max", "count") for y in (F.lit(n), F.col(f"`stats/{f}/{n}`").cast("array<double>")))))]
    more = episodes.select(F.col("episode_index").alias("__e"), F.create_map(*said).alias("__more"))
    none = F.create_map().cast("map<string,map<string,array<double>>>")
    both = out.join(more, F.col("episode_index") == F.col("__e"), "left")
    return both.select("episode_index", F.map_concat("stats", F.coalesce("__more", none)).alias("stats"))


def _nested(rows: DataFrame) -> dict[str, dict[str, list[float]]]:
    """Global statistics as a document: a few values a feature."""
    out: dict[str, dict[str, list[float]]] = {}
    for r in rows.orderBy("feature", "dim").collect():
        for n in ("mean", "std", "min", "max", "count"):
            out.setdefault(r.feature, {}).setdefault(n, []).append(r[n])
    return out


def write_lines(tree: LineTree, root: str, whole: DataFrame, chunk: int = CHUNK, stage: str | None = None) -> DataFrame:
    """Writes one file an episode, the metadata as JSON lines, info and global statistics.  `stage`: writes there, for `publish`.
    Returns the commit table."""
    spark = tree.frames.sparkSession
    to = stage or sinks.staged(spark, root)
    path = F.format_string("data/chunk-%03d/episode_%06d.parquet", F.floor(F.col("episode_index") / chunk), F.col("episode_index"))
    done = trees.keyed_parquet(tree.frames.withColumn("__file", path), to, "__file", ["frame_index"])
    tables = (
        ("tasks", tree.tasks, ["task_index", "task"]), ("episodes", tree.episodes, ["episode_index", "length", "tasks"]),
        ("episodes_stats", tree.episode_stats, ["episode_index", "stats"]),
    )
    for name, df, columns in tables:
        lines = df.select(F.lit(f"meta/{name}.jsonl").alias("file"), _json(df, *columns).alias("line"), F.col(columns[0]).alias("k"))
        done = done.unionAll(trees.keyed_lines(lines, to, "file", "line", ["k"]))
    total = done.where("path like 'data/%'").agg(F.count("*").alias("e"), F.coalesce(F.sum("rows"), F.lit(0)).alias("f")).first()
    info = tree.info | {
        "codebase_version": VERSION, "total_episodes": total.e, "total_frames": total.f, "total_tasks": tree.tasks.count(), "chunks_size": chunk,
        "total_chunks": -(-total.e // chunk), "data_path": EPISODE_FILE,
    }
    documents = [("meta/info.json", info), ("meta/stats.json", _nested(whole))]
    said = spark.createDataFrame([(p, json.dumps(v, indent=2, sort_keys=True), 0) for p, v in documents], "file string, line string, k int")
    done = done.unionAll(trees.keyed_lines(said, to, "file", "line", ["k"]))
    if stage is None:
        publish(spark, [(to, root)])
    return done


def converted(data: Dataset) -> LineTree:
    """The dataset with one file an episode: the prompt's index under the annotation's name as well."""
    info = {k: v for k, v in data.info.items() if k != "root"}
    info["features"] = dict(info.get("features") or {}) | {ANNOTATION: {"dtype": "int64", "shape": [1], "names": None}}
    frames, rows = with_language_annotation(data.frames.drop("place"), ANNOTATION), data.episodes.select("episode_index", "length", "tasks")
    return LineTree(frames, data.tasks, rows, episode_statistics(data.frames, data.episodes), info)


def convert(data: Dataset, root: str, chunk: int = CHUNK) -> DataFrame:
    """Writes `converted`; an existing tree is an error."""
    return write_lines(converted(data), root, global_stats(data.frames, data.episodes), chunk)


def lines_view(tree: LineTree, prompts: DataFrame, own: bool) -> tuple[LineTree, DataFrame]:
    """A language view of such a tree, whole: frames, prompts, lists, per-episode and global statistics, info.  Frames whose
    numbers have gaps are an error."""
    gaps = index.contiguity_violations(tree.frames, "episode_index", "frame_index", ["frame_index"]).first()
    if gaps is not None:
        raise ValueError(f"episode {gaps.episode_index}: frame_index {gaps.observed}, expected {gaps.expected}")
    size = prompts.count()
    frames, episodes, found = line_view(tree.frames, tree.episodes, tree.episode_stats, prompts, own, size)
    lost = segments.run_values(frames, "task_index", ["frame_index"]).select("episode_index").join(tree.episodes, "episode_index", "left_anti").first()
    if lost is not None:
        raise ValueError(f"episode {lost.episode_index} has no metadata row")
    whole = stats.column_stats(frames, [c for c in INTEGERS if c in frames.columns]).withColumn("dim", F.lit(0))
    return LineTree(frames, prompts, episodes, found, tree.info | {"total_tasks": size}), whole


# --- several trees as one


def _fs(spark: SparkSession, path: str) -> tuple:
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    return there.getFileSystem(spark._jsc.hadoopConfiguration()), there


def publish(spark: SparkSession, stages: list[tuple[str, str]], journal: str | None = None) -> None:
    """Staged trees take their places together or not at all.  None may be there already.  What is under way stands in the journal
    (by default beside the first tree), so that `recover` can undo it after a crash."""
    journal = journal or f"{stages[0][1].rstrip('/')}.publishing"
    taken = next((target for _, target in stages if (x := _fs(spark, target))[0].exists(x[1])), None)
    if taken is not None:
        for stage, _ in stages:
            fs, at = _fs(spark, stage)
            fs.delete(at, True)
        raise FileExistsError(taken)
    sinks.small_text(spark, journal, json.dumps(stages))
    try:
        for stage, target in stages:
            fs, to = _fs(spark, target)
            fs.mkdirs(to.getParent())
            if not fs.rename(_fs(spark, stage)[1], to):
                raise OSError(f"{stage} can't become {target}")
    except Exception:
        recover(spark, journal)
        raise
    fs, at = _fs(spark, journal)
    fs.delete(at, False)


def recover(spark: SparkSession, journal: str) -> list[str]:
    """Undoes a publication that didn't end: trees that had taken their places go, and so do staged ones.  The targets that were undone."""
    said = files.small_text(spark, journal)
    if said is None:
        return []
    undone = []
    for stage, target in json.loads(said):
        (fs, of), (_, to) = _fs(spark, stage), _fs(spark, target)
        if fs.exists(of):
            fs.delete(of, True)
        elif fs.exists(to):
            fs.delete(to, True)
            undone.append(target)
    fs, at = _fs(spark, journal)
    fs.delete(at, False)
    return undone


def publish_views(
    source: Dataset, prepared: Dataset, lines: LineTree, requested: list[str], root: str, registration: dict[str, Any], overall: str, mapped: dict[str, str] | None = None,
    prefix: str = "view", steps: int = 40
) -> dict[str, dict[str, Any]]:
    """Each requested language view as three trees with their receipts and a registration: <root>/<prefix>_<view>/{source,prepared,isaac} and
    <root>/registrations/<prefix>_<view>.json.  All of them appear together or none does.  Returns the registrations by name.

    source, prepared: the frame trees; lines: the one with one file an episode; registration: the parents'."""
    spark = source.frames.sparkSession
    stages: list[tuple[str, str]] = []
    made: dict[str, dict[str, Any]] = {}
    for view, (a, b) in variants(source, prepared, requested, overall, mapped).items():
        own, name = VARIANTS[view], f"{prefix}_{view}"
        told = [r.task for r in a.tasks.orderBy("task_index").collect()]  # a vocabulary
        c, whole = lines_view(lines, a.tasks, own)
        at = {kind: f"{root.rstrip('/')}/{name}/{kind}" for kind in ("source", "prepared", "isaac")}
        starts, numbers = boundary_manifest(source, steps)
        found = segments.run_segments(source.frames, "subtask_index", ["frame_index"])
        spans = segments.segment_lengths(found, "subtask_index").collect()  # a row a subtask
        report = documents.boundary_report(numbers.first(), source.frames.select("episode_index").distinct().count(), spans)
        digest = {}
        for kind, tree in (("source", a), ("prepared", b), ("isaac", c)):
            stage = sinks.staged(spark, f"{root.rstrip('/')}/{name}-{kind}")
            stages.append((stage, at[kind]))
            if isinstance(tree, LineTree):
                write_lines(tree, at[kind], whole, stage=stage)
            else:
                write(tree, at[kind], stage=stage)
            path, sha = write_boundary_manifest(starts, stage)
            digest[kind] = manifest.tree_digest(spark, stage, "language").first().digest
            receipt = documents.language_receipt(view, own, told, kind, str(source.info.get("root", "")), at[kind], {}, {}, report, path, sha)
            trees.small_file(f"{stage}/{RECEIPT}", json.dumps(receipt | {"payload_sha256": digest[kind]}, indent=2, sort_keys=True) + "\n")
        made[name] = registry.view_registration(registration, name, f"{prefix}:{view}", digest["source"], at, view, told, f"{at['source']}/{RECEIPT}", f"{root.rstrip('/')}/{name}_caption_audit.json")
        stage = sinks.staged(spark, f"{root.rstrip('/')}/{name}.json")
        trees.small_file(stage, json.dumps(made[name], indent=2, sort_keys=True) + "\n")
        stages.append((stage, f"{root.rstrip('/')}/registrations/{name}.json"))
    publish(spark, stages, f"{root.rstrip('/')}/{prefix}.publishing")
    return made


def package(spark: SparkSession, source: str, target: str, required: list[str]) -> dict[str, int]:
    """A copy of a tree with its SHA256SUMS, made by executors; required files must be there, and the target must not."""
    found = trees.listing(spark, source).where("path <> 'SHA256SUMS'")
    lost = spark.createDataFrame([(p,) for p in required], "path string").join(found, "path", "left_anti").orderBy("path").first()
    if lost is not None:
        raise FileNotFoundError(f"missing {lost.path}")
    stage = sinks.staged(spark, target)
    done = trees.copied(found, stage)
    lines = done.select(F.lit("SHA256SUMS").alias("file"), F.concat("sha256", F.lit("  "), "path").alias("line"), F.split("path", "/").alias("k"))
    trees.keyed_lines(lines, stage, "file", "line", ["k"])
    publish(spark, [(stage, target)])
    total = done.agg(F.count("*").alias("n"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("b")).first()
    return {"files": total.n, "bytes": total.b}
