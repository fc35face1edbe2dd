"""Whole-dataset plans: audit, language views, corrections, slicing, merging, subsetting, writing of dataset trees."""

from __future__ import annotations

import dataclasses
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import model
from ..functions import text
from ..functions.config import canonical
from ..operators import horizon, index, media, merge, segments, stats, subset, vectors, vocab
from ..sources import files, sinks
from . import captions, documents, rules

FRAME = ["episode_index", "frame_index", "index"]


class GateError(ValueError):
    """A stage's gate found violations; the first is the message."""


@dataclass(frozen=True)
class Dataset:
    """The tables of one dataset.  Frames keep their place in the files as `place`."""

    frames: DataFrame
    tasks: DataFrame
    subtasks: DataFrame
    episodes: DataFrame
    annotations: DataFrame | None
    info: dict[str, Any]

    def replaced(self, **tables: Any) -> Dataset:
        return dataclasses.replace(self, **tables)


def _names(df: DataFrame) -> list[str]:
    """The columns of a table, quoted: names may hold dots."""
    return [f"`{c}`" for c in df.columns]


def load(spark: SparkSession, root: str, columns: list[str] | None = None) -> Dataset:
    frames = index.file_positions(files.frames(spark, root, columns)).drop("file_path", "row_index")
    said = files.info(spark, root).first()
    return Dataset(
        frames,
        files.vocabulary(spark, f"{root}/meta/tasks.parquet", "task_index", "task"),
        files.vocabulary(spark, f"{root}/meta/subtasks.parquet", "subtask_index", "subtask"),
        files.episodes(spark, root).drop("file_path", "row_index"),
        files.annotations(spark, root),
        (said.asDict(True) if said else {}) | {"root": root},
    )


def preflight(data: Dataset) -> DataFrame:
    """Integrity violations, by files' order."""
    totals = (data.info.get("total_episodes"), data.info.get("total_frames"))
    words = {"tasks": (data.tasks, "task_index", "task"), "subtasks": (data.subtasks, "subtask_index", "subtask")}
    return rules.preflight(data.frames, data.episodes, words, data.annotations, totals if None not in totals else None, "place", True)


def caption_audit(data: Dataset, mode: str, phases: int = 5, overall: str | None = None, vocabulary: list[str] | None = None, expected_episodes: int | None = None) -> captions.Audit:
    """The language contract of every episode, and which prompts each has."""
    assert data.annotations is not None
    return captions.audit(
        data.frames, data.episodes, data.annotations, data.tasks, data.subtasks, mode, phases, data.info.get("total_episodes"), expected_episodes, overall, vocabulary
    )


def boundary_manifest(data: Dataset, steps: int) -> tuple[DataFrame, DataFrame]:
    """(starts, statistics) of action horizons that cross a subtask boundary."""
    order = ["frame_index", "subtask_index", "index"]
    return horizon.boundary_starts(data.frames, "subtask_index", order, steps), horizon.boundary_stats(data.frames, "subtask_index", order, steps)


#: Language views: whether each subtask has a prompt of its own.
VARIANTS = {"full_episode": False, "per_subtask": True, "mapped_subtask": True}


def chosen_variants(names: list[str]) -> list[str]:
    if unknown := sorted(set(names) - set(VARIANTS)):
        raise ValueError(f"unknown variants: {', '.join(unknown)}")
    return [v for v in VARIANTS if v in names]


def language_view(data: Dataset, variant: str, overall: str = "", mapped: dict[str, str] | None = None) -> Dataset:
    """The dataset with other prompts: one for the whole episode, the subtasks' texts, or mapped ones.  Only task
    indices, the task table, the episodes' task lists and their statistics change."""
    own = VARIANTS[variant]
    kind = data.frames.schema["task_index"].dataType
    frames = data.frames.withColumn("task_index", vocab.prompt_index(own, size=data.subtasks.count()).cast(kind))
    tasks = prompts(data, variant, overall, mapped)
    lists = _task_lists(frames, tasks)
    episodes = refreshed(data.episodes.drop("tasks").join(lists, "episode_index"), frames, ["task_index"])
    return data.replaced(frames=frames, tasks=tasks, episodes=episodes.select(*_names(data.episodes)), info=data.info | {"total_tasks": tasks.count()})


def prompts(data: Dataset, variant: str, overall: str = "", mapped: dict[str, str] | None = None) -> DataFrame:
    """The task table of a language view."""
    if not VARIANTS[variant]:
        return data.subtasks.sparkSession.createDataFrame([(0, overall)], "task_index long, task string")
    return data.subtasks.select(F.col("subtask_index").alias("task_index"), text.replaced(F.col("subtask"), mapped or {}).alias("task"))


def line_view(frames: DataFrame, episodes: DataFrame, episode_stats: DataFrame, tasks: DataFrame, own: bool, size: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """A language view of a tree whose metadata are JSON lines: frames (task index and its annotation), episodes with their
    task lists, and per-episode statistics with those of the task index.

    episodes: episode_index, tasks; episode_stats: episode_index, stats (a map from feature to a map from statistic to values)."""
    new = frames.withColumn("task_index", vocab.prompt_index(own, size=size).cast(frames.schema["task_index"].dataType))
    note = "annotation.human.task_description"
    if note not in frames.columns:
        raise ValueError(f"frames lack {note}")
    new = new.withColumn(note, F.col("task_index"))
    lists = _task_lists(new, tasks)
    found = stats.column_stats(new, ["task_index"], ["episode_index"])
    one = F.create_map(*(x for n in ("mean", "std", "min", "max", "count") for x in (F.lit(n), F.array(F.col(n).cast("double")))))
    found = found.select("episode_index", F.create_map(F.lit("task_index"), one).alias("__new"))
    old = F.map_filter(F.coalesce("stats", F.create_map().cast("map<string,map<string,array<double>>>")), lambda k, v: k != "task_index")
    out = episode_stats.join(found, "episode_index").withColumn("stats", F.map_concat(old, "__new")).select(*_names(episode_stats))
    return new, episodes.drop("tasks").join(lists, "episode_index").select(*_names(episodes)), out


def write_boundary_manifest(starts: DataFrame, root: str) -> tuple[str, str]:
    """Writes the crossing starts below a tree's metadata; the path below the root and the SHA-256 of the file's bytes."""
    path = "meta/language_h40_boundary_starts.parquet"
    sinks.table(starts.select(*(f.split()[0] for f in model.BOUNDARY_STARTS.split(", "))), f"{root}/{path}", ["episode_index", "frame_index"], 1)
    parts = files.files(starts.sparkSession, f"{root}/{path}", "*.parquet")
    return path, parts.select(F.sha2("content", 256).alias("h")).first().h


def rich_subtasks(data: Dataset, phases: int = 5) -> list[str]:
    """The subtasks' texts in order; there must be just so many, numbered from 0, none blank."""
    rows = data.subtasks.orderBy("subtask_index").collect()  # a vocabulary
    if [r.subtask_index for r in rows] != list(range(phases)) or not all((r.subtask or "").strip() for r in rows):
        raise ValueError(f"expected {phases} contiguous subtasks")
    return [r.subtask for r in rows]


def parent_problems(info: dict[str, Any], present: list[str], version: str, receipt: str | None = None) -> list[str]:
    """Why a tree can't be the parent of language views."""
    return (
        [] if info.get("codebase_version") == version else [f"expected {version}, observed {info.get('codebase_version')}"]
    ) + ([f"missing parent {receipt}"] if receipt and receipt not in present else [])


def variants(source: Dataset, prepared: Dataset, requested: list[str], overall: str, mapped: dict[str, str] | None = None) -> dict[str, tuple[Dataset, Dataset]]:
    """Of both frame trees each requested language view, in the order of VARIANTS; the trees must share their subtasks."""
    if rich_subtasks(source) != rich_subtasks(prepared):
        raise ValueError("source and prepared subtask vocabularies differ")
    return {v: (language_view(source, v, overall, mapped), language_view(prepared, v, overall, mapped)) for v in chosen_variants(requested)}


INTEGERS = ("index", "episode_index", "frame_index", "task_index", "subtask_index")


def refreshed(episodes: DataFrame, frames: DataFrame, columns: list[str] | tuple[str, ...] = INTEGERS) -> DataFrame:
    """Episode rows with their `stats/<column>/<stat>` arrays recomputed from the frames, where the columns exist."""
    there = [(c, n) for c in columns for n in ("mean", "std", "min", "max", "count") if f"stats/{c}/{n}" in episodes.columns]
    if not there:
        return episodes
    found = stats.column_stats(frames, sorted({c for c, _ in there}), ["episode_index"])
    wide = found.groupBy("episode_index").agg(
        *(F.max(F.when(F.col("feature") == c, F.array(F.col(n).cast(episodes.schema[f"stats/{c}/{n}"].dataType.elementType)))).alias(f"new/{c}/{n}") for c, n in there)
    )
    out = episodes.join(wide, "episode_index")
    for c, n in there:
        out = out.withColumn(f"stats/{c}/{n}", F.col(f"`new/{c}/{n}`"))
    return out.select(*_names(episodes))


def global_stats(frames: DataFrame, episodes: DataFrame, columns: list[str] | tuple[str, ...] = INTEGERS) -> DataFrame:
    """(feature, dim, mean, std, min, max, count): integer columns over all frames, every other feature pooled from its
    per-episode statistics; a feature that lacks one of them in some episode is an error."""
    own = stats.column_stats(frames, [c for c in columns if c in frames.columns]).withColumn("dim", F.lit(0))
    names = sorted({c.split("/")[1] for c in episodes.columns if c.startswith("stats/")} - set(columns))
    order = ["feature", "dim", "mean", "std", "min", "max", "count"]
    for f in names:
        part = [F.col(f"`stats/{f}/{n}`").alias(n) for n in ("mean", "std", "min", "max", "count")]
        rows = episodes.select(*part).select(F.posexplode(F.arrays_zip("mean", "std", "min", "max")).alias("dim", "s"), F.element_at("count", 1).alias("count")).select(
            F.lit(f).alias("feature"),
            "dim",
            *(F.col(f"s.{n}").cast("double").alias(n) for n in ("mean", "std", "min", "max")),
            "count"
        )
        whole = F.when(
            F.col("mean").isNull() | F.col("std").isNull() | F.col("min").isNull() | F.col("max").isNull() | F.col("count").isNull(),
            F.raise_error(F.lit(f"incomplete statistics of {f}")).cast("double")
        ).otherwise(F.col("mean"))
        own = own.select(order).unionByName(stats.pooled(rows.withColumn("mean", whole), ["feature", "dim"]).select(order))
    return own.select(order)


def _task_lists(frames: DataFrame, tasks: DataFrame) -> DataFrame:
    """Per episode the prompts' texts, consecutive repeats removed."""
    starts = segments.with_runs(frames, "task_index", ["frame_index"]).where("changed").join(tasks, "task_index", "left")
    lists = starts.groupBy("episode_index").agg(F.array_sort(F.collect_list(F.struct("run", "task"))).alias("t"))
    return lists.select("episode_index", F.transform("t", lambda x: x["task"]).alias("tasks"))


def corrected(data: Dataset, pairs: dict[str, str], phases: int = 5) -> tuple[Dataset, DataFrame]:
    """The dataset with instructions replaced where they match exactly, and (old, found, expected) counts: each must be
    once in the vocabulary, and once in every episode and every annotation, else it is an error."""
    assert data.annotations is not None
    said = data.subtasks.select(F.col("subtask").alias("old"))
    for rows, field in ((data.episodes, F.col("subtask_instructions")), (data.annotations, F.transform("sub_task_annotation", lambda b: b["sub_task_instruction"]))):
        checked = F.when(F.size(field) == phases, field).otherwise(F.raise_error(F.lit(f"not {phases} instructions")).cast("array<string>"))
        said = said.unionAll(rows.select(F.explode(checked).alias("old")))
    want = 1 + data.episodes.count() + data.annotations.count()
    spark = data.frames.sparkSession
    asked = spark.createDataFrame([(k,) for k in pairs], "old string")
    counts = exact_counts(said, asked, want)
    wrong = counts.where("found <> expected").orderBy("old").first()
    if wrong is not None:
        raise GateError(f"{wrong.old!r}: found {wrong.found} times, expected {wrong.expected}")
    out = data.replaced(
        subtasks=data.subtasks.withColumn("subtask", text.replaced(F.col("subtask"), pairs)),
        episodes=data.episodes.withColumn("subtask_instructions", text.replaced_list(F.col("subtask_instructions"), pairs)),
        annotations=data.annotations.withColumn("sub_task_annotation", text.replaced_blocks(F.col("sub_task_annotation"), pairs)),
    )
    return out, counts


def exact_counts(said: DataFrame, asked: DataFrame, expected: int) -> DataFrame:
    """(old, found, expected): how often each asked text stands among those said."""
    found = asked.distinct().join(said.groupBy("old").agg(F.count("*").alias("found")), "old", "left")
    return found.select("old", F.coalesce("found", F.lit(0)).cast("long").alias("found"), F.lit(expected).cast("long").alias("expected"))


def sliced_stats(rows: DataFrame, dims: dict[str, list[int]]) -> DataFrame:
    """Global statistics (feature, stat, dim, value) with the features' dimensions cut to those given, renumbered in their
    order; counts and other features stay."""
    spark = rows.sparkSession
    keep = spark.createDataFrame([(f, old, new) for f, ds in dims.items() for new, old in enumerate(ds)], "f string, old int, new int")
    cut = F.col("feature").isin(list(dims)) & (F.col("stat") != "count")
    inner = rows.where(cut).join(F.broadcast(keep), (F.col("feature") == F.col("f")) & (F.col("dim") == F.col("old")))
    return rows.where(~cut).select("feature", "stat", "dim", "value").unionAll(inner.select("feature", "stat", F.col("new").alias("dim"), "value"))


def letterboxed_stats(rows: DataFrame, camera: str, kept: float = 0.75) -> DataFrame:
    """Global statistics (feature, stat, dim, value) with a camera's moments as they are when the rest of its picture is black."""
    mine = rows.where((F.col("feature") == camera) & F.col("stat").isin("mean", "std"))
    both = mine.groupBy("feature", "dim").agg(
        F.max(F.when(F.col("stat") == "mean", F.col("value"))).alias("m"),
        F.max(F.when(F.col("stat") == "std", F.col("value"))).alias("s")
    ).where("m is not null and s is not null")
    mean, std = stats.padded_moments(F.col("m"), F.col("s"), kept)
    new = both.select("feature", F.explode(F.create_map(F.lit("mean"), mean, F.lit("std"), std)).alias("stat", "new"), "dim")
    return rows.join(new, ["feature", "stat", "dim"], "left").select("feature", "stat", "dim", F.coalesce("new", "value").alias("value"))


def derivative_problems(data: Dataset, frames: int, dims: dict[str, int], probes: DataFrame, cameras: dict[str, int], fps: float, tolerance: float, max_gop: int) -> list[str]:
    """Why a derivative can't be used: task texts, vectors of another size, frames lost, videos that aren't as they must be.

    probes: camera and the columns of `media.acceptable`; cameras: videos expected of each."""
    out = [f"task {r.task!r} is {r.problem}" for r in vocab.task_problems(data.tasks).collect()]
    for column, n in dims.items():
        if not data.frames.where(~F.size(F.col(f"`{column}`")).eqNullSafe(n)).isEmpty():
            out.append(f"{column} isn't {n}-dimensional")
    if (found := data.frames.count()) != frames:
        out.append(f"frame count changed: {frames} -> {found}")
    good = media.acceptable(640, 480, fps, tolerance, "h264", max_gop)
    videos = {r.camera: (r.n, r.bad) for r in probes.groupBy("camera").agg(F.count("*").alias("n"), F.count_if(~F.coalesce(good, F.lit(False))).alias("bad")).collect()}
    for camera, n in cameras.items():
        there, bad = videos.get(camera, (0, 0))
        out += [f"{camera}: {there} videos, expected {n}"] if there != n else []
        out += [f"{camera}: {bad} videos of another format"] if bad else []
    return out


def task_table(old: DataFrame, new: DataFrame) -> DataFrame:
    """A task table with other prompts in the columns of the old one; a name that all tasks share stays."""
    if "task_name" not in old.columns:
        return new.select(*_names(old))
    name = old.agg(F.min_by("task_name", "task_index").alias("task_name"))  # one row
    return new.drop("task_name").join(F.broadcast(name)).select(*_names(old))


def prepared(data: Dataset, names: list[str], cameras: dict[str, list[int]], fps: float) -> Dataset:
    """The derivative that trainers read: vectors cut to the named controls, task texts checked, info to match."""
    wrong = documents.source_problems(data.info, names, cameras, fps) + [f"task {r.task!r} is {r.problem}" for r in vocab.task_problems(data.tasks).collect()]
    if wrong:
        raise GateError("; ".join(wrong))
    vectors_of = ("observation.state", "action")
    dims = {v: [data.info["features"][v]["names"].index(n) for n in names] for v in vectors_of if v in data.frames.columns}
    return sliced(data, dims).replaced(info=documents.updated_info(data.info, {v: names for v in vectors_of}))


def letterboxed(data: Dataset, statistics: DataFrame, names: list[str], dims: dict[str, int], camera: str, height: int = 480, width: int = 640) -> tuple[Dataset, DataFrame]:
    """The older derivative: the first controls of each vector, and one camera's picture in a black frame, in the info, the
    global statistics (feature, stat, dim, value) and the episodes'."""
    keep = documents.control_positions(data.info, names, dims)
    info = documents.letterboxed_info(documents.updated_info(data.info, {v: names for v in keep}), camera, height, width)
    out = sliced(data, {v: k for v, k in keep.items() if v in data.frames.columns})
    mean, std = (f"stats/{camera}/{n}" for n in ("mean", "std"))
    episodes = out.episodes
    if mean in episodes.columns and std in episodes.columns:
        both = F.zip_with(F.col(f"`{mean}`"), F.col(f"`{std}`"), lambda m, s: F.struct(*(c.alias(n) for c, n in zip(stats.padded_moments(m, s), "ms", strict=True))))
        rows = episodes.withColumn("__b", both)
        episodes = rows.withColumn(mean, F.transform("__b", lambda x: x["m"])).withColumn(std, F.transform("__b", lambda x: x["s"])).drop("__b")
    return out.replaced(episodes=episodes, info=info), letterboxed_stats(sliced_stats(statistics, keep), camera)


def dataset_totals(data: Dataset) -> dict[str, int]:
    """Episodes, frames, and captions checked: of both vocabularies, of both of the episodes' lists and of the annotations."""
    of = lambda df, *lists: df.agg(*(F.coalesce(F.sum(F.coalesce(F.size(c), F.lit(0))), F.lit(0)) for c in lists)).first() if lists else (0,)
    said = data.tasks.count() + data.subtasks.count() + sum(of(data.episodes, *(c for c in rules.CAPTION_LISTS if c in data.episodes.columns)))
    if data.annotations is not None:
        said += sum(of(data.annotations, "sub_task_annotation"))
    seen = data.frames.agg(F.count_distinct("episode_index").alias("e"), F.count("*").alias("f")).first()
    return {"episodes": seen.e, "frames": seen.f, "captions_checked": said}


def sliced(data: Dataset, dims: dict[str, list[int]]) -> Dataset:
    """Vector columns and their per-episode statistics reduced to the given dimensions (null statistics stay null)."""
    frames, episodes = data.frames, data.episodes
    for column, keep in dims.items():
        frames = frames.withColumn(column, vectors.select_dims(F.col(f"`{column}`"), keep))
        for c in episodes.columns:
            if c.startswith(f"stats/{column}/") and not c.endswith("/count"):
                kind = episodes.schema[c].dataType.simpleString()
                episodes = episodes.withColumn(c, vectors.select_dims(F.col(f"`{c}`"), keep, kind))
    return data.replaced(frames=frames, episodes=episodes)


def with_language_annotation(frames: DataFrame, column: str = "annotation.human.task_description") -> DataFrame:
    """The task index under the annotation's name as well; where it is there already it must be the same."""
    if column not in frames.columns:
        return frames.withColumn(column, F.col("task_index"))
    same = F.when(F.col(f"`{column}`").eqNullSafe(F.col("task_index")), F.col(f"`{column}`")).otherwise(F.raise_error(F.lit("annotation differs from task_index")).cast("long"))
    return frames.withColumn(column, same)


def merged(sources: list[Dataset]) -> Dataset:
    """Datasets as one, in the order given: vocabularies united by text, episodes compacted and shifted, the index
    contiguous, task and subtask indices re-encoded, per-episode tasks and index statistics refreshed."""
    if len(sources) < 2:
        raise ValueError("a merge takes two sources at least")
    tag = lambda part, k: part.withColumn(merge.SOURCE, F.lit(k))
    union = lambda of: _union([tag(of(s), k) for k, s in enumerate(sources)])
    rows, tasks, words = union(lambda s: s.frames), union(lambda s: s.tasks), union(lambda s: s.subtasks)
    spark = rows.sparkSession
    said_of = [(k, str(s.info.get("root", k)), s.info.get("annotation_path"), {f: canonical(v) for f, v in documents.feature_view(s.info).items()}) for k, s in enumerate(sources)]
    gates = merge.gates(spark.createDataFrame(said_of, "source_id int, root string, annotation_path string, features map<string,string>"))
    shared = [c for c in tasks.columns if c not in ("task_index", "task", merge.SOURCE)]
    gates = gates.unionAll(vocab.conflicts(tasks, "task", shared).select(F.lit("vocabulary").alias("rule"), F.col("task").alias("location"))) if shared else gates
    broken = gates.orderBy("rule", "location").first()
    if broken is not None:
        raise GateError(f"{broken.rule}: {broken.location}")
    new_tasks, new_words = vocab.union(tasks, "task_index", "task"), vocab.union(words, "subtask_index", "subtask")
    ids = merge.compacted(rows)
    frames = merge.frames(rows, words, ["frame_index"], ids=ids).withColumn("new_task_index", F.col("task_index"))
    known = vocab.mapping(tasks, new_tasks, "task_index", "task").select(merge.SOURCE, F.col("task_index").alias("new_task_index"), F.col("new_task_index").alias("__new"))
    frames = vocab.remap(frames, known, [merge.SOURCE, "new_task_index"], "__new")
    lists = segments.first_seen(
        frames.select("new_episode", "place", "new_task_index").join(new_tasks, F.col("new_task_index") == F.col("task_index")),
        "task",
        ["place"],
        "new_episode"
    ).select("new_episode", F.col("values").alias("tasks"))
    meta = union(lambda s: s.episodes.drop("length", "dataset_from_index", "dataset_to_index", "tasks")).join(ids, [merge.SOURCE, "episode_index"])
    meta = meta.withColumn("dataset_to_index", F.col("dataset_from_index") + F.col("length"))
    meta = meta.join(lists, "new_episode").withColumn("full_episode_index", F.col("new_episode")).withColumn("episode_index", F.col("new_episode")).drop(merge.SOURCE, "new_episode")
    out = frames.withColumn(
        "task_index",
        F.col("new_task_index")
    ).withColumn(
        "subtask_index",
        F.col("new_subtask")
    ).withColumn(
        "episode_index",
        F.col("new_episode")
    ).withColumn("frame_index", F.col("place")).withColumn("index", F.col("new_index")).withColumn("place", F.col("new_index"))
    said = None
    if all(s.annotations is not None for s in sources):
        said = merge.annotations(union(lambda s: s.annotations), ids).drop(merge.SOURCE)
    total = {k: sum(s.info.get(k) or 0 for s in sources) for k in ("total_episodes", "total_frames")} | {"total_tasks": new_tasks.count()}
    meta = refreshed(meta, out)
    return Dataset(out.select(*_names(sources[0].frames)), new_tasks, new_words, meta, said, sources[0].info | total)


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def essential(data: Dataset, exclusions: DataFrame, fps: float, cameras: list[str] = ()) -> Dataset:  # type: ignore[assignment]
    """What is left without the excluded (episode_index, subtask_index) pairs, every stretch as an episode of its own."""
    flags = subset.flagged(data.frames, exclusions, ["frame_index"])
    kept = subset.islands(flags)
    found = subset.segments(kept)
    frames = subset.reindexed(kept, found, fps)
    runs = segments.run_segments(frames.select(F.col("new_episode").alias("episode_index"), F.col("new_frame").alias("frame_index"), "subtask_index"), "subtask_index", ["frame_index"])
    said = segments.annotation_blocks(runs.join(data.subtasks, "subtask_index"), "subtask_index", "subtask")
    if data.annotations is not None and "task_name" in data.annotations.columns:
        names = found.join(
            data.annotations.select(F.col("episode_index").alias("source_episode"), "task_name"),
            "source_episode",
            "left"
        ).select(F.col("new_episode").alias("episode_index"), "task_name")
        said = said.join(names, "episode_index")
    out = frames.withColumn(
        "episode_index",
        F.col("new_episode")
    ).withColumn("frame_index", F.col("new_frame")).withColumn("index", F.col("new_index")).withColumn("place", F.col("new_index"))
    if "timestamp" in data.frames.columns:
        out = out.withColumn("timestamp", F.col("new_timestamp"))
    return data.replaced(frames=out.select(*_names(data.frames)), episodes=subset.episode_rows(found, data.episodes, list(cameras), fps).drop("start_frame", "end_frame"), annotations=said)


def pipeline(data: Dataset, mode: str, dims: dict[str, list[int]], steps: int, phases: int = 5, overall: str | None = None, vocabulary: list[str] | None = None) -> tuple[Dataset, dict[str, Any]]:
    """Preflight, caption audit, slicing, preflight again, boundary report: each stage only if the gate before it is clean."""
    report: dict[str, Any] = {}

    def gate(name: str, found: DataFrame | captions.Audit) -> None:
        worst = rules.first(found) if isinstance(found, DataFrame) else found.first()
        if worst is not None:
            raise GateError(f"{name}: {worst.rule} at {worst.location}: expected {worst.expected}, observed {worst.observed}")
        report[name] = "ready"

    gate("preflight", preflight(data))
    gate("captions", caption_audit(data, mode, phases, overall, vocabulary))
    out = sliced(data, dims)
    frames, after = data.frames.count(), out.frames.count()
    if frames != after:
        raise GateError(f"slices: {after} frames, expected {frames}")
    gate("slices", preflight(out))
    report["boundaries"] = boundary_manifest(out, steps)[1].first().asDict()
    return out, report
