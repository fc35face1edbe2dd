"""The caption contract of a dataset, audited in one pass an episode.

Frames are shuffled by episode once.  One window numbers them and marks where the prompt and the subtask change; one
aggregation over the same partitioning leaves a row an episode with its runs as ordered arrays.  That table is written;
texts, metadata and annotation files join it by episode, sorted and never broadcast, as a written table's compressed files say little
of the memory that its rows take; and everything the contract says of an episode is an expression over
arrays of that row: violations with their rules, and the episode's summary.

Rules come in the order in which a fail-fast audit would raise them: those of the whole dataset, then all of the first
episode, all of the second, and so on, and the prompts' mode last.  A rule is judged wherever it can be: a missing metadata
row or a number of annotation files other than one leaves out what would be compared with it.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import problem_free
from ..operators.index import bounds_of_ids
from ..sources import files
from ..tables import written

#: What an episode's prompts are called if they follow the asked mode, and if they don't.
MODES = {
    "full_episode": ("full_episode_prompt_with_subtask_annotations", "invalid_full_episode_task_mapping"),
    "per_subtask": ("per_frame_subtasks_visible_to_training", "invalid_per_subtask_task_mapping"),
    "mapped_subtask": ("mapped_subtasks_visible_with_rich_annotations", "invalid_mapped_subtask_task_mapping"),
}
#: Rules of an episode in their order.
EPISODE_RULES = (
    "frame_index", "task_index", "subtask_index", "subtask_order", "episode_metadata", "episode_length", "subtask_instructions", "annotation_file", "task_duration",
    "valid_duration", "annotation_segments", "annotation_order", "annotation_caption", "annotation_frame_range",
)
_SPANS = "struct<task_duration: bigint, valid_duration: array<bigint>>"


@dataclass(frozen=True)
class Audit:
    """violations: rule, rule_order, episode_index, segment, location, expected, observed; summaries: a row an episode; mode:
    what every episode's mode must be."""

    violations: DataFrame
    summaries: DataFrame
    mode: str

    def first(self):
        """The violation a fail-fast audit would raise, or None."""
        stage = F.when(F.col("rule") == "mode", 2).when(F.col("episode_index").isNotNull(), 1).otherwise(0)
        return self.violations.orderBy(stage, F.col("episode_index"), "rule_order", "segment").first()

    def modes(self) -> DataFrame:
        """One row: the modes found, and whether they are just the expected one."""
        found = self.summaries.agg(F.array_sort(F.collect_set("mode")).alias("modes"))
        return found.select(F.array_join("modes", ",").alias("modes"), (F.col("modes") == F.array(F.lit(self.mode))).alias("ready"))


def _shown(values: Column) -> Column:
    return F.concat(F.lit("["), F.array_join(F.transform(values, lambda v: v.cast("string")), ", ", "none"), F.lit("]"))


def episode_runs(frames: DataFrame) -> DataFrame:
    """Per episode: frames, whether frame_index is 0, 1, ..., tasks and subtasks as arrays of (value, start, end)."""
    w = Window.partitionBy("episode_index").orderBy("frame_index", "task_index", "subtask_index")
    pos = (F.row_number().over(w) - 1).cast("long")
    rows = frames.select("episode_index", "frame_index", "task_index", "subtask_index", pos.alias("pos"))
    change = lambda c: (F.col("pos") == 0) | ~F.lag(c).over(w).eqNullSafe(F.col(c))
    rows = rows.select("*", change("task_index").alias("t"), change("subtask_index").alias("s"))
    starts = lambda flag, c: F.array_sort(F.collect_list(F.when(F.col(flag), F.struct(F.col("pos").alias("start"), F.col(c).cast("long").alias("value")))))
    out = rows.groupBy("episode_index").agg(
        F.count("*").alias("frames"), F.count_if(~F.col("frame_index").eqNullSafe(F.col("pos"))).alias("misplaced"), starts("t", "task_index").alias("t"),
        starts("s", "subtask_index").alias("s"),
    )
    ended = lambda c: F.transform(
        c, lambda r, i: F.struct(r["value"].alias("value"), r["start"].alias("start"), F.coalesce(F.get(F.col(c), i + 1)["start"], F.col("frames")).alias("end"))
    )
    return out.select("episode_index", "frames", "misplaced", ended("t").alias("task_runs"), ended("s").alias("subtask_runs"))


def _texts(per: DataFrame, runs: str, vocabulary: DataFrame, index: str, text: str, name: str) -> DataFrame:
    """(episode_index, name): the texts of an episode's runs, null where the vocabulary has none."""
    known = vocabulary.groupBy(F.col(index).cast("long").alias("known")).agg(F.max(text).alias("said"))
    each = per.select("episode_index", F.posexplode(runs).alias("p", "r")).join(known, F.col("r.value") == F.col("known"), "left")
    return each.groupBy("episode_index").agg(F.transform(F.array_sort(F.collect_list(F.struct("p", "said"))), lambda x: x["said"]).alias(name))


def facts(frames: DataFrame, episodes: DataFrame, annotations: DataFrame, tasks: DataFrame, subtasks: DataFrame) -> DataFrame:
    """Per observed episode its runs and their texts, metadata and annotation, as one row."""
    per = written(episode_runs(frames), "runs")
    fields = ["length", "tasks", "subtask_instructions"]
    if {"file_path", "row_index"} <= set(episodes.columns):  # of repeated rows the last one in path order counts
        episodes = files.last_episodes(episodes, fields)
    meta = episodes.groupBy(F.col("episode_index").alias("m")).agg(F.any_value(F.struct(*fields)).alias("meta"))
    path = F.col("path") if "path" in annotations.columns else F.lit(None).cast("string")
    spans = F.col("meta_data") if "meta_data" in annotations.columns else F.lit(None).cast(_SPANS)
    said = annotations.select(F.col("episode_index").alias("a"), F.struct(path.alias("path"), spans.alias("meta_data"), "sub_task_annotation").alias("note"))
    said = said.groupBy("a").agg(F.count("*").alias("files"), F.any_value("note").alias("note"))
    out = per.join(_texts(per, "task_runs", tasks, "task_index", "task", "prompts").hint("merge"), "episode_index")
    out = out.join(_texts(per, "subtask_runs", subtasks, "subtask_index", "subtask", "captions").hint("merge"), "episode_index")
    out = out.join(meta.hint("merge"), F.col("episode_index") == F.col("m"), "left").join(said.hint("merge"), F.col("episode_index") == F.col("a"), "left")
    return out.drop("m", "a").withColumn("files", F.coalesce("files", F.lit(0)))


def _values(runs: str) -> Column:
    return F.transform(runs, lambda r: r["value"])


def mode_of(mode: str, phases: int, overall: Column | None = None) -> Column:
    """Of a row of facts: what its prompts are, judged by the asked mode.  `overall`: the text of prompt 0."""
    order = F.array(*(F.lit(k).cast("long") for k in range(phases)))
    prompts, said = _values("task_runs"), F.col("meta.tasks")
    if mode == "full_episode":
        fits = prompts.eqNullSafe(F.array(F.lit(0).cast("long"))) & said.eqNullSafe(F.array(overall))
    elif mode == "per_subtask":
        fits = prompts.eqNullSafe(order) & F.col("prompts").eqNullSafe(F.col("captions")) & said.eqNullSafe(F.col("prompts"))
    else:
        fits = prompts.eqNullSafe(order) & _values("subtask_runs").eqNullSafe(order) & said.eqNullSafe(F.col("prompts"))
    good, bad = MODES[mode]
    return F.when(fits, good).otherwise(bad)


def summaries(found: DataFrame, mode: Column) -> DataFrame:
    """A row an episode, as the report lists them."""
    return found.select(
        "episode_index", "frames", mode.alias("mode"), _values("task_runs").alias("task_run_indices"), F.col("prompts").alias("training_captions"),
        _values("subtask_runs").alias("subtask_run_indices"), F.col("captions").alias("stored_subtask_captions"), F.col("note.path").alias("annotation"),
    )


def episode_violations(found: DataFrame, phases: int, mode: Column, expected_mode: str) -> DataFrame:
    order = F.array(*(F.lit(k).cast("long") for k in range(phases)))
    text = F.col("captions")
    number = {rule: 20 + k for k, rule in enumerate(EPISODE_RULES)} | {"mode": 60}
    known, one = F.col("meta").isNotNull(), F.col("files") == 1
    entries, runs = F.col("note.sub_task_annotation"), F.col("subtask_runs")

    def row(rule: str, expected: Column, observed: Column, segment: Column | None = None) -> Column:
        return F.struct(
            F.lit(rule).alias("rule"), F.lit(number[rule]).alias("rule_order"), (F.lit(None) if segment is None else segment).cast("int").alias("segment"),
            expected.cast("string").alias("expected"), observed.cast("string").alias("observed"),
        )

    def once(rule: str, wrong: Column, expected: Column, observed: Column) -> Column:
        return F.when(F.coalesce(wrong, F.lit(True)), F.array(row(rule, expected, observed)))

    def each(rule: str, expected, observed) -> Column:
        """An entry at a time, where there are as many as runs: what the run says, and what the entry says."""
        both = F.transform(runs, lambda r, i: F.struct(i.alias("i"), expected(r, i).cast("string").alias("x"), observed(F.get(entries, i)).cast("string").alias("y")))
        wrong = F.transform(F.filter(both, lambda b: ~b["x"].eqNullSafe(b["y"])), lambda b: row(rule, b["x"], b["y"], b["i"]))
        return F.when(one & (F.size(entries) == F.size(runs)), wrong)

    unresolved = lambda values, texts: F.array_distinct(F.filter(F.zip_with(values, texts, lambda v, t: F.when(t.isNull(), F.coalesce(v, F.lit(-1)))), lambda v: v.isNotNull()))
    no_task, no_word = unresolved(_values("task_runs"), F.col("prompts")), unresolved(_values("subtask_runs"), text)
    span = F.array(F.lit(0).cast("long"), F.col("frames"))
    rules = [
        once("frame_index", F.col("misplaced") > 0, F.lit("0, 1, ..."), F.concat("misplaced", F.lit(" frames out of place"))),
        once("task_index", F.size(no_task) > 0, F.lit("in the vocabulary"), _shown(no_task)),
        once("subtask_index", F.size(no_word) > 0, F.lit("in the vocabulary"), _shown(no_word)),
        once("subtask_order", ~_values("subtask_runs").eqNullSafe(order), _shown(order), _shown(_values("subtask_runs"))),
        once("episode_metadata", ~known, F.lit("a metadata row"), F.lit("none")),
        once("episode_length", known & ~F.col("meta.length").eqNullSafe(F.col("frames")), F.col("frames"), F.coalesce(F.col("meta.length").cast("string"), F.lit("none"))),
        once("subtask_instructions", known & ~F.col("meta.subtask_instructions").eqNullSafe(text), _shown(text), F.coalesce(_shown(F.col("meta.subtask_instructions")), F.lit("none"))),
        once("annotation_file", ~one, F.lit(1), F.col("files")),
        once("task_duration", one & ~F.col("note.meta_data.task_duration").eqNullSafe(F.col("frames")), F.col("frames"), F.coalesce(F.col("note.meta_data.task_duration").cast("string"), F.lit("none"))),
        once("valid_duration", one & ~F.col("note.meta_data.valid_duration").eqNullSafe(span), _shown(span), F.coalesce(_shown(F.col("note.meta_data.valid_duration")), F.lit("none"))),
        once("annotation_segments", one & ~F.size(entries).eqNullSafe(F.size(runs)), F.size(runs), F.size(entries)),
        each("annotation_order", lambda r, i: r["value"], lambda e: e["sub_task_idx"]),
        each("annotation_caption", lambda r, i: F.get(text, i), lambda e: e["sub_task_instruction"]),
        each("annotation_frame_range", lambda r, i: _shown(F.array(r["start"], r["end"])), lambda e: _shown(e["frame_duration"])),
        once("mode", mode != expected_mode, F.lit(expected_mode), mode),
    ]
    out = found.select("episode_index", F.explode(F.flatten(F.filter(F.array(*rules), lambda r: r.isNotNull()))).alias("v"))
    place = F.when(F.col("v.segment").isNull(), F.concat(F.lit("episode "), "episode_index")).otherwise(F.concat(F.lit("episode "), "episode_index", F.lit(" segment "), "v.segment"))
    return out.select("v.rule", "v.rule_order", "episode_index", "v.segment", place.alias("location"), "v.expected", "v.observed")


def _of_dataset(rule: str, number: int, rows: DataFrame, expected: Column, observed: Column) -> DataFrame:
    none = F.lit(None)
    return rows.select(
        F.lit(rule).alias("rule"), F.lit(number).alias("rule_order"), none.cast("long").alias("episode_index"), none.cast("int").alias("segment"), F.lit("dataset").alias("location"),
        expected.cast("string").alias("expected"), observed.cast("string").alias("observed"),
    )


def dataset_violations(
    found: DataFrame, tasks: DataFrame, total: int | None, expected_episodes: int | None, overall: str | None, vocabulary: Sequence[str] | None, vocabularies: dict[str, DataFrame]
) -> DataFrame:
    """What the contract says of the whole: vocabularies, and which episodes there are."""
    listed = F.array_sort(F.collect_list(F.struct(F.col("task_index").cast("long").alias("i"), F.col("task").alias("t"))))
    told = lambda c: F.array_join(F.transform(c, lambda x: F.concat_ws(":", x["i"].cast("string"), x["t"])), ", ")
    words = tasks.agg(listed.alias("v"))  # a vocabulary is small: it is what a report prints
    out = []
    for k, (name, table) in enumerate(vocabularies.items()):
        index, text = table.columns[:2]
        ids = bounds_of_ids(table, index)
        out.append(_of_dataset(f"{name}_vocabulary", 2 + 2 * k, ids.where("not dense"), F.lit("0, 1, ..."), F.concat_ws(" to ", "least", "most")))
        out.append(_of_dataset(f"{name}_caption", 3 + 2 * k, table.where(~problem_free(F.col(text))), F.lit("nonempty"), F.coalesce(F.col(text), F.lit("none"))))
    out.append(_of_dataset("tasks_empty", 6, words.where(F.size("v") == 0), F.lit("a prompt"), F.lit("none")))
    for rule, number, wanted in (("overall_task", 7, None if overall is None else [overall]), ("task_vocabulary", 8, vocabulary)):
        if wanted is not None:
            want = F.array(*(F.struct(F.lit(k).cast("long").alias("i"), F.lit(t).alias("t")) for k, t in enumerate(wanted))) if wanted else F.slice("v", 1, 0)
            out.append(_of_dataset(rule, number, words.where(F.col("v") != want), told(want), told(F.col("v"))))
    ids = bounds_of_ids(found, "episode_index")
    out.append(_of_dataset("frames", 10, ids.where("n = 0"), F.lit("data rows"), F.lit("none")))
    out.append(_of_dataset("episode_ids", 11, ids.where("n > 0 and not dense"), F.lit("0, 1, ..."), F.concat_ws(" to ", "least", "most")))
    for rule, number, wanted in (("total_episodes", 12, -1 if total is None else total), ("expected_episodes", 13, expected_episodes)):
        if wanted is not None:
            out.append(_of_dataset(rule, number, ids.where(F.col("n") != wanted), F.lit(wanted), F.col("n")))
    first, *rest = out
    for part in rest:
        first = first.unionAll(part)
    return first


def audit(
    frames: DataFrame,
    episodes: DataFrame,
    annotations: DataFrame,
    tasks: DataFrame,
    subtasks: DataFrame,
    mode: str,
    phases: int = 5,
    total: int | None = None,
    expected_episodes: int | None = None,
    overall: str | None = None,
    vocabulary: Sequence[str] | None = None,
) -> Audit:
    """frames: episode_index, frame_index, task_index, subtask_index; episodes: episode_index, length, tasks, subtask_instructions;
    annotations: a row a file, with episode_index, meta_data, sub_task_annotation and its path; tasks and subtasks: (index,
    text); total: the episodes the dataset declares; overall: the one approved prompt; vocabulary: all prompts in order."""
    if mode not in MODES:
        raise ValueError(f"no such language mode: {mode}")
    if mode == "full_episode" and not overall:
        raise ValueError("full_episode needs the approved prompt")
    if mode == "mapped_subtask" and vocabulary is None:
        raise ValueError("mapped_subtask needs the prompts in order")
    if any(not isinstance(t, str) or not t.strip() for t in vocabulary or ()):
        raise ValueError("a prompt of the vocabulary is empty")
    found = written(facts(frames, episodes, annotations, tasks, subtasks), "facts")
    zero = tasks.where("task_index = 0").agg(F.max("task")).first()[0] if mode == "full_episode" else None
    seen = mode_of(mode, phases, F.lit(zero).cast("string"))
    words = {"task": tasks.select("task_index", "task"), "subtask": subtasks.select("subtask_index", "subtask")}
    whole = dataset_violations(found, tasks, total, expected_episodes, overall, vocabulary, words)
    return Audit(whole.unionAll(episode_violations(found, phases, seen, MODES[mode][0])), summaries(found, seen), MODES[mode][0])
