import itertools
import json

import pytest
from pyspark.sql import functions as F

from episodica.operators import merge
from episodica.plans import captions, datasets, documents, layouts, rules
from episodica.sources import files, sinks


@pytest.fixture()
def tree(spark, tmp_path):
    """One episode of 45 frames, five subtasks of nine frames each."""
    root = tmp_path / "set"
    rows = [(0, k, k, k // 9, k // 9, k / 15) for k in range(45)]
    spark.createDataFrame(
        rows,
        "episode_index long, frame_index long, index long, task_index long, subtask_index long, timestamp double"
    ).withColumn(
        "observation.state",
        F.array(*(F.col("index") + F.lit(float(i)) for i in range(6))).cast("array<float>")
    ).coalesce(1).write.parquet(f"{root}/data/chunk-000")
    words = [(k, f"step {k}") for k in range(5)]
    for name, col in (("tasks", "task"), ("subtasks", "subtask")):
        spark.createDataFrame(words, f"{name[:-1]}_index long, {col} string").coalesce(1).write.parquet(f"{root}/meta/{name}.parquet")
    texts = [w for _, w in words]
    spark.createDataFrame(
        [(0, 45, 0, 45, texts, texts, [22.0], [45])],
        "episode_index long, length long, dataset_from_index long, dataset_to_index long, tasks array<string>, subtask_instructions array<string>, `stats/task_index/mean` array<double>, `stats/task_index/count` array<bigint>"
    ).coalesce(1).write.parquet(f"{root}/meta/episodes/chunk-000")
    note = {"task_name": "t", "meta_data": {"task_duration": 45, "valid_duration": [0, 45]}, "sub_task_annotation": [{"sub_task_idx": k, "sub_task_instruction": f"step {k}", "frame_duration": [9 * k, 9 * k + 9]} for k in range(5)]}
    (root / "annotations/chunk-000").mkdir(parents=True)
    (root / "annotations/chunk-000/episode_000000.json").write_text(json.dumps(note))
    (root / "meta/info.json").write_text(
        json.dumps(
            {
                "codebase_version": "v3.0",
                "fps": 15,
                "total_episodes": 1,
                "total_frames": 45,
                "features": {
                    "observation.state": {"dtype": "float32", "shape": [6], "names": list("abcdef")},
                    "cam": {"dtype": "video", "shape": [3, 480, 640], "info": dict.fromkeys(documents.VIDEO_KEYS, 1)}
                },
                "annotation_path": "annotations"
            }
        )
    )
    return str(root)


def test_clean_tree_passes(spark, tree):
    data = datasets.load(spark, tree)
    assert rules.ready(datasets.preflight(data))
    audit = datasets.caption_audit(data, "per_subtask", 5)
    assert rules.ready(audit.violations) and audit.first() is None and audit.modes().first().ready
    assert audit.summaries.first().annotation == "annotations/chunk-000/episode_000000.json"
    starts, said = datasets.boundary_manifest(data, 40)
    s = said.first()
    assert (s.valid_starts, s.crossing_starts, s.clean_starts, starts.count()) == (6, 6, 0, 6)


@pytest.mark.parametrize(
    ("change", "rule"),
    [
        (lambda d: d.replaced(frames=d.frames.withColumn("index", F.when(F.col("index") == 44, 45).otherwise(F.col("index")))), "global_index"),
        (lambda d: d.replaced(frames=d.frames.withColumn("frame_index", F.when(F.col("index") == 10, 3).otherwise(F.col("frame_index")))), "frame_index"),
        (lambda d: d.replaced(episodes=d.episodes.withColumn("dataset_from_index", F.lit(2).cast("long"))), "episode_dataset_from_index"),
        (lambda d: d.replaced(episodes=d.episodes.union(d.episodes)), "episode_duplicate"),
        (lambda d: d.replaced(episodes=d.episodes.withColumn("episode_index", F.lit(7).cast("long"))), "episode_set"),
        (lambda d: d.replaced(subtasks=d.subtasks.withColumn("subtask", F.concat(F.lit(" "), "subtask"))), "subtasks_caption"),
        (lambda d: d.replaced(tasks=d.tasks.withColumn("task_index", F.col("task_index") + 1)), "tasks_contiguous"),
        (lambda d: d.replaced(episodes=d.episodes.withColumn("subtask_instructions", F.array(F.lit("a  b")))), "episode_caption"),
        (lambda d: d.replaced(episodes=d.episodes.withColumn("tasks", F.array(F.lit(" a")))), "episode_caption"),
        (lambda d: d.replaced(frames=d.frames.withColumn("episode_index", F.col("episode_index") + 1)), "episode_ids"),
        (lambda d: d.replaced(frames=d.frames.where("false")), "data_empty"),
        (lambda d: d.replaced(episodes=d.episodes.where("false")), "episodes_empty"),
        (
            lambda d: d.replaced(
                annotations=d.annotations.withColumn(
                    "sub_task_annotation",
                    F.transform("sub_task_annotation", lambda b: b.withField("sub_task_instruction", F.lit("a\tb")))
                )
            ),
            "annotation_caption"
        ),
        (lambda d: d.replaced(info=d.info | {"total_frames": 46}), "total_frames"),
        (lambda d: d.replaced(info=d.info | {"total_episodes": 2}), "total_episodes"),
    ],
)
def test_each_defect_is_found(spark, tree, change, rule):
    found = datasets.preflight(change(datasets.load(spark, tree)))
    assert rule in {r.rule for r in found.collect()}
    assert rules.first(found) is not None


def test_annotation_ranges_and_modes(spark, tree):
    data = datasets.load(spark, tree)
    moved = data.replaced(
        annotations=data.annotations.withColumn(
            "sub_task_annotation",
            F.transform(
                "sub_task_annotation",
                lambda b, k: b.withField("frame_duration", F.when(k == 1, F.array(F.lit(9), F.lit(17)).cast("array<bigint>")).otherwise(b["frame_duration"]))
            )
        )
    )
    assert [r.rule for r in datasets.caption_audit(moved, "per_subtask").violations.collect()] == ["annotation_frame_range"]
    other = data.replaced(tasks=data.tasks.withColumn("task", F.concat(F.lit("do "), "task")))
    told = [f"do step {k}" for k in range(5)]
    other = other.replaced(episodes=data.episodes.withColumn("tasks", F.array(*map(F.lit, told))))
    assert datasets.caption_audit(other, "per_subtask").modes().first().modes == captions.MODES["per_subtask"][1]
    assert datasets.caption_audit(other, "mapped_subtask", vocabulary=told).first() is None
    assert datasets.caption_audit(other, "mapped_subtask", vocabulary=told[::-1]).first().rule == "task_vocabulary"
    one = datasets.language_view(data, "full_episode", "insert it")
    assert datasets.caption_audit(one, "full_episode", overall="insert it").first() is None
    assert datasets.caption_audit(one, "full_episode", overall="insert").first().rule == "overall_task"
    assert one.episodes.first().tasks == ["insert it"] and one.episodes.first()["stats/task_index/mean"] == [0.0]
    mapped = datasets.language_view(data, "mapped_subtask", mapped={"step 1": "turn"})
    assert mapped.episodes.first().tasks == ["step 0", "turn", "step 2", "step 3", "step 4"] and mapped.frames.where("task_index <> subtask_index").isEmpty()
    assert datasets.chosen_variants(["mapped_subtask", "full_episode"]) == ["full_episode", "mapped_subtask"]
    with pytest.raises(ValueError, match="unknown variants: x"):
        datasets.chosen_variants(["x"])


def test_correction_counts(spark, tree):
    out, counts = datasets.corrected(datasets.load(spark, tree), {"step 2": "right"})
    assert [(r.old, r.found, r.expected) for r in counts.collect()] == [("step 2", 3, 3)]
    assert out.annotations.first().sub_task_annotation[2].sub_task_instruction == "right" and out.episodes.first().subtask_instructions[2] == "right"


def test_merge_subset_slice_and_write(spark, tree, tmp_path):
    data = datasets.load(spark, tree)
    other = data.replaced(
        subtasks=data.subtasks.withColumn("subtask", F.when(F.col("subtask_index") == 0, "new").otherwise(F.col("subtask"))),
        frames=data.frames.withColumn("episode_index", F.col("episode_index") + 5),
        episodes=data.episodes.withColumn("episode_index", F.col("episode_index") + 5),
        annotations=data.annotations.withColumn("episode_index", F.lit(5).cast("long")),
        info=data.info | {"root": "other"}
    )
    both = datasets.merged([data, other])
    assert both.frames.count() == 90 and both.subtasks.count() == 6 and [
        r.subtask for r in both.subtasks.orderBy("subtask_index").collect()
    ] == ["step 0", "step 1", "step 2", "step 3", "step 4", "new"]
    assert rules.ready(datasets.preflight(both).where("rule not like '%caption'"))
    assert [r["stats/task_index/mean"] for r in both.episodes.orderBy("episode_index").collect()] == [[2.0], [2.0]]
    whole = {r.feature: r for r in datasets.global_stats(both.frames, both.episodes).collect()}
    assert (whole["index"]["mean"], whole["index"]["max"], whole["episode_index"]["count"]) == (44.5, 89.0, 90)
    named = both.frames.join(both.subtasks, "subtask_index").where("episode_index = 1 and frame_index < 9").select("subtask").distinct().collect()
    assert [r.subtask for r in named] == ["new"]
    with pytest.raises(ValueError):
        datasets.merged([data])
    less = datasets.essential(data, spark.createDataFrame([(0, 2)], "episode_index long, subtask_index long"), 15.0)
    assert [(r.episode_index, r.length) for r in less.episodes.orderBy("episode_index").collect()] == [(0, 18), (1, 18)] and less.frames.count() == 36
    short = datasets.sliced(data, {"observation.state": [0, 1, 2]})
    assert short.frames.first()["observation.state"] == [0.0, 1.0, 2.0]
    with pytest.raises(Exception, match="fewer than 9"):
        datasets.sliced(data, {"observation.state": [8]}).frames.collect()
    layouts.write(both, str(tmp_path / "out"))
    (tmp_path / "out/meta/info.json").write_text(json.dumps({"total_episodes": 2, "total_frames": 90}))
    assert files.frames(spark, str(tmp_path / "out")).count() == 90
    with pytest.raises(FileExistsError):
        sinks.table(both.subtasks, str(tmp_path / "out/meta/subtasks.parquet"))


def test_language_annotation_must_agree(spark, tree):
    rows = datasets.load(spark, tree).frames
    out = datasets.with_language_annotation(rows)
    assert datasets.with_language_annotation(out).count() == 45
    with pytest.raises(Exception, match="differs"):
        datasets.with_language_annotation(out.withColumn("annotation.human.task_description", F.lit(9).cast("long"))).collect()


def test_pooled_global_stats(spark, tree):
    data = datasets.load(spark, tree)
    meta = spark.createDataFrame(
        [(0, [1.0, 2.0], [0.0, 0.0], [1.0, 2.0], [1.0, 2.0], [2]), (1, [4.0, 2.0], [0.0, 1.0], [4.0, 1.0], [4.0, 3.0], [4])],
        "episode_index long, `stats/v/mean` array<double>, `stats/v/std` array<double>, `stats/v/min` array<double>, `stats/v/max` array<double>, `stats/v/count` array<bigint>"
    )
    got = {r.dim: r for r in datasets.global_stats(data.frames, meta).where("feature = 'v'").collect()}
    assert (got[0]["mean"], got[0]["std"], got[0]["min"], got[0]["count"]) == (3.0, 2**0.5, 1.0, 6) and abs(got[1]["std"] - (4 / 6) ** 0.5) < 1e-12
    with pytest.raises(Exception, match="incomplete"):
        datasets.global_stats(data.frames, meta.withColumn("stats/v/std", F.array(F.lit(None).cast("double"), F.lit(1.0)))).collect()


def test_pipeline_stops_at_the_first_gate(spark, tree):
    data = datasets.load(spark, tree)
    out, report = datasets.pipeline(data, "per_subtask", {"observation.state": [0, 1]}, 40, 5)
    assert report["boundaries"]["crossing_starts"] == 6 and len(out.frames.first()["observation.state"]) == 2
    with pytest.raises(datasets.GateError, match="captions: overall_task"):
        datasets.pipeline(data, "full_episode", {"observation.state": [0]}, 40, overall="insert it")
    with pytest.raises(ValueError, match="approved prompt"):
        datasets.pipeline(data, "full_episode", {"observation.state": [0]}, 40)
    bad = data.replaced(frames=data.frames.withColumn("index", F.when(F.col("index") == 44, 45).otherwise(F.col("index"))))
    with pytest.raises(datasets.GateError, match="preflight: global_index"):
        datasets.pipeline(bad, "per_subtask", {"observation.state": [0]}, 40)


def test_broken_annotation(spark, tree):
    from pathlib import Path

    Path(f"{tree}/annotations/chunk-000/episode_000001.json").write_text("{")
    assert "annotation_json" in {r.rule for r in datasets.preflight(datasets.load(spark, tree)).collect()}


def test_merge_gates(spark, tree):
    data = datasets.load(spark, tree)
    other = lambda **info: data.replaced(info=data.info | {"root": "other"} | info)
    with pytest.raises(datasets.GateError, match="unique_roots"):
        datasets.merged([data, data])
    with pytest.raises(datasets.GateError, match="one_annotation_path: annotations elsewhere"):
        datasets.merged([data, other(annotation_path="elsewhere")])
    with pytest.raises(datasets.GateError, match="annotation_path: other"):
        datasets.merged([data, other(annotation_path=None)])
    features = data.info["features"] | {"observation.state": data.info["features"]["observation.state"] | {"names": list("abcdeg")}}
    with pytest.raises(datasets.GateError, match="feature: other observation.state"):
        datasets.merged([data, other(features=features)])
    with pytest.raises(datasets.GateError, match="feature: other cam"):
        datasets.merged([data, other(features={k: v for k, v in data.info["features"].items() if k != "cam"})])
    with pytest.raises(documents.DocumentError, match="cam lacks"):
        datasets.merged([data, other(features={"cam": {"dtype": "video", "info": {"video.fps": 15}}})])
    named = lambda n: data.replaced(tasks=data.tasks.withColumn("task_name", F.lit(n)), info=data.info | {"root": n})
    with pytest.raises(datasets.GateError, match="vocabulary: step 0"):
        datasets.merged([named("a"), named("b")])
    lost = other().replaced(subtasks=data.subtasks.where("subtask_index < 4"))
    with pytest.raises(Exception, match="no mapping for new_subtask 4"):
        datasets.merged([data, lost]).frames.collect()
    both = datasets.merged([data, other()])
    assert both.info["total_tasks"] == 5 and both.info["total_frames"] == 90


def test_correction_must_be_exact(spark, tree):
    data = datasets.load(spark, tree)
    with pytest.raises(datasets.GateError, match="'step 2': found 2 times, expected 3"):
        datasets.corrected(data.replaced(subtasks=data.subtasks.where("subtask_index <> 2")), {"step 2": "right"})
    with pytest.raises(datasets.GateError, match="'step 9': found 0 times"):
        datasets.corrected(data, {"step 9": "x"})


def test_views_of_all_trees(spark, tree, tmp_path):
    data = datasets.load(spark, tree)
    views = datasets.variants(data, data, ["per_subtask", "full_episode"], "insert it")
    assert list(views) == ["full_episode", "per_subtask"] and all(v.episodes.first().tasks == ["insert it"] for v in views["full_episode"])
    with pytest.raises(ValueError, match="differ"):
        datasets.variants(data, data.replaced(subtasks=data.subtasks.withColumn("subtask", F.upper("subtask"))), ["full_episode"], "x")
    with pytest.raises(ValueError, match="expected 5"):
        datasets.rich_subtasks(data.replaced(subtasks=data.subtasks.where("subtask_index < 4")))
    with pytest.raises(Exception, match="outside the task vocabulary: 7"):
        datasets.language_view(data.replaced(frames=data.frames.withColumn("subtask_index", F.lit(7).cast("long"))), "per_subtask").frames.collect()
    assert datasets.parent_problems({"codebase_version": "v2.1"}, ["a"], "v3.0", "R") == ["expected v3.0, observed v2.1", "missing parent R"]
    # a tree of JSON lines
    frames = datasets.with_language_annotation(data.frames)
    lines = spark.createDataFrame([(0, ["old"], 45)], "episode_index long, tasks array<string>, length long")
    old = spark.createDataFrame([(0, {"task_index": {"mean": [9.0]}, "v": {"min": [1.0]}})], "episode_index long, stats map<string,map<string,array<double>>>")
    new, episodes, found = datasets.line_view(frames, lines, old, datasets.prompts(data, "per_subtask"), True, 5)
    assert new.where("task_index <> subtask_index or `annotation.human.task_description` <> task_index").isEmpty()
    assert episodes.first().tasks == [f"step {k}" for k in range(5)]
    stats = found.first().stats
    assert stats["v"] == {"min": [1.0]} and stats["task_index"]["mean"] == [2.0] and stats["task_index"]["count"] == [45.0]
    with pytest.raises(ValueError, match="lack annotation"):
        datasets.line_view(data.frames, lines, old, datasets.prompts(data, "per_subtask"), True, 5)
    path, digest = datasets.write_boundary_manifest(datasets.boundary_manifest(data, 40)[0], str(tmp_path / "view"))
    written = spark.read.parquet(f"{tmp_path}/view/{path}")
    assert path.startswith("meta/") and len(digest) == 64 and [r.frame_index for r in written.collect()] == list(range(6))


def test_derivative_checks(spark, tree):
    data = datasets.load(spark, tree)
    probe = [("cam", 640, 480, "15/1", "h264", 12), ("cam", 640, 480, "15/1", "h264", 40)]
    probes = spark.createDataFrame(probe, "camera string, width int, height int, avg_frame_rate string, codec_name string, max_gop long")
    good = datasets.derivative_problems(data, 45, {"observation.state": 6}, probes.where("max_gop = 12"), {"cam": 1}, 15.0, 0.05, 15)
    assert good == []
    bad = datasets.derivative_problems(data.replaced(tasks=data.tasks.withColumn("task", F.lit(" "))), 46, {"observation.state": 4}, probes, {"cam": 1, "other": 1}, 15.0, 0.05, 15)
    assert len(bad) == 11 and bad[-5:] == [
        "observation.state isn't 4-dimensional",
        "frame count changed: 46 -> 45",
        "cam: 2 videos, expected 1",
        "cam: 1 videos of another format",
        "other: 0 videos, expected 1"
    ]
    assert datasets.dataset_totals(data) == {"episodes": 1, "frames": 45, "captions_checked": 25}
    rows = spark.createDataFrame(
        [("s", "mean", k, float(k)) for k in range(4)] + [("s", "count", 0, 9.0), ("head", "mean", 0, 0.5), ("head", "std", 0, 0.25), ("w", "mean", 0, 1.0)],
        "feature string, stat string, dim int, value double"
    )
    cut = {(r.feature, r.stat, r.dim): r.value for r in datasets.sliced_stats(rows, {"s": [2, 0]}).collect()}
    assert cut == {("s", "mean", 0): 2.0, ("s", "mean", 1): 0.0, ("s", "count", 0): 9.0, ("head", "mean", 0): 0.5, ("head", "std", 0): 0.25, ("w", "mean", 0): 1.0}
    boxed = {(r.feature, r.stat): r.value for r in datasets.letterboxed_stats(rows, "head").where("feature <> 's'").collect()}
    assert boxed[("w", "mean")] == 1.0 and boxed[("head", "mean")] == 0.375 and abs(boxed[("head", "std")] - (0.75 * (0.25**2 + 0.5**2) - 0.375**2) ** 0.5) < 1e-12


def test_prepared_and_letterboxed(spark, tree):
    data = datasets.load(spark, tree)
    vector = {"dtype": "float32", "shape": [6], "names": list("abcdef")}
    data = data.replaced(
        frames=data.frames.withColumn("action", F.col("`observation.state`")),
        info=data.info | {"features": data.info["features"] | {"observation.state": vector, "action": dict(vector)}}
    )
    out = datasets.prepared(data, ["a", "b"], {"cam": [3, 480, 640]}, 15.0)
    assert out.info["features"]["action"]["names"] == ["a", "b"] and out.frames.first()["action"] == [0.0, 1.0]
    with pytest.raises(datasets.GateError, match="action order"):
        datasets.prepared(data, ["b", "a"], {"cam": [3, 480, 640]}, 15.0)
    receipt = documents.derivation_receipt("/s", "r", None, data.info, out.info, {"cam": {"source": 1, "output": 1, "operation": {}}}, ["t"], 15, 18, "medium")
    assert receipt["state"] == {"source_dimension": 6, "output_dimension": 2, "names": ["a", "b"]} and receipt["cameras"]["cam"]["geometry_transform"] == "identity"
    meta = data.episodes.withColumn("stats/cam/mean", F.array(F.lit(0.5))).withColumn("stats/cam/std", F.array(F.lit(0.25)))
    rows = spark.createDataFrame(
        [("action", "mean", k, float(k)) for k in range(6)] + [("cam", "mean", 0, 0.5), ("cam", "std", 0, 0.25)],
        "feature string, stat string, dim int, value double"
    )
    old, found = datasets.letterboxed(data.replaced(episodes=meta), rows, ["a", "b", "c"], {"observation.state": 6, "action": 6}, "cam", 600, 800)
    assert old.info["features"]["cam"]["shape"] == [3, 600, 800] and old.info["features"]["cam"]["info"]["video.width"] == 800 and len(old.frames.first()["action"]) == 3
    assert old.episodes.first()["stats/cam/mean"] == [0.375] and found.where("feature = 'action'").count() == 3
    with pytest.raises(documents.DocumentError, match="unexpected order"):
        datasets.letterboxed(data, rows, ["b", "a"], {"action": 6}, "cam")
    with pytest.raises(documents.DocumentError, match="5-dimensional"):
        datasets.letterboxed(data, rows, ["a"], {"action": 5}, "cam")


def test_sources_by_range(spark):
    """Sources of one episode and one that spans many pieces; every episode finds its own."""
    lengths = [1, 3 * merge.RANGE + 5, 1, merge.RANGE, 7]
    ends = list(itertools.accumulate(lengths))
    bounds = spark.createDataFrame([(k, e - n, e) for k, (n, e) in enumerate(zip(lengths, ends, strict=True))], "source_id int, from_episode long, to_episode long")
    found = merge.source_of(spark.range(ends[-1] + 3).withColumnRenamed("id", "new_episode"), bounds)
    assert {r.source_id: r["count"] for r in found.groupBy("source_id").count().collect()} == dict(enumerate(lengths))
    assert found.columns == ["new_episode", "source_id"] and found.agg({"new_episode": "max"}).first()[0] == ends[-1] - 1
