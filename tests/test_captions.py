"""The caption contract, one defect a rule on a small dataset that has none."""

import pytest

from episodica.plans import captions

WORDS = ["reach", "grasp", "place"]


def tables(spark, frames=None, episodes=None, annotations=None, tasks=None, subtasks=None):
    """Two episodes of six and nine frames, three subtasks each, one prompt."""
    own = [(e, k, 0, 3 * k // n) for e, n in ((0, 6), (1, 9)) for k in range(n)]
    meta = [(e, n, ["tidy"], WORDS) for e, n in ((0, 6), (1, 9))]
    note = lambda e, n: (e, f"annotations/episode_{e:06d}.json", (n, [0, n]), [(k, WORDS[k], [k * n // 3, (k + 1) * n // 3]) for k in range(3)])
    change = lambda rows, f: rows if f is None else f(rows)
    return {
        "frames": spark.createDataFrame(change(own, frames), "episode_index long, frame_index long, task_index long, subtask_index long").repartition(3),
        "episodes": spark.createDataFrame(change(meta, episodes), "episode_index long, length long, tasks array<string>, subtask_instructions array<string>"),
        "annotations": spark.createDataFrame(
            change([note(0, 6), note(1, 9)], annotations),
            "episode_index long, path string, meta_data struct<task_duration: long, valid_duration: array<long>>, "
            "sub_task_annotation array<struct<sub_task_idx: long, sub_task_instruction: string, frame_duration: array<long>>>"
        ),
        "tasks": spark.createDataFrame(change([(0, "tidy")], tasks), "task_index long, task string"),
        "subtasks": spark.createDataFrame(change(list(enumerate(WORDS)), subtasks), "subtask_index long, subtask string"),
    }


def audit(t, **more):
    return captions.audit(**t, **({"mode": "full_episode", "phases": 3, "total": 2, "overall": "tidy"} | more))


def test_clean(spark):
    out = audit(tables(spark), expected_episodes=2)
    assert out.first() is None and out.modes().first().ready
    rows = {r.episode_index: r for r in out.summaries.collect()}
    assert rows[1].frames == 9 and rows[1].task_run_indices == [0] and rows[1].subtask_run_indices == [0, 1, 2] and rows[1].stored_subtask_captions == WORDS
    assert rows[0].training_captions == ["tidy"] and rows[0].annotation == "annotations/episode_000000.json"


def entry(k, **new):
    def change(rows):
        e, path, spans, entries = rows[1]
        names = ("value", "said", "span")
        entries = [tuple(new.get(n, v) for n, v in zip(names, x, strict=True)) if i == k else x for i, x in enumerate(entries)]
        return [rows[0], (e, path, spans, entries)]

    return change


def last_of(rows, **new):
    names = ("episode_index", "frame_index", "task_index", "subtask_index")
    return [*rows[:-1], tuple(new.get(n, v) for n, v in zip(names, rows[-1], strict=True))]


DEFECTS = {
    "frame_index": {"frames": lambda r: last_of(r, frame_index=12)},
    "task_index": {"frames": lambda r: last_of(r, task_index=4)},
    "subtask_index": {"frames": lambda r: last_of(r, subtask_index=4)},
    "subtask_order": {"frames": lambda r: [(e, k, t, (1, 0, 2)[s] if e else s) for e, k, t, s in r]},
    "episode_metadata": {"episodes": lambda r: r[:1]},
    "episode_length": {"episodes": lambda r: [r[0], (1, 8, *r[1][2:])]},
    "subtask_instructions": {"episodes": lambda r: [r[0], (*r[1][:3], WORDS[:2])]},
    "annotation_file": {"annotations": lambda r: [r[0], r[1], r[1]]},
    "task_duration": {"annotations": lambda r: [r[0], (*r[1][:2], (8, [0, 9]), r[1][3])]},
    "valid_duration": {"annotations": lambda r: [r[0], (*r[1][:2], (9, [1, 9]), r[1][3])]},
    "annotation_segments": {"annotations": lambda r: [r[0], (*r[1][:3], r[1][3][:2])]},
    "annotation_order": {"annotations": entry(1, value=2)},
    "annotation_caption": {"annotations": entry(1, said="push")},
    "annotation_frame_range": {"annotations": entry(1, span=[3, 7])},
    "mode": {"episodes": lambda r: [r[0], (1, 9, ["other"], WORDS)]},
    "task_vocabulary": {"tasks": lambda r: [(1, "tidy")]},
    "subtask_caption": {"subtasks": lambda r: [*r, (3, " ")]},
    "tasks_empty": {"tasks": lambda r: []},
    "frames": {"frames": lambda r: []},
    "episode_ids": {"frames": lambda r: [(2 * e, k, t, s) for e, k, t, s in r]},
}


@pytest.mark.parametrize("rule", DEFECTS)
def test_each_rule_is_the_first_to_break(spark, rule):
    found = audit(tables(spark, **DEFECTS[rule]), overall=None if rule in ("task_vocabulary", "tasks_empty") else "tidy") if rule not in ("task_vocabulary", "tasks_empty") else audit(
        tables(spark, **DEFECTS[rule]), mode="mapped_subtask", vocabulary=["tidy"], overall=None
    )
    assert found.first().rule == rule


def test_rules_of_the_whole(spark):
    assert audit(tables(spark), total=3).first().rule == "total_episodes" and audit(tables(spark), total=None).first().rule == "total_episodes"
    assert audit(tables(spark), expected_episodes=3).first().rule == "expected_episodes"
    assert audit(tables(spark), overall="clean").first().rule == "overall_task"
    for bad in ({"mode": "other"}, {"overall": None}, {"mode": "mapped_subtask"}, {"vocabulary": ["a", " "]}):
        with pytest.raises(ValueError, match="mode|prompt"):
            audit(tables(spark), **bad)


def test_an_episode_fails_before_the_next_and_the_mode_last(spark):
    both = tables(spark, episodes=lambda r: [(0, 6, ["other"], WORDS), (1, 8, ["tidy"], WORDS)], annotations=lambda r: [(*r[0][:2], (5, [0, 6]), r[0][3]), r[1]])
    out = audit(both)
    assert out.first().rule == "task_duration" and {r.rule for r in out.violations.collect()} == {"task_duration", "episode_length", "mode"}
    assert not out.modes().first().ready and out.modes().first().modes == ",".join(sorted(captions.MODES["full_episode"]))


def test_prompts_a_subtask(spark):
    own = {"frames": lambda r: [(e, k, s, s) for e, k, t, s in r], "tasks": lambda r: list(enumerate(WORDS)), "episodes": lambda r: [(e, n, WORDS, WORDS) for e, n, *_ in r]}
    assert audit(tables(spark, **own), mode="per_subtask", overall=None).first() is None
    assert audit(tables(spark, **own), mode="mapped_subtask", vocabulary=WORDS, overall=None).first() is None
    three = own | {"frames": lambda r: [(e, k, 0, s) for e, k, t, s in r]}
    assert audit(tables(spark, **three), mode="per_subtask", overall=None).first().rule == "mode"


def test_one_shuffle_of_the_frames(spark):
    frames = tables(spark)["frames"]
    text = captions.episode_runs(frames)._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning") == 1
