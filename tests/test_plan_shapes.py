"""The physical plans are the ones meant: one shuffle an episode key, pruned and pushed-down scans."""

import re

from oracle import DATA

from episodica import proxies
from episodica.operators import horizon, segments, subset
from episodica.plans import captions


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(df):
    return len(re.findall(r"Exchange hashpartitioning", plan(df)))


def test_one_shuffle_for_runs_and_horizons(spark):
    rows = proxies.frames(spark, f"{DATA}/sf0.001")
    assert shuffles(segments.run_segments(rows, "subtask", proxies.ORDER)) == 1
    assert shuffles(horizon.boundary_starts(rows, "subtask", proxies.ORDER, 3)) == 1
    assert shuffles(horizon.clean_starts(rows, "subtask", proxies.ORDER, 3)) == 1
    assert shuffles(segments.run_values(rows, "subtask", proxies.ORDER)) == 1


def test_scans_are_pruned_and_filters_pushed(spark):
    df = proxies.table(spark, f"{DATA}/sf0.001", "events").where("user_id = 3").select("event_type")
    text = plan(df)
    assert "EqualTo(user_id,3)" in text and re.search(r"ReadSchema: struct<user_id:bigint,event_type:string>", text)
    lengths = segments.segment_lengths(segments.run_segments(proxies.frames(spark, f"{DATA}/sf0.001"), "subtask", proxies.ORDER), "subtask")
    assert "props" not in re.findall(r"ReadSchema: (\S+)", plan(lengths))[0]


def test_no_python_and_no_cartesian_in_the_core(spark):
    from episodica.queries import QUERIES

    files = {"file_footers", "file_hashes", "tree_fingerprint", "planned_files", "episode_files", "manifest_digest", "payload_digests", "dataset_fingerprint", "run_outcomes"}
    for name, q in QUERIES.items():
        # that one writes checkpoints; and files by name and digests in order have no column expression
        if name not in {"config_inheritance"} | files:
            text = plan(q(spark, f"{DATA}/sf0.001"))
            assert not re.search(r"CartesianProduct|BatchEvalPython|ArrowEvalPython|MapInPandas|MapInArrow", text), name


def test_counts_are_partial(spark):
    rows = proxies.frames(spark, f"{DATA}/sf0.001")
    drop = rows.where("subtask = 'error'").select("episode_index", "subtask")
    assert "partial_count" in plan(subset.counts(subset.flagged(rows, drop, proxies.ORDER, "subtask"), "subtask"))


def test_facts_of_episodes_are_never_broadcast(spark):
    from episodica.queries_audit import contract_tables

    t = contract_tables(spark, f"{DATA}/sf0.001", per_subtask=True)
    text = plan(captions.facts(**t))
    assert len(re.findall(r"SortMergeJoin \[episode_index", text)) == 4 and not re.search(r"BroadcastHashJoin \[(episode_index|m|a)#", text)
