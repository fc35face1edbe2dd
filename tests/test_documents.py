import hashlib
from datetime import UTC, datetime

import pytest

from episodica.plans import documents as D


def test_feature_views():
    video = dict.fromkeys(D.VIDEO_KEYS, 1)
    a = {"features": {"cam": {"dtype": "video", "fps": 15, "info": video | {"x": 1}}, "s": {"shape": [2]}}}
    b = {"features": {"cam": {"dtype": "video", "fps": 30, "info": video | {"x": 2}}, "s": {"shape": [3]}}}
    assert D.feature_differences([a, b]) == ["s"] and D.feature_differences([a, a]) == []
    info = D.updated_info(a | {"total_size_in_mb": 1}, {"s": ["p"]}, 1_000_000, 1_500_000)
    assert info["features"]["s"] == {"shape": [1], "names": ["p"]} and info["total_size_in_mb"] == 2.5 and a["features"]["s"] == {"shape": [2]} and "total_videos_size_in_mb" not in info
    assert D.missing_payloads(["a"], "v2.1", ["a", "b"]) == ["version v2.1", "b"]


def test_queue_transitions():
    queue, budget = [D.Entry("a"), D.Entry("b")], D.Budget(max_attempts=2)
    assert D.next_run(queue, budget, 0, 1).name == "a"
    queue[0] = D.after(queue[0], 1)
    assert D.next_run(queue, budget, 0, 1) == D.Entry("a", "failed", 1)
    queue[0] = D.after(queue[0], 0)
    assert D.next_run(queue, budget, 0, 1).name == "b"
    queue[1] = D.after(D.after(queue[1], 1), 1)
    assert D.next_run([queue[1], D.Entry("c")], budget, 0, 1) is None
    assert D.next_run([queue[1], D.Entry("c")], D.Budget(2, False), 0, 1).name == "c"
    assert D.next_run([D.Entry("c")], D.Budget(seconds=5), 6, 1) is None and D.next_run([D.Entry("c")], D.Budget(disk_bytes=9), 0, 1) is None
    assert D.after(D.Entry("x"), None).state == "blocked"


def test_small_documents():
    assert D.alias({"a": None, "b": 2}, ["a", "b"]) is None and D.alias({"b": 2}, ["a", "b"]) == 2
    assert D.digest({"b": 1, "a": 2}) == D.digest({"a": 2, "b": 1}) and D.stamp(compact=True).endswith("Z")
    at = datetime(2026, 1, 2, 3, 4, 5, tzinfo=UTC)
    m = D.run_manifest("r", {"a": 1}, ["run", "a b"], "c.yaml", "/runs/r", "/runs/r/output", "lerobot_act", {}, {}, at)
    assert m["created_utc"] == "2026-01-02T03:04:05Z" and m["config_sha256"] == hashlib.sha256(b'{"a":1}').hexdigest() and m["command_sha256"] == hashlib.sha256(b"run 'a b'\n").hexdigest()
    assert m["safety"] == {"robot_hardware_invoked": False, "allowed_backend": "lerobot_act"} and m["paths"]["output_dir"] == "/runs/r/output"
    said = {"cross_boundary_start_count": 7}
    r = D.language_receipt("per_subtask", True, ["a"], "source", "/p", "/d", {}, {}, said, "meta/x", "h")
    assert (r["task_index_source"], r["h40"]["language_conflict_start_count"], r["kind"]) == ("subtask_index", 7, "task700013_language_variant")
    assert D.language_receipt("full_episode", False, ["a"], "source", "/p", "/d", {}, {}, said, "meta/x", "h")["h40"]["language_conflict_start_count"] == 0
    assert D.acknowledgement("p", "m", "c", "h", at) == {
        "schema_version": 1,
        "acknowledged_utc": "2026-01-02T03:04:05Z",
        "package": "p",
        "package_sha256s_sha256": "m",
        "consumer_receipt": "c",
        "consumer_receipt_sha256": "h",
        "consumer_status": "acknowledged"
    }
    assert D.package_manifest("n", "lerobot_act", "lerobot", "r", "a", "b", "c", None, at)["consumer_status"] == "not_acknowledged"
    plan = D.transfer_plan("/packages/n", "lerobot_act", "lerobot", "u@host", "/home/w", 22, at)
    assert (plan["remote_host_path"], plan["remote_stage_path"], plan["remote_container_path"]) == (
        "/home/w/model/lerobot/n",
        "/home/w/model/lerobot/.n.partial-20260102T030405Z",
        "/workspace/model/lerobot/n"
    )
    for bad in ({"target": "host"}, {"port": 0}, {"workspace": "a/b"}, {"workspace": "/a/../b"}):
        with pytest.raises(D.DocumentError):
            D.transfer_plan(**({"package": "/p", "backend": "b", "family": "f", "target": "u@h", "workspace": "/w", "port": 22} | bad))


def test_results():
    blank = D.blank_result("r")
    assert blank["status"] == {"state": "not_started", "exit_code": None, "failure_category": None} and list(blank["metrics"])[-1] == "cuda_memory_gib" and blank["anomalies"] == []
    metrics = {"step": 20, "loss": 1.5, "gradient_norm": 1.0, "samples_per_second": 13.0, "cuda_memory_gib": 35.9}
    done = D.finished_result(blank, 0, None, 1.23456, metrics, "/m")
    assert done["status"]["state"] == "completed" and done["timing"]["runtime_seconds"] == 1.235 and done["metrics"]["final_train_loss"] == 1.5 and done["metrics"]["final_eval_loss"] is None
    assert done["best_checkpoint"] == {"step": 20, "path": "/m", "selection_reason": D.LAST_SAVED} and done["summary"] == D.REVIEW and blank["status"]["state"] == "not_started"
    lost = D.finished_result(blank, 137, "signal", 1.0, None, None)
    assert lost["status"] == {"state": "failed", "exit_code": 137, "failure_category": "signal"} and lost["summary"] is None and lost["artifacts"]["pretrained_model"] is None


def test_boundary_report():
    row = {"boundaries": 4, "valid_starts": 6, "crossing_starts": 3, "clean_starts": 3}
    out = D.boundary_report(row, 1, [Length(1, 2, 5, 6), Length(0, 1, 9, 9)])
    assert out["cross_boundary_fraction"] == 0.5 and out["segment_lengths"] == {"0": {"count": 1, "min": 9, "max": 9}, "1": {"count": 2, "min": 5, "max": 6}}


class Length(tuple):
    def __new__(cls, *x):
        return super().__new__(cls, x)

    def __getitem__(self, k):
        return super().__getitem__({"segments": 1, "min_length": 2, "max_length": 3}.get(k, k))


def test_source_problems():
    names = ["j1", "j2"]
    vector = lambda n: {"shape": [len(n)], "names": n}
    good = {"codebase_version": "v3.0", "fps": 15, "features": {"cam": {"shape": [3, 480, 640]}, "observation.state": vector(["j1", "j2", "x"]), "action": vector(["j1", "j2"])}}
    assert D.source_problems(good, names, {"cam": [3, 480, 640]}, 15.0) == []
    bad = {"codebase_version": "v2.1", "fps": 30, "features": {"cam": {"shape": [3, 720, 1280]}, "observation.state": vector(["j2", "j1"]), "action": vector(["j1", "j1"])}}
    assert D.source_problems(bad, names, {"cam": [3, 480, 640]}, 15.0) == ["version v2.1", "fps 30", "cam shape", "observation.state order", "action names"]


def test_launch_plans():
    free = 10 << 30
    assert D.launch_plan("r", "/r", "/r/output", ["x"], free, 5, []) == {"run_name": "r", "run_dir": "/r", "output_dir": "/r/output", "command": ["x"]}
    for options, said in (((1 << 30, 5, []), "1.0 GiB free; 5.0"), ((free, 5, ["/r/output"]), "existing output"), ((free, 5, [], True), "resume config missing")):
        with pytest.raises(D.DocumentError, match=said):
            D.launch_plan("r", "/r", "/r/output", ["x"], *options)
    assert D.launch_plan("r", "/r", "/o", ["x"], free, 5, ["/o", "/o/checkpoints/last/pretrained_model/train_config.json"], True)["output_dir"] == "/o"
