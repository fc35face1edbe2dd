import pytest

from episodica.functions.config import ConfigError
from episodica.operators import manifest
from episodica.plans import commands as C
from episodica.plans import registry as R

VARIABLES = {"workspace": "/w", "training_root": "/w/training"}
POLICY = {"base_model_path": "m/n", "optimizer_lr": 1e-4, "optimizer_weight_decay": 1e-5, "warmup_ratio": 0.05}


def lerobot(**more):
    base = {
        "backend": "act", "name": "run", "dataset": {"repo_id": "local/x", "root": "/d", "registry_ref": "x", "eval_split": 0.1}, "policy": {"type": "act", "chunk_size": 100, "use_relative_actions": False},
        "train": {"steps": 20, "batch_size": 8, "timeout_seconds": 9, "save_total_limit": 3}, "optimizer": {"lr": 0.1}, "scheduler": {"name": "cosine"}, "tracking": {"backend": "none"},
    }
    return base | more


def test_policy_trainer_command():
    got = C.command(lerobot(), "/o", "run_backend.sh")
    assert got == [
        "run_backend.sh", "lerobot", "lerobot-train", "--dataset.repo_id=local/x", "--dataset.root=/d", "--dataset.eval_split=0.1", "--policy.type=act", "--policy.chunk_size=100", "--policy.use_relative_actions=false",
        "--steps=20", "--batch_size=8", "--output_dir=/o", "--job_name=run", "--wandb.enable=false",
    ]
    own = C.command(lerobot(train={"steps": 1, "use_policy_training_preset": False}, tracking={"backend": "wandb", "enable": True, "project": "p", "url": "u", "entity": None}), "/o")
    assert own[-6:] == ["--optimizer.lr=0.1", "--scheduler.name=cosine", "--output_dir=/o", "--job_name=run", "--wandb.enable=true", "--wandb.project=p"]
    transforms = C.command(lerobot(dataset={"image_transforms": {"enable": True, "tfs": {"hue": {"weight": 0}}}}), "/o")
    assert transforms[3:5] == ["--dataset.image_transforms.enable=true", '--dataset.image_transforms.tfs={"hue":{"weight":0}}']
    assert C.command(lerobot(), "/o", "s", resume="/c.json") == ["s", "lerobot", "lerobot-train", "--config_path=/c.json", "--resume=true"]
    with pytest.raises(ConfigError, match="unknown backend"):
        C.command(lerobot(backend="zz"), "/o")


def test_native_trainer_command():
    doc = {
        "backend": "isaac-groot",
        "name": "n",
        "policy": POLICY | {"tune_llm": True, "color_jitter_params": {"hue": 0.1}},
        "dataset": {"root": "/d", "modality_config_path": "/m.py"},
        "train": {"steps": 5, "batch_size": 2, "num_workers": 4, "save_freq": 5, "seed": 42},
        "tracking": {"backend": "none", "project": "p"}
    }
    got = C.command(doc, "/o", "run_backend.sh", "launch.py")
    assert got[:4] == ["run_backend.sh", "isaac_groot", "python", "launch.py"]
    pairs = dict(zip(got[4:44:2], got[5:44:2], strict=True))
    assert list(pairs)[:6] == ["--base-model-path", "--dataset-path", "--embodiment-tag", "--modality-config-path", "--output-dir", "--experiment-name"]
    assert pairs["--embodiment-tag"] == "NEW_EMBODIMENT" and pairs["--num-shards-per-epoch"] == "100000" and pairs["--state-dropout-prob"] == "0.2" and pairs["--learning-rate"] == "0.0001"
    assert got[44:] == [
        "--tune-llm", "--no-tune-visual", "--tune-projector", "--tune-diffusion-model", "--use-percentiles", "--no-save-only-model", "--no-use-wandb",
        "--color-jitter-params", "hue", "0.1", "--wandb-project", "p"
    ]
    assert "--seed" not in got
    tracked = C.command(doc | {"tracking": {"backend": "wandb", "entity": "team", "enable": False}}, "/o")
    assert tracked[2:6] == ["env", "WANDB_MODE=online", "WANDB_ENTITY=team", "python"] and tracked[-4] == "--no-use-wandb"
    with pytest.raises(ConfigError, match="train.steps is missing"):
        C.command(doc | {"train": {}}, "/o")
    with pytest.raises(ConfigError, match="resumes from its output"):
        C.command(doc, "/o", resume="/c")


INFO = {
    "codebase_version": "v3.0", "fps": 15, "total_episodes": 2, "total_frames": 9,
    "features": {"observation.state": {"dtype": "float32", "shape": [2], "names": ["a", "b"]}, "action": {"dtype": "float32", "shape": [2], "names": ["a", "b"]}, "cam": {"dtype": "video", "shape": [3, 480, 640]}},
}
PROFILE = {"schema_version": 1, "name": "p", "robot_revision": "r1", "task": "insert", "evidence": "e"}


def registered(**more):
    return R.minimal_registration("set", "org/set", "a" * 40, "${workspace}/set", "r1", 0.1, {"state": "rad", "action": "rad"}, "one task", "e", info=INFO) | more


def test_registrations():
    defaults = R.profile(PROFILE, "profile.yaml", VARIABLES)
    assert defaults == {"profile": "profile.yaml", "hub_revision": "main", "robot_revision": "r1", "task": "insert", "evidence": "e"}
    with pytest.raises(R.RegistryError, match="profile_task"):
        R.profile(PROFILE | {"task": " "}, "p", VARIABLES)
    doc = R.local_registration("set", "/src", INFO, defaults, task="mine", handoff="/h")
    assert doc["registration"] == {"source_kind": R.LOCAL, "contract_profile": "profile.yaml", "robot_revision_source": "project_default", "task_source": "command_line", "handoff": "/h"}
    assert doc["contract"]["state"]["dim"] == 16 and doc["contract"]["state"]["names"][7] == "gripper_l_joint1" and doc["contract"]["language"]["instruction"] == "mine"
    assert doc["expected"] == {
        "codebase_version": "v3.0",
        "total_episodes": 2,
        "total_frames": 9
    } and doc["adapters"]["isaac_groot"]["root"] == "${training_root}/artifacts/datasets/set_isaac_v21"
    spec = R.dataset_spec(doc, VARIABLES)
    assert spec["prepared"]["root"] == "/w/training/artifacts/datasets/set_arms16_gop15" and R.report(spec, "x.yaml")["source"] == {
        "kind": R.LOCAL, "root": "/src", "label": "local", "handoff": "/h"
    }
    for bad in ({"name": "-x"}, {"eval_split": 1.0}, {"robot_revision": " "}):
        with pytest.raises(R.RegistryError):
            R.local_registration(**({"name": "set", "source": "/s", "info": {}, "defaults": defaults} | bad))
    small = R.dataset_spec(registered(), VARIABLES)
    assert R.report(small, "y")["hub"]["pinned_commit"] == "a" * 40 and R.report(small, "y")["task"] == {"value": None, "source": "registration"}
    for bad in ({"schema_version": 2}, {"revision": "main"}):
        with pytest.raises(R.RegistryError):
            R.dataset_spec(registered(**bad), VARIABLES)
    with pytest.raises(R.RegistryError, match="missing: download"):
        R.dataset_spec({k: v for k, v in registered().items() if k != "download"}, VARIABLES)
    view = R.view_registration(registered(preparation={"x": 1}), "set_v", "main:v", "h", {"source": "/s", "prepared": "/p", "isaac": "/i"}, "per_subtask", ["a", "b"], "/receipt", "/audit")
    assert "preparation" not in view and view["registration"]["language_mode"] == "per_subtask" and view["contract"]["language"]["instruction"] == "2 prompts selected by task_index (per_subtask)."
    assert view["contract"]["robot_revision"] == "r1" and view["validation"]["caption_audit"]["expected_task_vocabulary"] == ["a", "b"] and "expected_overall_task" not in view["validation"]["caption_audit"]


def test_contracts(spark):
    contract = R.derived_contract(registered()["contract"], INFO)
    assert contract["state"] == {"dim": 2, "names": ["a", "b"]} and contract["cameras"] == [{"key": "cam", "shape": [3, 480, 640]}] and contract["robot_revision"] == "r1"
    other = INFO | {"fps": 30, "features": INFO["features"] | {"cam": {"dtype": "video", "shape": [3, 720, 1280]}, "action": {"shape": [1], "names": ["a"]}}}
    assert R.contract_problems(contract, INFO) == [] and R.contract_problems(contract, other) == ["action dim", "action names", "camera cam", "fps"]
    more = INFO | {"features": INFO["features"] | {"side": {"dtype": "image", "shape": [3, 480, 640]}}}
    assert R.contract_problems(contract, more) == ["cameras"]
    assert R.contract_problems({}, INFO) == ["state dim", "state names", "action dim", "action names", "cameras", "fps"]
    assert R.derived_contract({"auto_from_metadata": True, "state": {"units": "rad"}}, INFO)["state"] == {"dim": 2, "names": ["a", "b"], "units": "rad"}
    with pytest.raises(ValueError, match="lack cameras"):
        R.derived_contract({"auto_from_metadata": True}, INFO | {"features": {k: v for k, v in INFO["features"].items() if k != "cam"}})
    audit = spark.createDataFrame([("b", 2, "here", "x", "y"), ("a", 1, "there", "x", "y")], "rule string, rule_order int, location string, expected string, observed string")
    assert R.dataset_problems(
        registered(),
        INFO | {"total_frames": 8},
        audit
    ) == ["total_frames mismatch", "a at there"] and R.dataset_problems(registered(), INFO, audit.where("false")) == []


def test_experiments_and_queues():
    spec = registered()
    assert R.dataset_defaults(R.dataset_spec(spec, VARIABLES), {})["dataset"] == {
        "registry_ref": "set", "source_revision": "a" * 40, "repo_id": "local/set", "root": "/w/set", "video_backend": "torchcodec", "eval_split": 0.1,
        "image_transforms": {"enable": False}
    }
    native = R.dataset_defaults(R.dataset_spec(spec, VARIABLES), {}, "isaac")["dataset"]
    assert native["repo_id"] == "local/set_isaac_v21" and native["modality_config_path"].endswith("f2_arms16_absolute_h40.py") and native["eval_split"] == 0.0
    recipe = {
        "schema_version": 1, "backend": "act", "tags": [], "policy": {"type": "act", "device": "cpu"}, "train": {"steps": 5, "batch_size": 1, "num_workers": 0}, "optimizer": {}, "scheduler": {}, "tracking": {"backend": "none"},
        "resources": {"timeout_hours": 1}, "artifacts": {"output_dir": "${workspace}/out/${name}"}, "annotation": {},
    }
    docs = {"runs/a": {"_base": "../policies/act", "name": "one", "dataset_ref": "set", "dataset": {"eval_split": 0.3}}, "runs/../policies/act": recipe}
    got = R.experiment(docs, "runs/a", {"set": spec}, VARIABLES, ["train.steps=7"], {"set": INFO})
    assert got["train"]["steps"] == 7 and got["dataset"]["eval_split"] == 0.3 and got["dataset"]["root"] == "/w/set" and got["artifacts"]["output_dir"] == "/w/out/one" and got["contract"]["action"]["dim"] == 2 and "dataset_ref" not in got
    with pytest.raises(R.RegistryError, match="no dataset 'set'"):
        R.experiment(docs, "runs/a", {}, VARIABLES)
    with pytest.raises(R.RegistryError, match="steps: 0"):
        R.experiment(docs, "runs/a", {"set": spec}, VARIABLES, ["train.steps=0"], {"set": INFO})
    queue = {"schema_version": 1, "name": "q", "max_attempts": 1, "time_budget_hours": 1, "runs": [{"config": "a"}, {"config": "b", "overrides": ["x=1"]}]}
    asked = []
    assert R.queue(queue, lambda c, sets: asked.append((c, sets)) or {"name": c}) == [{"name": "a"}, {"name": "b"}] and asked == [("a", []), ("b", ["x=1"])]
    for bad, said in (
        ({"zzz": 1}, "queue_keys"),
        ({"name": "-"}, "queue_name"),
        ({"runs": []}, "queue_empty"),
        ({"max_attempts": 0}, "queue_attempts"),
        ({"runs": [{"overrides": []}]}, r"queue_entry: \[0\]"),
        ({"runs": [{"config": "a", "overrides": "x"}]}, "queue_entry"),
        ({"runs": [{"config": "a"}, {"config": "a"}]}, "queue_duplicates: a")
    ):
        with pytest.raises(R.RegistryError, match=said):
            R.queue(queue | bad, lambda c, sets: {"name": c})
    assert R.new_run("n", "set", "isaac-groot")["_base"] == "../policies/isaac_groot_n17.yaml" and R.new_run("n", "set")["dataset_ref"] == "set"


def test_receipts(spark):
    expected = R.native_receipt({"name": "set", "revision": "r"}, "/s", "m", None, "j", "c")
    assert expected["action_horizon"] == 40 and not R.reusable(expected, None) and R.reusable(expected, expected | {"more": 1})
    with pytest.raises(R.RegistryError, match="mismatch for source_revision"):
        R.reusable(expected, expected | {"source_revision": "other"})
    spec = registered(source_manifest_sha256="h")
    said = spark.createDataFrame([("h1", "a")], "sha256 string, path string")
    there = spark.createDataFrame([("a", 1, "h1")], "path string, bytes long, sha256 string")
    marker = R.recovered_marker(spec, "/m.txt", "h", manifest.verified(said, there))
    assert marker["source_kind"] == "verified_legacy_manifest" and R.recovered_marker(registered(), "/m", "h", said) is None
    with pytest.raises(R.RegistryError, match="manifest_digest"):
        R.recovered_marker(spec, "/m.txt", "x", manifest.verified(said, there))
    with pytest.raises(R.RegistryError, match="manifest_files"):
        R.recovered_marker(spec, "/m.txt", "h", manifest.verified(said, there.where("false")))
    assert R.provenance({"a": 1}) == {"a": 1} and R.provenance([1]) == {}
    assert R.tracked_metrics({"eval_loss": None, "eval/loss": 3, "loss": 2}) == {"final_eval_loss": None, "final_train_loss": 2, "samples_per_second": None, "cuda_memory_gib": None}
    assert C.shown({"a": 1}).strip() in ('{"a":1}', "a: 1")
