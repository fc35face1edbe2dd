"""Trainer commands as argument arrays."""

from __future__ import annotations

from typing import Any

from ..functions.config import ConfigError, flags, rendered, switch
from .runs import backend

#: What of a dataset and of the training settings a trainer is told, or not.
DATASET_FLAGS = ("repo_id", "root", "episodes", "image_transforms", "revision", "use_imagenet_stats", "video_backend", "return_uint8", "depth_output_unit", "streaming", "eval_split")
NOT_TRAIN = ("timeout_seconds", "gradient_accumulation_steps", "save_total_limit")
NOT_TRACKING = ("backend", "url")
#: The native trainer's options in order, where each comes from (section, key), and its default if it has one.
NATIVE_OPTIONS = (
    ("base-model-path", "policy", "base_model_path"),
    ("dataset-path", "dataset", "root"),
    ("embodiment-tag", "policy", "embodiment_tag", "NEW_EMBODIMENT"),
    ("modality-config-path", "dataset", "modality_config_path"),
    ("output-dir", "", "output"),
    ("experiment-name", "", "name"),
    ("num-gpus", "train", "num_gpus", 1),
    ("max-steps", "train", "steps"),
    ("global-batch-size", "train", "batch_size"),
    ("gradient-accumulation-steps", "train", "gradient_accumulation_steps", 1),
    ("dataloader-num-workers", "train", "num_workers"),
    ("save-steps", "train", "save_freq"),
    ("save-total-limit", "train", "save_total_limit", 5),
    ("learning-rate", "policy", "optimizer_lr"),
    ("weight-decay", "policy", "optimizer_weight_decay"),
    ("warmup-ratio", "policy", "warmup_ratio"),
    ("state-dropout-prob", "policy", "state_dropout_prob", 0.2),
    ("shard-size", "dataset", "shard_size", 1024),
    ("episode-sampling-rate", "dataset", "episode_sampling_rate", 0.1),
    ("num-shards-per-epoch", "dataset", "num_shards_per_epoch", 100000),
)
#: Its switches in order, likewise.
NATIVE_SWITCHES = (
    ("tune-llm", "policy", "tune_llm", False),
    ("tune-visual", "policy", "tune_visual", False),
    ("tune-projector", "policy", "tune_projector", True),
    ("tune-diffusion-model", "policy", "tune_diffusion_model", True),
    ("use-percentiles", "policy", "use_percentiles", True),
    ("save-only-model", "train", "save_only_model", False),
)


def _setting(document: dict[str, Any], section: str, key: str, *default: Any) -> Any:
    found = document.get(section, {}) if section else document
    if key not in found and not default:
        raise ConfigError(f"{section}.{key} is missing")
    return found.get(key, *default)


def policy_trainer(document: dict[str, Any], output: str, launcher: str, resume: str | None = None) -> list[str]:
    """The policy trainer's arguments; one that resumes is told its saved configuration and nothing else."""
    head = [launcher, "lerobot", "lerobot-train"]
    if resume:
        return [*head, f"--config_path={resume}", "--resume=true"]
    train = {k: v for k, v in document["train"].items() if k not in NOT_TRAIN}
    out = head + flags("dataset", {k: v for k, v in document["dataset"].items() if k in DATASET_FLAGS}) + flags("policy", document["policy"]) + flags("", train)
    if not train.get("use_policy_training_preset", True):
        out += flags("optimizer", document["optimizer"]) + flags("scheduler", document.get("scheduler") or {})
    out += [f"--output_dir={output}", f"--job_name={document['name']}"]
    tracking = document["tracking"]
    if tracking["backend"] != "wandb":
        return [*out, "--wandb.enable=false"]
    return out + flags("wandb", {k: v for k, v in tracking.items() if k not in NOT_TRACKING})


def native_trainer(document: dict[str, Any], output: str, launcher: str, script: str) -> list[str]:
    """The native trainer's arguments: options and values, switches, then color jitter and the tracker's project."""
    tracking, tracked = document["tracking"], document["tracking"].get("backend") == "wandb"
    out = [launcher, "isaac_groot"]
    if tracked:
        out += ["env", f"WANDB_MODE={tracking.get('mode', 'online')}", f"WANDB_ENTITY={_setting(document, 'tracking', 'entity')}"]
    out += ["python", script]
    for option, *where in NATIVE_OPTIONS:
        out += [f"--{option}", str(output if where == ["", "output"] else _setting(document, *where))]
    out += [switch(name, bool(_setting(document, *where))) for name, *where in NATIVE_SWITCHES]
    out.append(switch("use-wandb", tracked and tracking.get("enable", True)))
    jitter = document["policy"].get("color_jitter_params")
    if jitter:
        out += ["--color-jitter-params", *(str(x) for pair in jitter.items() for x in pair)]
    if tracking.get("project"):
        out += ["--wandb-project", str(tracking["project"])]
    return out


def command(document: dict[str, Any], output: str, launcher: str = "scripts/run_backend.sh", script: str = "gr00t/experiment/launch_finetune.py", resume: str | None = None) -> list[str]:
    """The trainer's argument array for a resolved configuration."""
    if backend(str(document.get("backend"))) != "isaac_groot":
        return policy_trainer(document, output, launcher, resume)
    if resume:
        raise ConfigError("the native trainer resumes from its output folder, not from a configuration")
    return native_trainer(document, output, launcher, script)


def shown(value: Any) -> str:
    """A document as text for a terminal."""
    try:
        import yaml
    except ImportError:
        return rendered(value)
    return yaml.safe_dump(value, sort_keys=False)
