"""Driver-sized documents: metadata views and updates, receipts, run manifests, blank results, queue transitions."""

from __future__ import annotations

import copy
import hashlib
import re
import shlex
from dataclasses import dataclass, replace
from datetime import UTC, datetime
from pathlib import PurePosixPath
from typing import Any

from ..functions.config import canonical

#: The video settings a contract compares; all others may differ between sources.
VIDEO_KEYS = ("video.fps", "video.height", "video.width", "video.channels", "video.codec", "video.pix_fmt", "video.is_depth_map", "has_audio")


class DocumentError(ValueError):
    """A document that lacks what it must have."""


def feature_view(info: dict[str, Any]) -> dict[str, Any]:
    """Features as merges compare them: without a tensor's own rate, and of video settings only the contract's, all of
    which a video must state."""
    out = {}
    for name, feature in (info.get("features") or {}).items():
        if not isinstance(feature, dict):
            raise DocumentError(f"feature {name} is no mapping")
        one = {k: v for k, v in feature.items() if k != "fps"}
        if one.get("dtype") == "video":
            said = one.get("info")
            lost = sorted(set(VIDEO_KEYS) - set(said)) if isinstance(said, dict) else sorted(VIDEO_KEYS)
            if lost:
                raise DocumentError(f"video feature {name} lacks {', '.join(lost)}")
            one["info"] = {k: said[k] for k in VIDEO_KEYS}
        out[name] = one
    return out


def feature_differences(infos: list[dict[str, Any]]) -> list[str]:
    """Names of features that aren't the same in all sources."""
    views = [feature_view(i) for i in infos]
    return sorted(n for n in set().union(*views) if any(v.get(n) != views[0].get(n) for v in views))


def updated_info(info: dict[str, Any], names: dict[str, list[str]], video_bytes: int = 0, data_bytes: int = 0) -> dict[str, Any]:
    """Info with vector features cut to the given names; its sizes in megabytes, where it states any, are those given."""
    out = copy.deepcopy(info)
    for feature, keep in names.items():
        out["features"][feature] |= {"shape": [len(keep)], "names": list(keep)}
    sizes = {"total_videos_size_in_mb": video_bytes / 1e6, "total_size_in_mb": (video_bytes + data_bytes) / 1e6}
    return out | {k: v for k, v in sizes.items() if k in out}


def source_problems(info: dict[str, Any], names: list[str], cameras: dict[str, list[int]], fps: float, version: str = "v3.0") -> list[str]:
    """Why a source can't be sliced to `names`: version, rate, cameras' shapes, and state and action names, which must be
    unique and begin with exactly these, in this order."""
    out = [] if info.get("codebase_version") == version else [f"version {info.get('codebase_version')}"]
    if info.get("fps") != fps:
        out.append(f"fps {info.get('fps')}")
    features = info.get("features") or {}
    for camera, shape in cameras.items():
        if list((features.get(camera) or {}).get("shape") or []) != shape:
            out.append(f"{camera} shape")
    for vector in ("observation.state", "action"):
        feature = features.get(vector) or {}
        found, shape = list(feature.get("names") or []), list(feature.get("shape") or [])
        if len(set(found)) != len(found) or shape != [len(found)]:
            out.append(f"{vector} names")
        elif found[: len(names)] != names:
            out.append(f"{vector} order")
    return out


def control_positions(info: dict[str, Any], names: list[str], dims: dict[str, int]) -> dict[str, list[int]]:
    """Where the controls stand in each vector; they must be its first ones, in order, of as many dimensions as are said."""
    out = {}
    for vector, n in dims.items():
        feature = (info.get("features") or {}).get(vector) or {}
        found = list(feature.get("names") or [])
        if list(feature.get("shape") or []) != [n] or any(c not in found for c in names):
            raise DocumentError(f"{vector} lacks controls or isn't {n}-dimensional")
        out[vector] = [found.index(c) for c in names]
        if out[vector] != list(range(len(names))):
            raise DocumentError(f"unexpected order in {vector}: {out[vector]}")
    return out


def letterboxed_info(info: dict[str, Any], camera: str, height: int, width: int) -> dict[str, Any]:
    """Info with a camera's picture in a frame of another size."""
    out = copy.deepcopy(info)
    feature = out["features"][camera]
    feature["shape"] = [3, height, width]
    feature["info"] = (feature.get("info") or {}) | {"video.height": height, "video.width": width}
    return out


def derivation_receipt(
    source: str, revision: str | None, manifest_sha256: str | None, before: dict[str, Any], after: dict[str, Any], cameras: dict[str, dict[str, Any]], tasks: list[str],
    max_gop: int, crf: int, preset: str
) -> dict[str, Any]:
    """What a derivative was made from and how; cameras: their source, output and operation counts."""
    vector = lambda k: {
        "source_dimension": before["features"][k]["shape"][0],
        "output_dimension": after["features"][k]["shape"][0],
        "names": list(after["features"][k]["names"])
    }
    return {
        "source": source, "source_revision": revision, "source_manifest_sha256": manifest_sha256, "state": vector("observation.state"), "action": vector("action"),
        "cameras": {k: {"capture": "native_640x480_15fps", "geometry_transform": "identity"} | v for k, v in cameras.items()},
        "camera_file_operation": f"native geometry retained; H.264 max GOP {max_gop}; long-GOP streams re-encoded with CRF {crf}, preset {preset}; no resize, crop, pad, or letterbox",
        "image_statistics": "copied from source; training uses ImageNet statistics by default", "tasks": tasks,
    }


def launch_plan(name: str, run_folder: str, output: str, command: list[str], free_bytes: int, least_gib: float, present: list[str], resume: bool = False) -> dict[str, Any]:
    """What a launch would do: enough space, nothing written over, a saved configuration where it resumes."""
    free = free_bytes / (1 << 30)
    if free < least_gib:
        raise DocumentError(f"{free:.1f} GiB free; {least_gib:.1f} GiB required")
    saved = f"{output}/checkpoints/last/pretrained_model/train_config.json"
    if resume and saved not in present:
        raise DocumentError(f"resume config missing: {saved}")
    if not resume and output in present:
        raise DocumentError(f"existing output directory: {output}")
    return {"run_name": name, "run_dir": run_folder, "output_dir": output, "command": command}


def missing_payloads(present: list[str], version: str | None, required: list[str], expected_version: str = "v3.0") -> list[str]:
    """What a source lacks to be merged."""
    return ([f"version {version}"] if version != expected_version else []) + [r for r in required if r not in present]


def stamp(now: datetime | None = None, compact: bool = False) -> str:
    return (now or datetime.now(UTC)).astimezone(UTC).strftime("%Y%m%dT%H%M%SZ" if compact else "%Y-%m-%dT%H:%M:%SZ")


def digest(value: Any) -> str:
    return hashlib.sha256(canonical(value).encode()).hexdigest()


def run_manifest(
    name: str, config: dict, command: list[str], source: str, run_folder: str, output: str, backend: str, dataset: dict, code: dict, now: datetime | None = None
) -> dict[str, Any]:
    """What a run was: digests of its configuration and command, its dataset's fingerprint, its code, its folders."""
    said = (shlex.join(command) + "\n").encode()
    return {
        "schema_version": 1, "created_utc": stamp(now), "run_name": name, "backend": backend, "source_config": source, "config_sha256": digest(config),
        "command_sha256": hashlib.sha256(said).hexdigest(), "dataset": dataset, "code": code, "paths": {"run_dir": run_folder, "output_dir": output},
        "safety": {"robot_hardware_invoked": False, "allowed_backend": backend},
    }


#: What a language view's receipt says of prompts that change with the subtask, and of one that doesn't.
LIMITATIONS = {
    True: "Current-frame language supervises an H40 action chunk; boundary starts mix two subtasks.",
    False: "The one full-episode prompt covers both sides of each subtask boundary.",
}


def language_receipt(
    mode: str,
    own: bool,
    vocabulary: list[str],
    tree: str,
    parent: str,
    destination: str,
    parent_receipts: dict[str, str],
    media: dict,
    boundaries: dict,
    path: str,
    sha256: str,
    kind: str = "task700013_language_variant"
) -> dict[str, Any]:
    """`own`: whether each subtask has a prompt of its own; `boundaries`: the statistics of the starts that cross one."""
    return {
        "schema_version": 1, "kind": kind, "tree_kind": tree, "parent_root": parent, "destination_root": destination, "parent_receipts": parent_receipts,
        "language_mode": mode, "task_vocabulary": vocabulary, "task_index_source": "subtask_index" if own else "constant_zero", "rich_subtask_annotations_preserved": True,
        "media": media, "h40_boundary_manifest": path, "h40_boundary_manifest_sha256": sha256,
        "h40": boundaries | {"language_conflict_start_count": boundaries["cross_boundary_start_count"] if own else 0, "limitation": LIMITATIONS[own]},
    }


def boundary_report(row: Any, episodes: int, lengths: list[Any]) -> dict[str, Any]:
    """Boundary statistics (a row of `horizon.boundary_stats`) under the names of receipts; `lengths`: rows of segment_lengths."""
    return {
        "episode_count": episodes, "subtask_boundary_count": row["boundaries"], "valid_h40_start_count": row["valid_starts"], "cross_boundary_start_count": row["crossing_starts"],
        "clean_start_count": row["clean_starts"], "cross_boundary_fraction": row["crossing_starts"] / row["valid_starts"] if row["valid_starts"] else 0.0,
        "segment_lengths": {str(r[0]): {"count": r["segments"], "min": r["min_length"], "max": r["max_length"]} for r in sorted(lengths, key=lambda r: r[0])}, "sampling_change_applied": False,
    }


def acknowledgement(package: str, sums_sha256: str, receipt: str, receipt_sha256: str, now: datetime | None = None) -> dict[str, Any]:
    return {
        "schema_version": 1, "acknowledged_utc": stamp(now), "package": package, "package_sha256s_sha256": sums_sha256,
        "consumer_receipt": receipt, "consumer_receipt_sha256": receipt_sha256, "consumer_status": "acknowledged",
    }


def blank_result(name: str) -> dict[str, Any]:
    """A result before its run."""
    empty = lambda *keys: dict.fromkeys(keys)
    return {
        "schema_version": 1, "run_name": name, "status": {"state": "not_started"} | empty("exit_code", "failure_category"), "timing": empty("started_utc", "finished_utc", "runtime_seconds"),
        "wandb": empty("entity", "project", "run_id", "url"), "metrics": empty("best_eval_loss", "best_eval_step", "final_eval_loss", "final_train_loss", "samples_per_second", "cuda_memory_gib"),
        "best_checkpoint": empty("step", "path", "selection_reason"), "artifacts": empty("resolved_config", "manifest", "train_log", "pretrained_model"),
        "summary": None, "interpretation": None, "anomalies": [], "next_action": None,
        "evaluation": {k: {"status": "not_evaluated", "notes": None} for k in ("offline", "shadow", "guarded_hardware")},
    }


#: What a result says of the checkpoint it names, and of a run that ended well.
LAST_SAVED = "Last saved endpoint; not quality-selected."
REVIEW = "Trainer exited successfully. Review evaluation before selecting a checkpoint."


def finished_result(
    result: dict[str, Any], code: int, category: str | None, seconds: float, metrics: dict[str, Any] | None, model: str | None, now: datetime | None = None
) -> dict[str, Any]:
    """A running result after its trainer ended; `metrics`: the last reported, `model`: the folder it left, if complete."""
    out = copy.deepcopy(result)
    out["status"] = {"state": "failed" if code else "completed", "exit_code": code, "failure_category": category}
    out["timing"] |= {"finished_utc": stamp(now), "runtime_seconds": round(seconds, 3)}
    if metrics:
        out["metrics"] |= {"final_train_loss": metrics["loss"]} | {k: metrics[k] for k in ("samples_per_second", "cuda_memory_gib")}
    if model:
        out["artifacts"]["pretrained_model"] = model
        out["best_checkpoint"] = {"step": metrics["step"] if metrics else None, "path": model, "selection_reason": LAST_SAVED}
    return out if code else out | {"summary": REVIEW}


def package_manifest(name: str, backend: str, family: str, run: str | None, result: str, config: str, model: str, manifest: str | None, now: datetime | None = None) -> dict[str, Any]:
    return {
        "schema_version": 1, "created_utc": stamp(now), "package_name": name, "backend": backend, "model_family": family, "source_run": run, "source_result": result,
        "source_resolved_config": config, "source_model": model, "source_manifest": manifest, "action_representation": "absolute", "load_path": ".", "consumer_status": "not_acknowledged",
    }


def transfer_plan(package: str, backend: str, family: str, target: str, workspace: str, port: int, now: datetime | None = None) -> dict[str, Any]:
    """What a transfer would do; nothing is sent from here."""
    if not re.fullmatch(r"[A-Za-z0-9_][A-Za-z0-9_.-]*@[A-Za-z0-9][A-Za-z0-9.-]*", target):
        raise DocumentError(f"unsafe target {target}")
    if not 1 <= port <= 65535:
        raise DocumentError(f"port {port}")
    folder, name = PurePosixPath(workspace), PurePosixPath(package).name
    if not folder.is_absolute() or ".." in folder.parts:
        raise DocumentError(f"workspace {workspace} isn't absolute")
    final = folder / "model" / family / name
    return {
        "state": "dry_run", "package": package, "backend": backend, "target": target, "port": port, "robot_workspace": {"selected": workspace, "state": "planned", "device_inode": None},
        "remote_stage_path": str(final.with_name(f".{name}.partial-{stamp(now, True)}")), "remote_host_path": str(final),
        "remote_container_path": str(PurePosixPath("/workspace/model") / family / name), "consumer_status": "not_acknowledged",
    }


def alias(summary: dict[str, Any], names: list[str]) -> Any:
    """The value of the first name that is present, even if it is null."""
    return next((summary[n] for n in names if n in summary), None)


@dataclass(frozen=True)
class Entry:
    """A queue's run and where it stands."""

    name: str
    state: str = "pending"
    attempts: int = 0


@dataclass(frozen=True)
class Budget:
    max_attempts: int = 1
    stop_on_failure: bool = True
    seconds: float | None = None
    disk_bytes: int = 0


def next_run(queue: list[Entry], budget: Budget, elapsed: float, free_bytes: int) -> Entry | None:
    """The entry to run next, or None: the queue is done, out of time or disk, or stopped by a failure."""
    if (budget.seconds is not None and elapsed >= budget.seconds) or free_bytes < budget.disk_bytes:
        return None
    for e in queue:
        if e.state == "failed" and e.attempts >= budget.max_attempts and budget.stop_on_failure:
            return None
        if e.state == "pending" or (e.state == "failed" and e.attempts < budget.max_attempts):
            return e
    return None


def after(entry: Entry, exit_code: int | None) -> Entry:
    """The entry after an attempt (None: it was blocked before it began)."""
    if exit_code is None:
        return replace(entry, state="blocked")
    return replace(entry, state="completed" if exit_code == 0 else "failed", attempts=entry.attempts + 1)
