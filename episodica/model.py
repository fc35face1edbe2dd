"""Schemas of the dataset tables (frames, vocabularies, episodes, annotations, results, ...), as DDL."""

from __future__ import annotations

FRAMES = "episode_index long, frame_index long, index long, task_index long, subtask_index long, timestamp float"
TASKS = "task_index long, task string"
SUBTASKS = "subtask_index long, subtask string"
EPISODES = "episode_index long, length long, dataset_from_index long, dataset_to_index long, tasks array<string>, subtask_instructions array<string>"
ANNOTATION = "meta_data struct<task_duration: long, valid_duration: array<long>>, sub_task_annotation array<struct<sub_task_idx: long, sub_task_instruction: string, frame_duration: array<long>>>, task_name string, data_folder string"
INFO = "codebase_version string, fps double, total_episodes long, total_frames long, total_tasks long, annotation_path string, features map<string, struct<dtype: string, shape: array<long>, names: array<string>, info: map<string, string>>>"
STATS = "map<string, map<string, array<double>>>"
BOUNDARY_STARTS = "episode_index long, frame_index long, index long, subtask_index long, next_subtask_index long, first_next_offset long, boundary_frame_index long"
VIOLATIONS = "rule string, rule_order int, location string, expected string, observed string"
PROBES = "path string, camera string, width int, height int, avg_frame_rate string, codec_name string, max_gop long, frames long"
RESULT = (
    "schema_version int, run_name string, status struct<state: string, exit_code: int, failure_category: string>, timing struct<started_utc: string, finished_utc: string, runtime_seconds: double>, "
    "wandb struct<entity: string, project: string, run_id: string, url: string>, "
    "metrics struct<best_eval_loss: double, best_eval_step: long, final_eval_loss: double, final_train_loss: double, samples_per_second: double, cuda_memory_gib: double>, "
    "best_checkpoint struct<step: long, path: string, selection_reason: string>, artifacts struct<resolved_config: string, manifest: string, train_log: string, pretrained_model: string>"
)
PROBE = "streams array<struct<width: int, height: int, avg_frame_rate: string, codec_name: string>>, packets array<struct<flags: string>>"
