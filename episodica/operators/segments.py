"""Runs of equal values within episodes: boundaries, segments, de-duplicated sequences, annotation blocks.

Every operator partitions by the episode once; the later steps reuse that partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

EPISODE = "episode_index"


def _in_episode(episode: str, order: list[str]):
    return Window.partitionBy(episode).orderBy(*order)


def positions(frames: DataFrame, order: list[str], episode: str = EPISODE) -> DataFrame:
    """pos: 0-based place of each frame in its episode."""
    return frames.withColumn("pos", (F.row_number().over(_in_episode(episode, order)) - 1).cast("long"))


def with_runs(frames: DataFrame, value: str, order: list[str], episode: str = EPISODE) -> DataFrame:
    """pos, changed (a run begins here) and run (its number in the episode)."""
    w = _in_episode(episode, order)
    out = positions(frames, order, episode)
    out = out.withColumn("changed", (F.col("pos") == 0) | ~F.lag(value).over(w).eqNullSafe(F.col(value)))
    return out.withColumn("run", (F.sum(F.col("changed").cast("long")).over(w) - 1).cast("long"))


def run_segments(frames: DataFrame, value: str, order: list[str], episode: str = EPISODE) -> DataFrame:
    """(episode, run, value, start_frame, end_frame, length): half-open maximal runs."""
    runs = with_runs(frames, value, order, episode).groupBy(episode, "run").agg(F.first(value).alias(value), F.min("pos").alias("start_frame"), (F.max("pos") + 1).alias("end_frame"))
    return runs.withColumn("length", F.col("end_frame") - F.col("start_frame"))


def run_values(frames: DataFrame, value: str, order: list[str], episode: str = EPISODE) -> DataFrame:
    """Per episode the values with consecutive repeats removed, in order (A, B, A stays A, B, A)."""
    starts = with_runs(frames, value, order, episode).where("changed")
    return starts.groupBy(episode).agg(_ordered(F.collect_list(F.struct("run", F.col(value).alias("v")))).alias("values"))


def first_seen(frames: DataFrame, value: str, order: list[str], episode: str = EPISODE) -> DataFrame:
    """Per episode its distinct values in the order they first occur (A, B, A becomes A, B)."""
    seen = positions(frames, order, episode).groupBy(episode, value).agg(F.min("pos").alias("p"))
    return seen.groupBy(episode).agg(_ordered(F.collect_list(F.struct("p", F.col(value).alias("v")))).alias("values"))


def _ordered(pairs: Column) -> Column:
    return F.transform(F.array_sort(pairs), lambda s: s["v"])


def segment_lengths(segments: DataFrame, value: str) -> DataFrame:
    """Per value: how many segments, their smallest and largest length, their frames."""
    return segments.groupBy(value).agg(F.count("*").alias("segments"), F.min("length").alias("min_length"), F.max("length").alias("max_length"), F.sum("length").alias("frames"))


def annotation_blocks(segments: DataFrame, value: str, instruction: str, episode: str = EPISODE) -> DataFrame:
    """Per episode an array of (sub_task_idx, sub_task_instruction, frame_duration [start, end)), in order."""
    block = F.struct(
        F.col("start_frame"),
        F.struct(
            F.col(value).alias("sub_task_idx"),
            F.col(instruction).alias("sub_task_instruction"),
            F.array("start_frame", "end_frame").alias("frame_duration")
        ).alias("v")
    )
    return segments.groupBy(episode).agg(_ordered(F.collect_list(block)).alias("sub_task_annotation"))


def annotation_mismatches(segments: DataFrame, annotations: DataFrame, value: str, episode: str = EPISODE) -> DataFrame:
    """Observed runs against annotation entries by place: rows where either is missing or value or range differ."""
    seen = segments.select(
        F.col(episode).alias("e"),
        F.col("run").alias("p"),
        F.col(value).alias("observed_value"),
        F.col("start_frame").alias("observed_start"),
        F.col("end_frame").alias("observed_end")
    )
    said = annotations.select(F.col(episode).alias("e"), F.posexplode("sub_task_annotation").alias("p", "s")).select(
        "e",
        F.col("p").cast("long").alias("p"),
        F.col("s.sub_task_idx").alias("annotated_value"),
        F.col("s.frame_duration")[0].alias("annotated_start"),
        F.col("s.frame_duration")[1].alias("annotated_end")
    )
    same = F.lit(True)
    for c in ("value", "start", "end"):
        same = same & F.col(f"observed_{c}").eqNullSafe(F.col(f"annotated_{c}"))
    return seen.join(said, ["e", "p"], "full_outer").where(~same).withColumnsRenamed({"e": episode, "p": "segment"})
