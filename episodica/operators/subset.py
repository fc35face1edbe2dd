"""Reviewed subsets: drop excluded (episode, subtask) pairs, turn what is left into episodes of their own."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import index
from .segments import EPISODE, positions
from .stats import vector_stats


def flagged(frames: DataFrame, exclusions: DataFrame, order: list[str], subtask: str = "subtask_index", episode: str = EPISODE) -> DataFrame:
    """Frames with their place in the whole episode and whether they are kept."""
    out = exclusions.select(F.col(episode).alias("__e"), F.col(subtask).alias("__s")).distinct().withColumn("__x", F.lit(True))
    seen = positions(frames, order, episode)
    return seen.join(out, (seen[episode] == out["__e"]) & (seen[subtask] == out["__s"]), "left").withColumn("kept", F.col("__x").isNull()).drop("__e", "__s", "__x")


def islands(flags: DataFrame, episode: str = EPISODE) -> DataFrame:
    """Kept frames with the island they lie in (its key is constant over consecutive kept places)."""
    w = Window.partitionBy(episode).orderBy("pos")
    return flags.where("kept").withColumn("island", F.col("pos") - F.row_number().over(w))


def segments(kept: DataFrame, episode: str = EPISODE) -> DataFrame:
    """One row an island: source_episode, start_frame, end_frame, length, new episode id and global bounds."""
    out = kept.groupBy(episode, "island").agg(F.min("pos").alias("start_frame"), (F.max("pos") + 1).alias("end_frame"))
    out = out.withColumn("length", F.col("end_frame") - F.col("start_frame")).withColumnRenamed(episode, "source_episode")
    out = index.running_totals(out, ["source_episode", "start_frame"], {"new_episode": None, "dataset_from_index": F.col("length")})
    return out.withColumn("dataset_to_index", F.col("dataset_from_index") + F.col("length"))


def reindexed(kept: DataFrame, found: DataFrame, fps: float, episode: str = EPISODE) -> DataFrame:
    """Kept frames renumbered: new_episode, new_frame, new_index, new_timestamp."""
    s = found.select(F.col("source_episode").alias("__e"), F.col("island").alias("__i"), "new_episode", "start_frame", "dataset_from_index")
    out = kept.join(s, (kept[episode] == s["__e"]) & (kept["island"] == s["__i"])).withColumn("new_frame", F.col("pos") - F.col("start_frame"))
    return out.withColumn(
        "new_index",
        F.col("dataset_from_index") + F.col("new_frame")
    ).withColumn("new_timestamp", index.timestamps(F.col("new_frame"), fps)).drop("__e", "__i", "start_frame", "dataset_from_index", "island")


def frame_reuse(reuse: DataFrame, frames: DataFrame, episode: str = EPISODE, target: str = "target_frame_index") -> DataFrame:
    """Reuse rows whose target frame is kept, renumbered; the others go."""
    m = frames.select(F.col(episode).alias("__e"), F.col("pos").alias("__p"), "new_episode", "new_frame")
    out = reuse.join(m, (reuse[episode] == m["__e"]) & (reuse[target] == m["__p"]))
    return out.withColumn(episode, F.col("new_episode")).withColumn(target, F.col("new_frame")).select(*(f"`{c}`" for c in reuse.columns))


def counts(flags: DataFrame, subtask: str = "subtask_index") -> DataFrame:
    """Frames kept and dropped of each subtask that occurs."""
    return flags.groupBy(subtask).agg(F.count_if("kept").alias("retained"), F.count_if(~F.col("kept")).alias("excluded"))


def episode_rows(found: DataFrame, source: DataFrame, cameras: list[str], fps: float, episode: str = EPISODE) -> DataFrame:
    """New episode rows: the source's attributes, own length and bounds, media intervals moved into the source's."""
    out = found.join(source.drop("length", "dataset_from_index", "dataset_to_index"), found["source_episode"] == source[episode]).withColumn("full_episode_index", F.col("source_episode"))
    for c in cameras:
        a, b = f"videos/{c}/from_timestamp", f"videos/{c}/to_timestamp"
        start, end = index.media_interval(F.col(f"`{a}`"), F.col("start_frame"), F.col("end_frame"), fps)
        out = out.withColumn(b, end).withColumn(a, start)
    return out.withColumn(episode, F.col("new_episode")).drop("source_episode", "island", "new_episode")


def stats(frames: DataFrame, vector: str) -> DataFrame:
    return vector_stats(frames, vector, ["new_episode"])
