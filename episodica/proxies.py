"""The driver's tables in the shapes of the dataset model, so that every operator runs on them.

frames: events by user (episode), numbered by (ts, event_id); subtasks are event types in alphabetical order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

ORDER = ["ts", "index"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def subtasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event types as a vocabulary."""
    types = table(spark, sf_dir, "events").select(F.col("event_type").alias("subtask")).distinct()
    return types.select((F.row_number().over(Window.orderBy("subtask")) - 1).cast("long").alias("subtask_index"), "subtask")


def frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select(F.col("user_id").alias("episode_index"), F.col("event_id").alias("index"), "ts", F.col("event_type").alias("subtask"), "value")
    w = Window.partitionBy("episode_index").orderBy(*ORDER)
    return rows.withColumn("frame_index", (F.row_number().over(w) - 1).cast("long"))


def coded_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frames(spark, sf_dir).join(subtasks(spark, sf_dir), "subtask")


def turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as short episodes."""
    return table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("episode_index"), F.col("turn").alias("frame_index"), F.col("role").alias("subtask"), "text")


def sources(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Two merge sources: (frames, vocabularies), users by parity; the second source's vocabulary is in reverse order."""
    rows = frames(spark, sf_dir).withColumn("source_id", F.pmod("episode_index", F.lit(2)).cast("int"))
    words = subtasks(spark, sf_dir)
    both = words.select(F.lit(0).alias("source_id"), "subtask_index", "subtask").unionAll(
        words.select(F.lit(1).alias("source_id"), (F.count("*").over(Window.partitionBy()) - 1 - F.col("subtask_index")).cast("long").alias("subtask_index"), "subtask")
    )
    return rows.join(both, ["source_id", "subtask"]), both
