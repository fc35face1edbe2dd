"""Streams: training logs as they are written, run states, and event-time windows (an extension)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import METRICS, step_metrics


def log_stream(spark: SparkSession, folder: str, per_trigger: int = 100) -> DataFrame:
    """(path, line) of log files that appear below a folder."""
    df = spark.readStream.option("maxFilesPerTrigger", per_trigger).text(folder)
    return df.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("line"))


def metrics(lines: DataFrame) -> DataFrame:
    """Metric rows of step lines, batch or stream alike."""
    return lines.withColumn("m", step_metrics(F.col("line"))).where("m is not null").select("path", "m.*")


def last_metrics(lines: DataFrame) -> DataFrame:
    """The metrics of the largest step of each path so far (a stream keeps one row a path)."""
    return metrics(lines).where("step is not null").groupBy("path").agg(F.max_by(F.struct(*METRICS), "step").alias("m")).select("path", "m.*")


def run_states(events: DataFrame, watermark: str = "1 day") -> DataFrame:
    """Each run's last state by event time; events repeated within the watermark count once."""
    once = events.withWatermark("ts", watermark).dropDuplicatesWithinWatermark(["run_name", "event_no"])
    return once.groupBy("run_name").agg(F.max_by("state", "event_no").alias("state"), F.max("attempt").alias("attempts"))


def timed(events: DataFrame, ts: str = "ts") -> DataFrame:
    """Events with a time zone-aware event time (a time without zone can't carry a watermark)."""
    return events.withColumn(ts, F.col(ts).cast("timestamp"))


def tumbling(events: DataFrame, width: str, watermark: str | None = None, ts: str = "ts") -> DataFrame:
    rows = events.withWatermark(ts, watermark) if watermark else events
    return rows.groupBy(F.window(ts, width).alias("w"), "event_type").agg(F.count("*").alias("events"), F.sum("value").alias("value")).select(
        F.col("w.start").alias("start"), "event_type", "events", "value"
    )


def sliding(events: DataFrame, width: str, slide: str, watermark: str | None = None, ts: str = "ts") -> DataFrame:
    rows = events.withWatermark(ts, watermark) if watermark else events
    return rows.groupBy(F.window(ts, width, slide).alias("w")).agg(F.count("*").alias("events")).select(F.col("w.start").alias("start"), "events")


def sessions(events: DataFrame, gap: str, watermark: str | None = None, ts: str = "ts", key: str = "user_id") -> DataFrame:
    rows = events.withWatermark(ts, watermark) if watermark else events
    return rows.groupBy(F.session_window(ts, gap).alias("w"), key).agg(F.count("*").alias("events")).select(key, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "events")
