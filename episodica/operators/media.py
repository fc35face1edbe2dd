"""Video probe tables: key-frame intervals, acceptance, what has to be transcoded."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import fraction


def key_intervals(flags: DataFrame, key: str, order: str, path: str = "path") -> DataFrame:
    """Per video: frames, key frames, whether it begins with one, and the longest distance from a key frame to the next or to
    the end (null for a video without a key frame, which is a defect)."""
    w = Window.partitionBy(path)
    rows = flags.withColumn("pos", F.row_number().over(w.orderBy(order)) - 1).withColumn("n", F.count("*").over(w))
    after = F.first(F.when(F.col(key), F.col("pos")), ignorenulls=True).over(w.orderBy("pos").rowsBetween(1, Window.unboundedFollowing))
    rows = rows.withColumn("gap", F.when(F.col(key), F.coalesce(after, F.col("n")) - F.col("pos")))
    return rows.groupBy(path).agg(
        F.first("n").alias("frames"), F.count_if(key).alias("key_frames"), F.bool_or((F.col("pos") == 0) & F.col(key)).alias("starts_on_key"),
        F.max("gap").cast("long").alias("max_gop"),
    )


def unusable(videos: DataFrame) -> DataFrame:
    """(path, problem) of videos (path, frames, starts_on_key, streams) that can't be read by time: none or several streams, no
    frame, or a first frame that isn't a key frame."""
    problem = F.when(~F.col("streams").eqNullSafe(F.lit(1)), "not one video stream").when(~F.coalesce(F.col("frames") > 0, F.lit(False)), "empty").when(
        ~F.coalesce("starts_on_key", F.lit(False)), "does not start on a key frame"
    )
    return videos.withColumn("problem", problem).where("problem is not null").select("path", "problem")


def probe_rows(probes: DataFrame) -> DataFrame:
    """Of a prober's documents (path, streams, packets): (path, width, height, avg_frame_rate, codec_name, streams, frames,
    max_gop, key_frames, starts_on_key) of the first stream; packets with a K among their flags are key frames."""
    s = F.get("streams", F.lit(0))
    at = F.filter(F.transform("packets", lambda p, k: F.when(F.contains(p["flags"], F.lit("K")), k)), lambda k: k.isNotNull())
    n = F.size("packets")
    gaps = F.zip_with("at", F.concat(F.slice("at", 2, F.size("at")), F.array("frames")), lambda a, b: b - a)
    rows = probes.select("path", *(s[c].alias(c) for c in ("width", "height", "avg_frame_rate", "codec_name")), F.size("streams").alias("streams"), n.alias("frames"), at.alias("at"))
    rows = rows.withColumn("max_gop", F.when(F.size("at") > 0, F.array_max(gaps))).withColumn("key_frames", F.size("at"))
    return rows.withColumn("starts_on_key", F.get("at", F.lit(0)).eqNullSafe(F.lit(0))).drop("at")


def acceptable(width: int, height: int, fps: float, tolerance: float, codec: str, max_gop: int) -> Column:
    """A probe row's format: size, rate within the tolerance, codec, key frames close enough."""
    return (F.col("width") == width) & (F.col("height") == height) & (
        F.abs(fraction(F.col("avg_frame_rate")) - fps) <= tolerance
    ) & (F.col("codec_name") == codec) & (F.col("max_gop") <= max_gop)


def decision(codec: str, max_gop: int) -> Column:
    return F.when((F.col("codec_name") == codec) & (F.col("max_gop") <= max_gop), "copy").otherwise("transcode")


def by_camera(probes: DataFrame) -> DataFrame:
    return probes.groupBy("camera").agg(F.count("*").alias("files"), F.sum("frames").alias("frames"), F.max("max_gop").alias("max_gop"))
