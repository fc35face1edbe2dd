"""Action-horizon windows against segment boundaries.

A start is valid if the next H frames exist, and crosses a boundary if they hold another value.  The next run's
start is found by one backward pass over the episode, so no frame is compared with the H frames after it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .segments import EPISODE, with_runs


def _ahead(frames: DataFrame, value: str, order: list[str], episode: str) -> DataFrame:
    """Each frame with n (frames of its episode), next (where the next run begins, and its value) and offset (how far that is)."""
    back = Window.partitionBy(episode).orderBy(F.desc("pos")).rowsBetween(Window.unboundedPreceding, -1)
    out = with_runs(frames, value, order, episode).withColumn("n", F.count("*").over(Window.partitionBy(episode)))
    out = out.withColumn("next", F.last(F.when(F.col("changed"), F.struct(F.col("pos").alias("p"), F.col(value).alias("v"))), ignorenulls=True).over(back))
    return out.withColumn("offset", F.col("next.p") - F.col("pos"))


def _valid(horizon: int) -> Column:
    return F.col("pos") + horizon <= F.col("n")


def _crossing(horizon: int) -> Column:
    return _valid(horizon) & F.coalesce(F.col("offset") < horizon, F.lit(False))


def horizon_starts(frames: DataFrame, value: str, order: list[str], horizon: int, episode: str = EPISODE) -> DataFrame:
    """Each frame with n (frames of its episode), valid, crossing, and what comes next: next (place, value) and offset."""
    return _ahead(frames, value, order, episode).withColumns({"valid": _valid(horizon), "crossing": _crossing(horizon)})


def boundary_starts(frames: DataFrame, value: str, order: list[str], horizon: int, episode: str = EPISODE) -> DataFrame:
    """The crossing starts, with the first later value and where it begins."""
    out = horizon_starts(frames, value, order, horizon, episode).where("crossing")
    return out.select(
        episode,
        "frame_index",
        "index",
        value,
        F.col("next.v").alias(f"next_{value}"),
        F.col("offset").alias("first_next_offset"),
        F.col("next.p").alias("boundary_frame_index")
    )


def clean_starts(frames: DataFrame, value: str, order: list[str], horizon: int, episode: str = EPISODE) -> DataFrame:
    """The valid starts whose horizon stays within one run: what a boundary-safe sampler may draw."""
    return horizon_starts(frames, value, order, horizon, episode).where("valid and not crossing").select(episode, "frame_index", "index", value)


def boundary_stats(frames: DataFrame, value: str, order: list[str], *horizons: int, episode: str = EPISODE) -> DataFrame:
    """A row a horizon: frames, boundaries (runs less one an episode), valid, crossing and clean starts, crossing share (0 if
    none is valid).  All horizons are counted in one pass over the frames."""
    each = [
        F.struct(
            F.lit(h).cast("long").alias("horizon"), F.count_if(_valid(h)).alias("valid_starts"), F.count_if(_crossing(h)).alias("crossing_starts"),
            F.count_if(_valid(h) & ~_crossing(h)).alias("clean_starts")
        ) for h in horizons
    ]
    one = _ahead(frames, value, order, episode).agg(
        F.count("*").alias("frames"), F.count_if(F.col("changed") & (F.col("pos") > 0)).alias("boundaries"), F.array(*each).alias("each")
    )
    out = one.select("frames", "boundaries", F.inline("each")).select("horizon", "frames", "boundaries", "valid_starts", "crossing_starts", "clean_starts")
    return out.withColumn("crossing_fraction", F.round(F.coalesce(F.try_divide("crossing_starts", "valid_starts"), F.lit(0.0)), 6))
