"""Numbering without a global window: ranks, prefix sums and gap-free indices in one pass over ranges.

Rows are dealt to tasks by ranges of the order columns, sorted there, and written once with their place in the task; only
the tasks' totals (a row each) are accumulated in one place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..tables import written

#: Of monotonically_increasing_id: the bits of a row's place in its task, above which stands the task.
_PLACE = 33


def running_totals(df: DataFrame, order: list[str], sums: dict[str, Column | None]) -> DataFrame:
    """`df` and, for each name, the sum of a column over all rows before each in the order (None: how many rows these are)."""
    values = {n: v for n, v in sums.items() if v is not None}
    id_, first = "__id", {n: f"__first_{n}" for n in sums}
    x = df.withColumns({f"__{n}": v.cast("long") for n, v in values.items()}) if values else df
    x = written(x.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(id_, F.monotonically_increasing_id()), "numbered")
    task = F.shiftright(F.col(id_), _PLACE)
    totals = x.groupBy(task.alias("__task")).agg(*(F.count("*").alias(n) if v is None else F.sum(f"__{n}").alias(n) for n, v in sums.items()))
    ahead = Window.orderBy("__task").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(F.col("__task").alias("__of"), *(F.coalesce(F.sum(n).over(ahead), F.lit(0)).alias(first[n]) for n in sums))
    x = x.withColumn("__task", task)
    within = Window.partitionBy("__task").orderBy(id_).rowsBetween(Window.unboundedPreceding, -1)
    place = F.col(id_).bitwiseAND(F.lit((1 << _PLACE) - 1))
    x = x.withColumns({f"__in_{n}": place if v is None else F.coalesce(F.sum(f"__{n}").over(within), F.lit(0)) for n, v in sums.items()})
    x = x.join(F.broadcast(starts), F.col("__task") == F.col("__of"))  # a row for each task
    return x.select(*(f"`{c}`" for c in df.columns), *((F.col(first[n]) + F.col(f"__in_{n}")).cast("long").alias(n) for n in sums))


def running_total(df: DataFrame, order: str, value: Column | None = None, name: str = "before", ties: tuple[str, ...] = ()) -> DataFrame:
    """`df` and the sum of `value` (by default 1) over all rows before each in the order, `ties` breaking equal ones."""
    return running_totals(df, [order, *ties], {name: value})


def compact_ids(df: DataFrame, key: str, name: str) -> DataFrame:
    """(key, name): the distinct keys numbered 0, 1, ... in order, gaps closed."""
    return running_total(df.select(key).distinct(), key, name=name)


def episode_offsets(lengths: DataFrame, order: str, length: str = "length") -> DataFrame:
    """Lengths with dataset_from_index and dataset_to_index (exclusive)."""
    out = running_total(lengths, order, F.col(length), "dataset_from_index")
    return out.withColumn("dataset_to_index", F.col("dataset_from_index") + F.col(length))


def global_index_violations(rows: DataFrame, order: str, index: str, ties: tuple[str, ...] = ()) -> DataFrame:
    """Rows whose `index` isn't their 0-based place in the order."""
    return running_total(rows, order, name="expected", ties=ties).where(~F.col(index).eqNullSafe(F.col("expected"))).select(index, "expected")


def file_positions(rows: DataFrame, path: str = "file_path", row: str = "row_index", name: str = "place") -> DataFrame:
    """Each row's place in (path by components, row) order: file offsets come from per-file counts, so only they
    (one row a file) are accumulated in one place."""
    counts = rows.groupBy(path).agg(F.count("*").alias("c"))
    first = counts.select(F.col(path).alias("__p"), F.coalesce(F.sum("c").over(Window.orderBy(F.split(path, "/")).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__first"))
    return rows.join(first, rows[path] == first["__p"]).withColumn(name, (F.col("__first") + F.col(row)).cast("long")).drop("__p", "__first")


def file_order_violations(rows: DataFrame, path: str, row: str, index: str) -> DataFrame:
    """Rows whose `index` isn't their place in the files."""
    return file_positions(rows, path, row, "expected").where(~F.col(index).eqNullSafe(F.col("expected"))).select(path, row, index, "expected")


def contiguity_violations(frames: DataFrame, group: str, number: str, order: list[str], start: int = 0) -> DataFrame:
    """Frames whose `number` isn't start, start + 1, ... within its group."""
    place = F.row_number().over(Window.partitionBy(group).orderBy(*order)) - 1 + start
    return frames.withColumn("expected", place.cast("long")).where(~F.col(number).eqNullSafe(F.col("expected"))).select(group, "expected", F.col(number).cast("long").alias("observed"))


def bounds(frames: DataFrame, episode: str = "episode_index", index: str = "index") -> DataFrame:
    """Per episode: first index, last index + 1, frames, and whether its indices are contiguous."""
    out = frames.groupBy(episode).agg(F.min(index).alias("from_index"), (F.max(index) + 1).alias("to_index"), F.count("*").alias("frames"))
    return out.withColumn("contiguous", F.col("to_index") - F.col("from_index") == F.col("frames"))


def bounds_of_ids(rows: DataFrame, id_: str) -> DataFrame:
    """One row: n, least and most of the ids, and whether they are 0, 1, ..., n - 1."""
    out = rows.agg(F.count("*").alias("n"), F.count_distinct(id_).alias("__d"), F.min(id_).alias("least"), F.max(id_).alias("most"))
    dense = (F.col("n") == 0) | ((F.col("__d") == F.col("n")) & (F.col("least") == 0) & (F.col("most") == F.col("n") - 1))
    return out.select("n", "least", "most", F.coalesce(dense, F.lit(False)).alias("dense"))


def timestamps(frame: Column, fps: float) -> Column:
    """Seconds of a frame number, in single precision as stored."""
    return (frame / F.lit(float(fps))).cast("float")


def media_interval(base: Column, start: Column, end: Column, fps: float) -> tuple[Column, Column]:
    """Where frames [start, end) lie in a video that begins at `base` seconds."""
    return base + start / F.lit(float(fps)), base + end / F.lit(float(fps))
