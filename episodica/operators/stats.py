"""Statistics of integer columns and vectors; pooling of per-episode statistics.

All in double precision with population variance; a vector's dimensions are exploded, so partial sums are combined
before the shuffle and one row a dimension crosses it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Smallest deviation reported for vector features.
FLOOR = 1e-3


def numeric(column: str) -> list[Column]:
    """mean, population std, min and max as doubles, count."""
    x = F.col(column).cast("double")
    return [F.avg(x).alias("mean"), F.stddev_pop(x).alias("std"), F.min(x).alias("min"), F.max(x).alias("max"), F.count(x).alias("count")]


def column_stats(df: DataFrame, columns: list[str], group: list[str] | None = None) -> DataFrame:
    """Long form (group, feature, mean, std, min, max, count) of numeric columns in one pass."""
    wide = df.select(*(group or []), F.explode(F.create_map(*(x for c in columns for x in (F.lit(c), F.col(c).cast("double"))))).alias("feature", "value"))
    return wide.groupBy(*(group or []), "feature").agg(*numeric("value"))


def vector_stats(df: DataFrame, vector: str, group: list[str] | None = None, floor: float = FLOOR) -> DataFrame:
    """(group, dim, mean, std, min, max, count) of an array column; std at least `floor`."""
    long = df.select(*(group or []), F.posexplode(vector).alias("dim", "value"))
    out = long.groupBy(*(group or []), "dim").agg(*numeric("value"))
    return out.withColumn("std", F.greatest("std", F.lit(floor)))


def pooled(parts: DataFrame, keys: list[str]) -> DataFrame:
    """Pools (keys, mean, std, min, max, count) rows: count-weighted mean, deviation from within and between, extremes.

    Two passes: deviations are taken from the pooled mean, not from a difference of squares."""
    n = parts.groupBy(*keys).agg(F.sum("count").alias("count"), (F.sum(F.col("count") * F.col("mean")) / F.sum("count")).alias("mean"), F.min("min").alias("min"), F.max("max").alias("max"))
    each = parts.select(*keys, F.col("count").alias("c"), F.col("mean").alias("m"), F.col("std").alias("s")).join(n, keys)
    spread = each.groupBy(*keys).agg(F.sqrt(F.sum(F.col("c") * (F.col("s") ** 2 + (F.col("m") - F.col("mean")) ** 2)) / F.sum("c")).alias("std"))
    return n.join(spread, keys).select(*keys, "mean", "std", "min", "max", "count")


def incomplete(parts: DataFrame) -> DataFrame:
    """Statistics rows that lack a value."""
    return parts.where("mean is null or std is null or min is null or max is null or count is null")


def padded_moments(mean: Column, std: Column, kept: float = 0.75) -> tuple[Column, Column]:
    """Moments of an image of which the share `kept` is picture and the rest black."""
    m = mean * kept
    return m, F.sqrt(F.greatest((std**2 + mean**2) * kept - m**2, F.lit(0.0)))
