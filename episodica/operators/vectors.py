"""Vector columns: slices by position or name, finiteness, grouping by modality."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def select_dims(vector: Column, dims: list[int], kind: str = "array<float>") -> Column:
    """The given dimensions; contiguous ones as a slice.  A vector too short is an error, not a shorter slice."""
    least = max(dims) + 1
    if dims == list(range(dims[0], dims[0] + len(dims))):
        out = F.slice(vector, dims[0] + 1, len(dims))
    else:
        out = F.transform(F.lit(dims), lambda i: F.element_at(vector, i + 1))
    return F.when(vector.isNull() | (F.size(vector) >= least), out).otherwise(F.raise_error(F.lit(f"vector has fewer than {least} dimensions")).cast(kind)).cast(kind)


def all_finite(vector: Column) -> Column:
    return F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))


def positions_of(names: Column, wanted: list[str]) -> Column:
    """0-based place of each wanted name, -1 where missing."""
    return F.transform(F.lit(wanted), lambda w: F.array_position(names, w) - 1)


def has_prefix(names: Column, prefix: list[str]) -> Column:
    """The names begin with exactly these, in order, and are unique."""
    return (F.slice(names, 1, len(prefix)) == F.lit(prefix)) & (F.size(F.array_distinct(names)) == F.size(names))


def by_modality(df: DataFrame, vector: str, groups: list[tuple[str, int, int]]) -> DataFrame:
    """Each row once for every group (modality, start, end), with its slice [start, end)."""
    parts = F.array(*(F.struct(F.lit(g).alias("modality"), F.slice(F.col(vector), a + 1, b - a).alias("part")) for g, a, b in groups))
    return df.select("*", F.inline(parts))
