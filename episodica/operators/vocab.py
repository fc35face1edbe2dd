"""Dictionary vocabularies: contiguity, union by text, re-encoding of index columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def contiguity_violations(vocabulary: DataFrame, index: str, text: str) -> DataFrame:
    """Entries whose index isn't their rank, or whose text is null or empty.  A vocabulary is small: one task ranks it."""
    out = vocabulary.withColumn("expected", (F.row_number().over(Window.orderBy(index)) - 1).cast("long"))
    return out.where(~F.col(index).eqNullSafe(F.col("expected")) | F.col(text).isNull() | (F.trim(text) == "")).select(F.col(index).alias("observed"), "expected", text)


def union(vocabularies: DataFrame, index: str, text: str, source: str = "source_id") -> DataFrame:
    """Of (source, index, text) the merged vocabulary (index, text): distinct texts in order of source, then index."""
    first = vocabularies.groupBy(text).agg(F.min(F.struct(source, index)).alias("f"))
    return first.select((F.row_number().over(Window.orderBy("f")) - 1).cast("long").alias(index), text)


def mapping(vocabularies: DataFrame, merged: DataFrame, index: str, text: str, source: str = "source_id") -> DataFrame:
    """(source, old index, new_<index>) for every entry."""
    new = merged.select(F.col(index).alias(f"new_{index}"), F.col(text).alias("__t"))
    return vocabularies.join(new, vocabularies[text] == new["__t"]).select(source, index, f"new_{index}")


def conflicts(vocabularies: DataFrame, text: str, shared: list[str], source: str = "source_id") -> DataFrame:
    """Texts for which sources disagree on a shared column other than the index."""
    out = vocabularies.groupBy(text).agg(*(F.count_distinct(F.coalesce(F.col(c).cast("string"), F.lit("\0"))).alias(c) for c in shared))
    wrong = F.lit(False)
    for c in shared:
        wrong = wrong | (F.col(c) > 1)
    return out.where(wrong).select(text)


def remap(frames: DataFrame, pairs: DataFrame, keys: list[str], new: str, strict: bool = True) -> DataFrame:
    """`frames` with its last key replaced by the mapping's `new`; a key that isn't mapped is an error if strict, else null."""
    out = frames.join(pairs, keys, "left")
    value = F.col(new)
    if strict:
        value = F.when(
            F.col(new).isNull(),
            F.raise_error(F.concat(F.lit(f"no mapping for {keys[-1]} "), F.coalesce(F.col(keys[-1]).cast("string"), F.lit("null")))).cast("long")
        ).otherwise(F.col(new))
    return out.withColumn(keys[-1], value).select(*(f"`{c}`" for c in frames.columns))


def unresolved(frames: DataFrame, vocabulary: DataFrame, index: str) -> DataFrame:
    """Index values of frames that the vocabulary lacks."""
    return frames.select(index).distinct().join(vocabulary.select(index), index, "left_anti")


def prompt_index(use_subtask: bool, subtask: str = "subtask_index", size: int | None = None) -> Column:
    """Task index of a language view: the subtask's, or 0 for one prompt an episode.  A subtask outside a vocabulary of
    `size` prompts is an error."""
    if not use_subtask:
        return F.lit(0).cast("long")
    if size is None:
        return F.col(subtask).cast("long")
    inside = F.coalesce(F.col(subtask).between(0, size - 1), F.lit(False))
    return F.when(inside, F.col(subtask).cast("long")).otherwise(
        F.raise_error(F.concat(F.lit("outside the task vocabulary: "), F.coalesce(F.col(subtask).cast("string"), F.lit("null")))).cast("long")
    )


def task_problems(tasks: DataFrame, text: str = "task") -> DataFrame:
    """(text, problem): task texts that are blank or stand more than once."""
    blank = tasks.where(F.col(text).isNull() | (F.trim(text) == "")).select(text, F.lit("blank").alias("problem"))
    return blank.unionAll(duplicates(tasks, text).select(text, F.lit("not unique").alias("problem")))


def remap_lists(lists: Column, lookup: Column) -> Column:
    """Ids in an array replaced by a map; an id that the map lacks is an error."""
    new = lambda i: F.element_at(lookup, i.cast("long"))
    return F.transform(lists, lambda i: F.when(new(i).isNull(), F.raise_error(F.concat(F.lit("no new id for "), i.cast("string"))).cast("long")).otherwise(new(i)))


def texts_of(indices: Column, lookup: Column) -> Column:
    """Texts of an array of indices, from a map."""
    return F.transform(indices, lambda i: F.element_at(lookup, i))


def duplicates(vocabulary: DataFrame, text: str) -> DataFrame:
    """Texts that stand more than once."""
    return vocabulary.groupBy(text).agg(F.count("*").alias("entries")).where("entries > 1")


def differences(a: DataFrame, b: DataFrame) -> DataFrame:
    """Entries of one vocabulary that the other lacks, with the side that has them."""
    return a.exceptAll(b).withColumn("side", F.lit("left")).unionAll(b.exceptAll(a).withColumn("side", F.lit("right")))
