"""Merging datasets: compacted and shifted episodes, re-encoded vocabularies, contiguous index, pooled statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import index, segments, stats, vocab

SOURCE = "source_id"
#: Episodes of a piece of a source's range.
RANGE = 1 << 12


def compacted(frames: DataFrame, episode: str = "episode_index") -> DataFrame:
    """(source, episode, length, new_episode, dataset_from_index): each source's episode ids numbered 0.. without gaps, after all
    earlier sources', and the merged index of their first frames, in one numbering over (source, episode)."""
    ids = frames.groupBy(SOURCE, episode).agg(F.count("*").alias("length"))
    return index.running_totals(ids, [SOURCE, episode], {"new_episode": None, "dataset_from_index": F.col("length")})


def offsets(ids: DataFrame) -> DataFrame:
    """Per source: its first new episode and the one after its last."""
    return ids.groupBy(SOURCE).agg(F.min("new_episode").alias("from_episode"), (F.max("new_episode") + 1).alias("to_episode"))


def source_of(episodes: DataFrame, bounds: DataFrame, episode: str = "new_episode") -> DataFrame:
    """Episodes with their source by range.  Ranges are cut at multiples of RANGE, so that episodes find theirs by an equality, and
    neither many sources nor one with most episodes make a table that must fit in one place."""
    piece = lambda c: F.floor(c / RANGE)
    pieces = F.sequence(piece(F.col("from_episode")), piece(F.col("to_episode") - 1))
    b = bounds.where("from_episode < to_episode").select(F.col(SOURCE).alias("__s"), "from_episode", "to_episode", F.explode(pieces).alias("__piece"))
    mine = (piece(F.col(episode)) == F.col("__piece")) & (F.col(episode) >= F.col("from_episode")) & (F.col(episode) < F.col("to_episode"))
    return episodes.join(b, mine).withColumn(SOURCE, F.col("__s")).drop("__s", "__piece", "from_episode", "to_episode")


def frames(
    rows: DataFrame, vocabularies: DataFrame, order: list[str], episode: str = "episode_index", subtask: str = "subtask_index", text: str = "subtask",
    ids: DataFrame | None = None
) -> DataFrame:
    """Merged frames: new_episode, frame_index (place), new_index, new_subtask.  `rows` has source_id and these columns; a
    subtask that its source's vocabulary lacks is an error.  `ids`: of `compacted`, if it is there already."""
    ids = compacted(rows, episode) if ids is None else ids
    merged = vocab.union(vocabularies, subtask, text)
    pairs = vocab.mapping(vocabularies, merged, subtask, text)
    w = Window.partitionBy(SOURCE, episode).orderBy(*order)
    out = rows.withColumn("place", (F.row_number().over(w) - 1).cast("long")).join(ids.select(SOURCE, episode, "new_episode", "dataset_from_index"), [SOURCE, episode])
    out = out.withColumn("new_index", F.col("dataset_from_index") + F.col("place")).withColumn("new_subtask", F.col(subtask))
    known = pairs.select(SOURCE, F.col(subtask).alias("new_subtask"), F.col(f"new_{subtask}").alias("__new"))
    return vocab.remap(out, known, [SOURCE, "new_subtask"], "__new").drop("dataset_from_index")


def unmapped(rows: DataFrame, vocabularies: DataFrame, subtask: str = "subtask_index") -> DataFrame:
    """(source, subtask) of frames whose subtask their source's vocabulary lacks."""
    return rows.select(SOURCE, subtask).distinct().join(vocabularies.select(SOURCE, subtask), [SOURCE, subtask], "left_anti")


def gates(sources: DataFrame, vocabularies: DataFrame | None = None, text: str = "subtask", shared: list[str] | None = None) -> DataFrame:
    """(rule, location): why sources can't be merged; none if they can.

    sources: source_id, root, annotation_path, features (a map from name to its contract as text).  Roots must differ,
    annotation paths be there and the same, features equal those of the first source, and vocabularies agree on the
    shared columns of a text."""
    rule = lambda df, name, where: df.select(F.lit(name).alias("rule"), where.cast("string").alias("location"))
    out = rule(sources.groupBy("root").agg(F.count("*").alias("c")).where("c > 1"), "unique_roots", F.col("root"))
    out = out.unionAll(rule(sources.where("annotation_path is null"), "annotation_path", F.col("root")))
    paths = sources.agg(F.array_sort(F.collect_set("annotation_path")).alias("p")).where(F.size("p") > 1)
    out = out.unionAll(rule(paths, "one_annotation_path", F.array_join("p", " ")))
    first = sources.agg(F.min_by("features", SOURCE).alias("f"))  # one row
    each = sources.select("root", F.explode("features").alias("name", "said")).join(F.broadcast(first.select(F.explode("f").alias("name", "expected"))), "name", "full_outer")
    names = first.select(F.explode(F.map_keys("f")).alias("name"))
    lost = sources.select("root", F.map_keys("features").alias("have")).join(F.broadcast(names), ~F.array_contains("have", F.col("name")))
    out = out.unionAll(
        rule(each.where("root is not null and not said <=> expected"), "feature", F.concat_ws(" ", "root", "name"))
    ).unionAll(rule(lost, "feature", F.concat_ws(" ", "root", "name")))
    if vocabularies is not None and shared:
        out = out.unionAll(rule(vocab.conflicts(vocabularies, text, shared), "vocabulary", F.col(text)))
    return out


def episode_rows(merged: DataFrame, names: DataFrame, subtask: str = "subtask_index", text: str = "subtask") -> DataFrame:
    """Per new episode: length, tasks (distinct texts in the order first seen), refreshed index statistics."""
    words = names.select(F.col(subtask).alias("__i"), text)
    named = merged.select("new_episode", "place", "new_subtask").join(words, F.col("new_subtask") == F.col("__i"))
    seen = segments.first_seen(named, text, ["place"], "new_episode")
    agg = merged.groupBy("new_episode").agg(
        F.count("*").alias("length"),
        F.min("new_index").alias("dataset_from_index"),
        (F.max("new_index") + 1).alias("dataset_to_index"),
        *(c.alias(f"index_{n}") for c, n in zip(stats.numeric("new_index"), ("mean", "std", "min", "max", "count"), strict=True))
    )
    return agg.join(seen.withColumnRenamed("values", "tasks"), "new_episode")


def annotations(rows: DataFrame, ids: DataFrame, episode: str = "episode_index") -> DataFrame:
    """Annotation rows under their new episode."""
    return rows.join(ids.select(SOURCE, episode, "new_episode"), [SOURCE, episode]).withColumn(episode, F.col("new_episode")).drop("new_episode")


def frame_reuse(parts: list[DataFrame], ids: DataFrame, episode: str = "episode_index") -> DataFrame:
    """Reuse tables of all sources (columns a source lacks are null), ids compacted first, then shifted."""
    out = parts[0].withColumn(SOURCE, F.lit(0))
    for k, p in enumerate(parts[1:], 1):
        out = out.unionByName(p.withColumn(SOURCE, F.lit(k)), allowMissingColumns=True)
    return annotations(out, ids, episode)
