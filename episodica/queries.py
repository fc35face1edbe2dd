"""The registered queries (name -> callable) and their DuckDB SQL (name -> text)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import proxies
from .functions import config as cfg
from .functions import text
from .operators import horizon, index, manifest, media, merge, segments, stats, subset, vectors, vocab
from .plans import rules, runs
from .session import checkpoints
from .streaming import logs

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

#: Named sub-queries of the SQL, expanded where {name} stands.
_SQL = {
    "f": "f AS (SELECT user_id AS episode_index, event_id AS index, ts, event_type AS subtask, value, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS frame_index, count(*) OVER (PARTITION BY user_id) AS n FROM events)",
    "v": "v AS (SELECT subtask, row_number() OVER (ORDER BY subtask) - 1 AS subtask_index FROM (SELECT DISTINCT event_type AS subtask FROM events))",
    "c": "c AS (SELECT f.*, subtask_index, CASE WHEN frame_index = 0 OR lag(f.subtask) OVER (PARTITION BY episode_index ORDER BY frame_index) <> f.subtask THEN 1 ELSE 0 END AS chg FROM f JOIN v ON f.subtask = v.subtask)",
    "r": "r AS (SELECT *, sum(chg) OVER (PARTITION BY episode_index ORDER BY frame_index) - 1 AS run FROM c)",
    "s": "s AS (SELECT episode_index, run, any_value(subtask) AS subtask, any_value(subtask_index) AS subtask_index, any_value(n) AS n, min(frame_index) AS start_frame, max(frame_index) + 1 AS end_frame FROM r GROUP BY episode_index, run)",
    "h": "h AS (SELECT r.*, s.end_frame, s.end_frame - r.frame_index AS first_offset, t.subtask_index AS next_index FROM r JOIN s ON r.episode_index = s.episode_index AND r.run = s.run LEFT JOIN s t ON r.episode_index = t.episode_index AND r.run + 1 = t.run)",
    "src": "src AS (SELECT f.*, (episode_index % 2)::INT AS source_id FROM f), k AS (SELECT 0 AS source_id, subtask_index, subtask FROM v UNION ALL SELECT 1, (SELECT count(*) FROM v) - 1 - subtask_index, subtask FROM v), g AS (SELECT subtask, row_number() OVER (ORDER BY min(source_id * 1000000 + subtask_index)) - 1 AS new_index FROM k GROUP BY subtask), ids AS (SELECT source_id, episode_index, row_number() OVER (ORDER BY source_id, episode_index) - 1 AS new_episode FROM (SELECT DISTINCT source_id, episode_index FROM src)), m AS (SELECT src.*, new_episode, g.new_index AS new_subtask, row_number() OVER (ORDER BY new_episode, frame_index) - 1 AS new_index FROM src JOIN ids ON src.source_id = ids.source_id AND src.episode_index = ids.episode_index JOIN g ON src.subtask = g.subtask)",
    "kept": "e AS (SELECT *, frame_index - row_number() OVER (PARTITION BY episode_index ORDER BY frame_index) AS island FROM f WHERE subtask <> 'error'), i AS (SELECT episode_index AS source_episode, island, min(frame_index) AS start_frame, max(frame_index) + 1 AS end_frame, count(*) AS length FROM e GROUP BY episode_index, island), n AS (SELECT *, row_number() OVER (ORDER BY source_episode, start_frame) - 1 AS new_episode, sum(length) OVER (ORDER BY source_episode, start_frame) - length AS dataset_from_index FROM i), x AS (SELECT e.*, new_episode, frame_index - start_frame AS new_frame, dataset_from_index + frame_index - start_frame AS new_index FROM e JOIN n ON e.episode_index = n.source_episode AND e.island = n.island)",
}
_EVENTS = ("f", "v", "c", "r", "s")


def _with(*names: str) -> str:
    return "WITH " + ", ".join(_SQL[n] for n in names) + " "


def query(sql: str | None = None, *needs: str) -> Callable:
    """Registers a query under its function's name, with its SQL."""

    def add(f: Callable) -> Callable:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = (_with(*needs) if needs else "") + sql
        return f

    return add


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return proxies.table(spark, d, name)


# --- segments and horizons


@query(
    "SELECT episode_index, run::BIGINT AS run, subtask, start_frame::BIGINT AS start_frame, end_frame::BIGINT AS end_frame, (end_frame - start_frame)::BIGINT AS length "
    "FROM s",
    *_EVENTS,
)
def segment_runs(spark, d):
    return segments.run_segments(proxies.frames(spark, d), "subtask", proxies.ORDER)


@query(
    "SELECT subtask, count(*) AS segments, min(end_frame - start_frame)::BIGINT AS min_length, max(end_frame - start_frame)::BIGINT AS max_length, sum(end_frame - start_frame)::BIGINT AS frames "
    "FROM s GROUP BY subtask",
    *_EVENTS,
)
def segment_lengths(spark, d):
    return segments.segment_lengths(segments.run_segments(proxies.frames(spark, d), "subtask", proxies.ORDER), "subtask")


@query("SELECT episode_index, string_agg(subtask, ',' ORDER BY run) AS run_values, count(*) AS runs FROM s GROUP BY episode_index", *_EVENTS)
def run_values_dedup(spark, d):
    out = segments.run_values(proxies.frames(spark, d), "subtask", proxies.ORDER)
    return out.select("episode_index", F.array_join("values", ",").alias("run_values"), F.size("values").cast("long").alias("runs"))


@query(
    "SELECT episode_index, string_agg(subtask, ',' ORDER BY p) AS tasks FROM (SELECT episode_index, subtask, min(frame_index) AS p FROM f GROUP BY ALL) "
    "GROUP BY episode_index",
    "f",
)
def first_seen_tasks(spark, d):
    return segments.first_seen(proxies.frames(spark, d), "subtask", proxies.ORDER).select("episode_index", F.array_join("values", ",").alias("tasks"))


@query(
    "SELECT episode_index, frame_index::BIGINT AS frame_index, index, subtask_index::BIGINT AS subtask_index, next_index::BIGINT AS next_subtask_index, first_offset::BIGINT AS first_next_offset, end_frame::BIGINT AS boundary_frame_index "
    "FROM h WHERE frame_index + 3 <= n AND first_offset < 3",
    *_EVENTS, "h",
)
def boundary_starts(spark, d):
    return horizon.boundary_starts(proxies.coded_frames(spark, d), "subtask_index", proxies.ORDER, 3)


@query(
    "SELECT hz AS horizon, count(*) AS frames, sum(CASE WHEN chg = 1 AND frame_index > 0 THEN 1 ELSE 0 END)::BIGINT AS boundaries, count(*) FILTER (frame_index + hz <= n) AS valid_starts, count(*) FILTER (frame_index + hz <= n AND first_offset < hz) AS crossing_starts, count(*) FILTER (frame_index + hz <= n AND first_offset >= hz) AS clean_starts, round(coalesce(count(*) FILTER (frame_index + hz <= n AND first_offset < hz) / nullif(count(*) FILTER (frame_index + hz <= n), 0)::DOUBLE, 0), 6) AS crossing_fraction FROM h, (SELECT unnest([2, 3, 40])::BIGINT AS hz) GROUP BY hz",
    *_EVENTS, "h",
)
def boundary_stats(spark, d):
    return horizon.boundary_stats(proxies.coded_frames(spark, d), "subtask_index", proxies.ORDER, 2, 3, 40)


@query("SELECT episode_index, count(*) AS clean FROM h WHERE frame_index + 2 <= n AND first_offset >= 2 GROUP BY episode_index", *_EVENTS, "h")
def clean_starts(spark, d):
    return horizon.clean_starts(proxies.coded_frames(spark, d), "subtask_index", proxies.ORDER, 2).groupBy("episode_index").agg(F.count("*").alias("clean"))


@query(
    "SELECT episode_index, string_agg(subtask_index || ':' || subtask || ':' || start_frame || '-' || end_frame, ' ' ORDER BY run) AS blocks FROM s "
    "GROUP BY episode_index",
    *_EVENTS,
)
def annotation_segments(spark, d):
    found = segments.run_segments(proxies.coded_frames(spark, d), "subtask_index", proxies.ORDER).join(proxies.subtasks(spark, d), "subtask_index")
    blocks = segments.annotation_blocks(found, "subtask_index", "subtask")
    one = F.transform(
        "sub_task_annotation",
        lambda b: F.concat(
            b["sub_task_idx"].cast("string"), F.lit(":"), b["sub_task_instruction"], F.lit(":"), b["frame_duration"][0].cast("string"), F.lit("-"),
            b["frame_duration"][1].cast("string")
        )
    )
    return blocks.select("episode_index", F.array_join(one, " ").alias("blocks"))


@query(
    "SELECT episode_index, run::BIGINT AS segment, start_frame::BIGINT AS observed_start, end_frame::BIGINT AS observed_end, CASE WHEN run % 7 = 6 THEN NULL ELSE start_frame + CASE WHEN run % 5 = 4 THEN 1 ELSE 0 END END::BIGINT AS annotated_start "
    "FROM s WHERE run % 5 = 4 OR run % 7 = 6",
    *_EVENTS,
)
def annotation_mismatch(spark, d):
    """Annotations with two planted defects: starts moved by one, entries missing."""
    found = segments.run_segments(proxies.coded_frames(spark, d), "subtask_index", proxies.ORDER)
    said = found.select(
        "episode_index",
        F.col("run").alias("r"),
        F.when(
            F.col("run") % 7 != 6,
            F.struct(
                F.col("subtask_index").alias("sub_task_idx"),
                F.array(F.col("start_frame") + F.when(F.col("run") % 5 == 4, 1).otherwise(0), F.col("end_frame")).alias("frame_duration")
            )
        ).alias("s")
    )
    said = said.groupBy("episode_index").agg(F.transform(F.array_sort(F.collect_list(F.struct("r", "s"))), lambda x: x["s"]).alias("sub_task_annotation"))
    out = segments.annotation_mismatches(found, said, "subtask_index")
    return out.select("episode_index", "segment", "observed_start", "observed_end", "annotated_start")


# --- numbering


@query(
    "SELECT episode_index, min(index) AS from_index, max(index) + 1 AS to_index, count(*) AS frames, max(index) + 1 - min(index) = count(*) AS contiguous "
    "FROM f GROUP BY episode_index",
    "f",
)
def episode_bounds(spark, d):
    return index.bounds(proxies.frames(spark, d))


@query(
    "SELECT index, (row_number() OVER (ORDER BY o_custkey, index) - 1)::BIGINT AS expected FROM (SELECT o_orderkey AS index, o_custkey FROM orders) "
    "QUALIFY index <> row_number() OVER (ORDER BY o_custkey, index) - 1",
)
def global_index_check(spark, d):
    rows = _t(spark, d, "orders").select(F.col("o_orderkey").alias("index"), "o_custkey")
    return index.global_index_violations(rows, "o_custkey", "index", ("index",))


@query(
    "SELECT l_orderkey, (row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey))::BIGINT AS expected, l_linenumber::BIGINT AS observed "
    "FROM lineitem QUALIFY l_linenumber <> row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey)",
)
def frame_contiguity_violations(spark, d):
    return index.contiguity_violations(_t(spark, d, "lineitem"), "l_orderkey", "l_linenumber", ["l_linenumber", "l_partkey", "l_suppkey"], 1)


@query(
    "SELECT episode_index, (max(frame_index) + 1)::BIGINT AS length, (sum(max(frame_index) + 1) OVER (ORDER BY episode_index) - max(frame_index) - 1)::BIGINT AS dataset_from_index, (sum(max(frame_index) + 1) OVER (ORDER BY episode_index))::BIGINT AS dataset_to_index "
    "FROM f GROUP BY episode_index",
    "f",
)
def episode_offsets(spark, d):
    lengths = proxies.frames(spark, d).groupBy("episode_index").agg(F.count("*").alias("length"))
    return index.episode_offsets(lengths, "episode_index")


@query("SELECT o_custkey, (row_number() OVER (ORDER BY o_custkey) - 1)::BIGINT AS compact FROM (SELECT DISTINCT o_custkey FROM orders)")
def compact_ids(spark, d):
    return index.compact_ids(_t(spark, d, "orders"), "o_custkey", "compact")


@query(
    "SELECT episode_index, round(max(frame_index) / 15.0, 6) AS last_second, round(any_value(episode_index) + max(frame_index) / 15.0, 6) AS media_second "
    "FROM f GROUP BY episode_index",
    "f",
)
def media_timestamps(spark, d):
    last = proxies.frames(spark, d).groupBy("episode_index").agg(F.max("frame_index").alias("p"))
    a, b = index.media_interval(F.col("episode_index"), F.lit(0), F.col("p"), 15)
    return last.select("episode_index", F.round(b - a, 6).alias("last_second"), F.round(b, 6).alias("media_second"))


# --- vocabularies and merges


@query("SELECT (n_nationkey * 2)::BIGINT AS observed, n_nationkey::BIGINT AS expected, n_name FROM nation WHERE n_nationkey > 0")
def vocab_contiguity(spark, d):
    rows = _t(spark, d, "nation").select((F.col("n_nationkey") * 2).cast("long").alias("i"), "n_name")
    return vocab.contiguity_violations(rows, "i", "n_name")


@query("SELECT subtask, new_index::BIGINT AS subtask_index FROM g", "f", "v", "src")
def vocab_union(spark, d):
    return vocab.union(proxies.sources(spark, d)[1], "subtask_index", "subtask")


@query("SELECT source_id, k.subtask_index::BIGINT AS subtask_index, new_index::BIGINT AS new_subtask_index FROM k JOIN g ON k.subtask = g.subtask", "f", "v", "src")
def vocab_mapping(spark, d):
    words = proxies.sources(spark, d)[1]
    return vocab.mapping(words, vocab.union(words, "subtask_index", "subtask"), "subtask_index", "subtask")


@query("SELECT source_id, new_subtask::BIGINT AS subtask_index, count(*) AS frames, sum(index)::BIGINT AS index_sum FROM m GROUP BY source_id, new_subtask", "f", "v", "src")
def subtask_remap(spark, d):
    rows, words = proxies.sources(spark, d)
    pairs = vocab.mapping(words, vocab.union(words, "subtask_index", "subtask"), "subtask_index", "subtask")
    out = vocab.remap(rows, pairs, ["source_id", "subtask_index"], "new_subtask_index")
    return out.groupBy("source_id", "subtask_index").agg(F.count("*").alias("frames"), F.sum("index").alias("index_sum"))


@query("SELECT new_episode::BIGINT AS new_episode, source_id FROM ids", "f", "v", "src")
def range_join_source(spark, d):
    ids = merge.compacted(proxies.sources(spark, d)[0])
    return merge.source_of(ids.select("new_episode"), merge.offsets(ids))


@query(
    "SELECT new_episode::BIGINT AS new_episode, frame_index::BIGINT AS place, new_index::BIGINT AS new_index, new_subtask::BIGINT AS new_subtask, index AS old_index "
    "FROM m",
    "f", "v", "src",
)
def merge_frames(spark, d):
    rows, words = proxies.sources(spark, d)
    return merge.frames(rows, words, proxies.ORDER).select("new_episode", "place", "new_index", "new_subtask", F.col("index").alias("old_index"))


@query(
    "SELECT a.new_episode::BIGINT AS new_episode, length, dataset_from_index::BIGINT AS dataset_from_index, dataset_to_index::BIGINT AS dataset_to_index, tasks, index_mean, index_std FROM (SELECT new_episode, count(*) AS length, min(new_index) AS dataset_from_index, max(new_index) + 1 AS dataset_to_index, round(avg(new_index), 6) AS index_mean, round(stddev_pop(new_index), 6) AS index_std FROM m GROUP BY new_episode) a JOIN (SELECT new_episode, string_agg(subtask, ',' ORDER BY p) AS tasks FROM (SELECT new_episode, subtask, min(frame_index) AS p FROM m GROUP BY ALL) GROUP BY new_episode) b ON a.new_episode = b.new_episode",
    "f", "v", "src",
)
def merge_episodes(spark, d):
    rows, words = proxies.sources(spark, d)
    out = merge.episode_rows(merge.frames(rows, words, proxies.ORDER), vocab.union(words, "subtask_index", "subtask"))
    return out.select(
        "new_episode",
        "length",
        "dataset_from_index",
        "dataset_to_index",
        F.array_join("tasks", ",").alias("tasks"),
        F.round("index_mean", 6).alias("index_mean"),
        F.round("index_std", 6).alias("index_std")
    )


@query("SELECT DISTINCT subtask FROM v WHERE subtask > 'd'", "v")
def unresolved_tasks(spark, d):
    words = proxies.subtasks(spark, d)
    return vocab.unresolved(proxies.frames(spark, d), words.where("subtask <= 'd'"), "subtask")


# --- subsets


@query(
    "SELECT source_episode, start_frame::BIGINT AS start_frame, end_frame::BIGINT AS end_frame, length, new_episode::BIGINT AS new_episode, dataset_from_index::BIGINT AS dataset_from_index, (dataset_from_index + length)::BIGINT AS dataset_to_index "
    "FROM n",
    "f", "kept",
)
def essential_islands(spark, d):
    return subset.segments(_kept(spark, d)).drop("island")


def _flags(spark, d):
    rows = proxies.frames(spark, d)
    return subset.flagged(rows, rows.where("subtask = 'error'").select("episode_index", "subtask"), proxies.ORDER, "subtask")


def _kept(spark, d):
    return subset.islands(_flags(spark, d))


@query(
    "SELECT index, new_episode::BIGINT AS new_episode, new_frame::BIGINT AS new_frame, new_index::BIGINT AS new_index, round(new_frame / 15.0, 4) AS new_timestamp "
    "FROM x",
    "f", "kept",
)
def essential_frames(spark, d):
    kept = _kept(spark, d)
    out = subset.reindexed(kept, subset.segments(kept), 15.0)
    return out.select("index", "new_episode", "new_frame", "new_index", F.round(F.col("new_timestamp").cast("double"), 4).alias("new_timestamp"))


@query("SELECT new_episode::BIGINT AS episode_index, new_frame::BIGINT AS target_frame_index, x.index AS payload FROM x WHERE frame_index % 3 = 0", "f", "kept")
def frame_reuse_remap(spark, d):
    kept = _kept(spark, d)
    rows = subset.reindexed(kept, subset.segments(kept), 15.0)
    reuse = proxies.frames(spark, d).where("frame_index % 3 = 0").select("episode_index", F.col("frame_index").alias("target_frame_index"), F.col("index").alias("payload"))
    return subset.frame_reuse(reuse, rows)


@query("SELECT subtask, count(*) FILTER (subtask <> 'error') AS retained, count(*) FILTER (subtask = 'error') AS excluded FROM f GROUP BY subtask", "f")
def retained_excluded_counts(spark, d):
    return subset.counts(_flags(spark, d), "subtask")


@query(
    "SELECT new_episode::BIGINT AS new_episode, dim, round(avg(v), 6) AS mean, round(greatest(stddev_pop(v), 0.001), 6) AS std, count(*) AS count "
    "FROM (SELECT new_episode, 0 AS dim, value AS v FROM x UNION ALL SELECT new_episode, 1, frame_index::DOUBLE FROM x) GROUP BY new_episode, dim",
    "f", "kept",
)
def essential_stats(spark, d):
    kept = _kept(spark, d)
    rows = subset.reindexed(kept, subset.segments(kept), 15.0).withColumn("state", F.array("value", F.col("pos").cast("double")))
    return subset.stats(rows, "state").select("new_episode", "dim", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"), "count")


# --- statistics and vectors


@query(
    "SELECT feature, round(avg(v), 6) AS mean, round(stddev_pop(v), 6) AS std, min(v) AS min, max(v) AS max, count(*) AS count "
    "FROM (SELECT 'index' AS feature, index::DOUBLE AS v FROM f UNION ALL SELECT 'frame_index', frame_index::DOUBLE FROM f UNION ALL "
    "SELECT 'episode_index', episode_index::DOUBLE FROM f) GROUP BY feature",
    "f",
)
def int_stats(spark, d):
    out = stats.column_stats(proxies.frames(spark, d), ["index", "frame_index", "episode_index"])
    return out.select("feature", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"), "min", "max", "count")


@query(
    "SELECT episode_index, round(avg(index), 6) AS mean, round(stddev_pop(index), 6) AS std, min(index)::DOUBLE AS min, max(index)::DOUBLE AS max, count(*) AS count "
    "FROM f GROUP BY episode_index",
    "f",
)
def episode_int_stats(spark, d):
    out = stats.column_stats(proxies.frames(spark, d), ["index"], ["episode_index"])
    return out.select("episode_index", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"), "min", "max", "count")


@query(
    "SELECT vec_id, len(embedding[1:16])::INT AS dims, round(list_sum(list_transform(embedding[1:16], lambda x: x::DOUBLE)), 5) AS total, round(embedding[3]::DOUBLE, 6) AS picked "
    "FROM embeddings",
)
def vector_slice(spark, d):
    v = vectors.select_dims(F.col("embedding"), list(range(16)))
    some = vectors.select_dims(F.col("embedding"), [2, 0, 5])
    return _t(spark, d, "embeddings").select(
        "vec_id",
        F.size(v).alias("dims"),
        F.round(F.aggregate(v, F.lit(0.0), lambda a, x: a + x.cast("double")), 5).alias("total"),
        F.round(some[0].cast("double"), 6).alias("picked")
    )


@query(
    "SELECT dim - 1 AS dim, round(avg(x), 6) AS mean, round(greatest(stddev_pop(x), 0.001), 6) AS std, round(min(x), 6) AS min, round(max(x), 6) AS max, count(*) AS count "
    "FROM (SELECT generate_subscripts(embedding, 1) AS dim, unnest(embedding)::DOUBLE AS x FROM embeddings) WHERE dim <= 16 GROUP BY dim",
)
def vector_stats(spark, d):
    rows = _t(spark, d, "embeddings").withColumn("state", vectors.select_dims(F.col("embedding"), list(range(16))))
    r = lambda c: F.round(c, 6).alias(c)
    return stats.vector_stats(rows, "state").select("dim", r("mean"), r("std"), r("min"), r("max"), "count")


@query(
    "SELECT subtask, round(avg(value), 6) AS mean, round(stddev_pop(value), 6) AS std, round(min(value), 6) AS min, round(max(value), 6) AS max, count(*) AS count "
    "FROM f GROUP BY subtask",
    "f",
)
def pooled_stats(spark, d):
    """Per-episode statistics pooled again: the same as over all frames."""
    parts = proxies.frames(spark, d).groupBy("subtask", "episode_index").agg(*stats.numeric("value"))
    r = lambda c: F.round(c, 6).alias(c)
    return stats.pooled(parts.drop("episode_index"), ["subtask"]).select("subtask", r("mean"), r("std"), r("min"), r("max"), "count")


@query(
    "SELECT l_orderkey, l_linenumber, round(0.75 * l_discount, 6) AS mean, round(sqrt(greatest(0.75 * (l_tax * l_tax + l_discount * l_discount) - (0.75 * l_discount) * (0.75 * l_discount), 0)), 6) AS std "
    "FROM lineitem",
)
def padded_image_moments(spark, d):
    m, s = stats.padded_moments(F.col("l_discount"), F.col("l_tax"))
    return _t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.round(m, 6).alias("mean"), F.round(s, 6).alias("std"))


@query(
    "SELECT vec_id, modality, round(list_sum(list_transform(embedding[a + 1:b], lambda x: x::DOUBLE)), 5) AS total, (b - a)::INT AS dims "
    "FROM embeddings, (VALUES ('left_arm', 0, 7), ('left_hand', 7, 8), ('right_arm', 8, 15), ('right_hand', 15, 16)) AS g(modality, a, b)",
)
def modality_groups(spark, d):
    out = vectors.by_modality(_t(spark, d, "embeddings"), "embedding", [("left_arm", 0, 7), ("left_hand", 7, 8), ("right_arm", 8, 15), ("right_hand", 15, 16)])
    return out.select("vec_id", "modality", F.round(F.aggregate("part", F.lit(0.0), lambda a, x: a + x.cast("double")), 5).alias("total"), F.size("part").alias("dims"))


@query("SELECT count(*) AS vectors, count(*) FILTER (len(list_filter(embedding, lambda x: NOT isfinite(x))) = 0) AS finite FROM embeddings")
def finite_vectors(spark, d):
    return _t(spark, d, "embeddings").agg(F.count("*").alias("vectors"), F.count_if(vectors.all_finite(F.col("embedding"))).alias("finite"))


# --- captions

_WS = r"\t\n\v\f\r\x1c\x1d\x1e\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"


@query(
    f"SELECT conv_id, turn, CASE WHEN regexp_matches(text, '^[ {_WS}]|[ {_WS}]$') THEN 'leading or trailing whitespace' WHEN contains(text, '  ') THEN 'repeated ASCII spaces' ELSE 'unexpected whitespace U+' || upper(lpad(to_hex(unicode(regexp_extract(text, '[{_WS}]'))), 4, '0')) END AS problem "
    f"FROM conversations WHERE regexp_matches(text, '^[ {_WS}]|[ {_WS}]$') OR contains(text, '  ') OR regexp_matches(text, '[{_WS}]')",
)
def caption_whitespace(spark, d):
    return _t(spark, d, "conversations").select("conv_id", "turn", text.whitespace_problem(F.col("text")).alias("problem")).where("problem is not null")


_PAIRS = {"user": "operator", "assistant": "robot"}


@query(
    "SELECT role AS old, CASE role WHEN 'user' THEN 'operator' WHEN 'assistant' THEN 'robot' ELSE role END AS new, count(*) AS turns FROM conversations "
    "GROUP BY role",
)
def caption_replace_counts(spark, d):
    return _t(spark, d, "conversations").select(F.col("role").alias("old"), text.replaced(F.col("role"), _PAIRS).alias("new")).groupBy("old", "new").agg(F.count("*").alias("turns"))


@query(
    "SELECT conv_id, string_agg(CASE role WHEN 'user' THEN 'operator' WHEN 'assistant' THEN 'robot' ELSE role END, ',' "
    "ORDER BY turn) AS captions, string_agg(CASE role WHEN 'user' THEN 'operator' WHEN 'assistant' THEN 'robot' ELSE role END || turn, ',' "
    "ORDER BY turn) AS blocks FROM conversations GROUP BY conv_id",
)
def caption_replace_nested(spark, d):
    rows = _t(spark, d, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", F.col("role").alias("sub_task_instruction")))).alias("b"))
    rows = rows.withColumn("b", text.replaced_blocks(F.col("b"), _PAIRS)).withColumn("c", text.replaced_list(F.transform("b", lambda x: x["sub_task_instruction"]), {}))
    return rows.select(
        "conv_id",
        F.array_join("c", ",").alias("captions"),
        F.array_join(F.transform("b", lambda x: F.concat(x["sub_task_instruction"], x["turn"].cast("string"))), ",").alias("blocks")
    )


# --- audits


# --- media and manifests


@query(
    "SELECT episode_index AS path, any_value(n) AS frames, count(*) FILTER (key) AS key_frames, bool_or(key AND frame_index = 0) AS starts_on_key, max(gap)::BIGINT AS max_gop "
    "FROM (SELECT episode_index, frame_index, n, key, CASE WHEN key THEN coalesce(lead(frame_index) OVER (PARTITION BY episode_index, key ORDER BY frame_index), n) - frame_index END AS gap "
    "FROM (SELECT *, subtask = 'signup' AS key FROM f)) GROUP BY path",
    "f",
)
def gop_intervals(spark, d):
    rows = proxies.frames(spark, d).select(F.col("episode_index").alias("path"), "frame_index", (F.col("subtask") == "signup").alias("key"))
    return media.key_intervals(rows, "key", "frame_index")


_PROBE = "p_type AS codec_name, p_size AS max_gop, CASE WHEN p_size % 3 = 0 THEN '15/1' ELSE '30/2' END AS avg_frame_rate"


@query(
    "SELECT p_brand AS camera, CASE WHEN p_type = (SELECT min(p_type) "
    "FROM part) AND p_size <= 30 THEN 'copy' ELSE 'transcode' END AS decision, count(*) AS files, count(*) FILTER (p_type = (SELECT min(p_type) "
    "FROM part) AND p_size <= 25) AS acceptable FROM part GROUP BY ALL",
)
def video_decisions(spark, d):
    parts = _t(spark, d, "part")
    codec = parts.agg(F.min("p_type")).first()[0]
    rows = parts.select(
        F.col("p_brand").alias("camera"),
        F.col("p_type").alias("codec_name"),
        F.col("p_size").alias("max_gop"),
        F.lit(640).alias("width"),
        F.lit(480).alias("height"),
        F.when(F.col("p_size") % 3 == 0, "15/1").otherwise("30/2").alias("avg_frame_rate")
    )
    return rows.groupBy("camera", media.decision(codec, 30).alias("decision")).agg(
        F.count("*").alias("files"),
        F.count_if(media.acceptable(640, 480, 15.0, 0.05, codec, 25)).alias("acceptable")
    )


@query("SELECT p_brand AS camera, count(*) AS files, sum(p_partkey)::BIGINT AS frames, max(p_size) AS max_gop FROM part GROUP BY p_brand")
def camera_totals(spark, d):
    return media.by_camera(_t(spark, d, "part").select(F.col("p_brand").alias("camera"), F.col("p_partkey").alias("frames"), F.col("p_size").alias("max_gop")))


@query("SELECT url AS path, strlen(html) AS bytes, sha256(html) AS sha256 FROM pages")
def manifest_hashes(spark, d):
    return manifest.hashed(_t(spark, d, "pages"), "url", "html")


@query(
    "SELECT sha256(string_agg(sha256(html) || '  p/' || page_id || chr(10), '' ORDER BY page_id::VARCHAR)) AS digest, count(*) AS files, sum(strlen(html))::BIGINT AS bytes FROM pages",
)
def manifest_digest(spark, d):
    rows = _t(spark, d, "pages").select(F.concat(F.lit("p/"), F.col("page_id").cast("string")).alias("path"), F.col("html").alias("content"))
    return manifest.digest(manifest.hashed(rows))


@query(
    "SELECT n_name AS path, CASE WHEN n_nationkey % 5 = 0 THEN 'missing' WHEN n_nationkey % 5 = 1 THEN 'not listed' ELSE 'checksum mismatch' END AS problem "
    "FROM nation WHERE n_nationkey % 5 < 3",
)
def manifest_verify(spark, d):
    names = _t(spark, d, "nation")
    said = names.where("n_nationkey % 5 <> 1").select(F.concat(F.sha2("n_name", 256), F.lit("  "), "n_name").alias("value"))
    there = names.where("n_nationkey % 5 <> 0").select("n_name", F.when(F.col("n_nationkey") % 5 == 2, "changed").otherwise(F.col("n_name")).alias("content"))
    return manifest.verified(manifest.parsed(said), manifest.hashed(there, "n_name"))


@query("SELECT c_name AS path FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)")
def required_files_anti(spark, d):
    c, o = _t(spark, d, "customer"), _t(spark, d, "orders")
    there = c.join(o, c.c_custkey == o.o_custkey, "left_semi").select(F.col("c_name").alias("path"))
    return manifest.missing(c.select(F.col("c_name").alias("path")), there)


@query(
    "SELECT n_name AS key, n_regionkey::VARCHAR AS expected, CASE WHEN n_nationkey % 4 = 3 THEN NULL ELSE 'x' END AS observed FROM nation "
    "WHERE n_nationkey % 4 >= 2",
)
def receipt_compare(spark, d):
    rows = _t(spark, d, "nation")
    said = rows.select(F.col("n_name").alias("key"), F.col("n_regionkey").cast("string").alias("value"))
    found = rows.where("n_nationkey % 4 <> 3").select(F.col("n_name").alias("key"), F.when(F.col("n_nationkey") % 4 == 2, "x").otherwise(F.col("n_regionkey").cast("string")).alias("value"))
    return manifest.receipt_differences(said, found)


@query(
    "WITH a AS (SELECT p_brand, p_name, row_number() OVER (PARTITION BY p_brand ORDER BY lpad(p_partkey::VARCHAR, 9, '0')) - 1 AS place, p_size FROM part) "
    "SELECT p_brand AS camera, count(*) AS files, count(*) FILTER (p_size % 2 = 0) AS same FROM a GROUP BY p_brand",
)
def relinked_media(spark, d):
    rows = _t(spark, d, "part").select(F.col("p_brand").alias("camera"), F.lpad(F.col("p_partkey").cast("string"), 9, "0").alias("path"), F.sha2("p_name", 256).alias("sha256"), "p_size")
    other = rows.withColumn("sha256", F.when(F.col("p_size") % 2 == 0, F.col("sha256")).otherwise(""))
    return manifest.relinked(rows, other).groupBy("camera").agg(F.count("*").alias("files"), F.count_if("same").alias("same"))


# --- configuration, runs, queues, logs


@query(
    "WITH x AS (SELECT n_regionkey AS layer, CASE WHEN n_nationkey % 3 = 0 THEN 'p' || n_nationkey % 4 ELSE 'p' || n_nationkey % 4 || '.q' || n_nationkey % 2 END AS path, max(n_nationkey) AS value FROM nation GROUP BY ALL), t AS (SELECT path, arg_max(value, layer) AS value, max(layer) AS layer FROM x GROUP BY path), "
    "h AS (SELECT CASE WHEN t.layer > u.layer THEN u.path ELSE t.path END AS path FROM t JOIN t u ON t.path LIKE u.path || '.%') SELECT path, value::VARCHAR AS value FROM t WHERE path NOT IN (SELECT path FROM h)"
)
def config_merge(spark, d):
    """Layers by region; a leaf of one layer may stand where another has a mapping."""
    k = F.col("n_nationkey")
    top = F.concat(F.lit("p"), (k % 4).cast("string"))
    path = F.when(k % 3 == 0, top).otherwise(F.concat(top, F.lit(".q"), (k % 2).cast("string")))
    rows = _t(spark, d, "nation").groupBy(F.col("n_regionkey").alias("layer"), path.alias("path")).agg(F.max(k).cast("string").alias("value"))
    return cfg.merged_leaves(rows).select("path", "value")


@query(
    "WITH RECURSIVE l AS (SELECT n_nationkey AS name, n_nationkey AS cur, n_nationkey::VARCHAR AS chain, 0 AS depth FROM nation UNION ALL "
    "SELECT name, ((cur - cur % 2) / 2)::INT, chain || '>' || ((cur - cur % 2) / 2)::INT, depth + 1 FROM l WHERE cur > 0) "
    "SELECT name, max(depth)::INT AS depth, max_by(chain, depth) AS chain FROM l GROUP BY name",
)
def config_inheritance(spark, d):
    keys = _t(spark, d, "nation").select(F.col("n_nationkey").alias("child"))
    links = keys.select("child", F.when(F.col("child") > 0, F.floor(F.col("child") / 2).cast("int")).alias("parent"))
    checkpoints(spark)
    out = cfg.chains(links).where("name is not null")
    return out.select("name", (F.size("chain") - 1).cast("int").alias("depth"), F.array_join(F.transform("chain", lambda x: x.cast("string")), ">").alias("chain"))


#: A run a customer: its first order is the run's own result, the others are attempts; every 50th run's folder begins with _.
_RESULTS = (
    "res AS (SELECT CASE WHEN o_custkey % 50 = 0 THEN '_' ELSE '' END || o_custkey AS run, CASE WHEN n > 1 THEN n - 1 END AS attempt, 'r/' || o_custkey || CASE WHEN n > 1 THEN '/attempt-' || (n - 1) ELSE '' END || '/result.yaml' AS path, "
    "CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE 'run ' || o_orderkey END AS run_name, CASE o_orderstatus WHEN 'F' THEN 'failed' WHEN 'O' THEN 'completed' ELSE 'running' END AS state, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS n FROM orders))"
)
_SQL["results"] = _RESULTS


def _results(spark, d):
    n = F.row_number().over(Window.partitionBy("o_custkey").orderBy("o_orderkey"))
    rows = _t(spark, d, "orders").withColumn("n", n).withColumn("key", F.col("o_custkey").cast("string"))
    return rows.select(
        F.concat(F.when(F.col("o_custkey") % 50 == 0, "_").otherwise(""), "key").alias("run"), F.when(F.col("n") > 1, F.col("n") - 1).cast("long").alias("attempt"),
        F.concat(F.lit("r/"), "key", F.when(F.col("n") > 1, F.concat(F.lit("/attempt-"), (F.col("n") - 1).cast("string"))).otherwise(""), F.lit("/result.yaml")).alias("path"),
        F.when(F.col("o_orderkey") % 4 != 0, F.concat(F.lit("run "), F.col("o_orderkey").cast("string"))).alias("run_name"),
        F.when(F.col("o_orderstatus") == "F", "failed").when(
            F.col("o_orderstatus") == "O",
            "completed"
        ).otherwise("running").alias("state"), F.col("o_totalprice").alias("final_eval_loss"), F.lit(None).cast("string").alias("wandb_url"),
    )


@query("SELECT run, arg_max(path, coalesce(attempt, -1)) AS path FROM res WHERE NOT starts_with(run, '_') GROUP BY run", "results")
def latest_attempt(spark, d):
    return runs.latest_attempts(_results(spark, d)).select("run", "path")


@query("SELECT o_custkey AS run, 'checkpoint-' || max(o_orderkey) AS name FROM orders GROUP BY o_custkey")
def latest_checkpoint(spark, d):
    rows = _t(spark, d, "orders").select(F.col("o_custkey").alias("run"), F.concat(F.lit("checkpoint-"), F.col("o_orderkey").cast("string")).alias("name"))
    return runs.latest_checkpoints(rows)


@query(
    "SELECT event_id AS run, CASE WHEN code < 0 THEN 128 - code ELSE code END AS exit_code, CASE WHEN code = 0 THEN NULL WHEN event_id % 11 = 0 THEN 'timeout' WHEN event_type = 'error' THEN 'oom' WHEN code < 0 OR code >= 128 THEN 'signal' ELSE 'trainer_error' END AS failure_category "
    "FROM (SELECT *, ((event_id % 7 - 3) * 5)::INT AS code FROM events)",
)
def failure_category(spark, d):
    rows = _t(spark, d, "events").select(
        F.col("event_id").alias("run"),
        ((F.col("event_id") % 7 - 3) * 5).cast("int").alias("code"),
        (F.col("event_id") % 11 == 0).alias("timed_out"),
        F.when(F.col("event_type") == "error", "x\nCUDA Out Of Memory").otherwise("fine").alias("log")
    )
    return runs.failures(rows)


@query(
    "SELECT user_id AS run, CASE WHEN steps > 0 THEN step END AS step, CASE WHEN steps > 0 THEN loss ELSE end_loss END AS loss, CASE WHEN steps > 0 THEN gradient END AS gradient_norm, (CASE WHEN steps > 0 THEN rate ELSE end_rate END)::DOUBLE AS rate, CASE WHEN steps > 0 THEN 35.94::DOUBLE END AS memory FROM ("
    "SELECT user_id, count(*) FILTER (kind IN (0, 4)) AS steps, max(event_id) FILTER (kind IN (0, 4)) AS step, arg_max(round(value, 3), event_id) FILTER (kind IN (0, 4)) AS loss, arg_max(CASE kind WHEN 0 THEN 1.519::DOUBLE ELSE 2::DOUBLE END, event_id) FILTER (kind IN (0, 4)) AS gradient, "
    "arg_max(event_id % 50, event_id) FILTER (kind IN (0, 4)) AS rate, arg_max(round(value, 3), event_id) FILTER (kind = 3) AS end_loss, arg_max(event_id % 50, event_id) FILTER (kind IN (3, 5)) AS end_rate "
    "FROM (SELECT *, CASE WHEN user_id % 3 = 0 AND event_id % 6 IN (0, 4) THEN 9 ELSE event_id % 6 END AS kind FROM events) GROUP BY user_id) WHERE steps > 0 OR end_loss IS NOT NULL"
)
def log_metrics(spark, d):
    """Logs of whole and broken step lines, a word that ends in `step`, a second loss, and summaries; some runs have summaries only."""
    rows = _t(spark, d, "events")
    kind = F.when((F.col("user_id") % 3 == 0) & (F.col("event_id") % 6).isin(0, 4), 9).otherwise(F.col("event_id") % 6)
    n, loss, rate = F.col("event_id"), F.round("value", 3), F.col("event_id") % 50
    line = (
        F.when(kind == 0, F.format_string("INFO step:%d smpl:1K loss:%.3f grdn:1.519 smp/s:%d mem_gb:35.94", n, loss, rate))
        .when(kind == 1, F.format_string("step:%d eval_loss:9.5 loss:1.2", n))
        .when(kind == 2, F.format_string("substep:%d loss:8.25 grdn:1 smp/s:1 mem_gb:1", n))
        .when(kind == 3, F.format_string("{'train_runtime': 37.7, 'train_samples_per_second': %d, 'train_loss': %.3f}", rate, loss))
        .when(kind == 4, F.format_string("step:%d eval_loss:9.5 loss:%.3f grdn:2 smp/s:%d mem_gb:35.94", n, loss, rate))
        .when(kind == 5, F.format_string("{'train_samples_per_second': %d}", rate))
        .otherwise("nothing to see")
    )
    found = runs.last_metrics(rows.select(F.col("user_id").alias("run"), n.alias("line_no"), line.alias("line")))
    return found.select("run", "step", "loss", "gradient_norm", F.col("samples_per_second").alias("rate"), F.col("cuda_memory_gib").alias("memory"))


def _queue_events(spark, d):
    state = F.when(F.col("event_type") == "error", "failed").when(F.col("event_type") == "purchase", "completed").otherwise("running")
    return _t(spark, d, "events").select(
        F.concat(F.lit("run-"), F.col("user_id").cast("string")).alias("run_name"),
        F.col("event_id").alias("event_no"),
        state.alias("state"),
        (F.col("event_id") % 5).alias("attempt"),
        F.when(state == "failed", F.concat(F.lit("c"), (F.col("event_id") % 3).cast("string"))).alias("failure_category"),
        F.col("ts").cast("timestamp").alias("ts")
    )


@query(
    "SELECT 'run-' || user_id AS run_name, arg_max(CASE event_type WHEN 'error' THEN 'failed' WHEN 'purchase' THEN 'completed' ELSE 'running' END, event_id) AS state, max(event_id % 5) AS attempts, count(*) FILTER (event_type = 'error') AS failures, arg_max('c' || event_id % 3, event_id) FILTER (event_type = 'error') AS last_failure "
    "FROM events GROUP BY user_id",
)
def queue_state(spark, d):
    return runs.queue_state(_queue_events(spark, d))


@query(
    "SELECT c.c_custkey AS queue, (row_number() OVER (PARTITION BY c_custkey "
    "ORDER BY o_orderkey) - 1)::INT AS position, 'o' || o_orderkey AS config, '' AS overrides, CASE WHEN o_orderkey % 4 <> 0 THEN o_orderstatus END AS run_name "
    "FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey",
)
def queue_resolution(spark, d):
    orders = _t(spark, d, "orders")
    queues = orders.groupBy(F.col("o_custkey").alias("queue")).agg(
        F.transform(
            F.array_sort(F.collect_list("o_orderkey")),
            lambda k: F.struct(F.concat(F.lit("o"), k.cast("string")).alias("config"), F.array().cast("array<string>").alias("overrides"))
        ).alias("runs")
    )
    configs = orders.where("o_orderkey % 4 <> 0").select(F.concat(F.lit("o"), F.col("o_orderkey").cast("string")).alias("config"), F.col("o_orderstatus").alias("run_name"))
    return runs.resolved_queue(queues, configs)


@query(
    "SELECT queue, string_agg(o_orderpriority, ',' ORDER BY o_orderpriority) AS run_names FROM (SELECT o_custkey AS queue, o_orderpriority FROM orders "
    "GROUP BY ALL HAVING count(*) > 1) GROUP BY queue",
)
def queue_duplicates(spark, d):
    return runs.duplicate_runs(_t(spark, d, "orders").select(F.col("o_custkey").alias("queue"), F.col("o_orderpriority").alias("run_name")))


@query("SELECT n_name AS name FROM nation WHERE contains(lower(n_name), lower('N_1')) OR contains(lower(n_name), '2')")
def exclusion_terms(spark, d):
    return runs.excluded_actions(spark.createDataFrame([("N_1",), ("2",)], "term string"), _t(spark, d, "nation").select(F.col("n_name").alias("name")))


@query(
    "SELECT c_custkey, CASE WHEN c_nationkey % 3 = 1 THEN 'groot' ELSE 'lerobot' END AS family, CASE WHEN c_nationkey % 3 = 0 THEN 'lerobot_act' WHEN c_nationkey % 3 = 1 THEN 'isaac_groot' ELSE 'lerobot_groot' END AS backend "
    "FROM customer",
)
def backend_aliases(spark, d):
    k = F.col("c_nationkey") % 3
    name = F.when(k == 0, "act").when(k == 1, "isaac").otherwise("lerobot-groot")
    return _t(spark, d, "customer").select("c_custkey", runs.model_family(name).alias("family"), runs.canonical_backend(name).alias("backend"))


@query(
    "SELECT c_custkey, 'episode_' || lpad(c_custkey::VARCHAR, 6, '0') AS episode, c_custkey % 3 <> 0 AS safe, CASE WHEN c_custkey % 2 = 0 THEN '${workspace}/' || c_custkey ELSE '/other/' || c_custkey END AS portable "
    "FROM customer",
)
def scalar_names(spark, d):
    key = F.col("c_custkey").cast("string")
    path = F.when(F.col("c_custkey") % 2 == 0, F.concat(F.lit("/w/s/"), key)).otherwise(F.concat(F.lit("/other/"), key))
    name = F.when(F.col("c_custkey") % 3 != 0, F.concat(F.lit("a."), key)).otherwise(F.concat(F.lit("-b\n"), key))
    return _t(spark, d, "customer").select(
        "c_custkey",
        text.episode_name(F.col("c_custkey")).alias("episode"),
        text.safe_name(name).alias("safe"),
        text.portable_path(path, "/w/s/").alias("portable")
    )


# --- event-time windows (extensions), as batches


@query("SELECT time_bucket(INTERVAL 1 day, ts) AS start, event_type, count(*) AS events, round(sum(value), 4) AS value FROM events GROUP BY ALL")
def tumbling_windows(spark, d):
    out = logs.tumbling(logs.timed(_t(spark, d, "events")), "1 day")
    return out.select(F.col("start").cast("timestamp_ntz").alias("start"), "event_type", "events", F.round("value", 4).alias("value"))


@query(
    "SELECT start, count(*) AS events "
    "FROM (SELECT unnest([time_bucket(INTERVAL 12 hour, ts), time_bucket(INTERVAL 12 hour, ts) - INTERVAL 12 hour]) AS start FROM events) GROUP BY start",
)
def sliding_windows(spark, d):
    return logs.sliding(logs.timed(_t(spark, d, "events")), "1 day", "12 hours").select(F.col("start").cast("timestamp_ntz").alias("start"), "events")


@query(
    "SELECT user_id, min(ts) AS start, max(ts) + INTERVAL 6 hour AS \"end\", count(*) AS events FROM (SELECT *, sum(n) OVER (PARTITION BY user_id "
    "ORDER BY ts, event_id) AS k FROM (SELECT *, CASE WHEN lag(ts) OVER (PARTITION BY user_id "
    "ORDER BY ts, event_id) + INTERVAL 6 hour >= ts THEN 0 ELSE 1 END AS n FROM events)) GROUP BY user_id, k",
)
def session_windows(spark, d):
    out = logs.sessions(logs.timed(_t(spark, d, "events")), "6 hours")
    return out.select("user_id", F.col("start").cast("timestamp_ntz").alias("start"), F.col("end").cast("timestamp_ntz").alias("end"), "events")


from . import queries_audit, queries_more, queries_trees  # noqa: E402, F401  (register the rest)
