"""More registered queries: gates, documents as tables, lookups, scalars."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import proxies
from .functions import config as cfg
from .functions import text
from .operators import manifest, media, merge, segments, stats, subset, vectors, vocab
from .plans import datasets, rules, runs
from .queries import _EVENTS, _flags, _kept, _results, _t, query

# --- runs and queues


@query(
    "SELECT run, coalesce(run_name, run) AS run_name, state, final_eval_loss, path AS result "
    "FROM (SELECT run, arg_max(run_name, k) FILTER (last) AS run_name, arg_max(state, k) AS state, arg_max(o_totalprice, k) AS final_eval_loss, arg_max(path, k) AS path "
    "FROM (SELECT *, coalesce(attempt, -1) AS k, coalesce(attempt, -1) = max(coalesce(attempt, -1)) OVER (PARTITION BY run) AS last FROM res) "
    "WHERE NOT starts_with(run, '_') GROUP BY run)",
    "results",
)
def result_listing(spark, d):
    return runs.listing(_results(spark, d)).select("run", "run_name", "state", "final_eval_loss", "result")


@query(
    "SELECT run, path, CASE WHEN state <> 'completed' THEN 'run is not completed' END AS problem FROM res "
    "QUALIFY row_number() OVER (PARTITION BY run ORDER BY attempt IS NOT NULL DESC, attempt::VARCHAR DESC) = 1",
    "results",
)
def completed_lookup(spark, d):
    return runs.completed(_results(spark, d))


@query(
    "SELECT c_custkey AS run, CASE WHEN c_custkey % 5 <> 0 THEN 'm/' || c_custkey END AS path, CASE WHEN c_custkey % 5 = 0 THEN 'result does not identify a model' WHEN c_custkey % 2 = 1 THEN 'model directory is incomplete' END AS problem "
    "FROM customer",
)
def model_folders(spark, d):
    key = F.col("c_custkey")
    rows = _t(spark, d, "customer").select(key.alias("run"), F.when(key % 5 != 0, F.concat(F.lit("m/"), key.cast("string"))).alias("path"))
    there = rows.where("run % 2 = 0").select(F.concat("path", F.lit("/config.json")).alias("path"))
    return runs.model_paths(rows, there)


@query(
    "SELECT run, CASE WHEN attempt % 2 = 1 THEN 'c/' || run ELSE regexp_replace(path, 'result.yaml$', 'resolved_config.yaml') END AS path, CASE WHEN attempt % 2 = 1 THEN 'resolved training config is missing' END AS problem "
    "FROM res",
    "results",
)
def resolved_configs(spark, d):
    rows = _results(spark, d).withColumn("resolved_config", F.when(F.col("attempt") % 2 == 1, F.concat(F.lit("c/"), "run")))
    return runs.resolved_configs(rows, rows.select(F.regexp_replace("path", "result.yaml$", "resolved_config.yaml").alias("path")))


_ENTRIES = (
    "e AS (SELECT o_custkey AS queue, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS position, o_orderkey, o_orderstatus "
    "FROM orders)"
)


@query(
    f"WITH {_ENTRIES}, b AS (SELECT queue, min(position) FILTER (o_orderstatus = 'F') AS broke FROM e GROUP BY queue) "
    f"SELECT e.queue, CASE WHEN any_value(broke) IS NULL THEN 'completed' ELSE 'failed' END AS state, count(*) FILTER (o_orderstatus <> 'F' AND (broke IS NULL OR position < broke)) AS runs_done, count(*) FILTER (o_orderstatus <> 'F') AS runs_done_going_on "
    f"FROM e JOIN b ON e.queue = b.queue GROUP BY e.queue",
)
def queue_outcomes(spark, d):
    from pyspark.sql import Window

    position = F.row_number().over(Window.partitionBy("o_custkey").orderBy("o_orderkey")) - 1
    rows = _t(spark, d, "orders").select(
        F.col("o_custkey").alias("queue"),
        position.alias("position"),
        F.lit(1).alias("attempt"),
        F.when(F.col("o_orderstatus") == "F", "failed").otherwise("completed").alias("state")
    )
    on = runs.queue_outcomes(rows, True).select("queue", F.col("runs_done").alias("runs_done_going_on"))
    return runs.queue_outcomes(rows).join(on, "queue")


@query(
    "SELECT 'run-' || event_id AS run_name, CASE WHEN event_id % 50 < 10 THEN '-' ELSE (event_id % 3 + 1)::VARCHAR END AS attempt, CASE WHEN event_id % 50 < 10 THEN 'blocked_low_disk' WHEN event_id % 4 = 0 THEN 'completed' WHEN event_type = 'error' THEN 'failed_oom_continuing' ELSE 'failed_continuing' END AS status, (CASE WHEN event_id % 50 < 10 THEN 75 ELSE event_id % 4 END)::INT AS exit_code "
    "FROM events WHERE event_id % 7 <> 0",
)
def queue_status_rows(spark, d):
    key = F.col("event_id")
    rows = _t(spark, d, "events").select(
        F.concat(F.lit("run-"), key.cast("string")).alias("run_name"),
        (key % 3 + 1).alias("attempt"),
        (key % 4).alias("code"),
        F.when(F.col("event_type") == "error", "torch.OutOfMemoryError").otherwise("fine").alias("log"),
        (key % 50).alias("free_gib"),
        (key % 7 == 0).alias("succeeded")
    )
    return runs.status_rows(rows, 10)


@query(
    f"WITH {_ENTRIES}, l AS (SELECT queue, position, 0 AS layer, p.path, CASE p.path WHEN 'status' THEN '\"' || o_orderstatus || '\"' WHEN 'train.steps' THEN o_orderkey::VARCHAR ELSE '0.1' END AS value, o_orderkey % 3 AS kind FROM e, (VALUES ('status'), ('train.steps'), ('train.lr')) AS p(path)) "
    "SELECT queue, position::INT AS position, path, CASE WHEN kind = 0 AND path = 'train.steps' THEN '20' ELSE value END AS value FROM l WHERE NOT (kind = 1 AND path LIKE 'train.%') UNION ALL SELECT queue, position::INT, 'train', '5' FROM e WHERE o_orderkey % 3 = 1 UNION ALL SELECT queue, position::INT, 'tag', 'a=b' FROM e WHERE o_orderkey % 3 = 1"
)
def queue_overrides(spark, d):
    """Each order a run of its customer's queue: its own settings, some overridden, one a mapping replaced by a value."""
    orders = _t(spark, d, "orders").withColumn("config", F.concat(F.lit("o"), F.col("o_orderkey").cast("string")))
    leaves = F.create_map(F.lit("status"), F.concat(F.lit('"'), "o_orderstatus", F.lit('"')), F.lit("train.steps"), F.col("o_orderkey").cast("string"), F.lit("train.lr"), F.lit("0.1"))
    configs = orders.select("config", F.explode(leaves).alias("path", "value"))
    kind = F.col("o_orderkey") % 3
    sets = F.when(kind == 0, F.array(F.lit("train.steps=20"))).when(kind == 1, F.array(F.lit("train=5"), F.lit("tag=a=b"))).otherwise(F.array().cast("array<string>"))
    entry = F.struct("o_orderkey", F.struct("config", sets.alias("overrides")).alias("r"))
    queues = orders.groupBy(F.col("o_custkey").alias("queue")).agg(F.transform(F.array_sort(F.collect_list(entry)), lambda x: x["r"]).alias("runs"))
    return runs.overridden(configs, queues)


@query(
    "SELECT c_custkey, min_by('p' || k, k) AS path FROM customer, (VALUES (0), (1), (2)) AS t(k) WHERE (c_custkey + k) % 3 > 0 AND c_custkey % 7 > 0 "
    "GROUP BY c_custkey",
)
def first_candidate(spark, d):
    key = F.col("c_custkey")
    rows = _t(spark, d, "customer").select("c_custkey", F.explode(F.array(*map(F.lit, range(3)))).alias("priority")).withColumn(
        "path",
        F.concat(key.cast("string"), F.lit("/p"), F.col("priority").cast("string"))
    )
    there = rows.where(((key + F.col("priority")) % 3 > 0) & (key % 7 > 0)).select("path")
    return runs.first_existing(rows, there, "c_custkey").select("c_custkey", F.substring_index("path", "/", -1).alias("path"))


# --- gates


_SOURCES = "n AS (SELECT n_nationkey AS k, 'r' || n_nationkey % 24 AS root, CASE n_nationkey WHEN 3 THEN NULL WHEN 5 THEN 'b' ELSE 'a' END AS p FROM nation)"


@query(
    f"WITH {_SOURCES} SELECT 'unique_roots' AS rule, root AS location FROM n GROUP BY root HAVING count(*) > 1 UNION ALL SELECT 'annotation_path', root FROM n WHERE p IS NULL UNION ALL SELECT 'one_annotation_path', string_agg(DISTINCT p, ' ' ORDER BY p) FROM n HAVING count(DISTINCT p) > 1 UNION ALL SELECT 'feature', root || ' cam' FROM n WHERE k = 7 "
    "UNION ALL SELECT 'feature', root || ' state' FROM n WHERE k = 9 UNION ALL SELECT 'vocabulary', p_brand FROM part GROUP BY p_brand HAVING count(DISTINCT p_size % 2) > 1"
)
def merge_gates(spark, d):
    """Nations as sources with planted defects: a root twice, annotation paths that lack or differ, a feature changed, one lost."""
    k = F.col("n_nationkey")
    features = F.when(k == 9, F.create_map(F.lit("cam"), F.lit("x"))).otherwise(F.create_map(F.lit("cam"), F.when(k == 7, "y").otherwise("x"), F.lit("state"), F.lit("s")))
    rows = _t(spark, d, "nation").select(
        k.alias("source_id"),
        F.concat(F.lit("r"), (k % 24).cast("string")).alias("root"),
        F.when(k == 5, "b").when(k != 3, "a").alias("annotation_path"),
        features.alias("features")
    )
    words = _t(spark, d, "part").select((F.col("p_partkey") % 3).alias("source_id"), F.col("p_brand").alias("subtask"), (F.col("p_size") % 2).alias("kind"))
    return merge.gates(rows, words, "subtask", ["kind"])


@query("SELECT 1 AS source_id, subtask_index::BIGINT AS subtask_index FROM k WHERE source_id = 1 AND subtask = 'signup'", "f", "v", "src")
def unmapped_subtasks(spark, d):
    rows, words = proxies.sources(spark, d)
    return merge.unmapped(rows, words.where("not (source_id = 1 and subtask = 'signup')"))


@query(
    "SELECT 'integer' AS rule, o_orderkey || ' ' || field AS location, 'an integer' AS expected, CASE WHEN field = 'length' THEN 'missing' ELSE 'x' END AS observed "
    "FROM orders, (VALUES ('length'), ('from')) AS t(field) WHERE (field = 'length' AND o_orderkey % 10 = 0) OR (field = 'from' AND o_orderkey % 10 = 1)",
)
def integer_fields(spark, d):
    key = F.col("o_orderkey")
    rows = _t(spark, d, "orders").select("o_orderkey", F.when(key % 10 != 0, key).alias("length"), F.when(key % 10 == 1, "x").otherwise("5").alias("from"))
    return rules.integers(rows, "o_orderkey", ["length", "from"]).drop("rule_order")


@query(
    "SELECT 'columns' AS rule, 'd/' || n_name AS location, 'index, value' AS expected, CASE WHEN n_nationkey % 4 = 0 THEN 'index, value' ELSE 'value' END AS observed "
    "FROM nation WHERE n_nationkey % 4 < 2 UNION ALL SELECT 'schema', 'e/' || n_name, 'index int', 'index bigint' FROM nation WHERE n_nationkey % 5 = 0",
)
def file_schemas(spark, d):
    names, k = _t(spark, d, "nation"), F.col("n_nationkey")
    have = F.when(k % 4 == 0, F.array(F.lit("x"))).when(k % 4 == 1, F.array(F.lit("index"))).otherwise(F.array(F.lit("index"), F.lit("value")))
    lost = rules.missing_columns(names.select(F.concat(F.lit("d/"), "n_name").alias("path"), have.alias("columns")), ["index", "value"])
    typed = lambda top, kind: names.select(F.concat(F.lit(top), "n_name").alias("path"), F.array(F.concat(F.lit("index "), kind)).alias("types"))
    found = rules.schema_differences(typed("e/", F.when(k % 5 == 0, "bigint").otherwise("int")), typed("d/", F.lit("int")))
    return lost.unionAll(found).drop("rule_order")


@query(
    "SELECT p_type AS task, 'not unique' AS problem FROM part GROUP BY p_type HAVING count(*) > 1 UNION ALL SELECT ' ', 'blank' FROM part "
    "WHERE p_partkey % 100 = 0 UNION ALL SELECT ' ', 'not unique' FROM part WHERE p_partkey % 100 = 0 HAVING count(*) > 1",
)
def task_problems(spark, d):
    parts = _t(spark, d, "part")
    rows = parts.select(F.col("p_type").alias("task")).unionAll(parts.where("p_partkey % 100 = 0").select(F.lit(" ").alias("task")))
    return vocab.task_problems(rows)


@query(
    "SELECT (row_number() OVER (ORDER BY event_type) - 1)::BIGINT AS task_index, 'do ' || event_type AS task, 'the name' AS task_name FROM events "
    "GROUP BY event_type",
)
def task_table(spark, d):
    words = proxies.subtasks(spark, d)
    old = words.select(F.col("subtask_index").alias("task_index"), F.col("subtask").alias("task"), F.lit("the name").alias("task_name"))
    return datasets.task_table(old, words.select(F.col("subtask_index").alias("task_index"), F.concat(F.lit("do "), "subtask").alias("task")))


@query(
    "SELECT t.old, count(role) AS found, (SELECT count(DISTINCT conv_id) FROM conversations) AS expected "
    "FROM (VALUES ('user'), ('assistant'), ('nobody')) AS t(old) LEFT JOIN conversations ON role = t.old GROUP BY t.old",
)
def instruction_counts(spark, d):
    said = _t(spark, d, "conversations").select("conv_id", F.col("role").alias("old"))
    want = said.agg(F.count_distinct("conv_id")).first()[0]
    return datasets.exact_counts(said.select("old"), spark.createDataFrame([("user",), ("assistant",), ("nobody",)], "old string"), want)


@query(
    "SELECT episode_index, min(frame_index)::BIGINT AS first_frame, count(*) AS frames, sum(subtask_index)::BIGINT AS own, 0::BIGINT AS whole FROM c "
    "GROUP BY episode_index",
    "f", "v", "c",
)
def prompt_indices(spark, d):
    rows = proxies.coded_frames(spark, d)
    size = proxies.subtasks(spark, d).count()
    rows = rows.withColumn("own", vocab.prompt_index(True, size=size)).withColumn("whole", vocab.prompt_index(False))
    return rows.groupBy("episode_index").agg(F.min("frame_index").alias("first_frame"), F.count("*").alias("frames"), F.sum("own").alias("own"), F.sum("whole").alias("whole"))


# --- episodes and statistics


@query("SELECT o_custkey AS episode_index, arg_max(o_orderkey, (o_orderkey % 3) * 1000000000 + o_orderkey) AS length FROM orders GROUP BY o_custkey")
def last_episode_rows(spark, d):
    from .sources import files

    key = F.col("o_orderkey")
    rows = _t(spark, d, "orders").select(
        F.col("o_custkey").alias("episode_index"),
        key.alias("length"),
        F.concat(F.lit("f"), (key % 3).cast("string")).alias("file_path"),
        key.alias("row_index")
    )
    return files.last_episodes(rows, ["length"])


@query("SELECT o_custkey AS episode_index, count(*) AS rows FROM orders GROUP BY o_custkey HAVING count(*) > 1")
def episode_duplicates(spark, d):
    from .sources import files

    return files.duplicate_episodes(_t(spark, d, "orders").select(F.col("o_custkey").alias("episode_index")))


@query("SELECT c_custkey, (24 - c_nationkey) || ',' || (24 - c_nationkey * 7 % 25) AS ids FROM customer")
def stat_ids_remapped(spark, d):
    """Ids inside statistics arrays, through a map of a vocabulary."""
    pairs = F.map_from_entries(F.collect_list(F.struct(F.col("n_nationkey").cast("long").alias("k"), (24 - F.col("n_nationkey")).cast("long").alias("v"))))
    lookup = _t(spark, d, "nation").agg(pairs.alias("lookup"))  # one row
    rows = _t(spark, d, "customer").join(F.broadcast(lookup))
    return rows.select("c_custkey", F.array_join(vocab.remap_lists(F.array("c_nationkey", F.col("c_nationkey") * 7 % 25), F.col("lookup")), ",").alias("ids"))


@query(
    "SELECT episode_index, round(avg(frame_index), 6) AS mean, round(stddev_pop(frame_index), 6) AS std, max(frame_index)::DOUBLE AS max, count(*) AS count, [9.0::DOUBLE] AS other "
    "FROM f GROUP BY episode_index",
    "f",
)
def refreshed_stats(spark, d):
    rows = proxies.frames(spark, d)
    double, long = F.array(F.lit(0.0)), F.array(F.lit(0).cast("long"))
    old = rows.select("episode_index").distinct().select(
        "episode_index",
        *(double.alias(f"stats/frame_index/{k}") for k in ("mean", "std", "max")),
        long.alias("stats/frame_index/count"),
        F.array(F.lit(9.0)).alias("stats/value/mean")
    )
    out = datasets.refreshed(old, rows)
    get = lambda k: F.get(F.col(f"`stats/frame_index/{k}`"), F.lit(0))
    return out.select(
        "episode_index",
        F.round(get("mean"), 6).alias("mean"),
        F.round(get("std"), 6).alias("std"),
        get("max").alias("max"),
        get("count").alias("count"),
        F.col("`stats/value/mean`").alias("other")
    )


@query(
    "SELECT 'index' AS feature, round(avg(index), 6) AS mean, round(stddev_pop(index), 6) AS std, count(*) AS count FROM f UNION ALL "
    "SELECT 'value', round(avg(value), 6), round(stddev_pop(value), 6), count(*) FROM f",
    "f",
)
def global_stats(spark, d):
    """The index over all frames, values pooled from their episodes' statistics."""
    rows = proxies.frames(spark, d)
    one = {n: c for n, c in zip(("mean", "std", "min", "max", "count"), stats.numeric("value"), strict=True)}
    episodes = rows.groupBy("episode_index").agg(*(F.array(c).alias(f"stats/value/{n}") for n, c in one.items()))
    out = datasets.global_stats(rows, episodes, ["index"])
    return out.select("feature", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"), "count")


_LONG = (
    "x AS (SELECT CASE WHEN dim <= 8 THEN 'state' ELSE 'head' END AS feature, CASE WHEN dim <= 8 THEN dim - 1 ELSE dim - 9 END AS dim, avg(v) AS m, stddev_pop(v) AS s "
    "FROM (SELECT generate_subscripts(embedding, 1) AS dim, unnest(embedding)::DOUBLE AS v FROM embeddings) WHERE dim <= 11 GROUP BY ALL)"
)


def _long_stats(spark, d):
    rows = stats.vector_stats(_t(spark, d, "embeddings").withColumn("state", vectors.select_dims(F.col("embedding"), list(range(11)))), "state", floor=0.0)
    rows = rows.select("dim", F.explode(F.create_map(F.lit("mean"), F.col("mean"), F.lit("std"), F.col("std"))).alias("stat", "value"))
    return rows.select(F.when(F.col("dim") < 8, "state").otherwise("head").alias("feature"), "stat", F.when(F.col("dim") < 8, F.col("dim")).otherwise(F.col("dim") - 8).alias("dim"), "value")


@query(
    f"WITH {_LONG}, k AS (SELECT * FROM (VALUES (2, 0), (0, 1), (5, 2)) AS t(old, new)) SELECT feature, stat, dim::INT AS dim, round(value, 5) AS value "
    f"FROM (SELECT feature, new AS dim, unnest(['mean', 'std']) AS stat, unnest([m, s]) AS value FROM x JOIN k ON feature = 'state' AND dim = old UNION ALL "
    f"SELECT feature, dim, unnest(['mean', 'std']), unnest([m, s]) FROM x WHERE feature = 'head')",
)
def sliced_stats(spark, d):
    return datasets.sliced_stats(_long_stats(spark, d), {"state": [2, 0, 5]}).select("feature", "stat", F.col("dim").cast("int").alias("dim"), F.round("value", 5).alias("value"))


@query(
    f"WITH {_LONG} SELECT feature, stat, dim::INT AS dim, round(value, 5) AS value "
    f"FROM (SELECT feature, dim, unnest(['mean', 'std']) AS stat, unnest(CASE WHEN feature = 'head' THEN [0.75 * m, sqrt(greatest(0.75 * (s * s + m * m) - 0.75 * m * 0.75 * m, 0))] ELSE [m, s] END) AS value "
    f"FROM x)",
)
def letterboxed_stats(spark, d):
    return datasets.letterboxed_stats(_long_stats(spark, d), "head").select("feature", "stat", F.col("dim").cast("int").alias("dim"), F.round("value", 5).alias("value"))


@query(
    "SELECT count(DISTINCT user_id) AS episodes, count(*) AS frames, 2 * count(DISTINCT event_type) + (SELECT count(*) + count(*) FILTER (role = 'user') "
    "FROM conversations) AS captions_checked FROM events",
)
def dataset_totals(spark, d):
    words = proxies.subtasks(spark, d)
    lists = _t(spark, d, "conversations").groupBy(F.col("conv_id").alias("episode_index")).agg(
        F.collect_list("role").alias("subtask_instructions"), F.collect_list(F.when(F.col("role") == "user", "x")).alias("tasks")
    )
    data = datasets.Dataset(proxies.frames(spark, d), words, words, lists, None, {})
    return spark.createDataFrame([datasets.dataset_totals(data)], "episodes long, frames long, captions_checked long")


@query(
    "SELECT new_episode::BIGINT AS episode_index, source_episode AS full_episode_index, n.length, round(source_episode * 10 + start_frame / 15.0, 6) AS starts, round(source_episode * 10 + end_frame / 15.0, 6) AS ends, 'task ' || source_episode AS task_name "
    "FROM n",
    "f", "kept",
)
def essential_episode_rows(spark, d):
    """Attributes of the source episode, and the media interval within its video."""
    found = subset.segments(_kept(spark, d))
    e = F.col("episode_index")
    source = _flags(spark, d).select(e).distinct().select(
        e,
        F.lit(0).alias("length"),
        (e * 10.0).alias("videos/cam/from_timestamp"),
        (e * 10.0).alias("videos/cam/to_timestamp"),
        F.concat(F.lit("task "), e.cast("string")).alias("task_name")
    )
    out = subset.episode_rows(found, source, ["cam"], 15.0)
    r = lambda c, n: F.round(F.col(f"`videos/cam/{c}_timestamp`"), 6).alias(n)
    return out.select("episode_index", "full_episode_index", "length", r("from", "starts"), r("to", "ends"), "task_name")


@query("SELECT episode_index, string_agg(subtask, ',' ORDER BY run) AS tasks FROM s GROUP BY episode_index", *_EVENTS)
def prompt_lists(spark, d):
    words = proxies.subtasks(spark, d).select(F.col("subtask_index").alias("task_index"), F.col("subtask").alias("task"))
    rows = proxies.coded_frames(spark, d).withColumn("task_index", F.col("subtask_index"))
    return datasets._task_lists(rows, words).select("episode_index", F.array_join("tasks", ",").alias("tasks"))


@query(
    "SELECT new_episode::BIGINT AS episode_index, f.index AS payload, CASE WHEN f.episode_index % 2 = 0 THEN f.value END AS extra FROM f "
    "JOIN ids ON f.episode_index = ids.episode_index WHERE frame_index = 0",
    "f", "v", "src",
)
def merged_frame_reuse(spark, d):
    """Reuse tables of two sources, one of which lacks a column, under the merged episodes."""
    rows = proxies.sources(spark, d)[0]
    first = rows.where("frame_index = 0").select("source_id", "episode_index", F.col("index").alias("payload"), F.col("value").alias("extra"))
    parts = [first.where("source_id = 0").drop("source_id"), first.where("source_id = 1").drop("source_id", "extra")]
    return merge.frame_reuse(parts, merge.compacted(rows)).select("episode_index", "payload", "extra")


# --- files and media


@query(
    "SELECT episode_index AS path, 640 AS width, '15/1' AS avg_frame_rate, 'h264' AS codec_name, any_value(n)::INT AS frames, (count(*) FILTER (key))::INT AS key_frames, max(gap)::INT AS max_gop, "
    "CASE WHEN episode_index % 7 = 0 THEN 'not one video stream' WHEN NOT bool_or(key AND frame_index = 0) THEN 'does not start on a key frame' END AS problem "
    "FROM (SELECT episode_index, frame_index, n, key, CASE WHEN key THEN coalesce(lead(frame_index) OVER (PARTITION BY episode_index, key ORDER BY frame_index), n) - frame_index END AS gap "
    "FROM (SELECT *, subtask = 'signup' AS key FROM f)) GROUP BY path",
    "f",
)
def probe_documents(spark, d):
    """A prober's documents, one an episode, its packets the frames; some have no key frame, some don't begin with one, some
    have two streams."""
    flags = F.array_sort(F.collect_list(F.struct("frame_index", F.when(F.col("subtask") == "signup", "K__").otherwise("___").alias("flags"))))
    stream = F.array(F.struct(F.lit(640).alias("width"), F.lit(480).alias("height"), F.lit("15/1").alias("avg_frame_rate"), F.lit("h264").alias("codec_name")))
    rows = proxies.frames(spark, d).groupBy(F.col("episode_index").alias("path")).agg(
        F.transform(flags, lambda x: F.struct(x["flags"].alias("flags"))).alias("packets")
    ).withColumn("streams", F.when(F.col("path") % 7 == 0, F.concat(stream, stream)).otherwise(stream))
    found = media.probe_rows(rows)
    return found.join(media.unusable(found), "path", "left").select(
        "path", "width", "avg_frame_rate", "codec_name", "frames", "key_frames", F.col("max_gop").cast("int").alias("max_gop"), "problem"
    )


@query(
    "SELECT sha256(string_agg(path || chr(0) || strlen(html) || chr(10), '' ORDER BY path)) AS inventory_sha256, sha256(string_agg(path || chr(0) || html, '' "
    "ORDER BY path) FILTER (starts_with(path, 'meta/'))) AS metadata_sha256, count(*) AS file_count, sum(strlen(html))::BIGINT AS bytes "
    "FROM (SELECT CASE WHEN page_id % 3 = 0 THEN 'meta/' ELSE 'data/' END || page_id AS path, html FROM pages)",
)
def dataset_fingerprint(spark, d):
    key = F.col("page_id")
    rows = _t(spark, d, "pages").select(F.concat(F.when(key % 3 == 0, "meta/").otherwise("data/"), key.cast("string")).alias("path"), F.col("html").alias("content"))
    return manifest.fingerprint(rows)


_NAMED = (
    "x AS (SELECT CASE n_nationkey WHEN 0 THEN 'a/MERGE_RECEIPT.json' WHEN 1 THEN '.cache/x' WHEN 2 THEN 'b/.groot_registry_download.json' WHEN 3 THEN 'DERIVATION_RECEIPT.json' WHEN 4 THEN 'INSTRUCTION_CORRECTION_RECEIPT.json' WHEN 5 THEN 'c/.cache/y' ELSE n_name END AS path, n_name AS content "
    "FROM nation)"
)


@query(
    f"WITH {_NAMED}, y AS (SELECT flavour, path, content FROM x, (VALUES ('registry'), ('merge'), ('correction'), ('language')) AS t(flavour) "
    f"WHERE CASE flavour WHEN 'registry' THEN NOT starts_with(path, '.cache/') AND path NOT LIKE '%download.json' WHEN 'merge' THEN path NOT LIKE '%MERGE_RECEIPT.json' WHEN 'correction' THEN path NOT LIKE '%CORRECTION_RECEIPT.json' ELSE path NOT LIKE '%DERIVATION_RECEIPT.json' AND path NOT LIKE '%download.json' END) "
    f"SELECT flavour, sha256(string_agg(sha256(content) || '  ' || path || chr(10), '' ORDER BY string_split(path, '/'))) AS digest, count(*) AS files, sum(strlen(content))::BIGINT AS bytes "
    f"FROM y GROUP BY flavour",
)
def payload_digests(spark, d):
    names, k = _t(spark, d, "nation"), F.col("n_nationkey")
    special = {0: "a/MERGE_RECEIPT.json", 1: ".cache/x", 2: "b/.groot_registry_download.json", 3: "DERIVATION_RECEIPT.json", 4: "INSTRUCTION_CORRECTION_RECEIPT.json", 5: "c/.cache/y"}
    path = F.col("n_name")
    for n, p in special.items():
        path = F.when(k == n, p).otherwise(path)
    rows = names.select(path.alias("path"), F.col("n_name").alias("content"))
    one = [manifest.payload_digest(rows, f).select(F.lit(f).alias("flavour"), "digest", "files", "bytes") for f in manifest.LEFT_OUT]
    return one[0].unionAll(one[1]).unionAll(one[2]).unionAll(one[3])


@query(
    "WITH a AS (SELECT p_brand, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) - 1 AS place, lpad(p_partkey::VARCHAR, 9, '0') AS path, p_size "
    "FROM part) SELECT p_brand AS camera, place::INT AS place, path AS source, path AS output FROM a WHERE p_size % 2 = 1",
)
def relink_refusals(spark, d):
    rows = _t(spark, d, "part").select(F.col("p_brand").alias("camera"), F.lpad(F.col("p_partkey").cast("string"), 9, "0").alias("path"), F.sha2("p_name", 256).alias("sha256"), "p_size")
    other = rows.withColumn("sha256", F.when(F.col("p_size") % 2 == 0, F.col("sha256")).otherwise(""))
    return manifest.relink_differences(manifest.relinked(rows, other))


@query(
    "SELECT p_brand AS camera, count(*) AS left, count(*) FILTER (p_size % 2 = 0) AS right, round(sum(p_partkey * 1000) / 1e6, 6) AS megabytes FROM part "
    "GROUP BY p_brand HAVING count(*) <> count(*) FILTER (p_size % 2 = 0)",
)
def inventory_differences(spark, d):
    rows = _t(spark, d, "part").select(F.col("p_brand").alias("camera"), "p_size", F.col("p_partkey"))
    sizes = rows.groupBy("camera").agg(F.round(manifest.megabytes(F.col("p_partkey") * 1000), 6).alias("megabytes"))
    return manifest.inventory_differences(rows, rows.where("p_size % 2 = 0")).join(sizes, "camera")


@query(
    "SELECT n_name AS name, 'left' AS side FROM nation WHERE n_nationkey % 5 = 0 UNION ALL SELECT lower(n_name), 'right' FROM nation "
    "WHERE n_nationkey % 5 = 0",
)
def vocabulary_differences(spark, d):
    names = _t(spark, d, "nation")
    other = names.select(F.when(F.col("n_nationkey") % 5 == 0, F.lower("n_name")).otherwise(F.col("n_name")).alias("name"))
    return vocab.differences(names.select(F.col("n_name").alias("name")), other)


# --- values


@query("SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN NULL WHEN c_custkey % 2 = 0 THEN c_acctbal END AS loss FROM customer")
def alias_values(spark, d):
    """Summaries in which the first name may be present without a value."""
    k, balance = F.col("c_custkey"), F.col("c_acctbal").cast("double")
    both = F.map_concat(
        F.when(k % 3 == 0, F.create_map(F.lit("eval_loss"), F.lit(None).cast("double"))).otherwise(F.create_map().cast("map<string,double>")),
        F.when(k % 2 == 0, F.create_map(F.lit("eval/loss"), balance)).otherwise(F.create_map().cast("map<string,double>"))
    )
    return _t(spark, d, "customer").select("c_custkey", cfg.alias_value(both, ["eval_loss", "eval/loss"]).alias("loss"))


@query(
    "SELECT o_orderkey, o_orderkey % 3 < 2 AS close, o_orderkey % 2 = 0 AS pinned, o_orderkey % 2 = 0 AS inode, o_orderkey % 2 = 0 AS target, o_orderkey / 4.0::DOUBLE AS gib, o_orderkey >= 100 AS enough, CASE WHEN o_orderkey % 2 = 0 THEN o_orderkey END AS whole, CASE o_orderkey % 3 WHEN 0 THEN '/x' WHEN 1 THEN '/d/output' ELSE '/runs/' || o_orderkey || '/output' END AS folder, o_orderkey % 2 = 0 AS lerobot "
    "FROM orders",
)
def scalar_checks(spark, d):
    rows, k = _t(spark, d, "orders"), F.col("o_orderkey")
    key, even, price = k.cast("string"), k % 2 == 0, F.col("o_totalprice").cast("double")
    target = F.when(even, F.concat(F.lit("u@h"), key)).otherwise(F.concat(F.lit("-u@h"), key))
    folder = runs.output_folder(F.when(k % 3 == 0, "/x").otherwise(""), F.when(k % 3 == 1, "/d"), "/runs", key)
    return rows.select(
        "o_orderkey", text.is_close(price, price * (1 + (k % 3) * F.lit(0.6e-9))).alias("close"), text.commit_hash(F.when(even, F.sha1(key)).otherwise(F.md5(key))).alias("pinned"),
        text.device_inode(F.concat(key, F.when(even, ":7").otherwise(":x"))).alias("inode"), text.ssh_target(target).alias("target"), text.gibibytes(k * F.lit(1 << 28)).alias("gib"),
        text.enough_space(k * F.lit(1 << 28), F.lit(25)).alias("enough"), text.whole_number(F.when(even, key).otherwise("x")).alias("whole"), folder.alias("folder"), runs.is_lerobot(
            F.when(even, "act").otherwise("isaac")
        ).alias("lerobot"),
    )


@query(
    "SELECT user_id, strftime(min(ts), '%Y-%m-%dT%H:%M:%SZ') AS stamp, strftime(max(ts), '%Y%m%dT%H%M%SZ') AS compact, round((epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6, 3) AS seconds "
    "FROM events GROUP BY user_id",
)
def stamps(spark, d):
    rows = _t(spark, d, "events").groupBy("user_id").agg(F.min("ts").cast("timestamp").alias("a"), F.max("ts").cast("timestamp").alias("b"))
    return rows.select("user_id", text.utc_stamp(F.col("a")).alias("stamp"), text.utc_stamp(F.col("b"), True).alias("compact"), runs.elapsed(F.col("a"), F.col("b")).alias("seconds"))


@query(
    "SELECT c_custkey, c_nationkey % 2 = 0 AS prefix, CASE WHEN c_nationkey % 2 = 0 THEN '0,1,-1' ELSE '1,0,-1' END AS places, 't' || c_nationkey || ',t0' AS texts "
    "FROM customer",
)
def list_lookups(spark, d):
    k = F.col("c_nationkey")
    names = F.when(k % 2 == 0, F.array(F.lit("a"), F.lit("b"), F.lit("c"))).otherwise(F.array(F.lit("b"), F.lit("a"), F.lit("c")))
    lookup = _t(spark, d, "nation").agg(
        F.map_from_entries(F.collect_list(F.struct(F.col("n_nationkey"), F.concat(F.lit("t"), F.col("n_nationkey").cast("string"))))).alias("lookup")
    )  # one row
    rows = _t(spark, d, "customer").join(F.broadcast(lookup))
    return rows.select(
        "c_custkey",
        vectors.has_prefix(names, ["a", "b"]).alias("prefix"),
        F.array_join(vectors.positions_of(names, ["a", "b", "z"]), ",").alias("places"),
        F.array_join(vocab.texts_of(F.array(k, k * 0), F.col("lookup")), ",").alias("texts")
    )


@query(
    "SELECT subtask, count(*) AS segments, sum(end_frame - start_frame)::BIGINT AS frames, count(*) FILTER (end_frame - start_frame = 1) AS short FROM s "
    "GROUP BY subtask",
    *_EVENTS,
)
def segment_shares(spark, d):
    found = segments.run_segments(proxies.frames(spark, d), "subtask", proxies.ORDER)
    return found.groupBy("subtask").agg(F.count("*").alias("segments"), F.sum("length").alias("frames"), F.count_if(F.col("length") == 1).alias("short"))
