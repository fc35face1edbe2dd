"""Registered queries of the audits: customers' orders as episodes, with one defect planted a rule.

The SQL builds the same tables, defects included, and judges each rule by joins of frames, metadata and annotation entries.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import proxies
from .operators import index
from .plans import captions, rules
from .queries import _t, query
from .tables import written

#: Every how many episodes the same defect comes again.
CYCLE = 40
PHASES = 3

_FRAMES = """
ids AS (SELECT o_custkey, row_number() OVER (ORDER BY o_custkey) - 1 AS e, count(*) AS n FROM orders GROUP BY o_custkey HAVING count(*) >= 3),
g AS (SELECT e, e % 40 AS k, n, row_number() OVER (PARTITION BY e ORDER BY o_orderkey) - 1 AS p FROM orders JOIN ids USING (o_custkey)),
f AS (SELECT e, k, n, p, p + CASE WHEN k = 1 AND p = n - 1 THEN 1 ELSE 0 END AS frame_index,
  CASE WHEN k = 3 AND p = n - 1 THEN 7 WHEN k = 4 THEN 2 - p * 3 // n ELSE p * 3 // n END AS w, {prompt} AS t FROM g),
tv AS ({tasks}), wv AS (SELECT * FROM (VALUES (0, 'reach'), (1, 'grasp'), (2, 'place')) AS t(i, x)),
r AS (SELECT e, k, n, w, seg, min(p) AS a, max(p) + 1 AS b FROM (SELECT *, sum(c) OVER (PARTITION BY e ORDER BY p) - 1 AS seg FROM
  (SELECT *, CASE WHEN lag(w) OVER (PARTITION BY e ORDER BY p) = w THEN 0 ELSE 1 END AS c FROM f)) GROUP BY e, k, n, w, seg),
u AS (SELECT e, k, t, seg, min(p) AS a FROM (SELECT *, sum(c) OVER (PARTITION BY e ORDER BY p) - 1 AS seg FROM
  (SELECT *, CASE WHEN lag(t) OVER (PARTITION BY e ORDER BY p) = t THEN 0 ELSE 1 END AS c FROM f)) GROUP BY e, k, t, seg),
rs AS (SELECT e, k, max(n) AS n, list(w ORDER BY seg) AS ws, list(coalesce(x, '?') ORDER BY seg) AS said, count(*) AS c, count(*) FILTER (x IS NULL) AS lost FROM r LEFT JOIN wv ON w = i GROUP BY e, k),
us AS (SELECT e, list(t ORDER BY seg) AS ts, list(coalesce(x, '?') ORDER BY seg) AS told, count(*) FILTER (x IS NULL) AS lost FROM u LEFT JOIN tv ON t = i GROUP BY e),
m AS (SELECT rs.e, n + CASE WHEN k = 6 THEN 1 ELSE 0 END AS length, CASE WHEN k = 7 THEN list_reverse(said) ELSE said END AS instructions,
  CASE WHEN k = 16 THEN ['another'] ELSE told END AS tasks FROM rs JOIN us ON rs.e = us.e WHERE k <> 5),
a AS (SELECT e, k, seg, w + CASE WHEN k = 13 AND seg = 0 THEN 1 ELSE 0 END AS v, CASE WHEN k = 14 AND seg = 1 THEN 'wrong' ELSE coalesce(x, '?') END AS s, a, b + CASE WHEN k = 15 AND seg = 0 THEN 1 ELSE 0 END AS b
  FROM r LEFT JOIN wv ON w = i WHERE k <> 8 AND NOT (k = 12 AND b = n))"""


def _sql(prompt: str, tasks: str) -> str:
    return "WITH " + _FRAMES.format(prompt=prompt, tasks=tasks).strip()


_ONE = ("CASE WHEN k = 2 AND p = 0 THEN 9 WHEN k = 17 THEN 1 ELSE 0 END", "SELECT * FROM (VALUES (0, 'tidy up'), (1, 'another')) AS t(i, x)")


def contract_tables(spark, d, per_subtask: bool = False, mapped: bool = False) -> dict[str, DataFrame]:
    """Frames, metadata, annotations and vocabularies of a dataset in which episode e has the defect e % CYCLE.

    Defects: 1 a gap in frame_index, 2 an unknown prompt, 3 an unknown subtask, 4 subtasks reversed, 5 no metadata, 6 another
    length, 7 instructions reversed, 8 no annotation, 9 two of them, 10 and 11 wrong durations, 12 an entry too few, 13 another subtask in an
    entry, 14 another caption, 15 another range, 16 another task list, 17 another prompt."""
    rows = _t(spark, d, "orders")
    sizes = rows.groupBy("o_custkey").agg(F.count("*").alias("n")).where("n >= 3")
    ids = index.running_total(sizes, "o_custkey", name="episode_index")
    k, p, n = F.pmod("episode_index", F.lit(CYCLE)), F.col("p"), F.col("n")
    place = F.row_number().over(Window.partitionBy("episode_index").orderBy("o_orderkey")) - 1
    rows = rows.join(ids, "o_custkey").select("episode_index", "n", place.alias("p"))
    own = F.floor(p * PHASES / n).cast("long")
    word = F.when((k == 3) & (p == n - 1), 7).when(k == 4, PHASES - 1 - own).otherwise(own).cast("long")
    prompt = F.when((k == 2) & (p == 0), 9).when(k == 17, 1).otherwise(own if per_subtask or mapped else F.lit(0)).cast("long")
    frames = rows.select("episode_index", (p + F.when((k == 1) & (p == n - 1), 1).otherwise(0)).cast("long").alias("frame_index"), prompt.alias("task_index"), word.alias("subtask_index"))
    words = [(0, "reach"), (1, "grasp"), (2, "place")]
    tasks = [(0, "reach it"), (1, "grasp it"), (2, "place it")] if mapped else words if per_subtask else [(0, "tidy up"), (1, "another")]
    subtasks = spark.createDataFrame(words, "subtask_index long, subtask string")
    tasks = spark.createDataFrame(tasks, "task_index long, task string")
    found = written(captions.facts(frames, _no_metadata(spark), _no_annotations(spark), tasks, subtasks), "planted")
    said = lambda c: F.transform(c, lambda x: F.coalesce(x, F.lit("?")))
    meta = found.where(k != 5).select(
        "episode_index", (F.col("frames") + (k == 6).cast("int")).alias("length"), F.when(k == 16, F.array(F.lit("another"))).otherwise(said("prompts")).alias("tasks"),
        F.when(k == 7, F.reverse(said("captions"))).otherwise(said("captions")).alias("subtask_instructions"),
    )
    first = lambda i, v: ((k == v) & (i == 0)).cast("int")
    entry = lambda r, i: F.struct(
        (r["value"] + first(i, 13)).alias("sub_task_idx"),
        F.when((k == 14) & (i == 1), F.lit("wrong")).otherwise(F.get(said("captions"), i)).alias("sub_task_instruction"),
        F.array(r["start"], r["end"] + first(i, 15)).alias("frame_duration"),
    )
    entries = F.transform("subtask_runs", entry)
    entries = F.when(k == 12, F.slice(entries, 1, F.size(entries) - 1)).otherwise(entries)
    copies = F.when(k == 8, 0).when(k == 9, 2).otherwise(1)
    notes = found.select(
        "episode_index", F.array_repeat(F.format_string("annotations/episode_%06d.json", "episode_index"), copies).alias("paths"),
        F.struct((F.col("frames") + (k == 10).cast("int")).alias("task_duration"), F.array((k == 11).cast("long"), F.col("frames")).alias("valid_duration")).alias("meta_data"),
        entries.alias("sub_task_annotation"),
    ).select("episode_index", F.explode("paths").alias("path"), "meta_data", "sub_task_annotation")
    return {"frames": frames, "episodes": meta, "annotations": notes, "tasks": tasks, "subtasks": subtasks}


def _no_metadata(spark) -> DataFrame:
    return spark.createDataFrame([], "episode_index long, length long, tasks array<string>, subtask_instructions array<string>")


def _no_annotations(spark) -> DataFrame:
    return spark.createDataFrame(
        [], "episode_index long, path string, meta_data struct<task_duration: long, valid_duration: array<long>>, "
        "sub_task_annotation array<struct<sub_task_idx: long, sub_task_instruction: string, frame_duration: array<long>>>"
    )


_RULES = """
SELECT rule, count(*) AS violations, min(e)::BIGINT AS first_episode FROM (
SELECT 'frame_index' AS rule, e FROM f GROUP BY e HAVING count(*) FILTER (frame_index <> p) > 0
UNION ALL SELECT 'task_index', e FROM us WHERE lost > 0
UNION ALL SELECT 'subtask_index', e FROM rs WHERE lost > 0
UNION ALL SELECT 'subtask_order', e FROM rs WHERE ws <> [0, 1, 2]
UNION ALL SELECT 'episode_metadata', e FROM rs WHERE e NOT IN (SELECT e FROM m)
UNION ALL SELECT 'episode_length', m.e FROM m JOIN rs ON m.e = rs.e WHERE length <> n
UNION ALL SELECT 'subtask_instructions', m.e FROM m JOIN rs ON m.e = rs.e WHERE instructions <> said OR lost > 0
UNION ALL SELECT 'annotation_file', e FROM rs WHERE k IN (8, 9)
UNION ALL SELECT 'task_duration', e FROM rs WHERE k = 10
UNION ALL SELECT 'valid_duration', e FROM rs WHERE k = 11
UNION ALL SELECT 'annotation_segments', rs.e FROM rs JOIN (SELECT e, count(*) AS c FROM a GROUP BY e) b ON rs.e = b.e WHERE b.c <> rs.c AND k <> 9
UNION ALL SELECT 'annotation_order', a.e FROM a JOIN r ON a.e = r.e AND a.seg = r.seg WHERE a.v <> r.w AND a.k NOT IN (9, 12)
UNION ALL SELECT 'annotation_caption', a.e FROM a JOIN r ON a.e = r.e AND a.seg = r.seg LEFT JOIN wv ON r.w = i WHERE a.s IS DISTINCT FROM x AND a.k NOT IN (9, 12)
UNION ALL SELECT 'annotation_frame_range', a.e FROM a JOIN r ON a.e = r.e AND a.seg = r.seg WHERE (a.a <> r.a OR a.b <> r.b) AND a.k NOT IN (9, 12)
UNION ALL SELECT 'mode', us.e FROM us LEFT JOIN m ON us.e = m.e WHERE ts <> [0] OR tasks IS DISTINCT FROM ['tidy up']
UNION ALL SELECT x.rule, NULL FROM (VALUES ('overall_task'), ('total_episodes'), ('expected_episodes')) AS x(rule)
) GROUP BY rule"""


@query(_sql(*_ONE) + _RULES)
def caption_contract_violations(spark, d):
    """Every rule of the full_episode contract, with the first episode that breaks it."""
    t = contract_tables(spark, d)
    audit = captions.audit(**t, mode="full_episode", phases=PHASES, total=7, expected_episodes=9, overall="tidy up")
    return audit.violations.groupBy("rule").agg(F.count("*").alias("violations"), F.min("episode_index").alias("first_episode"))


@query(
    _sql(*_ONE)
    + """
SELECT rs.e AS episode_index, n AS frames, CASE WHEN ts = [0] AND tasks = ['tidy up'] THEN 'full_episode_prompt_with_subtask_annotations' ELSE 'invalid_full_episode_task_mapping' END AS mode,
  array_to_string(ts, ',') AS prompts, array_to_string(ws, ',') AS phases, array_to_string(said, '|') AS captions,
  CASE WHEN k <> 8 THEN 'annotations/episode_' || lpad(rs.e::VARCHAR, 6, '0') || '.json' END AS annotation
FROM rs JOIN us ON rs.e = us.e LEFT JOIN m ON rs.e = m.e"""
)
def caption_contract_summaries(spark, d):
    t = contract_tables(spark, d)
    out = captions.audit(**t, mode="full_episode", phases=PHASES, overall="tidy up").summaries
    return out.select(
        "episode_index", "frames", "mode", F.array_join("task_run_indices", ",").alias("prompts"), F.array_join("subtask_run_indices", ",").alias("phases"),
        F.array_join("stored_subtask_captions", "|", "?").alias("captions"), "annotation",
    )


_OWN = "CASE WHEN k = 2 AND p = 0 THEN 9 WHEN k = 17 THEN 1 ELSE p * 3 // n END"


@query(
    _sql(_OWN, "SELECT * FROM (VALUES (0, 'reach'), (1, 'grasp'), (2, 'place')) AS t(i, x)")
    + """, q AS (SELECT us.*, ws, said, tasks FROM us JOIN rs ON us.e = rs.e LEFT JOIN m ON us.e = m.e)
SELECT mode, count(*) AS episodes FROM (
SELECT CASE WHEN ts = [0, 1, 2] AND said = ['reach', 'grasp', 'place'] AND tasks = ['reach', 'grasp', 'place'] THEN 'per_frame_subtasks_visible_to_training' ELSE 'invalid_per_subtask_task_mapping' END AS mode FROM q
UNION ALL SELECT CASE WHEN ts = [0, 1, 2] AND ws = [0, 1, 2] AND tasks IN (['reach', 'grasp', 'place'], ['reach it', 'grasp it', 'place it']) THEN 'mapped_subtasks_visible_with_rich_annotations' ELSE 'invalid_mapped_subtask_task_mapping' END FROM q
UNION ALL SELECT 'invalid_full_episode_task_mapping' FROM q
) GROUP BY mode"""
)
def language_mode_labels(spark, d):
    """Episodes with a prompt a subtask, judged as each mode: the prompts' own texts, mapped ones, and one for the whole."""
    own, mapped = contract_tables(spark, d, per_subtask=True), contract_tables(spark, d, mapped=True)
    judged = lambda t, mode, **said: captions.audit(**t, mode=mode, phases=PHASES, **said).summaries.select("mode")
    out = judged(own, "per_subtask").unionAll(judged(mapped, "mapped_subtask", vocabulary=["reach it", "grasp it", "place it"]))
    return out.unionAll(judged(own, "full_episode", overall="reach")).groupBy("mode").agg(F.count("*").alias("episodes"))


@query(
    _sql(*_ONE)
    + """
SELECT x.kept, string_agg(DISTINCT mode, ',' ORDER BY mode) AS modes, count(DISTINCT mode) = 1 AND max(mode) = 'full_episode_prompt_with_subtask_annotations' AS ready FROM (
SELECT us.e, e % 40 AS k, CASE WHEN ts = [0] AND tasks = ['tidy up'] THEN 'full_episode_prompt_with_subtask_annotations' ELSE 'invalid_full_episode_task_mapping' END AS mode FROM us LEFT JOIN m USING (e)
) y JOIN (VALUES ('all', 0), ('clean', 18)) AS x(kept, least) ON k >= least GROUP BY x.kept"""
)
def modes_ready(spark, d):
    """The mode report of all episodes, and of those without a defect."""
    t = contract_tables(spark, d)
    whole = captions.audit(**t, mode="full_episode", phases=PHASES, overall="tidy up")
    clean = captions.Audit(whole.violations, whole.summaries.where(F.pmod("episode_index", F.lit(CYCLE)) >= 18), whole.mode)
    return whole.modes().select(F.lit("all").alias("kept"), "*").unionAll(clean.modes().select(F.lit("clean").alias("kept"), "*"))


@query(
    """
WITH ids AS (SELECT user_id, row_number() OVER (ORDER BY user_id) - 1 AS e FROM (SELECT DISTINCT user_id FROM events)),
v AS (SELECT event_type AS x, row_number() OVER (ORDER BY event_type) - 1 AS w FROM (SELECT DISTINCT event_type FROM events)),
f AS (SELECT e, w, x, row_number() OVER (PARTITION BY e ORDER BY ts, event_id) - 1 AS p FROM events JOIN ids USING (user_id) JOIN v ON event_type = x),
r AS (SELECT e, w, x, seg FROM (SELECT *, sum(c) OVER (PARTITION BY e ORDER BY p) - 1 AS seg FROM (SELECT *, CASE WHEN lag(w) OVER (PARTITION BY e ORDER BY p) = w THEN 0 ELSE 1 END AS c FROM f)) GROUP BY e, w, x, seg),
s AS (SELECT e, list(w ORDER BY seg) AS ws FROM r GROUP BY e)
SELECT 'subtask_order' AS rule, count(*) AS violations FROM s WHERE ws <> [0, 1, 2, 3, 4] HAVING count(*) > 0
UNION ALL SELECT 'annotation_frame_range', count(*) FROM r WHERE seg = 0 UNION ALL SELECT 'mode', count(*) FROM s WHERE e % 3 = 0"""
)
def language_violations(spark, d):
    """Event sequences, long and with many runs: the order of subtasks, the first segment's range a frame too long in each
    annotation, and another task list in every third episode."""
    rows = proxies.coded_frames(spark, d)
    ids = index.compact_ids(rows, "episode_index", "e")
    frames = rows.join(ids, "episode_index").select(F.col("e").alias("episode_index"), "frame_index", F.lit(0).cast("long").alias("task_index"), "subtask_index")
    tasks = spark.createDataFrame([(0, "watch")], "task_index long, task string")
    found = captions.facts(frames, _no_metadata(spark), _no_annotations(spark), tasks, proxies.subtasks(spark, d))
    meta = found.select("episode_index", F.col("frames").alias("length"), F.array(F.when(F.col("episode_index") % 3 == 0, "look").otherwise("watch")).alias("tasks"), F.col("captions").alias("subtask_instructions"))
    entry = lambda r, i: F.struct(r["value"].alias("sub_task_idx"), F.get("captions", i).alias("sub_task_instruction"), F.array(r["start"], r["end"] + (i == 0).cast("int")).alias("frame_duration"))
    span = F.struct(F.col("frames").alias("task_duration"), F.array(F.lit(0).cast("long"), F.col("frames")).alias("valid_duration"))
    notes = found.select("episode_index", F.lit("a").alias("path"), span.alias("meta_data"), F.transform("subtask_runs", entry).alias("sub_task_annotation"))
    total = ids.count()
    audit = captions.audit(frames, meta, notes, tasks, proxies.subtasks(spark, d), "full_episode", 5, total, overall="watch")
    return audit.violations.groupBy("rule").agg(F.count("*").alias("violations"))


# --- integrity

_LINES = """
ids AS (SELECT user_id, row_number() OVER (ORDER BY user_id) - 1 AS r, count(*) AS n FROM events GROUP BY user_id),
o AS (SELECT user_id, CASE WHEN r = 4 THEN 100000 ELSE r END AS e, r % 20 AS k, n, coalesce(sum(n) OVER (ORDER BY r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM ids),
f AS (SELECT e, k, n, start, event_id, start + p AS place, p + CASE WHEN event_id % 89 = 7 THEN 1000 ELSE 0 END AS frame_index, CASE WHEN event_id % 97 = 5 THEN NULL ELSE start + p END AS index, p
  FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS p FROM events JOIN o USING (user_id))),
m AS (SELECT e, k, n + CASE WHEN k = 3 THEN 1 ELSE 0 END AS length, start + CASE WHEN k = 5 THEN 1 ELSE 0 END AS a, start + n + CASE WHEN k = 6 THEN 1 ELSE 0 END AS b,
  CASE WHEN k = 8 THEN [' bad  task '] ELSE ['fine'] END AS tasks, CASE WHEN k = 9 THEN ['', 'fine'] ELSE ['fine'] END AS says FROM o WHERE k <> 7),
s AS (SELECT e, n, start, min(index) AS least, max(index) + 1 AS past, count(*) AS c FROM f GROUP BY e, n, start)"""


@query(
    "WITH " + _LINES.strip() + """
SELECT rule, count(*) AS violations, min(location) AS first_location FROM (
SELECT 'tasks_contiguous' AS rule, 'tasks 9' AS location UNION ALL SELECT 'subtasks_caption', 'subtasks 1'
UNION ALL SELECT 'episode_duplicate', 'episode ' || e FROM m WHERE k = 10
UNION ALL SELECT 'episode_caption', 'episode ' || e || ' tasks 0' FROM m WHERE k = 8
UNION ALL SELECT 'episode_caption', 'episode ' || e || ' subtask_instructions 0' FROM m WHERE k = 9
UNION ALL SELECT 'annotation_json', 'episode ' || e FROM o WHERE k = 11
UNION ALL SELECT 'annotation_caption', 'episode ' || e || ' 1' FROM o WHERE k = 12
UNION ALL SELECT 'global_index', 'index' || coalesce(' ' || index, '') FROM f WHERE index IS DISTINCT FROM place
UNION ALL SELECT 'frame_index', 'episode ' || e || ' ' || p FROM f WHERE frame_index <> p
UNION ALL SELECT 'episode_contiguous', 'episode ' || e FROM s WHERE past - least <> c
UNION ALL SELECT 'episode_ids', 'data'
UNION ALL SELECT 'episode_set', 'episode ' || e FROM o WHERE k = 7
UNION ALL SELECT 'episode_length', 'episode ' || m.e FROM m JOIN s USING (e), range(CASE WHEN k = 10 THEN 2 ELSE 1 END) WHERE c <> length
UNION ALL SELECT 'episode_dataset_from_index', 'episode ' || m.e FROM m JOIN s USING (e), range(CASE WHEN k = 10 THEN 2 ELSE 1 END) WHERE least <> a
UNION ALL SELECT 'episode_dataset_to_index', 'episode ' || m.e FROM m JOIN s USING (e), range(CASE WHEN k = 10 THEN 2 ELSE 1 END) WHERE past <> b
UNION ALL SELECT 'total_episodes', 'info' UNION ALL SELECT 'total_frames', 'info'
) GROUP BY rule"""
)
def preflight_violations(spark, d):
    """Users' events as episodes, with a defect a rule: of episode e the one that e % 20 says, and of single events."""
    rows = proxies.frames(spark, d)
    ids = index.running_totals(rows.groupBy("episode_index").agg(F.count("*").alias("n")), ["episode_index"], {"r": None, "start": F.col("n")})
    k = F.pmod("r", F.lit(20))
    ids = ids.select(F.col("episode_index").alias("user"), F.when(F.col("r") == 4, 100000).otherwise(F.col("r")).cast("long").alias("episode_index"), k.cast("int").alias("k"), "n", "start")
    placed = rows.withColumnRenamed("episode_index", "user").join(ids, "user").withColumn("place", F.col("start") + F.col("frame_index"))
    frames = placed.select(
        "episode_index", "place", (F.col("frame_index") + F.when(F.col("index") % 89 == 7, 1000).otherwise(0)).alias("frame_index"),
        F.when(F.col("index") % 97 != 5, F.col("place")).alias("index"),
    )
    plus = lambda v: (F.col("k") == v).cast("long")
    caption = lambda v, bad, *more: F.when(F.col("k") == v, F.array(*map(F.lit, (bad, *more)))).otherwise(F.array(F.lit("fine")))
    meta = ids.where("k <> 7").select(
        "episode_index", (F.col("n") + plus(3)).alias("length"), (F.col("start") + plus(5)).alias("dataset_from_index"), (F.col("start") + F.col("n") + plus(6)).alias("dataset_to_index"),
        caption(8, " bad  task ").alias("tasks"), caption(9, "", "fine").alias("subtask_instructions"), F.array_repeat("k", F.when(F.col("k") == 10, 2).otherwise(1)).alias("times"),
    )
    meta = meta.withColumn("times", F.explode("times")).drop("times")
    said = F.array(F.lit("fine"), F.when(F.col("k") != 12, F.lit("fine")))
    notes = ids.select(
        "episode_index", F.transform(said, lambda t: F.struct(t.alias("sub_task_instruction"))).alias("sub_task_annotation"), F.when(F.col("k") == 11, "{").alias("_corrupt_record")
    )
    words = {
        "tasks": (spark.createDataFrame([(0, "a"), (9, "b")], "i long, t string"), "i", "t"),
        "subtasks": (spark.createDataFrame([(0, "a"), (1, "b\u00a0c")], "i long, t string"), "i", "t"),
    }
    found = rules.preflight(frames, meta, words, notes, (1, 2), "place", True)
    return found.groupBy("rule").agg(F.count("*").alias("violations"), F.min("location").alias("first_location"))


@query(
    """
WITH n AS (SELECT n_name AS dataset, n_nationkey % 10 AS k FROM nation)
SELECT dataset, 'contract' AS rule, field, expected, observed FROM (
SELECT dataset, 'fps' AS field, '[15.0]' AS expected, CASE WHEN k = 1 THEN '[30.0]' ELSE NULL END AS observed FROM n WHERE k = 1
UNION ALL SELECT dataset, 'fps', '[15.0]', '[null]' FROM n WHERE k = 2
UNION ALL SELECT dataset, 'state_dim', '[2]', '[3]' FROM n WHERE k = 3
UNION ALL SELECT dataset, 'state_names', '[["a","b"]]', '[["b","a"]]' FROM n WHERE k = 4
UNION ALL SELECT dataset, 'action_names', '[["x"]]', '[null]' FROM n WHERE k = 5
UNION ALL SELECT dataset, 'cameras', '[["head:3x480x640","wrist:3x480x640"]]', '[["wrist:3x480x640","head:3x480x640"]]' FROM n WHERE k = 6
UNION ALL SELECT dataset, 'cameras', '[["head:3x480x640","wrist:3x480x640"]]', '[["head:3x480x640","wrist:3x480x640","side:3x480x640"]]' FROM n WHERE k = 7
UNION ALL SELECT dataset, 'cameras', '[["head:3x480x640","wrist:3x480x640"]]', '[["head:3x240x320","wrist:3x480x640"]]' FROM n WHERE k = 8
UNION ALL SELECT dataset, 'cameras', '[["head:3x480x640","wrist:3x480x640"]]', '[[]]' FROM n WHERE k = 9)
UNION ALL SELECT dataset, 'contract_source', 'underivable', 'cameras and names', CASE k WHEN 5 THEN 'action_names' ELSE 'cameras' END FROM n WHERE k IN (5, 9)"""
)
def contract_check(spark, d):
    """A contract for each nation against metadata with one defect a tenth of them."""
    k = F.pmod("n_nationkey", F.lit(10))
    names = lambda *x: F.array(*map(F.lit, x))

    def feature(key, dtype, shape, said=None):
        return F.struct(F.lit(key).alias("key"), F.lit(dtype).alias("dtype"), shape.alias("shape"), (said if said is not None else F.lit(None).cast("array<string>")).alias("names"))

    wide, small = F.array(F.lit(3), F.lit(480), F.lit(640)), F.array(F.lit(3), F.lit(240), F.lit(320))
    head, wrist, side = feature("head", "video", F.when(k == 8, small).otherwise(wide)), feature("wrist", "image", wide), feature("side", "video", wide)
    cameras = F.when(k == 6, F.array(wrist, head)).when(k == 7, F.array(head, wrist, side)).when(k == 9, F.slice(F.array(head, wrist), 1, 0)).otherwise(F.array(head, wrist))
    state = feature("observation.state", "float32", F.array(F.when(k == 3, 3).otherwise(2)), F.when(k == 4, names("b", "a")).otherwise(names("a", "b")))
    action = feature("action", "float32", F.array(F.lit(1)), F.when(k != 5, names("x")))
    infos = _t(spark, d, "nation").select(
        F.col("n_name").alias("dataset"), F.when(k == 1, 30).when(k != 2, 15).alias("fps"), F.concat(F.array(state, action), cameras).alias("features")
    )
    said = _t(spark, d, "nation").select(
        F.col("n_name").alias("dataset"), F.lit(2).alias("state_dim"), names("a", "b").alias("state_names"), F.lit(1).alias("action_dim"), names("x").alias("action_names"),
        names("head:3x480x640", "wrist:3x480x640").alias("cameras"), F.lit(15.0).alias("fps"),
    )
    seen = rules.observed_contract(infos)
    out = rules.contract(said, seen).select("dataset", F.lit("contract").alias("rule"), "field", "expected", "observed")
    return out.unionAll(rules.underivable(seen).select(F.col("location").alias("dataset"), "rule", F.lit("underivable").alias("field"), "expected", "observed"))
