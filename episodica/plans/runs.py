"""Runs, attempts, queues and their logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text
from ..functions.config import ConfigError, merged_leaves

#: The trainers' names as configurations write them, and the canonical one of each.
BACKENDS = {
    "lerobot": "lerobot_groot",
    "lerobot-groot": "lerobot_groot",
    "lerobot_groot": "lerobot_groot",
    "groot": "lerobot_groot",
    "lerobot-act": "lerobot_act",
    "lerobot_act": "lerobot_act",
    "act": "lerobot_act",
    "isaac-groot": "isaac_groot",
    "isaac_groot": "isaac_groot",
    "isaac": "isaac_groot",
}


def backend(name: str) -> str:
    if name not in BACKENDS:
        raise ConfigError(f"unknown backend {name}")
    return BACKENDS[name]


def canonical_backend(name: Column) -> Column:
    table = F.create_map(*(F.lit(x) for kv in BACKENDS.items() for x in kv))
    found = F.element_at(table, name)
    return F.when(found.isNull(), F.raise_error(F.concat(F.lit("unknown backend "), F.coalesce(name, F.lit("null"))))).otherwise(found)


def is_lerobot(name: Column) -> Column:
    return F.startswith(canonical_backend(name), F.lit("lerobot_"))


def model_family(name: Column) -> Column:
    return F.when(canonical_backend(name) == "isaac_groot", "groot").otherwise("lerobot")


def latest_attempts(results: DataFrame, run: str = "run", path: str = "path") -> DataFrame:
    """Each run's newest attempt by number; the run's own result comes before any attempt.  `_` folders are skipped."""
    kept = results.where(~F.startswith(run, F.lit("_")))
    return kept.groupBy(run).agg(F.max_by(F.struct(path, "attempt"), F.coalesce("attempt", F.lit(-1))).alias("r")).select(run, "r.*")


def latest_checkpoints(names: DataFrame, run: str = "run", name: str = "name") -> DataFrame:
    n = text.number_after(F.col(name), "checkpoint-")
    return names.withColumn("n", n).where("n is not null").groupBy(run).agg(F.max_by(name, "n").alias(name))


def first_existing(candidates: DataFrame, present: DataFrame, key: str, priority: str = "priority", path: str = "path") -> DataFrame:
    found = candidates.join(present.select(path).distinct(), path, "left_semi")
    return found.groupBy(key).agg(F.min_by(path, priority).alias(path))


def last_metrics(lines: DataFrame, run: str = "run", number: str = "line_no", line: str = "line") -> DataFrame:
    """Each run's metrics: of its last step line; of a run without any, the last loss and the last rate of its summaries."""
    rows = lines.select(run, number, text.step_metrics(F.col(line)).alias("m"), *(text.summary_metric(F.col(line), k).alias(k) for k in text.SUMMARY))
    rows = rows.where("m is not null or loss is not null or samples_per_second is not null")
    last = lambda c: F.max_by(c, F.when(F.col(c).isNotNull(), F.col(number)))
    found = rows.groupBy(run).agg(last("m").alias("m"), *(last(k).alias(k) for k in text.SUMMARY)).where("m is not null or loss is not null")
    own = {k: F.col(k) if k in text.SUMMARY else F.lit(None) for k in text.METRICS}
    return found.select(run, *(F.when(F.col("m").isNotNull(), F.col(f"m.{k}")).otherwise(own[k]).cast(kind).alias(k) for k, kind in text.METRICS.items()))


def failures(exits: DataFrame) -> DataFrame:
    """exits: run, code (negative: signal), timed_out, log.  With exit_code and failure_category; only the log's last
    two million characters are read."""
    code = text.exit_code(F.col("code"))
    return exits.select("run", code.alias("exit_code"), text.failure_category(code, F.col("timed_out"), F.right("log", F.lit(2_000_000))).alias("failure_category"))


def queue_state(events: DataFrame, run: str = "run_name", order: str = "event_no") -> DataFrame:
    """Each run's last state with its attempts and failures."""
    out = events.groupBy(run).agg(
        F.max_by("state", order).alias("state"),
        F.max("attempt").alias("attempts"),
        F.count_if(F.col("state") == "failed").alias("failures"),
        F.max_by("failure_category", F.when(F.col("state") == "failed", F.col(order))).alias("last_failure")
    )
    return out


def runnable(state: DataFrame, max_attempts: int) -> DataFrame:
    return state.where((F.col("state") == "failed") & (F.col("attempts") < max_attempts) | F.col("state").isin("pending"))


def listing(results: DataFrame) -> DataFrame:
    """One row a run that has a result, by name: the newest attempt's own name, state, evaluation loss and tracker page.

    results: run (the folder), attempt (null: the run's own), path, run_name, state, final_eval_loss, wandb_url."""
    newest = F.coalesce("attempt", F.lit(-1))
    rows = results.where(~F.startswith("run", F.lit("_")))
    one = rows.groupBy("run").agg(
        F.max_by(F.struct(F.coalesce("run_name", "run").alias("run_name"), "state", "final_eval_loss", "wandb_url", F.col("path").alias("result")), newest).alias("r")
    )
    return one.select("run", "r.*").orderBy("run")


def completed(results: DataFrame) -> DataFrame:
    """(run, path, problem): the result that a package is made from is the last in the order of names, so attempt-9 comes
    after attempt-10, and the run's own comes before any; a problem if it isn't completed."""
    last = results.groupBy("run").agg(F.max_by(F.struct("path", "state"), F.struct(F.col("attempt").isNotNull(), F.col("attempt").cast("string"))).alias("r"))
    return last.select("run", "r.path", F.when(~F.col("r.state").eqNullSafe(F.lit("completed")), "run is not completed").alias("problem"))


def model_paths(candidates: DataFrame, present: DataFrame) -> DataFrame:
    """(run, path, problem): a run's model folder must hold config.json."""
    known = present.select(F.col("path").alias("file")).distinct().withColumn("there", F.lit(True))
    rows = candidates.join(known, F.concat("path", F.lit("/config.json")) == F.col("file"), "left")
    return rows.select("run", "path", F.when(F.col("path").isNull(), "result does not identify a model").when(F.col("there").isNull(), "model directory is incomplete").alias("problem"))


def resolved_configs(results: DataFrame, present: DataFrame) -> DataFrame:
    """(run, path, problem): a run's resolved configuration is where its result says, else beside the result."""
    path = F.coalesce(F.nullif("resolved_config", F.lit("")), F.concat(F.regexp_replace("path", r"[^/]*\z", ""), F.lit("resolved_config.yaml")))
    rows = results.select("run", path.alias("path"))
    known = present.select("path").distinct().withColumn("there", F.lit(True))
    return rows.join(known, "path", "left").select("run", "path", F.when(F.col("there").isNull(), "resolved training config is missing").alias("problem"))


def queue_outcomes(events: DataFrame, continue_on_failure: bool = False) -> DataFrame:
    """(queue, state, runs_done): of (queue, position, attempt, state) the state in which a queue ends: failed at the first run
    without a completed attempt, unless it goes on."""
    runs = events.groupBy("queue", "position").agg(F.max((F.col("state") == "completed").cast("int")).alias("ok"))
    per = runs.groupBy("queue").agg(
        F.min(F.when(F.col("ok") == 0, F.col("position"))).alias("broke"),
        F.sum("ok").alias("all_ok"),
        F.collect_list(F.when(F.col("ok") == 1, F.col("position"))).alias("good")
    )
    stops = F.col("broke").isNotNull() & F.lit(not continue_on_failure)
    done = F.when(stops, F.size(F.filter("good", lambda p: p < F.col("broke")))).otherwise(F.col("all_ok"))
    return per.select("queue", F.when(stops, "failed").otherwise("completed").alias("state"), done.cast("long").alias("runs_done"))


#: Fixed value: the exit code of a queue that stops for want of disk.
LOW_DISK = 75


def status_rows(exits: DataFrame, least_gib: int) -> DataFrame:
    """Rows that a queue appends to its status table: of (run_name, attempt, code, log, free_gib, succeeded) what is said of each run.

    A run that succeeded before is skipped; too little disk stops; a failure is told from one for want of memory."""
    oom = F.coalesce(F.col("log").rlike(text.OUT_OF_MEMORY), F.lit(False))
    low = F.col("free_gib") < least_gib
    status = F.when(low, "blocked_low_disk").when(F.col("code") == 0, "completed").when(oom, "failed_oom_continuing").otherwise("failed_continuing")
    rows = exits.where(~F.col("succeeded"))
    return rows.select(
        "run_name",
        F.when(low, "-").otherwise(F.col("attempt").cast("string")).alias("attempt"),
        status.alias("status"),
        F.when(low, F.lit(LOW_DISK)).otherwise(F.col("code")).cast("int").alias("exit_code")
    )


def overridden(configs: DataFrame, queues: DataFrame) -> DataFrame:
    """(queue, position, path, value): the leaves of each entry's configuration with its overrides applied in order.

    configs: config, path, value (JSON); queues: queue, runs array<struct<config, overrides array<"a.b=value">>>."""
    rows = queues.select("queue", F.posexplode("runs").alias("position", "r")).select("queue", "position", F.col("r.config").alias("config"), F.col("r.overrides").alias("overrides"))
    base = rows.join(configs, "config").select("queue", "position", F.lit(0).alias("layer"), "path", "value")
    sets = rows.select("queue", "position", F.posexplode("overrides").alias("n", "o"))
    sets = sets.select(
        "queue",
        "position",
        (F.col("n") + 1).alias("layer"),
        F.substring_index("o", "=", 1).alias("path"),
        F.substring(F.col("o"), F.instr("o", "=") + 1, F.length("o")).alias("value")
    )
    return merged_leaves(base.unionAll(sets), ["queue", "position"]).select("queue", "position", "path", "value")


def resolved_queue(queues: DataFrame, configs: DataFrame) -> DataFrame:
    """queues: queue, runs array<struct<config, overrides>>; configs: config, run_name.  One row an entry, in order;
    run_name null where the configuration is missing."""
    rows = queues.select("queue", F.posexplode("runs").alias("position", "r")).select(
        "queue",
        "position",
        F.col("r.config").alias("config"),
        F.array_join("r.overrides", " ").alias("overrides")
    )
    return rows.join(configs, "config", "left").select("queue", "position", "config", "overrides", "run_name")


def duplicate_runs(entries: DataFrame) -> DataFrame:
    twice = entries.groupBy("queue", "run_name").agg(F.count("*").alias("c")).where("c > 1")
    return twice.groupBy("queue").agg(F.array_join(F.array_sort(F.collect_list("run_name")), ",").alias("run_names"))


def excluded_actions(terms: DataFrame, names: DataFrame) -> DataFrame:
    """Action names that contain a term, whatever the case; terms are a handful, so the condition is a broadcast."""
    return names.join(F.broadcast(terms), text.contains_ignoring_case(F.col("name"), F.col("term")), "left_semi")


def output_folder(explicit: Column, run_folder: Column, root: str, name: Column) -> Column:
    """Where a run writes: where it says, else below its folder, else below the folder of its name."""
    return F.coalesce(F.nullif(explicit, F.lit("")), F.concat(F.coalesce(run_folder, F.concat(F.lit(f"{root}/"), name)), F.lit("/output")))


def elapsed(start: Column, end: Column) -> Column:
    return F.round((F.unix_micros(end) - F.unix_micros(start)) / F.lit(1e6), 3)


def numbered(rows: DataFrame, group: str, order: str, name: str) -> DataFrame:
    return rows.withColumn(name, F.row_number().over(Window.partitionBy(group).orderBy(order)))
