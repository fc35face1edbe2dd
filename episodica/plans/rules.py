"""Audits as violation tables.

Every rule yields rows (rule, rule_order, location, expected, observed); an audit is their union and passes if it is
empty.  All violations are reported; the first in (rule_order, location) is what a fail-fast audit would raise.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import caption_problem
from ..operators import index, vocab


def violations(df: DataFrame, rule: str, order: int, location: Column, expected: Column, observed: Column) -> DataFrame:
    return df.select(
        F.lit(rule).alias("rule"),
        F.lit(order).alias("rule_order"),
        location.cast("string").alias("location"),
        expected.cast("string").alias("expected"),
        observed.cast("string").alias("observed")
    )


def all_of(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionAll, parts)


def first(audit: DataFrame):
    """The violation a fail-fast audit would raise, or None."""
    return audit.orderBy("rule_order", "location").first()


def ready(audit: DataFrame) -> bool:
    return audit.isEmpty()


def captions(df: DataFrame, rule: str, order: int, location: Column, text: Column) -> DataFrame:
    bad = df.withColumn("__problem", caption_problem(text)).where("__problem is not null")
    return violations(bad, rule, order, location, F.lit("clean caption"), F.col("__problem"))


#: Lists of captions in an episode's metadata.
CAPTION_LISTS = ("tasks", "subtask_instructions")


def preflight(
    frames: DataFrame,
    episodes: DataFrame,
    vocabularies: dict[str, tuple[DataFrame, str, str]],
    annotations: DataFrame | None,
    totals: tuple[int, int] | None = None,
    order: str = "index",
    numbered: bool = False
) -> DataFrame:
    """Dataset integrity.  `numbered`: the order column is each frame's place in the files, so nothing has to be counted.
    frames: index, episode_index, frame_index; episodes: episode_index, length,
    dataset_from_index, dataset_to_index, lists of captions; vocabularies: name -> (table, index, text);
    annotations: episode_index, sub_task_annotation; totals: declared episodes and frames."""
    at = lambda *x: F.concat_ws(" ", *(F.lit(v) if isinstance(v, str) else v.cast("string") for v in x))
    out = []
    for k, (name, (table, number, text)) in enumerate(vocabularies.items()):
        ranked = vocab.contiguity_violations(table, number, text).where(~F.col("observed").eqNullSafe(F.col("expected")))
        out.append(violations(ranked, f"{name}_contiguous", 20 + 2 * k, at(name, F.col("observed")), F.col("expected"), F.col("observed")))
        out.append(captions(table, f"{name}_caption", 21 + 2 * k, at(name, F.col(number)), F.col(text)))
    out.append(violations(episodes.agg(F.count("*").alias("c")).where("c = 0"), "episodes_empty", 29, F.lit("metadata"), F.lit("rows"), F.lit("none")))
    twice = episodes.groupBy("episode_index").agg(F.count("*").alias("c")).where("c > 1")
    out.append(violations(twice, "episode_duplicate", 30, at("episode", F.col("episode_index")), F.lit(1), F.col("c")))
    for c in (c for c in CAPTION_LISTS if c in episodes.columns):
        said = episodes.select("episode_index", F.posexplode(c).alias("p", "t"))
        out.append(captions(said, "episode_caption", 31, at("episode", F.col("episode_index"), c, F.col("p")), F.col("t")))
    if annotations is not None:
        if "_corrupt_record" in annotations.columns:
            broken = annotations.where("_corrupt_record is not null")
            out.append(violations(broken, "annotation_json", 39, at("episode", F.col("episode_index")), F.lit("valid JSON"), F.col("_corrupt_record")))
        said = annotations.select("episode_index", F.posexplode("sub_task_annotation").alias("p", "s"))
        out.append(captions(said, "annotation_caption", 40, at("episode", F.col("episode_index"), F.col("p")), F.col("s.sub_task_instruction")))
    # of each frame both numbers at once: in the files, and in its episode
    known = frames if numbered else index.running_total(frames, order, name="__expected")
    w = Window.partitionBy("episode_index").orderBy(order)
    own = ["index", "episode_index", "frame_index"]
    placed = known.select(
        *own,
        *([] if order in own else [order]),
        F.col(order if numbered else "__expected").alias("__global")
    ).withColumn("__place", (F.row_number().over(w) - 1).cast("long"))
    wrong = lambda rule, n, location, expected, observed: F.when(
        ~observed.eqNullSafe(expected),
        F.struct(
            F.lit(rule).alias("rule"),
            F.lit(n).alias("rule_order"),
            location.alias("location"),
            expected.cast("string").alias("expected"),
            observed.cast("string").alias("observed")
        )
    )
    both_rules = F.array(
        wrong("global_index", 50, at("index", F.col("index")), F.col("__global"), F.col("index")),
        wrong("frame_index", 51, at("episode", F.col("episode_index"), F.col("__place")), F.col("__place"), F.col("frame_index")),
    )
    out.append(placed.select(F.explode(F.filter(both_rules, lambda x: x.isNotNull())).alias("v")).select("v.*"))
    seen = index.bounds(placed)
    out.append(violations(seen.where("not contiguous"), "episode_contiguous", 52, at("episode", F.col("episode_index")), F.col("to_index") - F.col("from_index"), F.col("frames")))
    ids = index.bounds_of_ids(seen, "episode_index")
    out.append(violations(ids.where("n = 0"), "data_empty", 49, F.lit("data"), F.lit("rows"), F.lit("none")))
    out.append(violations(ids.where("n > 0 and not dense"), "episode_ids", 59, F.lit("data"), F.concat(F.lit("0 to "), F.col("n") - 1), F.concat_ws(" to ", "least", "most")))
    both = seen.join(episodes.select(F.col("episode_index").alias("e"), "length", "dataset_from_index", "dataset_to_index"), F.col("episode_index") == F.col("e"), "full_outer")
    out.append(
        violations(
            both.where("e is null or episode_index is null"),
            "episode_set",
            60,
            at("episode", F.coalesce("episode_index", "e")),
            F.lit("in data and metadata"),
            F.when(F.col("e").isNull(), "in data only").otherwise("in metadata only")
        )
    )
    for k, (a, b) in enumerate((("frames", "length"), ("from_index", "dataset_from_index"), ("to_index", "dataset_to_index"))):
        wrong = both.where("e is not null and episode_index is not null").where(~F.col(a).eqNullSafe(F.col(b)))
        out.append(violations(wrong, f"episode_{b}", 61 + k, at("episode", F.col("episode_index")), F.col(a), F.col(b)))
    if totals is not None:
        counted = seen.agg(F.count("*").alias("e"), F.coalesce(F.sum("frames"), F.lit(0)).alias("f"))
        out.append(violations(counted.where(F.col("e") != totals[0]), "total_episodes", 70, F.lit("info"), F.col("e"), F.lit(totals[0])))
        out.append(violations(counted.where(F.col("f") != totals[1]), "total_frames", 71, F.lit("info"), F.col("f"), F.lit(totals[1])))
    return all_of(out)


def integers(rows: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """Fields of metadata rows that are missing or aren't whole numbers."""
    one = lambda c: F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias("said"), F.col(c).cast("string").try_cast("double").isNotNull().alias("number"))
    said = rows.select(key, F.explode(F.array(*map(one, fields))).alias("f")).select(key, "f.*").where("said is null or not number")
    return violations(said, "integer", 32, F.concat_ws(" ", key, "field"), F.lit("an integer"), F.coalesce("said", F.lit("missing")))


def missing_columns(footers: DataFrame, required: list[str]) -> DataFrame:
    """Files (path, columns) that lack a required column."""
    lost = F.array_except(F.lit(required), "columns")
    bad = footers.withColumn("lost", lost).where(F.size("lost") > 0)
    return violations(bad, "columns", 10, F.col("path"), F.lit(", ".join(required)), F.array_join("lost", ", "))


def schema_differences(output: DataFrame, source: DataFrame) -> DataFrame:
    """Files of two trees (path, columns with types), paired by their place in path order, whose schemas differ."""

    def place(df: DataFrame, n: str) -> DataFrame:
        parts = df.select(F.split("path", "/").alias("parts"), F.col("path").alias(f"{n}_path"), F.col("types").alias(f"{n}_types"))
        return index.running_total(parts, "parts", name="place").drop("parts")

    both = place(output, "output").join(place(source, "source"), "place", "full_outer").where("not output_types <=> source_types")
    return violations(both, "schema", 11, F.coalesce("output_path", "source_path"), F.array_join("source_types", ", "), F.array_join("output_types", ", "))


#: A run configuration's top-level keys, and those of them that are mappings.
CONFIG_KEYS = (
    "schema_version", "backend", "name", "description", "hypothesis", "tags", "dataset_ref", "dataset", "contract", "policy", "train", "optimizer", "scheduler", "tracking",
    "resources", "artifacts", "annotation", "adapters",
)
CONFIG_MAPPINGS = ("dataset", "contract", "policy", "train", "optimizer", "scheduler", "tracking", "resources", "artifacts", "annotation")
#: What the native trainer supports.
NATIVE = {"action_representation": "absolute", "chunk_size": 40, "seed": 42}


def _whole(x: object, least: int) -> bool:
    return isinstance(x, int) and not isinstance(x, bool) and x >= least


def config(document: dict) -> list[tuple[str, object]]:
    """(rule, offending value) of a run configuration: every broken rule, in the order in which they are checked."""
    from ..functions.config import ConfigError
    from .runs import backend

    part = {k: v if isinstance(v := document.get(k), dict) else {} for k in CONFIG_MAPPINGS}
    data, policy, train, tracking, resources = (part[k] for k in ("dataset", "policy", "train", "tracking", "resources"))
    try:
        kind = backend(str(document.get("backend")))
    except ConfigError:
        kind = ""
    name, tags = str(document.get("name", "")), document.get("tags")
    relative, excluded = bool(policy.get("use_relative_actions")), policy.get("relative_exclude_joints")
    names = [str(n).lower() for n in (part["contract"].get("action") or {}).get("names", [])]
    lr, other_lr = part["optimizer"].get("lr"), policy.get("optimizer_lr")
    native = kind == "isaac_groot"
    unknown = sorted(set(document) - set(CONFIG_KEYS))
    lost = [t for t in (excluded if isinstance(excluded, list) else []) if not any(str(t).lower() in n for n in names)]
    # (rule, whether it holds, value)
    table = [
        ("unknown_key", not unknown, unknown),
        ("schema_version", document.get("schema_version") == 1, document.get("schema_version")),
        ("backend", bool(kind), document.get("backend")),
        ("name", name[:1].isascii() and name[:1].isalnum() and all(c.isascii() and (c.isalnum() or c in "._-") for c in name), name),
        ("tags", isinstance(tags, list) and all(isinstance(t, str) for t in tags), tags),
        ("mapping", all(isinstance(document.get(k), dict) for k in CONFIG_MAPPINGS), [k for k in CONFIG_MAPPINGS if not isinstance(document.get(k), dict)]),
        ("dataset", bool(data.get("repo_id") and data.get("root")), data),
        ("policy_type", policy.get("type") == ("act" if kind == "lerobot_act" else "groot") and policy.get("device") in ("cuda", "cpu", "mps"), [policy.get("type"), policy.get("device")]),
        ("max_steps", kind != "lerobot_groot" or policy.get("max_steps") == train.get("steps"), policy.get("max_steps")),
        ("learning_rate", other_lr is None or (lr is not None and abs(float(lr) - float(other_lr)) <= 1e-9 * max(abs(float(lr)), abs(float(other_lr)))), [lr, other_lr]),
        ("batch_size", _whole(train.get("batch_size"), 1), train.get("batch_size")),
        ("steps", _whole(train.get("steps"), 1), train.get("steps")),
        ("num_workers", _whole(train.get("num_workers"), 0), train.get("num_workers")),
        ("absolute_action", not native or policy.get("action_representation") == NATIVE["action_representation"], policy.get("action_representation")),
        ("modality", not native or bool(data.get("modality_config_path")), data.get("modality_config_path")),
        ("horizon", not native or policy.get("chunk_size") == NATIVE["chunk_size"], policy.get("chunk_size")),
        ("seed", not native or train.get("seed", NATIVE["seed"]) == NATIVE["seed"], train.get("seed")),
        ("relative_exclusions", bool(excluded) == relative and (not excluded or isinstance(excluded, list)), excluded),
        ("exclusion_term", not lost, lost),
        ("tracking_backend", tracking.get("backend") in ("wandb", "none"), tracking.get("backend")),
        ("tracking_project", tracking.get("backend") != "wandb" or bool(tracking.get("project")), tracking.get("project")),
        ("tracking_mode", tracking.get("mode") in (None, "online", "offline", "disabled"), tracking.get("mode")),
        ("timeout", float(resources.get("timeout_hours", 0)) > 0, resources.get("timeout_hours")),
        ("memory_guard", resources.get("memory_guard_gib") is None or float(resources["memory_guard_gib"]) > 0, resources.get("memory_guard_gib")),
    ]
    return [(rule, value) for rule, holds, value in table if not holds]


def observed_contract(infos: DataFrame) -> DataFrame:
    """Of metadata (dataset, fps, features: array of (key, dtype, shape, names)) the contract that they show; cameras in
    their order."""
    one = lambda k: F.get(F.filter("features", lambda f: f["key"] == k), F.lit(0))
    seen = F.filter("features", lambda f: f["dtype"].isin("video", "image"))
    camera = lambda f: F.concat(f["key"], F.lit(":"), F.array_join(F.transform(f["shape"], lambda x: x.cast("string")), "x"))
    state, action = one("observation.state"), one("action")
    dim = lambda f: F.when(F.size(f["shape"]) == 1, f["shape"][0]).cast("int")
    return infos.select(
        "dataset", dim(state).alias("state_dim"), state["names"].alias("state_names"), dim(action).alias("action_dim"), action["names"].alias("action_names"),
        F.transform(seen, camera).alias("cameras"), F.col("fps").cast("double").alias("fps"),
    )


def underivable(observed: DataFrame) -> DataFrame:
    """Datasets whose metadata can't fill a contract: no camera, or no names of state or action."""
    none = lambda c: F.coalesce(F.size(c), F.lit(0)) == 0
    what = F.concat_ws(", ", *(F.when(none(c), F.lit(c)) for c in ("cameras", "state_names", "action_names")))
    return violations(observed.withColumn("__lost", what).where("__lost <> ''"), "contract_source", 80, F.col("dataset"), F.lit("cameras and names"), F.col("__lost"))


def contract(expected: DataFrame, observed: DataFrame) -> DataFrame:
    """(dataset, field, expected, observed) where a declared contract and the data's own differ.

    Both: dataset, state_dim, state_names, action_dim, action_names, cameras (array of key:shape), fps."""
    fields = ["state_dim", "state_names", "action_dim", "action_names", "cameras", "fps"]
    text = lambda p: F.array(*(F.to_json(F.array(F.col(f"{p}.{f}"))) for f in fields))
    e, o = expected.alias("e"), observed.alias("o")
    both = e.join(o, F.col("e.dataset") == F.col("o.dataset"), "left").select(
        F.col("e.dataset").alias("dataset"),
        F.explode(F.arrays_zip(F.lit(fields).alias("field"), text("e").alias("expected"), text("o").alias("observed"))).alias("x")
    )
    return both.select("dataset", "x.field", "x.expected", "x.observed").where(~F.col("expected").eqNullSafe(F.col("observed")))
