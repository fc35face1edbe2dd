"""Layered configuration documents: merge, inheritance, assignment, substitution, rendering.

Documents are small and stay on the driver as plain dicts; `leaves` gives the tabular form, and `merged_leaves`
merges in that form.
"""

from __future__ import annotations

import copy
import json
from pathlib import PurePosixPath
from string import Template
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


class ConfigError(ValueError):
    """A configuration that can't be resolved."""


def merge(base: Any, override: Any) -> Any:
    """`override` over `base`: mappings merge key by key, everything else (lists too) is replaced."""
    if not (isinstance(base, dict) and isinstance(override, dict)):
        return copy.deepcopy(override)
    out = {k: copy.deepcopy(v) for k, v in base.items() if k not in override}
    return out | {k: merge(base[k], v) if k in base else copy.deepcopy(v) for k, v in override.items()}


def layered(documents: dict[str, dict], name: str, key: str = "_base") -> dict:
    """A document over its chain of bases (relative names resolve beside the document); a cycle is an error."""
    chain: list[str] = []
    at: str | None = name
    while at is not None:
        if at in chain:
            raise ConfigError("inheritance cycle: " + " -> ".join([*chain, at]))
        if at not in documents:
            raise ConfigError(f"no document {at}")
        chain.append(at)
        base = documents[at].get(key)
        at = None if base is None else base if base in documents else str(PurePosixPath(at).parent / base)
    out: dict = {}
    for at in reversed(chain):
        out = merge(out, {k: v for k, v in documents[at].items() if k != key})
    return out


def assigned(document: dict, assignments: list[str]) -> dict:
    """The document with `a.b.c=value` applied in order; values are read as YAML scalars where that module exists."""
    out = copy.deepcopy(document)
    for one in assignments:
        path, eq, text = one.partition("=")
        if not eq or not all(path.split(".")):
            raise ConfigError(f"not an assignment: {one}")
        *up, last = path.split(".")
        at = out
        for k in up:
            at = at.setdefault(k, {})
            if not isinstance(at, dict):
                raise ConfigError(f"{path}: {k} is no mapping")
        at[last] = typed(text)
    return out


def typed(text: str) -> Any:
    try:
        import yaml
    except ImportError:
        try:
            return json.loads(text)
        except ValueError:
            return {"true": True, "false": False, "null": None, "~": None, "": None}.get(text.lower(), text)
    return yaml.safe_load(text)


def substituted(value: Any, variables: dict[str, str]) -> Any:
    """${name} replaced in every string; an unknown name is an error."""
    if isinstance(value, dict):
        return {k: substituted(v, variables) for k, v in value.items()}
    if isinstance(value, list):
        return [substituted(v, variables) for v in value]
    if isinstance(value, str):
        try:
            return Template(value).substitute(variables)
        except KeyError as e:
            raise ConfigError(f"unknown variable {e.args[0]}") from None
    return value


def rendered(value: Any) -> str:
    if isinstance(value, bool):
        return str(value).lower()
    return json.dumps(value, separators=(",", ":")) if isinstance(value, list | dict) else str(value)


def flags(prefix: str, values: dict, skip: frozenset[str] = frozenset(), whole: frozenset[str] = frozenset({"tfs"})) -> list[str]:
    """--prefix.key=value for every leaf; nulls, empty lists and skipped paths have none, `whole` keys stay one value."""
    out = []
    for k, v in values.items():
        path = f"{prefix}.{k}" if prefix else k
        if path in skip or v is None or v == []:
            continue
        out += flags(path, v, skip, whole) if isinstance(v, dict) and k not in whole else [f"--{path}={rendered(v)}"]
    return out


def switch(name: str, on: bool) -> str:
    return f"--{name}" if on else f"--no-{name}"


def canonical(value: Any) -> str:
    """The form that is hashed: sorted keys, no white space."""
    return json.dumps(value, sort_keys=True, separators=(",", ":"))


def leaves(spark: SparkSession, documents: dict[str, dict]) -> DataFrame:
    """(document, path, value as JSON) of every leaf."""
    rows: list[tuple[str, str, str]] = []

    def walk(name: str, path: str, value: Any) -> None:
        if isinstance(value, dict) and value:
            for k, v in value.items():
                walk(name, f"{path}.{k}" if path else k, v)
        else:
            rows.append((name, path, json.dumps(value)))

    for name, d in documents.items():
        walk(name, "", d)
    return spark.createDataFrame(rows, "document string, path string, value string")


def merged_leaves(layers: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Of (keys, layer number, path, value): the value of the highest layer for each path, dropping a lower layer's leaves
    above or below a higher layer's (a leaf replaces a mapping and the reverse)."""
    keys = keys or []
    top = layers.withColumn("n", F.row_number().over(Window.partitionBy(*keys, "path").orderBy(F.desc("layer")))).where("n = 1").drop("n")
    parts = F.split("path", r"\.")
    up = top.select(
        *keys,
        F.col("layer").alias("l"),
        F.explode(F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.concat_ws(".", F.slice(parts, 1, n)))).alias("p"),
        F.col("path").alias("of")
    )
    up = up.where("p <> of")
    above = top.select(*keys, "layer", F.col("path").alias("p"))
    lower = up.join(above, [*keys, "p"])  # leaf `p` against leaf `of` below it
    hidden = lower.select(*keys, F.when(F.col("l") > F.col("layer"), F.col("p")).otherwise(F.col("of")).alias("path")).distinct()
    return top.join(hidden, [*keys, "path"], "left_anti")


def chains(links: DataFrame) -> DataFrame:
    """Of (child, parent): (name, chain array, cyclic) for every name; a cyclic chain ends with the first name it holds twice.

    Each round appends to an open chain the chain of its last name, which doubles its length, so rounds are as many as
    the logarithm of the longest chain."""
    names = links.select(F.col("child").alias("name")).union(links.select("parent")).distinct()
    up = links.select(F.col("child").alias("c"), F.col("parent").alias("p")).where("p is not null").distinct()
    at = names.join(up, F.col("name") == F.col("c"), "left")
    at = at.select("name", F.when(F.col("p").isNull(), F.array("name")).otherwise(F.array("name", "p")).alias("chain"), F.col("p").isNull().alias("ended"))
    at, open_ones = _cut(at).checkpoint(), 1
    while open_ones:
        ways = at.select(F.col("name").alias("last"), F.col("chain").alias("way"), F.col("ended").alias("way_ended"))
        longer = at.where("not ended").join(ways, F.element_at("chain", -1) == F.col("last"))
        longer = longer.select("name", F.concat("chain", F.slice("way", F.lit(2), F.size("way"))).alias("chain"), F.col("way_ended").alias("ended"))
        at = at.where("ended").unionByName(_cut(longer).distinct()).checkpoint()
        open_ones = at.where("not ended").count()
    return at.select("name", "chain", "cyclic")


def _cut(at: DataFrame) -> DataFrame:
    """Chains up to the first name that they hold twice, which ends them."""
    again = F.filter(F.transform("chain", lambda x, i: F.when(F.array_position("chain", x) <= i, i + 1)), lambda i: i.isNotNull())
    out = at.withColumn("until", F.get(again, F.lit(0))).withColumn("cyclic", F.col("until").isNotNull())
    whole = F.slice("chain", F.lit(1), F.coalesce("until", F.size("chain")))
    return out.select("name", whole.alias("chain"), "cyclic", (F.col("ended") | F.col("cyclic")).alias("ended"))


def alias_value(values: Column, names: list[str]) -> Column:
    """Of a map, the value of the first name that is present, even if it is null."""
    out = F.lit(None)
    for n in reversed(names):
        out = F.when(F.map_contains_key(values, n), F.element_at(values, F.lit(n))).otherwise(out)
    return out
