"""A corpus pipeline of five stages over `documents`; each stage's result is written as Parquet and is the next one's docs.

1. language_id: rows without letters go; no score is too low to stay.
2. near_duplicates: one row of each group of near duplicates (sets of five-word shingles, Jaccard similarity from 0.8)
   stays, the one with the smallest id.
3. decontamination: rows that hold a benchmark window go.
4. mixing: each source is taken to its target, whole copies first, then a Pareto order sample.
5. token_output: what is left, as binary shards of token ids, read back per row.

Null, empty and blank texts go in the first stage, as they have no letters.  Null ids pass: in the second stage rows without id are
told apart by their texts (one of equal ones stays), elsewhere they are rows like any.  Null languages don't train, a null
source is a source of its own.  Repeated rows are near duplicates of each other; those of one id stay together.  Very long
texts are whole in every stage.  An empty table, or one that a stage leaves empty, ends in no rows.  Extra columns are kept up to the
fourth stage, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from episodica.llm import decontaminate, jaccard_join, language_id, mixing, store, token_output

#: Words of a shingle, and similarity in percent from which two documents are near copies, in the second stage.
SHINGLE, PERCENT = 5, 80


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    store.bounded_batches(spark)
    return language_id.keep_known(docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    store.bounded_batches(spark)
    return jaccard_join.keep_one(docs, size=SHINGLE, percent=PERCENT)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    store.bounded_batches(spark)
    return decontaminate.remove(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    store.bounded_batches(spark)
    return mixing.mixture(docs)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    store.bounded_batches(spark)
    return token_output.report(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
    ("token_output", token_stage),
]

#: Learned profiles and token ids can't be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        kept = store.written(stage(spark, docs, sf_dir), name)
        store.forget(docs)
        docs = kept
    return STAGES[-1][1](spark, docs, sf_dir)
