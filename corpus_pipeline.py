"""A corpus pipeline of five stages: toxicity, near duplicates, decontamination, mixing, sharding.

Every stage takes (spark, docs, sf_dir) and works on all that its predecessor kept. Null or empty texts pass all filters
(they are scored like any text, link with nothing and match no benchmark item). Of rows that are equal or near copies one
stays, whatever their doc_id; a clean text that shares its doc_id, or a null one, with a copy stays too. Extra columns pass
through all stages; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evalspark.llm import decontaminate, jaccard_join, mixing, sharding, toxicity
from evalspark.llm.shared import helper, materialize, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.reject(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays, the one of least doc_id: five-word shingles, similarity 0.8 or more."""
    return jaccard_join.deduplicate(docs, n=5, percent=80)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document at least once; those of smaller sources again, up to the limit on repeats."""
    held = {c: helper(docs, f"held_{c}") for c in ("n_tokens", "epoch", "block", "order_key") if c in docs.columns}
    mixed = mixing.mix(docs.withColumnsRenamed(held))
    return mixed.select(*(F.col(f"`{held.get(c, c)}`").alias(c) for c in docs.columns))


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sharding.place(docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", drop_near_duplicates),
    ("benchmark_decontamination", drop_benchmark_leaks),
    ("source_mixing", mix_sources),
    ("sharding", shard),
]

ORACLE_SQL = None  # a trained model decides in the first stage


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
