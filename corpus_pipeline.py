"""The documents table made ready for training: five stages, each written and read again by the next.

``run`` applies them to ``documents``. A stage works on all rows that its predecessor kept.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from outcomekit.llm import jaccard, mixing, perplexity, sharding, tiling
from outcomekit.session import scratch_dir, staged_run

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that a model of trusted text finds unlike it."""
    return perplexity.keep_likely(docs, _table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similarity 0.8 or more on shingles of five words."""
    return jaccard.one_of_each(docs, size=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that hold a benchmark item."""
    return tiling.without_leaks(docs, _table(spark, sf_dir, "benchmark"))


def mixing_to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents chosen by the weights of their domain, language and source; once for each pass."""
    return mixing.mix_documents(docs).select(*docs.columns)


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows with their shard and slot."""
    return sharding.shard_documents(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", quality),
    ("ngram_jaccard_join", near_duplicates),
    ("benchmark_decontamination", decontamination),
    ("mixing_to_target_weights", mixing_to_weights),
    ("sharding", sharded),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the last stage; every other one is written to the shared folder and read again.

    What a stage stages on the way is deleted when its rows are written.
    """
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = f"{scratch_dir(spark).rstrip('/')}/corpus-pipeline/{uuid.uuid4().hex}/{name}"
        with staged_run(spark) as release:
            stage(spark, docs, sf_dir).write.parquet(path)
            release()
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)


#: Model training, token prefixes of seeded passes and sampled splitters are beyond SQL.
ORACLE_SQL = None

QUERIES = {"pipeline": run}
ORACLES = {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
