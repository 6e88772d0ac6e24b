"""From raw documents to packed training sequences, stage by stage.

Every stage takes what the stage before it kept, as a written table, and returns a DataFrame; all but
the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tallystone.llm import language, mixing, near_dedup, packing, toxicity
from tallystone.llm.queries import TOXICITY_CHAIN, VOCABULARY
from tallystone.sources.tables import stage


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learn from the labelled documents among the input and drop those predicted toxic."""
    models = toxicity.train_chain(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), TOXICITY_CHAIN)
    return toxicity.without_toxic(docs, models, TOXICITY_CHAIN)


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learn the languages from the ``lang`` column and drop documents in none of them."""
    labelled = docs.filter(~language.held_out())
    prototypes = language.learn_prototypes(labelled)
    return language.in_known_language(docs, prototypes, language.least_scores(labelled, prototypes))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near duplicates."""
    return near_dedup.without_near_duplicates(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat and sample documents so that the sources meet their target weights."""
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encode the documents and place their pieces in sequences."""
    return packing.pack_documents(docs, public_tokenizers.path(VOCABULARY))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", reject_toxic),
    ("language", keep_known_languages),
    ("near_duplicates", drop_near_duplicates),
    ("mixing", mix_sources),
    ("packing", pack),
]

# Trained models and tokenizers are beyond SQL; tests compare with a brute-force run instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}").df
    return STAGES[-1][1](spark, docs, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
