"""A training corpus in five stages, each written and read again before the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from docsim.llm import decontaminate, mixing, simhash, token_shards, toxicity
from docsim.llm.queries import domain_labels, table
from docsim.session import written

#: Shares of tokens after toxic documents have gone; ``keep_all`` grows the poorer domain only.
TARGETS = {"good": 0.8, "poor": 0.2}


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model does not reject; it learns from the labelled rows among all documents."""
    model = toxicity.train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return toxicity.without_toxic(docs, model)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return simhash.keep_one(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages."""
    return docs.where(~decontaminate.contaminated_column(table(spark, sf_dir, "benchmark"), "text"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated so that the domains' tokens meet the targets; every document stays once at least."""
    labels = domain_labels(table(spark, sf_dir, "labels")).where("domain IN ('good', 'poor')")
    return mixing.remix(docs, labels, TARGETS, keep_all=True)


def token_records(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token shards in training order, listed by sequence."""
    return token_shards.materialise(docs)


STAGES = [
    ("toxicity", without_toxic),
    ("simhash near-dedup", without_near_copies),
    ("benchmark decontamination", without_benchmark),
    ("mixing sources", mixed),
    ("token-id output", token_records),
]

#: Trained scores and tokenisers have no SQL; the tests hold ``run`` against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
