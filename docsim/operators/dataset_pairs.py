"""Comparison of the two newest documents of each labelled pair group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from docsim.functions import similarity as S
from docsim.operators.pairs import with_scores
from docsim.sources.corpus import DATASET


def grouped_documents(corpus: DataFrame) -> DataFrame:
    """Dataset documents that belong to a pair group."""
    return corpus.where((F.col("source_type") == DATASET) & (F.col("pair_group") != ""))


def newest_two(corpus: DataFrame) -> DataFrame:
    """The two newest documents of each group, with their rank.

    Spark keeps two rows per group in every map task before the shuffle (window group limit),
    so a group that holds a large part of the table costs no more than a small one.
    """
    newest = Window.partitionBy("pair_group").orderBy(F.desc("uploaded_at"), F.desc("id"))
    return (
        grouped_documents(corpus)
        .select("pair_group", "id", "filename", "processed_text", "expected_label", "uploaded_at")
        .withColumn("rank", F.row_number().over(newest))
        .where("rank <= 2")
    )


def compare_dataset_pairs(corpus: DataFrame) -> DataFrame:
    """One row per group with two documents or more; sorted by similarity, highest first."""

    def ranked(name: str, rank: int) -> Column:
        return F.max(F.when(F.col("rank") == rank, F.col(name)))

    pairs = (
        newest_two(corpus)
        .groupBy("pair_group")
        .agg(
            ranked("id", 1).alias("doc_a_id"),
            ranked("filename", 1).alias("doc_a_name"),
            ranked("processed_text", 1).alias("processed_a"),
            ranked("expected_label", 1).alias("expected_label"),
            ranked("uploaded_at", 1).alias("uploaded_a"),
            ranked("id", 2).alias("doc_b_id"),
            ranked("filename", 2).alias("doc_b_name"),
            ranked("processed_text", 2).alias("processed_b"),
            F.count(F.lit(1)).alias("documents"),
        )
        .where("documents = 2")
    )
    scored = with_scores(pairs).withColumns(
        {
            "expected_meaning": S.label_meaning(F.col("expected_label")),
            "prediction_matches_dataset": S.matches_label(
                F.col("similarity_score"), F.col("expected_label")
            ),
        }
    )
    return scored.orderBy(
        F.desc("similarity_percentage"), F.desc("uploaded_a"), F.desc("doc_a_id")
    ).select(
        "pair_group", "doc_a_id", "doc_a_name", "doc_b_id", "doc_b_name",
        "similarity_score", "similarity_percentage", "cosine_distance", "distance_percentage",
        "status", "expected_label", "expected_meaning", "prediction_matches_dataset",
    )
