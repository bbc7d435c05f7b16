"""Inputs of the registered queries, derived from the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docsim.functions import text as T
from docsim.sources.corpus import corpus_rows
from docsim.sources.ingest import ingest_pairs

FIRST_DATASET_ID = 10_000_000_000
CLOCK_START = "2024-01-01 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def labelled_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document with a thinned copy (label 1) or with the next document (label 0).

    Some second texts are blank and some labels are null or 2, to exercise the filters.
    """
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    # text work follows, so the number of tasks must not follow the bytes
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    number = F.col("doc_id")
    blank, thin = number % 40 == 3, number % 2 == 0
    # a text that no row shows is not moved
    following = documents.select((number - 1).alias("doc_id"), F.col("text").alias("next_text"))
    following = following.withColumn("next_text", F.when(blank | thin, F.lit(None)).otherwise(F.col("next_text"))).repartition(tasks, "doc_id")
    documents = documents.repartition(tasks, "doc_id")
    thinned = F.array_join(F.filter(F.split("text", " "), lambda x, i: i % 5 != 4), " ")
    return documents.join(following, "doc_id").select(
        number.alias("pair_id"),
        number.alias("row_idx"),
        F.col("text").alias("text_a"),
        F.when(blank, F.lit("   "))
        .when(thin, thinned)
        .otherwise(F.col("next_text"))
        .alias("text_b"),
        F.when(number % 20 == 7, F.lit(None))
        .when(number % 50 == 9, F.lit(2))
        .when(number % 2 == 0, F.lit(1))
        .otherwise(F.lit(0))
        .cast("int")
        .alias("label"),
    )


def raw_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The labelled pairs spread over the accepted row layouts."""
    pairs = labelled_pairs(spark, sf_dir)
    layout = F.col("pair_id") % 7
    flat_a = F.translate("text_a", "\n", " ")
    flat_b = F.translate("text_b", "\n", " ")
    label = F.coalesce(F.col("label").cast("string"), F.lit("x"))
    cell = (
        F.when(layout == 0, F.concat("text_a", F.lit("\t\t"), "text_b", F.lit("\t "), label))
        .when(
            layout == 2,
            F.concat(
                F.lit("Sentence 1: "), "text_a", F.lit("\nSENTENCE 2 = "), "text_b",
                F.lit(" label: "), label,
            ),
        )
        .when(layout == 3, F.concat(flat_a, F.lit("\r\n \n"), flat_b, F.lit("\nlabel = 1")))
        .when(layout == 4, flat_a)
        .when(layout == 6, F.concat(F.lit("text1="), flat_a, F.lit(" text2:"), flat_b))
    )

    def only(number: int, value: Column) -> Column:
        return F.when(layout == number, value)

    return pairs.select(
        "row_idx",
        cell.alias("text"),
        only(1, F.col("text_a")).alias("sentence1"),
        only(1, F.col("text_b")).alias("sentence2"),
        only(5, F.col("text_a")).alias("premise"),
        only(5, F.col("text_b")).alias("target"),
        F.when((layout == 1) | (layout == 4), label).alias("label"),
        only(5, F.concat(F.lit(" "), label, F.lit(" "))).alias("labels"),
    )


def _clock(seconds: Column) -> Column:
    return F.timestamp_seconds(F.unix_timestamp(F.lit(CLOCK_START)) + seconds)


def uploads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents table as uploaded files."""
    number = F.col("doc_id")
    return table(spark, sf_dir, "documents").select(
        number.alias("id"),
        F.when(number % 10 == 4, F.concat(F.lit("notes "), number, F.lit(".txt")))
        .when(number % 10 == 5, F.concat(F.lit("My File "), number, F.lit(".PDF")))
        .otherwise(F.concat(F.lit("doc_"), number, F.lit(".pdf")))
        .alias("filename"),
        F.col("text").alias("raw_text"),
    )


def repeated_uploads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The uploads, some of them again under a name that is accepted, some under one that is not, some without id."""
    once = uploads(spark, sf_dir)
    again = F.concat(F.lit("again "), F.col("id"), F.lit(".pdf"))
    nameless = once.where("id % 9 = 0").withColumn("filename", F.lit("x.txt"))
    without_id = once.where("id % 11 = 0").withColumn("id", F.lit(None).cast("bigint"))
    return once.unionByName(once.where("id % 7 IN (0, 4)").withColumn("filename", again)).unionByName(nameless).unionByName(without_id)


def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Uploads (all documents) plus two dataset documents per labelled pair.

    Among the groups are some with one document (the other one has an empty group) and some
    with four.
    """
    uploaded = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("id"),
        F.concat(F.lit("doc_"), F.col("doc_id"), F.lit(".pdf")).alias("filename"),
        F.col("text").alias("raw_text"),
        T.prepare_text(F.col("text")).alias("processed_text"),
        T.detect_language(F.col("text")).alias("language"),
        F.lit("upload").alias("source_type"),
        F.lit(None).cast("int").alias("expected_label"),
        F.lit(None).cast("string").alias("pair_group"),
    )
    loaded = ingest_pairs(labelled_pairs(spark, sf_dir), FIRST_DATASET_ID)
    number = F.floor((F.col("id") - FIRST_DATASET_ID) / 2)
    is_b = (F.col("id") % 2) == 1
    grouped = loaded.withColumn(
        "pair_group",
        F.when((number % 50 == 11) & is_b, F.lit(""))
        .when(number % 50 == 12, F.format_string("dataset_pair_%03d", number + 2))
        .otherwise(F.col("pair_group")),
    )
    return corpus_rows(
        uploaded.unionByName(grouped),
        _clock(F.when(F.col("id") >= FIRST_DATASET_ID, F.col("id") - FIRST_DATASET_ID).otherwise(F.col("id"))),
    )


def uploaded_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents table alone, as a corpus."""
    number = F.col("doc_id")
    return corpus_rows(
        table(spark, sf_dir, "documents").select(
            number.alias("id"),
            F.concat(F.lit("doc_"), number, F.lit(".pdf")).alias("filename"),
            F.col("text").alias("raw_text"),
            T.prepare_text(F.col("text")).alias("processed_text"),
            T.detect_language(F.col("text")).alias("language"),
        ),
        _clock(F.col("id")),
    )
