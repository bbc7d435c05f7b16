"""The document corpus: one table, its schema, and its maintenance.

The functions take and return DataFrames; :class:`CorpusTable` keeps the table as partitioned Parquet.
"""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as Ty

from docsim.session import written

CORPUS_SCHEMA = Ty.StructType(
    [
        Ty.StructField("id", Ty.LongType()),
        Ty.StructField("filename", Ty.StringType()),
        Ty.StructField("raw_text", Ty.StringType()),
        Ty.StructField("processed_text", Ty.StringType()),
        Ty.StructField("language", Ty.StringType()),
        Ty.StructField("source_type", Ty.StringType()),
        Ty.StructField("expected_label", Ty.IntegerType()),
        Ty.StructField("pair_group", Ty.StringType()),
        Ty.StructField("uploaded_at", Ty.TimestampType()),
    ]
)

# Defaults, source names.
DEFAULT_LANGUAGE = "unknown"
UPLOAD = "upload"
DATASET = "dataset"
# Buckets of ids in a stored corpus, and the most that the Bloom filter of a row group takes, which is as large as its ids need.
BUCKETS = 16
BLOOM_BYTES = 1 << 17


def corpus_rows(
    documents: DataFrame, uploaded_at: Column | None = None, raw_length: int | None = None
) -> DataFrame:
    """Rows as the corpus stores them: defaults set, time stamped.

    Missing optional columns become null or their default. The raw text is kept whole unless
    ``raw_length`` asks for its beginning; the prepared text is never cut.
    """
    have = set(documents.columns)

    def optional(name: str, default: Column) -> Column:
        return F.coalesce(F.col(name), default) if name in have else default

    stamp = uploaded_at if uploaded_at is not None else optional("uploaded_at", F.current_timestamp())
    values = {
        "id": F.col("id"),
        "filename": F.col("filename"),
        "raw_text": F.col("raw_text") if raw_length is None else F.substring("raw_text", 1, raw_length),
        "processed_text": F.col("processed_text"),
        "language": optional("language", F.lit(DEFAULT_LANGUAGE)),
        "source_type": optional("source_type", F.lit(UPLOAD)),
        "expected_label": optional("expected_label", F.lit(None)),
        "pair_group": optional("pair_group", F.lit(None)),
        "uploaded_at": stamp,
    }
    return documents.select(
        *[values[field.name].cast(field.dataType).alias(field.name) for field in CORPUS_SCHEMA]
    )


def newest_first(corpus: DataFrame) -> DataFrame:
    """All documents, newest first; the higher id wins a tie in time."""
    return corpus.orderBy(F.desc("uploaded_at"), F.desc("id"))


def display_rows(corpus: DataFrame) -> DataFrame:
    """The corpus with ``uploaded_at`` as ISO 8601 text."""
    whole = F.date_format("uploaded_at", "yyyy-MM-dd'T'HH:mm:ss")
    fraction = F.date_format("uploaded_at", ".SSSSSS")
    return corpus.withColumn(
        "uploaded_at", F.concat(whole, F.when(fraction == ".000000", F.lit("")).otherwise(fraction))
    )


def document_by_id(corpus: DataFrame, doc_id: int) -> DataFrame:
    """The document with this id, or no row. The filter reaches the Parquet scan."""
    return corpus.where(F.col("id") == F.lit(doc_id))


def without_documents(corpus: DataFrame, ids: DataFrame) -> DataFrame:
    """The corpus without the documents listed in ``ids(id)``."""
    return corpus.join(ids.select("id").distinct(), "id", "left_anti").select(*corpus.columns)


def deletion_report(corpus: DataFrame, ids: DataFrame) -> DataFrame:
    """``id, existed`` for every asked id."""
    found = corpus.select("id").distinct().withColumn("existed", F.lit(True))
    return (
        ids.select("id")
        .distinct()
        .join(found, "id", "left")
        .select("id", F.coalesce("existed", F.lit(False)).alias("existed"))
    )


def without_dataset(corpus: DataFrame) -> DataFrame:
    """Only the documents that do not come from a labelled dataset."""
    return corpus.where(F.coalesce(F.col("source_type") != DATASET, F.lit(True)))


def corpus_counts(corpus: DataFrame) -> DataFrame:
    """One row: all documents and documents of the dataset."""
    return corpus.agg(
        F.count(F.lit(1)).alias("total_documents"),
        F.count_if(F.coalesce(F.col("source_type") == DATASET, F.lit(False))).alias("dataset_documents"),
    )


class CorpusTable:
    """A corpus kept as Parquet under a folder, in partitions of ``source_type`` and a bucket of the id.

    Deleting rewrites the partitions that hold one of the ids and leaves the files of all others as they
    are: Spark's dynamic partition overwrite replaces the partitions that a job writes. A partition that
    loses its last document is written with a row without id, which ``read`` leaves out; documents without id
    are not stored. Spark stages the new files and puts them in place when the whole job has succeeded,
    partition by partition, so one writer at a time may delete; what was read before a delete must be used
    before it.

    A partition has a file for every task that wrote rows of it. Files are sorted by id and carry a Bloom filter
    on it, so a lookup reads one bucket and in it only the row groups that may hold the id. The number of buckets
    is part of the name of the partition column; a folder is opened with the number it was made with.
    """

    def __init__(self, spark: SparkSession, folder: str, buckets: int = BUCKETS):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self.buckets = buckets
        self.bucket_col = f"id_bucket_of_{buckets}"

    def _bucket(self, id_column: Column) -> Column:
        return F.pmod(F.xxhash64(id_column.cast("bigint")), F.lit(self.buckets)).cast("int")

    def _stored(self) -> DataFrame:
        """All rows with their bucket, placeholders included; no rows before the first save."""
        empty = self.spark.createDataFrame([], CORPUS_SCHEMA).withColumn(self.bucket_col, F.lit(0))
        try:
            stored = self.spark.read.schema(CORPUS_SCHEMA).parquet(self.folder)
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return empty
            raise
        if self.bucket_col in stored.columns:
            return stored.select(*empty.columns)
        if set(stored.columns) - set(CORPUS_SCHEMA.fieldNames()):
            raise ValueError(f"{self.folder} was made with another number of buckets than {self.buckets}")
        return empty  # cleared

    def _placed(self, rows: DataFrame) -> DataFrame:
        """Rows of the corpus with their bucket, in the order of the files.

        Texts stay in their tasks: bringing partitions together took as much disk as the texts of the corpus.
        """
        placed = rows.withColumn(self.bucket_col, self._bucket(F.col("id"))) if self.bucket_col not in rows.columns else rows
        return placed.sortWithinPartitions("source_type", self.bucket_col, "id")

    def _write(self, rows: DataFrame, mode: str, overwrite: str = "static") -> None:
        """Write rows of the corpus; every task writes its rows of a partition to files sorted by id."""
        (
            self._placed(rows)
            .write.mode(mode)
            .option("partitionOverwriteMode", overwrite)
            .option("compression", "zstd")
            .option("parquet.bloom.filter.enabled#id", "true")
            .option("parquet.bloom.filter.adaptive.enabled", "true")
            .option("parquet.bloom.filter.max.bytes", str(BLOOM_BYTES))
            .partitionBy("source_type", self.bucket_col)
            .parquet(self.folder)
        )

    def _replace(self, kept: DataFrame, touched: list[tuple[str, int]]) -> None:
        """Write ``kept`` as the new content of the ``touched`` partitions."""
        names = [name for name in CORPUS_SCHEMA.fieldNames() if name != "source_type"]
        marks = self.spark.createDataFrame(touched, f"source_type string, {self.bucket_col} int")
        marks = marks.select("*", *[F.lit(None).cast(CORPUS_SCHEMA[name].dataType).alias(name) for name in names])
        self._write(kept.unionByName(marks), "overwrite", "dynamic")

    def _partitions(self, rows: DataFrame) -> list[tuple[str, int]]:
        """The partitions that rows lie in: at most ``buckets`` for each source."""
        return [tuple(row) for row in rows.select("source_type", self.bucket_col).distinct().collect()]

    def read(self) -> DataFrame:
        """All stored documents; an empty table before the first save."""
        return self._stored().where("id IS NOT NULL").select(*CORPUS_SCHEMA.fieldNames())

    def save(self, documents: DataFrame) -> None:
        """Append documents, with the defaults of :func:`corpus_rows`; rows without id are left out."""
        self._write(corpus_rows(documents).where("id IS NOT NULL"), "append")

    def get(self, doc_id: int) -> DataFrame:
        """The document with this id, or no row: one bucket is read."""
        bucket = self._bucket(F.lit(doc_id))
        found = document_by_id(self._stored().where(F.col(self.bucket_col) == bucket), doc_id)
        return found.select(*CORPUS_SCHEMA.fieldNames())

    def delete(self, ids: DataFrame) -> int:
        """Delete the documents of ``ids(id)``; returns how many of these ids existed."""
        stored = self._stored()
        asked = ids.select("id").where("id IS NOT NULL").distinct().withColumn(self.bucket_col, self._bucket(F.col("id")))
        found = written(stored.select("id", "source_type", self.bucket_col).join(asked, ["id", self.bucket_col], "left_semi"), "found")
        touched = self._partitions(found)
        if touched:
            inside = [(F.col("source_type") == source) & (F.col(self.bucket_col) == bucket) for source, bucket in touched]
            rows = stored.where(reduce(Column.__or__, inside)).where("id IS NOT NULL")
            self._replace(rows.join(found.select("id"), "id", "left_anti"), touched)
        return found.select("id").distinct().count()

    def clear(self) -> int:
        """Delete everything; returns how many documents there were."""
        total = self.read().count()
        self._write(self.spark.createDataFrame([], CORPUS_SCHEMA), "overwrite")
        return total

    def clear_dataset(self) -> int:
        """Delete the dataset documents only; returns how many there were."""
        dataset = self._stored().where(F.col("source_type") == DATASET)
        total = dataset.where("id IS NOT NULL").count()
        if total:
            self._replace(dataset.where(F.lit(False)), self._partitions(dataset))
        return total

    def counts(self) -> DataFrame:
        return corpus_counts(self.read())
