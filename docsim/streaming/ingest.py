"""Document ingest from a stream: accepted documents to the corpus, all others to a table of rejects."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from docsim.functions import text as T
from docsim.sources.corpus import CorpusTable
from docsim.sources.ingest import as_uploads

# Why a row is not stored.
NO_ID, WRONG_NAME, LITTLE_CONTENT, DUPLICATE, STORED = "no id", "name", "content", "duplicate", "stored"
REJECT_SCHEMA = "id bigint, filename string, reason string, rows bigint, batch bigint"
ACCEPTED_SCHEMA = "id bigint, row bigint, batch bigint"


def with_reason(documents: DataFrame) -> DataFrame:
    """Rows of ``id, filename, raw_text`` with the ``reason`` not to store them, by their own content, or null.

    ``processed_text`` and ``language`` are made here, once; ``place`` is the fixed order among rows of one id: by
    name, then by a digest of the text.
    """
    named = F.coalesce(T.is_pdf_name(F.col("filename")), F.lit(False))
    prepared = documents.select(
        F.col("id").cast("bigint").alias("id"), "filename", "raw_text",
        T.prepare_text(F.col("raw_text")).alias("processed_text"), T.detect_language(F.col("raw_text")).alias("language"),
    )
    reason = (
        F.when(F.col("id").isNull(), NO_ID)
        .when(~named, WRONG_NAME)
        .when(T.word_count(F.col("processed_text")) < T.MIN_DOCUMENT_TOKENS, LITTLE_CONTENT)
    )
    place = F.concat_ws("|", F.coalesce("filename", F.lit("")), F.sha2(F.coalesce("raw_text", F.lit("")), 256))
    return prepared.withColumns({"reason": reason, "place": place})


def first_of_ids(judged: DataFrame) -> DataFrame:
    """``id, row`` of the first acceptable row of each id: by ``place``, then by ``row``. No text is moved."""
    firsts = judged.where("reason IS NULL").groupBy("id").agg(F.min(F.struct("place", "row")).alias("first"))
    return firsts.select("id", "first.row")


def _accept(judged: DataFrame, number: int, between: Column, accepted: str) -> DataFrame:
    """``id, row`` of the rows of batch ``number`` to store, kept under ``accepted``: no id is accepted in two batches.

    Of the earlier batches only ids ``between`` are read. A batch that is tried again replaces what its first try
    kept.
    """
    earlier = _table(judged.sparkSession, accepted, ACCEPTED_SCHEMA).where((F.col("batch") < number) & between)
    firsts = first_of_ids(judged).join(earlier, "id", "left_anti").withColumn("batch", F.lit(number).cast("bigint"))
    firsts.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(accepted)
    return _table(judged.sparkSession, accepted, ACCEPTED_SCHEMA).where(F.col("batch") == number).select("id", "row")


def _count_rejects(batch: DataFrame, number: int, stored: DataFrame, rejects: str) -> None:
    """Write the batch's rejects and, in a row without reason, how many rows it had.

    A batch that is tried again keeps the rejects of its first try: by then its own documents may be stored.
    """
    if not _reports(batch.sparkSession, rejects).where(F.col("batch") == number).isEmpty():
        return
    before = F.when(F.col("reason").isNull() & F.col("known"), STORED).otherwise(F.col("reason"))
    judged = batch.join(stored.withColumn("known", F.lit(True)), "id", "left").withColumn("reason", before)
    bad = judged.where("reason IS NOT NULL").groupBy("id", "filename", "reason").agg(F.count(F.lit(1)).alias("rows"))
    read = batch.agg(F.count(F.lit(1)).alias("rows")).selectExpr("NULL AS id", "NULL AS filename", "NULL AS reason", "rows")
    report = bad.unionByName(read).withColumn("batch", F.lit(number))
    report.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(rejects)


def stream_into_corpus(
    documents: DataFrame,
    corpus: CorpusTable,
    checkpoint: str,
    rejects: str | None = None,
    available_now: bool = True,
) -> StreamingQuery:
    """Append accepted documents of a stream of ``id, filename, raw_text`` to the corpus.

    Every other row is counted under ``rejects`` (next to the corpus, if not given) with its reason, so rows
    read are documents stored plus rows rejected. A batch that is tried again after a failure is not stored
    or counted twice. An id that the corpus held before is rejected as stored; one that this stream has accepted, as
    a duplicate. The accepted ids are kept by batch as a table in the checkpoint folder, which grows with them.
    """
    rejects = rejects or f"{corpus.folder}-rejects"

    accepted = f"{checkpoint.rstrip('/')}/accepted"

    def store(batch: DataFrame, number: int) -> None:
        batch = batch.withColumn("row", F.monotonically_increasing_id()).persist()
        left_out = None
        try:
            # the texts are moved once, for the rows to store; all else is decided without them
            judged = batch.drop("raw_text", "processed_text")
            span = judged.agg(F.min("id").alias("low"), F.max("id").alias("high")).first()
            # the id range reaches the Parquet scan and skips most of the stored files
            between = F.col("id").between(span["low"], span["high"])
            stored = corpus.read().where(between).select("id").distinct()
            firsts = _accept(judged, number, between, accepted)
            again = F.when(F.col("reason").isNull() & F.col("first").isNull(), DUPLICATE).otherwise(F.col("reason"))
            judged = judged.join(firsts.withColumn("first", F.lit(True)), ["id", "row"], "left").withColumn("reason", again)
            _count_rejects(judged.select("id", "filename", "reason"), number, stored, rejects)
            known = _reports(batch.sparkSession, rejects).where((F.col("batch") == number) & (F.col("reason") == STORED))
            wanted = firsts.join(known.select("id"), "id", "left_anti").join(stored, "id", "left_anti")
            # those left out are few as a rule: once counted, Spark knows their size, and does not move the texts to join them
            left_out = batch.where("reason IS NULL").select("id", "row").join(wanted, ["id", "row"], "left_anti").select("row").persist()
            left_out.count()
            fresh = batch.where("reason IS NULL").join(left_out, "row", "left_anti")
            corpus.save(as_uploads(fresh.select("id", "filename", "raw_text", "processed_text", "language")))
        finally:
            batch.unpersist()
            if left_out is not None:
                left_out.unpersist()

    writer = with_reason(documents).writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def _table(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """A stored table; no rows before it is first written."""
    try:
        return spark.read.schema(schema).parquet(folder)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], schema)
        raise


def _reports(spark: SparkSession, folder: str) -> DataFrame:
    return _table(spark, folder, REJECT_SCHEMA)


def rejected(spark: SparkSession, folder: str) -> DataFrame:
    """``id, filename, reason, rows, batch`` of all rows that were not stored."""
    return _reports(spark, folder).where("reason IS NOT NULL")


def rows_read(spark: SparkSession, folder: str) -> DataFrame:
    """``batch, rows``: the rows of every batch so far."""
    return _reports(spark, folder).where("reason IS NULL").select("batch", "rows")
