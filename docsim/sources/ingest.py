"""From pages, documents and labelled pairs to corpus rows."""

from __future__ import annotations

import random
import re
from collections.abc import Iterable, Iterator
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docsim.functions import text as T
from docsim.operators.pairs import both_long_enough, with_prepared
from docsim.sources.corpus import DATASET, UPLOAD

# The last start of a random window and lengths of previews.
LAST_RANDOM_START = 300_000
PREVIEW_ROWS = 3
CELL_PREVIEW = 250
TEXT_PREVIEW = 100
# Most files whose offsets are broadcast: a path and a number each.
MAX_BROADCAST_FILES = 100_000


def window_start(seed: int | None = None, last_start: int = LAST_RANDOM_START) -> int:
    """A random start, both ends included; the same seed gives the same start."""
    return random.Random(seed).randint(0, last_start)


def window_rows(rows: DataFrame, start: int, limit: int, index_col: str = "row_idx") -> DataFrame:
    """``limit`` consecutive rows from ``start``; the row index counts from 0 again."""
    if limit < 1 or start < 0:
        raise ValueError("limit must be at least 1 and start at least 0")
    inside = rows.where((F.col(index_col) >= start) & (F.col(index_col) < start + limit))
    return inside.withColumn(index_col, F.col(index_col) - start)


def with_row_index(parquet_rows: DataFrame, index_col: str = "row_idx") -> DataFrame:
    """Number the rows of a Parquet scan from 0, in file order.

    Positions inside a file come with the scan, and offsets are summed over one row per file. Up to
    ``MAX_BROADCAST_FILES`` files the offsets are broadcast, so no row is sorted or moved.
    """
    few = len(parquet_rows.inputFiles()) <= MAX_BROADCAST_FILES
    placed = parquet_rows.select(
        "*",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.row_index").alias("_position"),
    )
    offsets = (
        placed.groupBy("_file")
        .agg(F.count(F.lit(1)).alias("n"))
        .selectExpr(
            "_file",
            "coalesce(sum(n) over (order by _file rows between unbounded preceding and 1 preceding), 0)"
            " as _offset",
        )
    )
    return (
        placed.join(F.broadcast(offsets) if few else offsets, "_file")
        .withColumn(index_col, F.col("_offset") + F.col("_position"))
        .drop("_file", "_position", "_offset")
    )


def _path_of(file: str) -> str:
    """A file's path without scheme and host, which Spark writes in more than one way."""
    return re.sub(r"^[A-Za-z][\w+.-]*:(//[^/]*)?", "", unquote(file))


def _rows_of_files(spark: SparkSession, files: list[str]) -> dict[str, int]:
    """Rows of Parquet files, from their footers: no column is read."""
    counts = spark.read.parquet(*files).groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count(F.lit(1)).alias("n"))
    return {_path_of(row["file"]): row["n"] for row in counts.collect()}


def read_window(spark: SparkSession, path: str, start: int, limit: int, index_col: str = "row_idx") -> DataFrame:
    """``limit`` rows of a Parquet table from row ``start`` on, numbered from 0, in file order.

    Footers tell which files hold the window, and only these are scanned. Files are asked in order, more each
    time, and none after the window's end, so a head opens the first file alone.
    """
    if limit < 1 or start < 0:
        raise ValueError("limit must be at least 1 and start at least 0")
    whole = spark.read.parquet(path)
    files = sorted(whole.inputFiles(), key=_path_of)
    chosen: list[str] = []
    seen = first = at = 0
    step = 1
    while at < len(files) and seen < start + limit:
        asked = files[at : at + step]
        counts = _rows_of_files(spark, asked)
        for file in asked:
            rows = counts.get(_path_of(file), 0)
            if rows and seen < start + limit and seen + rows > start:
                first = first if chosen else seen
                chosen.append(file)
            seen += rows
        at, step = at + step, step * 4
    if not chosen:
        return with_row_index(whole, index_col).where(F.lit(False))
    rows = with_row_index(spark.read.schema(whole.schema).parquet(*chosen), index_col)
    return window_rows(rows.withColumn(index_col, F.col(index_col) + first), start, limit, index_col)


def _joined_pages(stream: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows (document, text) to one row per document; only the document at hand is held."""
    document, pages, kind = None, [], pa.null()
    for batch in stream:
        kind = batch.column(0).type
        keys, texts = [], []
        for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if pages and key != document:
                keys.append(document)
                texts.append("\n".join(pages))
                pages = []
            document = key
            pages.append(text)
        if keys:
            yield pa.RecordBatch.from_arrays([pa.array(keys, kind), pa.array(texts, pa.string())], names=["document", "text"])
    if pages:
        last = [pa.array([document], kind), pa.array(["\n".join(pages)], pa.string())]
        yield pa.RecordBatch.from_arrays(last, names=["document", "text"])


def assemble_pages(
    pages: DataFrame, doc_col: str = "doc_id", page_col: str = "page_no", text_col: str = "text"
) -> DataFrame:
    """``doc_col, raw_text``: page texts in page order, a line break after each, ends trimmed.

    Rows are sorted by document and page, which spills to disk, and joined in one pass, so a document of very
    many pages takes the memory of its text and no list of rows is built.
    """
    kind = pages.schema[doc_col].dataType.simpleString()
    placed = pages.select(
        F.col(doc_col).alias("document"), F.col(page_col).alias("page"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )
    ordered = placed.repartition("document").sortWithinPartitions("document", "page", "text")
    joined = ordered.select("document", "text").mapInArrow(_joined_pages, f"document {kind}, text string")
    return joined.select(F.col("document").alias(doc_col), T.strip_spaces(F.col("text")).alias("raw_text"))


def ingest_documents(documents: DataFrame) -> DataFrame:
    """Accept ``id, filename, raw_text`` rows as uploaded documents.

    The name must end with ``.pdf`` and the text must have enough content. Every step works on
    one row, so the same function serves a batch and a stream.
    """
    prepared = documents.where(T.is_pdf_name(F.col("filename"))).withColumns(
        {"processed_text": T.prepare_text(F.col("raw_text")), "language": T.detect_language(F.col("raw_text"))}
    )
    return as_uploads(prepared.where(T.word_count(F.col("processed_text")) >= T.MIN_DOCUMENT_TOKENS))


def as_uploads(prepared: DataFrame) -> DataFrame:
    """Accepted rows of ``id, filename, raw_text, processed_text, language`` as uploaded documents."""
    return prepared.withColumns({"filename": T.safe_filename(F.col("filename")), "source_type": F.lit(UPLOAD)})


def prepared_pairs(pairs: DataFrame, index_col: str = "row_idx", languages: bool = False) -> DataFrame:
    """Pairs with prepared texts (and their languages), a 1-based row number and whether the row will be saved."""
    return with_prepared(pairs, languages).withColumns(
        {
            "row_number": (F.col(index_col) + 1).cast("bigint"),
            "saved": both_long_enough(),
        }
    )


def ingest_pairs(pairs: DataFrame, first_id: int = 0, index_col: str = "row_idx") -> DataFrame:
    """Each accepted pair becomes two documents that share a ``pair_group``.

    Numbers in names count skipped rows too. ``uploaded_at`` is left to the caller; side B is
    saved after side A, and ids follow that order.
    """
    accepted = prepared_pairs(pairs, index_col, languages=True).where("saved")

    def side(letter: str, offset: int) -> Column:
        raw, prepared = f"text_{letter.lower()}", f"processed_{letter.lower()}"
        return F.struct(
            (F.lit(first_id) + F.col(index_col) * 2 + offset).cast("bigint").alias("id"),
            F.format_string(f"dataset_%03d_{letter}.txt", "row_number").alias("filename"),
            F.col(raw).alias("raw_text"),
            F.col(prepared).alias("processed_text"),
            F.col(f"language_{letter.lower()}").alias("language"),
        )

    return accepted.select(
        F.explode(F.array(side("A", 0), side("B", 1))).alias("side"),
        F.lit(DATASET).alias("source_type"),
        F.col("label").cast("int").alias("expected_label"),
        F.format_string("dataset_pair_%03d", "row_number").alias("pair_group"),
    ).select("side.*", "source_type", "expected_label", "pair_group")


def ingest_summary(
    pairs: DataFrame, limit: int, start: int = 0, dataset_name: str = "", index_col: str = "row_idx"
) -> DataFrame:
    """One row: what was asked for, where it started, documents saved and rows skipped of these rows."""
    return prepared_pairs(window_rows(pairs, start, limit, index_col), index_col).agg(
        F.lit(dataset_name).alias("dataset_name"),
        F.lit(limit).alias("requested_pairs"),
        F.lit(start).alias("start_index"),
        (F.count_if(F.col("saved")) * 2).alias("saved_documents"),
        F.count_if(~F.col("saved")).alias("skipped_rows"),
    )


def ingest_preview(
    rows: DataFrame, pairs: DataFrame, index_col: str = "row_idx", cell_col: str = "text"
) -> DataFrame:
    """The first rows with their column names and the start of each text."""
    columns = F.array(*[F.lit(name) for name in rows.columns if name != index_col])
    cells = rows.where(F.col(index_col) < PREVIEW_ROWS).select(
        index_col,
        (T.preview(F.col(cell_col), CELL_PREVIEW) if cell_col in rows.columns else F.lit("")).alias(
            "text_preview"
        ),
    )
    return (
        pairs.where(F.col(index_col) < PREVIEW_ROWS)
        .join(cells, index_col)
        .select(
            (F.col(index_col) + 1).cast("bigint").alias("row"),
            columns.alias("available_columns"),
            "text_preview",
            T.preview(F.col("text_a"), TEXT_PREVIEW).alias("sentence1_preview"),
            T.preview(F.col("text_b"), TEXT_PREVIEW).alias("sentence2_preview"),
            "label",
        )
    )
